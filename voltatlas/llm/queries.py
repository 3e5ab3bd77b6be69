"""The operators of this subpackage as registered queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltatlas.llm import (
    bpe, grid_join, host_rules, language, mixing, packing, phrases, pii, quality, sharding, shingle_join, toxicity, whitening)
from voltatlas.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    """The public vocabulary the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), vocabulary())


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.learn(docs))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.rate(docs, toxicity.learn(docs, table(spark, folder, "labels")))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.rate(docs, quality.learn(docs, table(spark, folder, "labels")))


def op5_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.judge(table(spark, folder, "documents"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents"))


def op8_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.classes(table(spark, folder, "documents"))


def op9_grid_join(spark: SparkSession, folder: str) -> DataFrame:
    return grid_join.near_copies(table(spark, folder, "embeddings"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), vocabulary())


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_language": op2_language,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_host_rules": op5_host_rules,
    "op6_mixing": op6_mixing,
    "op7_sharding": op7_sharding,
    "op8_shingle_join": op8_shingle_join,
    "op9_grid_join": op9_grid_join,
    "op10_pii": op10_pii,
    "op11_phrases": op11_phrases,
    "op12_whitening": op12_whitening,
    "op13_packing": op13_packing,
}

#: DuckDB SQL for the same rows, where SQL can express the method.
ORACLE_SQL: dict[str, str] = {
    "op5_host_rules": r"""
WITH raw AS (
  SELECT row_number() OVER () AS i, doc_id, source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT i, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
         generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS n
  FROM raw
), windows AS (
  SELECT * FROM (
    SELECT i, n, word, lead(word) OVER w AS second, lead(word, 2) OVER w AS third
    FROM words WINDOW w AS (PARTITION BY i ORDER BY n)) WHERE third IS NOT NULL
), repeated AS (
  SELECT i, n FROM (SELECT i, n, count(*) OVER (PARTITION BY i, word, second, third) AS times FROM windows)
  WHERE times > 1
), covered AS (
  SELECT i, count(DISTINCT n + step) AS n_repeat_words FROM repeated, (VALUES (0), (1), (2)) s(step) GROUP BY i
), counted AS (
  SELECT i, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY i
), lines AS (
  SELECT i, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT i, unnest(string_split(text, chr(10))) AS line FROM raw)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY i
), measures AS (
  SELECT doc_id, source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM raw LEFT JOIN counted USING (i) LEFT JOIN lines USING (i) LEFT JOIN covered USING (i)
), hosts AS (
  SELECT source, rule, count(*) AS n, sum(failed::INT) AS k FROM (
    SELECT source, unnest(['short', 'repeating', 'symbols', 'copied_lines']) AS rule,
           unnest([n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words,
                   10 * n_dup_lines > n_words]) AS failed
    FROM measures WHERE source IS NOT NULL) GROUP BY source, rule
), moments AS (
  SELECT rule, sum(k) / sum(n) AS mean, var_pop(k / n) AS variance FROM hosts GROUP BY rule
), priors AS (
  SELECT rule, mean, CASE WHEN variance > 0
    THEN least(greatest(mean * (1 - mean) / variance - 1, 2), 10000) ELSE 10000 END AS weight FROM moments
), rejected AS (
  SELECT DISTINCT source FROM hosts JOIN priors USING (rule)
  JOIN (VALUES ('short', 0.8), ('repeating', 0.5), ('symbols', 0.5), ('copied_lines', 0.5)) l(rule, most) USING (rule)
  WHERE (k + mean * weight) / (n + weight) > most
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND coalesce(source NOT IN (SELECT source FROM rejected), true) AS kept
FROM measures
""",
    "op11_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split
), grams AS MATERIALIZED (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, lang || chr(10) || phrase AS key, count(*) AS f
  FROM places, (VALUES (1), (2), (3)) s(size) WHERE i + size - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM grams WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1 AND f >= 10
), longest AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM candidates WHERE size = 3)
  GROUP BY lang, part
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM candidates c LEFT JOIN longest o ON o.lang = c.lang AND o.part = c.phrase, (VALUES (1), (2)) s(k)
  WHERE k < c.size AND NOT (c.size = 2 AND coalesce(100 * o.most >= 50 * c.a, false))
), scores AS (
  SELECT u.lang, u.phrase, u.a, u.k, x.f AS l, y.f AS r,
         ((1000000::HUGEINT * u.a * u.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts u JOIN grams x ON x.key = u.lang || chr(10) || u.head JOIN grams y ON y.key = u.lang || chr(10) || u.rest
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       n::BIGINT AS n, score
FROM lowest JOIN totals USING (lang) QUALIFY rank <= 2000
""",
    "op9_grid_join": """
WITH RECURSIVE usable AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS i, vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.i AS a, b.i AS b, b.vec_id FROM usable a JOIN usable b
    ON a.i <> b.i AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached(i, j, vec_id) AS (
  SELECT a, b, vec_id FROM links UNION SELECT r.i, l.b, l.vec_id FROM reached r JOIN links l ON l.a = r.j
), least AS (
  SELECT i, min(vec_id) AS vec_id FROM reached GROUP BY i
), counted AS (
  SELECT a AS i, count(*) AS n FROM links GROUP BY a
), found AS (
  SELECT u.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(u.vec_id, coalesce(l.vec_id, u.vec_id)) AS component_id
  FROM usable u LEFT JOIN least l USING (i) LEFT JOIN counted USING (i)
  UNION ALL
  SELECT vec_id, 0, vec_id FROM embeddings WHERE vec_id IS NULL OR embedding IS NULL OR len(embedding) = 0
    OR len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0
    OR len(list_filter(embedding, lambda x: x <> 0)) = 0
)
SELECT vec_id, n_links, component_id, coalesce(vec_id = component_id, false) AS kept FROM found
""",
}
