"""Collocations by a weighted de Bruijn graph of word pairs.

Nodes are pairs of neighbouring words within a piece of text; an edge joins the
pairs w1 w2 and w2 w3 and weighs as much as the three words occur. Only edges
are counted. A pair occurs as often as weight leaves its node, and once more for
every piece that ends with it; a word occurs as often as weight leaves the
pairs it begins, and once more for every piece that ends with it.

Rows of edges are kept few in two ways. Each task counts what it reads before
anything is shuffled. And a first pass counts hashes of pairs: a pair whose
hash is rarer than a candidate may be is rarer itself, so edges from it are
counted under its first word alone. Hashes that meet only make such a pair
kept; counts are always those of the words themselves.

Among the edges as frequent as a candidate, paths through nodes with one edge
in and one out are compacted into one row, by contracting nodes whose hash is
less than their neighbours' in rounds. Some nodes, chosen by hash, always end
a path, which bounds the length of a row. Phrases of three words are then read
off the paths, whose rows hold the counts of the pairs within.

Rows: a null or empty text has no words; a null language is ``und``. Repeated
rows count each. The ids of documents are not used. Very long texts are
handled in stretches that end where a piece ends. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.llm.common import in_chunks, pick, stored
from voltatlas.llm.wordhash import mix, runs

#: Least count of a candidate, share of its count (in hundredths) from which a longer one hides it, and phrases of a language.
LEAST, HIDDEN_BY, FIRST = 10, 50, 2000
#: Bytes of text, hashes of pairs and different rows that a Python task handles at once.
BYTES_AT_ONCE, PAIRS_AT_ONCE, ROWS_AT_ONCE = 4_000_000, 4_000_000, 300_000
#: Bits of the pair filter: so many for each frequent pair, within these bounds. A full filter keeps more pairs, and changes no count.
BITS_PER_PAIR, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28
#: Words of 64 bits of the filter that come to the driver as one row.
WORDS_AT_ONCE = 8_192
#: One node in so many ends a path whatever its edges.
PATH_ENDS = 128
#: Parts a language's candidates are first ranked in.
RANK_PARTS = 256

#: Bytes between pieces (2), between words (1) and within words (0).
_KIND = np.zeros(256, dtype=np.int8)
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_KIND[list(b" \t")] = 1
#: A-Z as a-z, and the tab as a space.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t", b"abcdefghijklmnopqrstuvwxyz ")


def stretches(data: bytes, most: int = BYTES_AT_ONCE) -> Iterator[bytes]:
    """The bytes in stretches that end where a piece ends, each as long as allowed or a single piece."""
    if len(data) <= most:
        yield data
        return
    ends = np.flatnonzero(_KIND[np.frombuffer(data, dtype=np.uint8)] == 2) + 1
    start = 0
    while start < len(data):
        at = int(np.searchsorted(ends, start + most, side="right")) - 1
        if at < 0 or ends[at] <= start:
            at += 1  # no piece ends within the stretch: it goes on to the end of its piece
        end = int(ends[at]) if at < len(ends) else len(data)
        yield data[start:end]
        start = end


class Stretch:
    """Words of a stretch of text in one language, whether others follow in the piece, and a hash of each pair."""

    def __init__(self, lang: str, data: bytes):
        self.lang, self.data = lang, data
        codes = np.frombuffer(data, dtype=np.uint8)
        kind = _KIND[codes]
        self.start, self.end, hashes = runs(codes, kind == 0)
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.start]
        self.second = np.append(piece[1:] == piece[:-1], False) if len(piece) else np.zeros(0, dtype=bool)
        self.third = np.append(self.second[1:], False) & self.second if len(piece) else self.second
        own = np.uint64(int.from_bytes(lang.encode()[:64], "little") % (1 << 61))
        self.pairs = mix(mix(hashes + own) * np.uint64(3) + np.append(hashes[1:], hashes[:1]))


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Stretch]:
    """The stretches of batches of lang and text."""
    for chunk in in_chunks(batches):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist()):
            if text:
                by_lang.setdefault(lang, []).append(text.encode())
        for lang, texts in by_lang.items():
            for data in stretches(b"\n".join([*texts, b""]).translate(_PLAIN)):
                yield Stretch(lang, data)


def texts_of(docs: DataFrame) -> DataFrame:
    return pick(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def frequent_pairs(docs: DataFrame, least: int) -> DataFrame:
    """Hashes of pairs that occur often enough, each once; written once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = 0

        def counted() -> pa.RecordBatch:
            pair, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(times.astype(np.int32))], ["pair", "times"])

        for stretch in read(batches):
            held.append(stretch.pairs[stretch.second])
            total += len(held[-1])
            if total >= PAIRS_AT_ONCE:
                yield counted()
                held, total = [], 0
        if held:
            yield counted()

    # Counted by the tasks as far as they see, so the shuffle comes before any further counting.
    made = texts_of(docs).mapInArrow(task, "pair long, times int").repartition("pair")
    return stored(made.groupBy("pair").agg(F.sum("times").alias("times")).where(F.col("times") >= least).select("pair"), "pairs")


def pair_filter(pairs: DataFrame) -> np.ndarray:
    """A bit table with two bits set for each pair: at most MOST_BITS bits, whatever the number of pairs.

    Tasks put its words together to stretches of bytes, so the driver holds the table and one partition's stretches, and no row per word.
    """
    bits = min(max(LEAST_BITS, 1 << (BITS_PER_PAIR * pairs.count()).bit_length()), MOST_BITS)
    table = np.zeros(bits // 64, dtype=np.uint64)
    size = min(WORDS_AT_ONCE, len(table))

    def task(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        words = np.zeros(size, dtype=np.uint64)
        words[rows["word"].to_numpy() % size] = rows["bits"].to_numpy().view(np.uint64)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([words.tobytes()], pa.binary())})

    both = F.explode(F.array(F.col("pair").bitwiseAND(F.lit(bits - 1)),
                             F.shiftrightunsigned("pair", 32).bitwiseAND(F.lit(bits - 1))))
    found = pairs.select(both.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).groupBy(
        F.floor(F.col("word") / size).cast("long").alias("part")).applyInArrow(task, "part long, words binary")
    for row in stored(found, "filter").toLocalIterator():
        table[row["part"] * size:(row["part"] + 1) * size] = np.frombuffer(row["words"], dtype=np.uint64)
    return table


def passes(table: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    bits = np.uint64(len(table) * 64 - 1)
    out = np.ones(len(pairs), dtype=bool)
    for place in (pairs & bits, (pairs >> np.uint64(32)) & bits):
        out &= (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


def rows_of(stretch: Stretch, table: np.ndarray) -> Iterator[bytes]:
    """A row for each word: three words; two words and a space, where the piece ends after them; or a word alone,
    where the piece ends after it or the pair it begins is rare."""
    data, start, end = stretch.data, stretch.start, stretch.end
    known = stretch.second & passes(table, stretch.pairs)
    length = np.append(end - start, [0, 0])
    for places, words in ((known & stretch.third, 3), (known & ~stretch.third, 2), (~known, 1)):
        at = np.flatnonzero(places)
        first, last = start[at], end[at + words - 1]
        tight = last - first == sum(length[at + n] for n in range(words)) + words - 1  # one space between words
        closing = b" " if words == 2 else b""
        for one, two in zip(first[tight].tolist(), last[tight].tolist()):
            yield data[one:two] + closing
        for one, two in zip(first[~tight].tolist(), last[~tight].tolist()):
            yield b" ".join(filter(None, data[one:two].split(b" "))) + closing


def edge_counts(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """lang, gram and a: how often each row of ``rows_of`` comes; written once."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter), pa.string()), pa.array(list(counter), pa.binary()).cast(pa.string()),
                     pa.array(list(counter.values()), pa.int64())], ["lang", "gram", "times"])

        for stretch in read(batches):
            held.setdefault(stretch.lang, Counter()).update(rows_of(stretch, shared.value))
            if sum(map(len, held.values())) >= ROWS_AT_ONCE:
                yield from counted()
                held = {}
        yield from counted()

    made = texts_of(docs).mapInArrow(task, "lang string, gram string, times long").repartition("lang", "gram")
    return stored(made.groupBy("lang", "gram").agg(F.sum("times").alias("a")), "edges")


def head(gram: str, words: int):
    """The first words of a row."""
    return F.substring_index(gram, " ", words)


def node_counts(edges: DataFrame, least: int) -> DataFrame:
    """lang, node and f: the pairs that are frequent enough, by the weight that leaves them and the pieces that end with them."""
    return edges.where(F.contains("gram", F.lit(" "))).groupBy("lang", head("gram", 2).alias("node")).agg(
        F.sum("a").alias("f")).where(F.col("f") >= least)


def word_counts(edges: DataFrame) -> DataFrame:
    """lang, word and f: every word, by the weight that leaves its pairs and the pieces that end with it; written once."""
    return stored(edges.groupBy("lang", head("gram", 1).alias("word")).agg(F.sum("a").alias("f")), "words")


def strong_edges(edges: DataFrame, least: int) -> DataFrame:
    """lang, first and last node, words and weight of the edges that are candidates; written once."""
    whole = (F.col("a") >= least) & (head("gram", 2) != F.col("gram")) & ~F.endswith("gram", F.lit(" "))
    return stored(edges.where(whole).select(
        "lang", head("gram", 2).alias("first"), F.substring_index("gram", " ", -2).alias("last"),
        F.split("gram", " ").alias("words"), "a"), "strong-edges")


def vertices_of(edges: DataFrame, strong: DataFrame, least: int) -> DataFrame:
    """lang, node, f, the greatest weight of an edge at the node (most), and whether paths go on through it (open)."""
    ends = strong.select("lang", F.col("first").alias("node"), "a", F.lit(0).alias("ins"), F.lit(1).alias("outs")).union(
        strong.select("lang", F.col("last").alias("node"), "a", F.lit(1).alias("ins"), F.lit(0).alias("outs")))
    degrees = ends.groupBy("lang", "node").agg(F.max("a").alias("most"), F.sum("ins").alias("ins"), F.sum("outs").alias("outs"))
    through = (F.col("ins") == 1) & (F.col("outs") == 1) & (F.pmod(F.xxhash64("node"), F.lit(PATH_ENDS)) > 0)
    return stored(node_counts(edges, least).join(degrees, ["lang", "node"], "left").select(
        "lang", "node", "f", "most", F.coalesce(through, F.lit(False)).alias("open")), "vertices")


PATH = ("first", "last", "words", "weights", "inner", "first_f", "last_f", "first_open", "last_open")


def compacted(strong: DataFrame, vertices: DataFrame) -> DataFrame:
    """Paths: words, weights of the edges in order, and counts of the nodes between them and at both ends.

    In a round a path goes to the end that it may go on through, of two such
    ends to the one with the lesser hash; a node at which two paths meet joins
    them. The least node of all always does, so rounds come to an end, also on circles.
    """
    at = lambda end: vertices.select(
        "lang", F.col("node").alias(end), F.col("f").alias(f"{end}_f"), F.col("open").alias(f"{end}_open"))
    left = stored(strong.join(at("first"), ["lang", "first"]).join(at("last"), ["lang", "last"]).select(
        "lang", "first", "last", "words", F.array("a").alias("weights"), F.array().cast("array<bigint>").alias("inner"),
        *PATH[5:]), "paths")
    order = lambda end: F.struct(F.xxhash64(end, F.lit(3)), F.col(end))
    goal = F.when(F.col("first") == F.col("last"), None).when(
        F.col("last_open") & (~F.col("first_open") | (order("last") < order("first"))), F.col("last")).when(
        F.col("first_open"), F.col("first"))
    done = []
    while True:
        aimed = left.withColumn("at", goal)
        done.append(aimed.where("at is null").drop("at"))
        moving = aimed.where("at is not null")
        if moving.isEmpty():
            return reduce(DataFrame.union, done)
        whole = F.struct(*PATH)
        met = moving.groupBy("lang", "at").agg(
            F.first(F.when(F.col("last") == F.col("at"), whole), ignorenulls=True).alias("before"),
            F.first(F.when(F.col("first") == F.col("at"), whole), ignorenulls=True).alias("after"))
        both = F.col("before").isNotNull() & F.col("after").isNotNull()
        joined = F.struct(
            F.col("before.first").alias("first"), F.col("after.last").alias("last"),
            F.concat("before.words", F.slice("after.words", F.lit(3), F.size("after.words"))).alias("words"),
            F.concat("before.weights", "after.weights").alias("weights"),
            F.concat("before.inner", F.array("before.last_f"), "after.inner").alias("inner"),
            F.col("before.first_f").alias("first_f"), F.col("after.last_f").alias("last_f"),
            F.col("before.first_open").alias("first_open"), F.col("after.last_open").alias("last_open"))
        left = stored(met.select("lang", F.when(both, joined).otherwise(F.coalesce("before", "after")).alias("path")).select(
            "lang", *(F.col(f"path.{name}").alias(name) for name in PATH)), "paths")


def candidates(paths: DataFrame, vertices: DataFrame, hidden_by: int) -> DataFrame:
    """lang, phrase, a, its first and last word, and for three words the counts of its first and last pair."""
    steps = paths.select("*", F.posexplode("weights").alias("i", "a"))
    word = lambda n: F.get("words", F.col("i") + n)
    three = steps.select(
        "lang", F.concat_ws(" ", word(0), word(1), word(2)).alias("phrase"), "a", word(0).alias("one"), word(2).alias("other"),
        F.when(F.col("i") == 0, F.col("first_f")).otherwise(F.get("inner", F.col("i") - 1)).alias("left_pair"),
        F.when(F.col("i") == F.size("weights") - 1, F.col("last_f")).otherwise(F.get("inner", F.col("i"))).alias("right_pair"))
    two = vertices.where(F.coalesce(100 * F.col("most") < hidden_by * F.col("f"), F.lit(True))).select(
        "lang", F.col("node").alias("phrase"), F.col("f").alias("a"), head("node", 1).alias("one"),
        F.substring_index("node", " ", -1).alias("other"), F.lit(None).cast("bigint").alias("left_pair"),
        F.lit(None).cast("bigint").alias("right_pair"))
    return three.union(two)


def scored(found: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """lang, phrase, a, l, r and score, by the cut with the lowest score; whole-number arithmetic of 38 digits."""
    count = lambda word, name: words.where(F.col("f") >= least).select(
        "lang", F.col("word").alias(word), F.col("f").alias(name))
    wide = lambda name: f"cast({name} as decimal(20,0))"
    score = lambda l, r: F.expr(f"(1000000 * {wide('a')} * {wide('a')}) div ({wide(l)} * {wide(r)})")  # noqa: E731,E741
    rows = found.join(count("one", "one_f"), ["lang", "one"]).join(count("other", "other_f"), ["lang", "other"])
    rows = rows.withColumn("early", score("one_f", "coalesce(right_pair, other_f)")).withColumn(
        "late", F.when(F.col("left_pair").isNotNull(), score("left_pair", "other_f")))
    by_late = F.coalesce(F.col("late") < F.col("early"), F.lit(False))
    return rows.select(
        "lang", "phrase", "a", F.when(by_late, F.col("left_pair")).otherwise(F.col("one_f")).alias("l"),
        F.when(by_late, F.col("other_f")).otherwise(F.coalesce("right_pair", "other_f")).alias("r"),
        F.when(by_late, F.col("late")).otherwise(F.col("early")).alias("score"))


def ranked(found: DataFrame, words: DataFrame, first: int) -> DataFrame:
    """The first phrases of each language; ranked in parts first, so that no task holds a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= first)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, least: int = LEAST, hidden_by: int = HIDDEN_BY, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first phrases of each language."""
    edges = edge_counts(docs, pair_filter(frequent_pairs(docs, least)))
    words = word_counts(edges)
    strong = strong_edges(edges, least)
    vertices = vertices_of(edges, strong, least)
    found = candidates(compacted(strong, vertices), vertices, hidden_by)
    return ranked(scored(found, words, least), words, first)
