from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import GIVEN, ODD, documents, plain_rows
from voltatlas.llm import phrases


def brute(rows: list[tuple], least: int = 10, hidden_by: int = 50, first: int = 2000) -> list[tuple]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda hit: hit.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            for size in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(a for gram, a in f.items() if len(gram) == 1)
        strong = {gram: a for gram, a in f.items() if len(gram) > 1 and a >= least}
        found = []
        for gram, a in strong.items():
            if any(len(longer) > len(gram) and 100 * b >= hidden_by * a and gram in (longer[:2], longer[1:])
                   for longer, b in strong.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram)))
            found.append((-score, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        out += [(lang, rank, phrase.decode(), -a, left, right, n, -score)
                for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1)]
    return sorted(out)


def mined(df, **how) -> list[tuple]:
    return sorted(map(tuple, phrases.mine(df, **how).collect()))


def small(seed: int, rows: int = 60) -> list[tuple]:
    """Random texts of few words, with common passages, circles, odd blanks and piece ends."""
    rng = random.Random(seed)
    passage = " ".join(f"p{n}" for n in range(40))
    out = []
    for n in range(rows):
        words = [rng.choice(["a", "B", "c", "dé", "É", "x\x00", "漢"]) for _ in range(rng.randint(0, 40))]
        text = "".join(word + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", " \t ", ",", " "]) for word in words)
        if n % 3 == 0:
            text += passage
        if n % 5 == 0:
            text += " u v u v u v u v" + rng.choice(["", "!"])
        out.append((n, text, rng.choice(["en", "en", "fr", None, "und"]), "s"))
    return out


@pytest.mark.parametrize("seed, least, first", [(1, 2, 2000), (2, 3, 7), (3, 1, 2000)])
def test_like_counting_every_phrase(spark, monkeypatch, seed, least, first):
    rows = small(seed)
    if seed == 2:  # few parts, small chunks and a filter that is full: the result stays
        for name, value in (("BYTES_AT_ONCE", 50), ("ROWS_AT_ONCE", 20), ("PAIRS_AT_ONCE", 20), ("LEAST_BITS", 64), ("MOST_BITS", 64)):
            monkeypatch.setattr(phrases, name, value)
    expected = brute([(row[1], row[2]) for row in rows], least, first=first)
    assert expected and mined(documents(spark, rows).repartition(3), least=least, first=first) == expected


def test_odd_rows(spark):
    rows = ODD * 3
    assert mined(documents(spark, rows), least=3) == brute([(row[1], row[2]) for row in rows], 3)
    assert mined(documents(spark, [])) == [] and mined(documents(spark, [(1, None, None, None), (2, "", "en", "a")])) == []


def test_given_documents(spark):
    docs = spark.read.parquet(f"{GIVEN}/sf0.001/documents.parquet")
    assert mined(docs) == brute([(row.text, row.lang) for row in docs.collect()])


def test_paths(spark):
    """A passage is one path; a circle ends where it began; a node that always ends a path cuts it."""
    words = [f"w{n}" for n in range(60)]
    rows = [(n, " ".join(words), "en", "s") for n in range(4)] + [(9, "r s t r s t r s t r s", "de", "s")] * 3
    docs = documents(spark, rows)
    edges = phrases.edge_counts(docs, phrases.pair_filter(phrases.frequent_pairs(docs, 2)))
    strong = phrases.strong_edges(edges, 2)
    vertices = phrases.vertices_of(edges, strong, 2)
    paths = phrases.compacted(strong, vertices).collect()
    long = sorted((row for row in paths if row.lang == "en"), key=lambda row: int(row.words[0][1:]))
    cuts = vertices.where("lang = 'en' and not open").count() - 2  # but for both ends of the passage
    assert len(long) == cuts + 1
    assert long[0].words + [word for row in long[1:] for word in row.words[2:]] == words
    for row in paths:
        assert len(row.words) == len(row.weights) + 2 == len(row.inner) + 3
        assert row.lang == "de" or set(row.weights + row.inner + [row.first_f, row.last_f]) == {4}
    assert sum(len(row.weights) for row in paths if row.lang == "de") == 3


def test_hash_of_pairs_never_loses_one():
    stretch = phrases.Stretch("en", b"a b c. a b\na  b c")
    table = np.zeros(1, dtype=np.uint64)
    assert sorted(phrases.rows_of(stretch, table)) == sorted([b"a", b"b", b"c", b"a", b"b", b"a", b"b", b"c"])
    full = ~table
    assert sorted(phrases.rows_of(stretch, full)) == sorted(
        [b"a b c", b"b c ", b"c", b"a b ", b"b", b"a b c", b"b c ", b"c"])


def test_stretches():
    data = b"aa bb. cc dd\nee" + b"f" * 30 + b", gg. hh"
    for most in (1, 5, 10, 100):
        found = list(phrases.stretches(data, most))
        assert b"".join(found) == data
        assert all(part[-1:] in (b".", b"\n", b",") for part in found[:-1])


def test_long_text(spark):
    text = "one two three four " * 60_000 + "end." + "y" * 200_000
    found = mined(documents(spark, [(1, text, "en", "a")]))
    assert {row[2] for row in found} >= {"one two three", "four one two"} and found[0][6] == 240_002
    assert plain_rows(phrases.mine(documents(spark, [(1, text, "en", "a")]), least=10 ** 6)) == []


def test_filter_comes_to_the_driver_in_bytes(spark):
    """The table holds both bits of each pair and no others; the driver makes no object for each of its words."""
    made = spark.range(400_000).selectExpr("xxhash64(id) as pair")
    pairs = np.array([row.pair for row in made.collect()], dtype=np.int64).view(np.uint64)
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")  # a session that build_session has not set up
    tracemalloc.start()
    try:
        table = phrases.pair_filter(made)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    assert len(table) == 1 << 17 and most < 8_000_000
    expected = np.zeros(len(table), dtype=np.uint64)
    for place in (pairs, pairs >> np.uint64(32)):
        place = place & np.uint64(64 * len(table) - 1)
        np.bitwise_or.at(expected, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    assert (table == expected).all() and phrases.passes(table, pairs).all()
    assert not phrases.pair_filter(made.limit(0)).any()
