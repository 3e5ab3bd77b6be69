from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import GIVEN, ODD, documents
from voltatlas.llm import shingle_join
from voltatlas.llm.wordhash import shingles, words_of

SPACES = " \t\n\x0b\x0c\r"


def shingle_set(text: str | None) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in SPACES else c for c in text or "")
    words = [word for word in lower.split(" ") if word]
    if not words:
        return frozenset()
    return frozenset(zip(*(words[n:] for n in range(5)))) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows: list[tuple]) -> Counter:
    """(doc_id, set size, least id reachable) by comparing all pairs."""
    sets = [shingle_set(row[1]) for row in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least: dict = {}
    for n, row in enumerate(rows):
        if row[0] is not None:
            least[find(n)] = min(least.get(find(n), row[0]), row[0])
    return Counter((row[0], len(sets[n]), least.get(find(n)) if sets[n] else row[0]) for n, row in enumerate(rows))


def copies(seed: int, groups: int = 6) -> list[tuple]:
    """Near copies at all degrees of likeness, a passage many share, and groups of exact copies."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("rstuvw") + str(rng.randrange(40))
    passage = " ".join(word() for _ in range(30))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 6, 12, 40, 90, 200]))]
        for _ in range(rng.choice([2, 5, 25])):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(own) // 12)):
                own[rng.randrange(len(own))] = word()
            text = " ".join(own)
            rows.append(text if rng.random() < 0.6 else f"{passage} {text}")
        rows += [" ".join(base).upper()] * 3
    rng.shuffle(rows)
    return [(n * 3, text, "en", "s") for n, text in enumerate(rows)]


def result(df) -> Counter:
    return Counter((row.doc_id, row.n_shingles, row.component_id) for row in df.collect())


@pytest.mark.parametrize("seed,frequent,often", [(1, 32, 3), (2, 6, 2), (3, 2, 1), (4, 3, 1)])
def test_against_all_pairs(spark, monkeypatch, seed, frequent, often):
    """Low limits make most tokens frequent, so the links must come from combinations."""
    monkeypatch.setattr(shingle_join, "FREQUENT_SETS", frequent)
    monkeypatch.setattr(shingle_join, "OFTEN", often)
    rows = copies(seed)
    assert result(shingle_join.classes(documents(spark, rows))) == brute(rows)


def test_linked_sets_share_a_key():
    """Whatever tokens count as frequent, sets that link have a key in common."""
    rng = np.random.default_rng(7)
    for _ in range(1500):
        n = int(rng.choice([3, 4, 5, 8, 9, 16, 31, 64, 130, 400]))
        pool = rng.integers(1, 2 ** 63, 3 * n, dtype=np.uint64)
        one = np.unique(pool[:n])
        drop = int(rng.integers(0, n // 4 + 1))
        two = np.unique(np.concatenate([rng.permutation(one)[drop:], pool[n:n + int(rng.integers(0, n // 3 + 1))]]))
        frequent = np.sort(pool[rng.random(len(pool)) < rng.choice([0, 0.3, 0.7, 0.95, 1])])
        common = len(np.intersect1d(one, two))
        if 4 * common >= 3 * (len(one) + len(two) - common) and not np.array_equal(one, two):
            keys = [set(np.concatenate(shingle_join.keys_of(side, frequent)).tolist()) for side in (one, two)]
            assert keys[0] & keys[1], (n, len(one), len(two), common)


def test_keys_stay_in_proportion():
    tokens = np.unique(np.random.default_rng(1).integers(1, 2 ** 63, 20_000, dtype=np.uint64))
    single, combined = shingle_join.keys_of(tokens, tokens)
    assert len(single) == 0 and len(combined) < 4 * len(tokens)


def test_hashed_shingles_are_the_shingles():
    texts = [row[1] for row in ODD] + ["a b c d", "A b  C\td", "a b c d e", "a b c d e a b c d e f", "É é É é É é"]
    found = shingles(words_of(texts), 5)
    assert [len(tokens) for tokens in found] == [len(shingle_set(text)) for text in texts]
    signatures = [shingle_join.signature(tokens) for tokens in found]
    for a in range(len(texts)):
        for b in range(a):
            assert (signatures[a] == signatures[b]) == (shingle_set(texts[a]) == shingle_set(texts[b]))


def test_rows(spark):
    assert result(shingle_join.classes(documents(spark, ODD))) == brute(ODD)
    assert shingle_join.classes(documents(spark, [])).collect() == []
    only_empty = [(1, None, "en", "a"), (2, "  ", "en", "a")]
    assert result(shingle_join.classes(documents(spark, only_empty))) == Counter({(1, 0, 1): 1, (2, 0, 2): 1})


def test_given_documents(spark):
    docs = spark.read.parquet(f"{GIVEN}/sf0.001/documents.parquet")
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    assert result(shingle_join.classes(docs)) == brute(rows)


def test_one_of_each(spark):
    rows = copies(9) + [(1, None, "en", "a"), (2, "", "en", "a"), (None, "no id at all", "en", "a")]
    rows += [(0, rows[0][1], "en", "s")] * 2  # rows that repeat an id and its text
    least = {doc: low for doc, _, low in brute(rows)}
    stay = shingle_join.one_of_each(documents(spark, rows))
    assert stay.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert Counter(row.doc_id for row in stay.collect()) == Counter(
        {doc: 1 for doc in {row[0] for row in rows} if doc is None or least[doc] == doc})
    assert shingle_join.one_of_each(documents(spark, [])).collect() == []


def test_an_id_with_two_texts(spark):
    """Rows are judged one by one: the near copy goes, the text that nothing resembles stays, and so on."""
    words = [f"w{n}" for n in range(100)]
    a, near, other = " ".join(words), " ".join(words[:95]), " ".join(f"u{n}" for n in range(30))
    rows = [(1, a, "en", "s"), (2, near, "en", "s"), (2, other, "en", "s"), (2, other, "de", "s"), (2, None, "en", "s"),
            (5, near, "en", "s"), (5, " ".join(words[:94]), "en", "t"), (7, other.upper(), "en", "s")]
    stay = shingle_join.one_of_each(documents(spark, rows)).collect()
    assert Counter((row.doc_id, row.text, row.lang) for row in stay) == Counter([(1, a, "en"), (2, other, "de"), (2, None, "en")])
    twice = [(3, a, "en", "s"), (3, near, "en", "s"), (4, near, "en", "s")]  # two texts of one class under its least id: one of them
    stay = shingle_join.one_of_each(documents(spark, twice)).collect()
    assert len(stay) == 1 and stay[0].doc_id == 3 and stay[0].text in (a, near)


def extended(seed: int, pairs: int = 150) -> list[tuple]:
    """Pairs that nothing else resembles: a text, and the same text cut or carried on to a likeness of 0.72 to 0.85."""
    rng = random.Random(seed)
    rows = []
    for pair in range(pairs):
        words = [f"p{pair}w{n}" for n in range(rng.choice([20, 36, 70, 140, 300]))]
        kept = 4 + round((len(words) - 4) * rng.uniform(0.72, 0.85))
        rows += [" ".join(words), " ".join(words[:kept])]
    rng.shuffle(rows)
    return [(n, text, "en", "s") for n, text in enumerate(rows)]


@pytest.mark.parametrize("hot", [64, 1])
def test_texts_cut_or_carried_on(spark, monkeypatch, hot):
    """One text's prefix tokens lie beyond the other's prefix; with a low limit of hot keys the pairs come from blocks."""
    monkeypatch.setattr(shingle_join, "HOT_KEY", hot)
    monkeypatch.setattr(shingle_join, "ROUNDS", 0)
    rows = extended(5)
    assert result(shingle_join.classes(documents(spark, rows))) == brute(rows)


def test_sets_without_an_id_link(spark):
    """Texts 3 and 9 are linked only through a text without an id; another one gets the id of its near copy."""
    words = [f"w{n}" for n in range(104)]
    rows = [(3, words[:84]), (None, words[:96]), (9, words[12:]), (None, [f"v{n}" for n in range(60)]),
            (7, [f"v{n}" for n in range(58)])]
    rows = [(doc, " ".join(text), "en", "s") for doc, text in rows]
    expected = brute(rows)
    assert (9, 88, 3) in expected and (None, 56, 7) in expected
    assert result(shingle_join.classes(documents(spark, rows))) == expected
