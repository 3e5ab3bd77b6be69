from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.llm.helpers import GIVEN, ODD, documents
from voltatlas.llm import host_rules

SPACES = " \t\n\x0b\x0c\r"


def brute(text: str | None) -> tuple:
    text = text or ""
    words = "".join(" " if c in SPACES else c for c in text).split(" ")
    words = [word for word in words if word]
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    windows = [tuple(words[n:n + 3]) for n in range(len(words) - 2)]
    times = Counter(windows)
    covered = {n + step for n, window in enumerate(windows) if times[window] > 1 for step in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    more = [(100, "a b c a b c a", "x", "s"), (101, "a a a a a", "x", "s"), (102, "l1\nl1 \nl1\n\n \nl1", "x", "s"),
            (103, "#*$ %&| <> é漢 \U0001f600", "x", "s"), (104, "a b c d a b c a b", "x", "s")]
    texts = [*ODD, *more]
    found = host_rules.judge(documents(spark, texts)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((row.doc_id, *(row[n] for n in names)) for row in found) == Counter((i, *brute(t)) for i, t, *_ in texts)
    for row in found:
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert not (row.kept and row.base_failed)
    assert host_rules.judge(documents(spark, [])).collect() == []


@pytest.mark.parametrize("bits, around", [(61, 64), (61, 1), (62, 2), (8, 64)])
def test_windows_whose_hashes_meet(spark, monkeypatch, bits, around):
    """With three hash bits, or two, nearly all windows meet others; words decide, in any order and run length."""
    monkeypatch.setattr(host_rules, "LEAST_POSITION_BITS", bits)
    monkeypatch.setattr(host_rules, "LOOK_AROUND", around)
    rng = random.Random(bits + around)
    texts = ["w1866339 a b w56396 a b w1866339 a b", "a b " * 300 + "c d e", " ".join(f"w{n}" for n in range(400))]
    texts += [" ".join(rng.choice("abcd") * rng.randint(1, 2) for _ in range(rng.randint(0, 300))) for _ in range(40)]
    found = host_rules.judge(documents(spark, [(n, text, "en", "s") for n, text in enumerate(texts)])).collect()
    assert {row.doc_id: row.n_repeat_words for row in found} == {n: brute(text)[4] for n, text in enumerate(texts)}


def test_a_text_of_seventeen_million_words(spark, tmp_path):
    """More words than 24 bits can number; all but the last ones stand in repeated windows."""
    count = (1 << 24) + 10
    text = "a " * count + "b c d"
    pq.write_table(pa.table({"doc_id": [1], "text": [text], "source": ["s"]}), tmp_path / "long.parquet")
    row = host_rules.judge(spark.read.parquet(str(tmp_path / "long.parquet"))).first()
    assert row.n_words == count + 3 and row.n_repeat_words == count and row.base_failed


def test_given_documents(spark):
    docs = spark.read.parquet(f"{GIVEN}/sf0.001/documents.parquet")
    expected = {row.doc_id: brute(row.text) for row in docs.collect()}
    for row in host_rules.judge(docs).collect():
        assert tuple(row[1:6]) == expected[row.doc_id]


def words(n: int, start: int = 0) -> str:
    return " ".join(f"word{start + k}" for k in range(n))


def test_hosts(spark):
    """A bad host of many documents is rejected, a small one with the same rate is not, a null host has no verdict."""
    rows, n = [], 0
    for host, good, bad in (("bad", 3, 60), ("small", 1, 2), *((f"fine{k}", 30, 1) for k in range(12)), (None, 1, 9)):
        for text, count in ((words(60), good), (words(10), bad)):
            for _ in range(count):
                rows.append((n, text, "en", host))
                n += 1
    found = {row.doc_id: row for row in host_rules.judge(documents(spark, rows)).collect()}
    kept = Counter(rows[i][3] for i, row in found.items() if row.kept)
    assert kept == Counter({"small": 1, None: 1, **{f"fine{k}": 30 for k in range(12)}})
    stay = host_rules.kept_documents(documents(spark, rows))
    assert stay.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {row.doc_id for row in stay.collect()} == {i for i, row in found.items() if row.kept}


def test_many_rejected_hosts_join_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(host_rules, "BROADCAST_HOSTS", 0)
    rows = [(n, words(10), "en", "bad") for n in range(50)] + [(100 + n, words(60), "en", "good") for n in range(50)]
    assert {row.kept for row in host_rules.judge(documents(spark, rows)).where("doc_id >= 100").collect()} == {True}
