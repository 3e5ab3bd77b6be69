from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import GIVEN, ODD, documents
from voltatlas.llm import pii
from voltatlas.llm.boosting import fit_trees, margins

#: The patterns of the base spans as they are stated.
PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def right(kind: int, text: str) -> bool:
    number = [int(c) for c in text if c in "0123456789"]
    if kind == 1:
        return all(int(part) <= 255 for part in text.split("."))
    if kind == 2:
        doubled = [sum(divmod(2 * d, 10)) if n % 2 else d for n, d in enumerate(number[::-1])]
        return 12 <= len(number) <= 19 and sum(doubled) % 10 == 0
    return 9 <= len(number) <= 15 if kind == 3 else True


def brute(text: str) -> list[tuple]:
    return sorted((hit.start(), kind, hit.end()) for kind, pattern in enumerate(PATTERNS)
                  for hit in re.finditer(pattern, text) if right(kind, hit.group()))


@pytest.mark.parametrize("text", [
    "", "a@b.c@d.e.f", "@@a@b", "x.@-.-", "a@b", "a@b@c.d", "u@h.x@y.z", "..a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255",
    "4111-1111 1111-1111", "4111 1111  1111 1111", "+12 34-5.6(7)89)", "+1+2 3456789", "+1 (269) 555-3296 4524132264652876",
    "é漢a@b.cd\U0001f600 +44 20 7946 0958", "4111111111111111" * 400, "a@b." * 300, "0000.1.2.3",
])
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_base_spans_of_given_documents(spark):
    for row in spark.read.parquet(f"{GIVEN}/sf0.01/documents.parquet").collect():
        assert pii.base_spans(row.text or "") == brute(row.text or "")


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 10, (2000, 4)).astype(float)
    y = ((x[:, 0] > 4) & (x[:, 1] < 3) | (x[:, 2] == 7)).astype(float)
    model = fit_trees(x[:1500], y[:1500])
    assert ((margins(model, x[1500:]) > 0) == (y[1500:] == 1)).mean() > 0.97
    assert len(margins(model, x[:0])) == 0


def test_threshold_reaches_the_precision():
    score = np.array([0.99, 0.98, 0.9, 0.9, 0.8, 0.6])
    assert pii.threshold(score, np.array([1, 1, 1, 1, 0, 0.0])) == 0.9
    assert pii.threshold(score, np.zeros(6)) == 2.0
    assert pii.threshold(score, np.array([1, 1, 1, 0, 1, 1.0])) == 0.98


def test_thresholds_lie_between_examples():
    score = np.array([0.99, 0.9, 0.7, 0.1])
    assert pii.in_the_gap(score, 0.9) == pytest.approx(0.8) and pii.in_the_gap(score, 0.7) == 0.5
    assert pii.in_the_gap(score, 0.1) == 0.5 and pii.in_the_gap(score, 2.0) == 2.0


def corpus(card: tuple[str, ...] = ("4111111111111111", "5500005555555559", "4012888888881881")) -> list[tuple]:
    rows = []
    for n in range(900):
        parts = ["word here", f"+1 ({200 + n % 700}) 555-{1000 + n}", "some text", card[n % len(card)], "and", f"{n % 250}.7.{n % 90}.1",
                 "more", f"u{n}@mail.example.org", "number", f"{4111111111111000 + n * 7}", "end."]
        rows.append((n, " ".join(parts), "en", "s"))
    return rows


def test_neighbours_are_found(spark):
    """Data next to other numbers, which the greedy patterns lose, is added; clean text is left alone."""
    more = [(5001, "call +1 (269) 555-3296 4012888888881881 now", "en", "s"), (5002, "4111111111111111 27.65.93.188 x", "en", "s"),
            (5003, "clean text with 3 numbers, 1999 and 12 of them", "en", "s")]
    found = {row.doc_id: row for row in pii.find(documents(spark, corpus() + more)).where("doc_id > 5000").collect()}
    assert found[5001].spans == "phone:5:22,card:23:39" and found[5001].n_phone == found[5001].n_card == 0
    assert found[5002].spans == "card:0:16,ip:17:29" and found[5002].n_ip == 1
    assert found[5003].spans == "" and found[5003].n_added == 0


def test_base_stays_and_nothing_overlaps(spark):
    docs = spark.read.parquet(f"{GIVEN}/sf0.01/documents.parquet")
    texts = {row.doc_id: row.text or "" for row in docs.collect()}
    for row in pii.find(docs).collect():
        spans = {tuple(part.split(":")) for part in row.spans.split(",") if part}
        base = {(pii.KINDS[kind], str(start), str(end)) for start, kind, end in brute(texts[row.doc_id])}
        assert base <= spans and len(spans) == len(base) + row.n_added
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(b[0] == kind for b in base) for kind in pii.KINDS]
        for _, start, end in spans - base:
            assert not any(int(start) < int(e) and int(s) < int(end) for _, s, e in base)


@pytest.mark.parametrize("text", [
    "x" * 1_000_000, "7" * 1_000_000, "1." * 500_000, "at" * 500_000, "(at)" * 250_000, "a(at)b(dot)" * 90_000, "@" * 1_000_000,
    "a@" * 500_000, "@a." * 300_000, "+" * 1_000_000, "+1 (" * 250_000, "a." * 500_000 + "@b", "9" + "-" * 1_000_000,
], ids=lambda text: text[:6])
def test_unbroken_runs_take_time_in_proportion(text):
    started = time.perf_counter()
    pii.base_spans(text)
    pii.candidates(text)
    assert time.perf_counter() - started < 20


def test_overlaps():
    taken = pii.Occupied([(5, 0, 9), (7, 1, 12), (20, 2, 22)])
    for start in range(25):
        for end in range(start + 1, 26):
            assert taken.overlaps((start, 0, end)) == any(start < e and s < end for s, e in ((5, 9), (7, 12), (20, 22)))
    taken.take((12, 0, 14))
    assert taken.overlaps((13, 0, 20)) and not taken.overlaps((14, 0, 20))


def test_prose_is_no_address():
    for text in ("let us meet (at) noon.tomorrow then", "prices [at] shop.now are low", "look (at) this (dot", "(at) a (dot) b"):
        assert [span for span in pii.candidates(text) if span[1] == 0] == []
    text = "write to joe.smith (at) host (dot) com today"
    assert (9, 0, 38) in pii.candidates(text) and pii.plain(text[9:38]) == "joe.smith@host.com"


def test_recall_and_precision_of_added_spans(spark):
    """Data planted where the patterns lose it: nine in ten are added, and next to nothing else."""
    rng = random.Random(3)

    def card() -> str:
        body = [rng.randrange(10) for _ in range(15)]
        doubled = [sum(divmod(2 * d, 10)) if n % 2 == 0 else d for n, d in enumerate(body[::-1])]
        return "".join(map(str, [*body, -sum(doubled) % 10]))

    rows, planted = [], {}
    for n in range(400):
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        number, ip = card(), ".".join(str(rng.randrange(1, 255)) for _ in range(4))
        kind = n % 4
        if kind == 0:  # a phone and a card in a row: one run of digits to the patterns
            text, at = f"call {phone} {number} soon", [(5, 3, 5 + len(phone)), (6 + len(phone), 2, 22 + len(phone))]
        elif kind == 1:  # a card and an address in a row
            text, at = f"pay {number} {ip} now", [(4, 2, 20)]
        elif kind == 2:
            name = f"jo.{n}"
            text, at = f"write to {name} (at) mail{n % 9} (dot) example (dot) com today", [(9, 0, 9 + len(f"{name} (at) mail0 (dot) example (dot) com"))]
        else:
            text, at = f"meet (at) noon.tomorrow, {n} of {rng.randrange(10 ** 6)} prices [at] shop.now", []
        rows.append((10_000 + n, text, "en", "s"))
        base = pii.Occupied(brute(text))
        planted[10_000 + n] = {span for span in at if not base.overlaps(span)}
    found = pii.find(documents(spark, corpus(tuple(card() for _ in range(500))) + rows)).where("doc_id >= 10000").collect()
    kinds = {kind: n for n, kind in enumerate(pii.KINDS)}
    added = {row.doc_id: {(int(s), kinds[k], int(e)) for k, s, e in (part.split(":") for part in row.spans.split(",") if part)}
             - set(brute(dict((r[0], r[1]) for r in rows)[row.doc_id])) for row in found}
    right = sum(len(added[doc] & planted[doc]) for doc in planted)
    assert right >= 0.9 * sum(map(len, planted.values()))
    assert right >= 0.95 * sum(map(len, added.values()))


def test_redaction():
    text = "a@b.cd é 1.2.3.4, +1 (269) 555-3296."
    assert pii.redacted(text, brute(text)) == "[EMAIL] é [IP], [PHONE]."
    assert pii.redacted("0123456789", [(1, 2, 5), (3, 3, 7)]) == "0[CARD]789"
    assert pii.redacted("", []) == ""


def test_rows(spark):
    found = pii.find(documents(spark, ODD)).collect()
    assert Counter(row.doc_id for row in found) == Counter(row[0] for row in ODD)
    by_id = {row.doc_id: row for row in found}
    assert by_id[1].spans == "" and by_id[-3].spans == "ip:0:7,email:12:17"
    stay = pii.redact(documents(spark, ODD))
    assert stay.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = {row.doc_id: (row.text, row.n_chars) for row in stay.collect()}
    assert texts[1] == (None, None) and texts[-3] == ("[IP] and [EMAIL]", 16) and texts[2] == ("", 0)
    assert pii.find(documents(spark, [])).collect() == [] and pii.redact(documents(spark, [])).collect() == []


def test_numbers_of_many_groups_are_found(spark):
    """Phones and cards of six and more groups next to other numbers are proposed whole, and added."""
    text = "appelez +33 6 12 34 56 78 4012888888881881 demain"
    assert {(8, 3, 25), (26, 2, 42)} <= set(pii.candidates(text))
    assert (0, 2, 24) in pii.candidates("4 1 1 1 1 1 1 1 11111111 5550100")
    rows = [(n, f"appelez le +33 {1 + n % 9} {10 + n % 90} {10 + n % 87} {10 + n % 79} {10 + n % 71} ou payez par carte "
             f"{['4111111111111111', '5500005555555559'][n % 2]} numero {4111111111111000 + n * 7} fin", "fr", "s")
            for n in range(900)]
    found = {row.doc_id: row.spans for row in pii.find(documents(spark, rows + [(5001, text, "fr", "s")])).collect()}
    assert found[5001] == "phone:8:25,card:26:42"


def test_few_examples_are_enough(spark):
    """A small table, with fewer examples of each kind than stand alone in the calibrating fold, still gets what the patterns lose."""
    more = [(5001, "call +1 (269) 555-3296 4012888888881881 now", "en", "s"), (5002, "4111111111111111 27.65.93.188 x", "en", "s"),
            (5003, "clean text with 3 numbers, 1999 and 12 of them", "en", "s")]
    for count in (60, 30):
        docs = documents(spark, corpus()[:count] + more)
        x, y, fold = pii.sample(docs)
        for kind in range(len(pii.KINDS)):
            assert 0 < ((x[:, kind] == 1) & (y == 1) & (fold == 1)).sum() < pii.LEAST_EXAMPLES
        found = {row.doc_id: row for row in pii.find(docs).where("doc_id > 5000").collect()}
        assert found[5001].spans == "phone:5:22,card:23:39" and found[5002].spans == "card:0:16,ip:17:29"
        assert found[5003].spans == "" and found[5003].n_added == 0


def test_a_kind_without_examples_gets_nothing():
    """Few examples are held to the stricter threshold; a fold without a label takes all examples; no example, no span."""
    rng = np.random.default_rng(1)
    kinds, y = rng.integers(0, 3, 300), rng.integers(0, 2, 300).astype(float)
    x = np.column_stack([*(kinds == kind for kind in range(4)), y + rng.normal(size=300) * 0.01]).astype(float)
    fold = (np.arange(300) % 5 == 0).astype(int)
    fold[kinds == 2] = 0  # examples to learn from, none to calibrate on
    judge = pii.Judge(x, y, fold)
    held = judge.score(x[fold == 1])
    common = pii.in_the_gap(held, pii.threshold(held, y[fold == 1]))
    assert judge.thresholds[2] == common < 1 and judge.thresholds[3] == 2.0
    assert all(0.5 <= limit < 1 for limit in judge.thresholds[:3])
    assert pii.Judge(x[:20], y[:20], np.zeros(20, int)).thresholds[0] < 1  # no document in the calibrating fold
    assert pii.Judge(x, np.ones(300), fold).trees is None and pii.Judge(x[:0], y[:0], fold[:0]).trees is None
