from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import GIVEN, ODD, documents
from voltatlas.llm import packing
from voltatlas.llm.packing import Limits, Packer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def packed(examples, limits: Limits, cut: bool = True) -> list:
    packer = Packer(limits, cut)
    out = []
    for row, (ids, marks) in enumerate(examples):
        out += packer.add(row, np.array(ids, dtype=np.int32), None if marks is None else np.array(marks, dtype=bool))
    return out + list(packer.packed())


def check(examples, limits: Limits, sequences) -> None:
    """Every id in one piece, every limit kept, and no padding but below the limit of tokens."""
    seen = defaultdict(list)
    for pieces in sequences:
        assert 0 < sum(end - start for _, _, start, end in pieces) <= limits.tokens
        assert len(pieces) <= limits.segments
        loss = 0
        for row, ids, start, end in pieces:
            marks = examples[row][1]
            assert start < end
            seen[row].append((start, end, ids[start:end].tolist()))
            loss += end - start - 1 if marks is None else sum(marks[start:end])
        assert loss <= limits.loss
    for row, (ids, _) in enumerate(examples):
        parts = sorted(seen[row])
        assert [i for _, _, part in parts for i in part] == list(ids)
        assert all(one[1] == two[0] for one, two in zip(parts, parts[1:]))


@pytest.mark.parametrize("limits", [Limits(64, 8, 63), Limits(64, 3, 63), Limits(64, 8, 20), Limits(1, 1, 0), Limits(64, 64, 1)])
def test_limits_and_ids(limits):
    rng = random.Random(7)
    for most in (3, 40, 400):
        for marked in (False, True):
            examples = []
            for _ in range(150):
                ids = [rng.randrange(50_000) for _ in range(rng.randint(0, most))]
                marks = [rng.random() < 0.4 for _ in ids] if marked and limits.loss else None
                examples.append((ids, marks))
            sequences = packed(examples, limits)
            check(examples, limits, sequences)
            for pieces in sequences:  # full, or a power of two that needs no padding
                size = sum(end - start for _, _, start, end in pieces)
                assert size == limits.tokens or size & (size - 1) == 0


def test_whole_examples_when_they_must_not_be_cut():
    rng = random.Random(9)
    examples = [([1] * rng.randint(1, 60), None) for _ in range(500)]
    sequences = packed(examples, Limits(64, 5, 64), cut=False)
    check(examples, Limits(64, 5, 64), sequences)
    assert sum(map(len, sequences)) == len(examples)
    tokens = sum(len(ids) for ids, _ in examples)
    assert len(sequences) <= 1.1 * max(tokens / 64, len(examples) / 5)
    with pytest.raises(ValueError):
        packed([([1] * 65, None)], Limits(64, 5, 64), cut=False)


def test_dot_product_balances_limits():
    """Long answers and long prompts share sequences: neither the tokens nor the loss alone decide."""
    examples = [([1] * 30, [True] * 30) for _ in range(40)] + [([2] * 34, [False] * 34) for _ in range(40)]
    sequences = packed(examples, Limits(64, 4, 30), cut=False)
    assert len(sequences) == 40
    assert all({pieces[0][0] // 40, pieces[1][0] // 40} == {0, 1} for pieces in sequences)


def test_first_choice_is_the_greatest_dot_product():
    rng = random.Random(2)
    examples = [([1] * rng.randint(1, 50), None) for _ in range(60)]
    limits = Limits(64, 8, 63)
    pieces = packed(examples, limits)[0]
    vectors = np.array([[len(ids) / 64, 1 / 8, (len(ids) - 1) / 63] for ids, _ in examples])
    scores = vectors @ vectors.mean(0)
    assert scores[pieces[0][0]] == pytest.approx(scores.max())


def test_long_example_and_pool(monkeypatch):
    monkeypatch.setattr(packing, "POOL", 50)
    monkeypatch.setattr(packing, "POOL_LEFT", 10)
    rng = random.Random(4)
    examples = [([5] * 100_000, None)] + [([n] * rng.randint(1, 90), None) for n in range(700)]
    limits = Limits(64, 8, 63)
    sequences = packed(examples, limits)
    check(examples, limits, sequences)
    tokens = sum(len(ids) for ids, _ in examples)
    assert len(sequences) <= tokens // 64 + 7


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    return lambda text: [*found.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_like_the_library(library):
    """Short stretches, long pieces, odd white space, special tokens; also with a vocabulary whose ids are in another order."""
    with open(PATH, encoding="utf-8") as file:
        own = packing.Encoder(file.read())
    assert own.quick is not None
    rng = random.Random(6)
    texts = ["", "  ", "x" * 3000, "ab" * 2000, " " * 2500 + "a", "a\n b <|endoftext|> c", "\u00c9t\u00e9 \u6f22\u5b57  \U0001f600", "don't  I'll"]
    texts += ["".join(rng.choice("abcdehinorst  \n.,!aA\u00e9\u00df1290\u6f22\"'") for _ in range(rng.randint(1, 3000))) for _ in range(200)]
    texts += [" ".join(rng.choice(["le", "eau", "tion", "\u00e9", "der"]) * rng.randint(1, 4) for _ in range(500)) for _ in range(5)]
    for text in texts:
        assert [*own.encode(text).tolist(), 1] == library(text), text[:80]
    own.quick = None
    for text in texts[:20]:
        assert [*own.encode(text).tolist(), 1] == library(text), text[:80]


def holds(rows, texts: list[tuple], library, tokens: int = 2048) -> float:
    """Checks the rows of the query against plain encoding; the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    expected = defaultdict(list)
    for doc_id, text in texts:
        expected[doc_id].append(library(text))
    assert by_doc.keys() == expected.keys()
    for doc_id, copies in expected.items():
        found = sorted((row.start, row.length, row.ids_crc32, row.doc_tokens) for row in by_doc[doc_id])
        if len(copies) == 1:
            at = 0
            for start, length, crc, doc_tokens in found:
                assert start == at and length > 0 and doc_tokens == len(copies[0])
                assert crc == zlib.crc32(np.array(copies[0][start:start + length], dtype="<u4").tobytes())
                at += length
            assert at == len(copies[0])
        else:
            assert sum(length for _, length, _, _ in found) == sum(map(len, copies))
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for row in sorted(pieces, key=lambda row: row.offset):
            assert row.offset == at
            at += row.length
        assert at <= tokens and len(pieces) <= 128
        padding += 0 if at & (at - 1) == 0 else tokens - at
    return padding / sum(row.length for row in rows)


def test_rows(spark, library):
    rows = packing.pack_documents(documents(spark, ODD), PATH).collect()
    assert holds(rows, [row[:2] for row in ODD], library) == 0
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []


def test_given_documents(spark, library):
    docs = spark.read.parquet(f"{GIVEN}/sf0.001/documents.parquet")
    rows = packing.pack_documents(docs.repartition(3), PATH).collect()
    assert holds(rows, [(row.doc_id, row.text) for row in docs.collect()], library) == 0


def test_examples_with_marks(spark):
    rows = [("a", [1, 2, None, 3], [True, None]), ("a", None, None), (None, [7] * 100, None), ("b", [], [True]), ("c", [9], None)]
    df = spark.createDataFrame(rows, "example_id string, ids array<int>, loss array<boolean>").selectExpr("*", "1 as offset", "2 as IDS")
    found = packing.pack(df.coalesce(1), Limits(16, 4, 15)).collect()
    by_id = defaultdict(list)
    for row in found:
        assert row.length == len(row.ids)
        by_id[row.example_id] += [(row.start, row.ids)]
    assert [i for _, ids in sorted(by_id["a"]) for i in ids] == [1, 2, 3]
    assert sum(len(ids) for _, ids in by_id[None]) == 100 and by_id.keys() == {"a", None, "c"}
    assert packing.pack(df.limit(0)).collect() == []


def test_conversations(spark, library):
    """Instruction data: the loss limit counts the answers' tokens only."""
    turns = spark.read.parquet(f"{GIVEN}/sf0.001/conversations.parquet")
    examples = packing.turn_examples(turns, PATH)
    marked = {row.example_id: row for row in examples.collect()}
    limits = Limits(256, 16, 100)
    loss = defaultdict(int)
    for row in packing.pack(examples, limits).collect():
        whole = marked[row.example_id]
        assert row.ids == whole.ids[row.start:row.start + row.length]
        loss[row.sequence_id] += sum(whole.loss[row.start:row.start + row.length])
    assert max(loss.values()) <= 100
    for row in turns.limit(20).collect():
        one = marked[f"{row.conv_id}:{row.turn}"]
        assert one.ids == library(row.text) and set(one.loss) == {row.role == "assistant"}
