from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import GIVEN, ODD, documents
from voltatlas.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Bpe(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def agree(own, library, text: str) -> None:
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist() == ids, text
    assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False), text


@pytest.mark.parametrize("text", [
    "", " ", "  ", "a", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "   x\n\n  y", "don't I'll we've",
    "aaaaaaaaaaaaaaaaaaaaaaaa", "a\nb\nc", " a b", "a b ", "a\n b", "a \nb", "a\u00a0b \u2003c", "\u0120\u0120", "\ufffd\x00\x01",
    "\u00bd \u0663\u0664 \u2167", "e\u0301\u00df\u6f22\u5b57\U0001f600", "x" * 3000, "ab" * 2000, "\t\tif x:\r\n",
])
def test_like_the_library(own, library, text):
    agree(own, library, text)


def test_random_texts(own, library):
    rng = random.Random(3)
    for _ in range(1500):
        agree(own, library, "".join(rng.choice("abcdehinorst  \n.,!aA\u00e9\u00df1290\u6f22\"'") for _ in range(rng.randint(1, 70))))


def test_backtracking_equals_merging(own):
    """The cover found by backtracking is the one that merging pairs by rank gives."""
    rng = random.Random(5)
    for _ in range(400):
        piece = "".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 30)))
        parts = [own.automaton.get(letter) for letter in piece]
        while True:
            ranks = [own.made.get(pair, 1 << 40) for pair in zip(parts, parts[1:])]
            if not ranks or min(ranks) == 1 << 40:
                break
            at = ranks.index(min(ranks))
            joined = next(t for t in range(len(own.parts)) if own.rank[t] == ranks[at])
            parts[at:at + 2] = [joined]
        assert own.encode_piece(piece) == parts


def test_memory_is_bounded(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 50)
    monkeypatch.setattr(bpe, "PAIRS_KEPT", 50)
    for n in range(200):
        agree(own, library, f"word{n} number{n * 7} other{n % 13}")
    assert len(own.words) <= 50


def test_rows(spark, own):
    found = bpe.round_trip(documents(spark, ODD), PATH).collect()
    assert len(found) == len(ODD)
    expected = []
    for doc_id, text, _, _ in ODD:
        ids = own.encode(text or "").tolist()
        expected.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(own.decode(own.encode(text or "")).encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert bpe.round_trip(documents(spark, []), PATH).collect() == []


def test_given_documents(spark, library):
    docs = spark.read.parquet(f"{GIVEN}/sf0.001/documents.parquet")
    texts = {row.doc_id: row.text or "" for row in docs.collect()}
    encoded = bpe.encode(docs, PATH)
    for row in encoded.collect():
        assert row.ids == library.encode(texts[row.doc_id], add_special_tokens=False).ids
    for row in bpe.decode(encoded, PATH).collect():
        assert row.text == texts[row.doc_id]
