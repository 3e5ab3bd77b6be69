"""Byte-level BPE: exact encoding by backtracking, decoding through an offset table.

A text is cut at special tokens and by the pre-tokenizer's pattern. Each piece
is covered from the left with the longest token that starts there; the longest
matches come from one pass of an Aho-Corasick automaton. A token may follow
another only if the two would not have been merged across their border, which
a table of compatible pairs answers; if none fits, the last token is taken
back and a shorter one tried. An end position from which no cover exists is
marked, so no position is tried twice and the work is linear in the piece.
The result is the one that applying the merges in order of rank gives.

Rows: a null or empty text has no tokens and decodes to the empty text. Every
input row gives one output row, repeated rows and null ids included.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.llm.common import in_chunks, pick

#: Fixed value: the pattern the byte-level pre-tokenizer cuts text by.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words a worker remembers; beyond it the memory starts afresh. Only speed depends on it.
WORDS_KEPT = 600_000
LONGEST_KEPT = 60
PAIRS_KEPT = 1_000_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


def packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Bpe:
    """Vocabulary of a tokenizer file, ready to encode and decode."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, letters = spec["model"], byte_letters()
        vocab = model["vocab"]
        self.special = {added["content"]: added["id"] for added in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        raw = [b""] * size
        for token, at in vocab.items():
            raw[at] = bytes(letters[letter] for letter in token)
        for token, at in self.special.items():
            raw[at] = token.encode()
        self.length = [len(token) for token in raw]
        self.lengths = np.array(self.length, dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        # Rank of the merge that makes a token, its two parts, and the token a pair makes.
        self.rank, self.parts, self.made = [-1] * size, [(-1, -1)] * size, {}
        reachable = {at for at in vocab.values() if len(raw[at]) == 1}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            one, two, at = vocab[left], vocab[right], vocab[left + right]
            self.made.setdefault((one, two), rank)
            if self.rank[at] < 0 and at not in reachable and one in reachable and two in reachable \
                    and self.compatible(one, two, rank):
                self.rank[at], self.parts[at] = rank, (one, two)
                reachable.add(at)
        self.automaton = ahocorasick.Automaton()
        for at in reachable:
            self.automaton.add_word(raw[at].decode("latin-1"), at)
        self.automaton.make_automaton()
        whole = {raw[at]: at for at in reachable}
        self.shorter = [-1] * size
        for token, at in whole.items():
            self.shorter[at] = next((whole[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in whole), -1)
        self.pattern = regex.compile(PIECES)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        self.pairs: dict[int, bool] = {}
        self.heads: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.other_space = re.compile(r"[^\S \n]")
        self.newline = packed(self.encode_piece("\n"))

    def compatible(self, one: int, two: int, before: int | None = None) -> bool:
        """Whether no merge joins the end of one token with the start of the other.

        The merges at the border are undone from the latest back. While the
        border lies between two given parts, the merge of these parts wins if
        its rank comes before the merge that used up the left part, or not
        after the one that used up the right part, as merges of one rank run
        from the left.
        """
        limit = float("inf") if before is None else before
        while True:
            rank = self.made.get((one, two))
            if rank is not None and rank < limit:
                return False
            left, right = self.rank[one], self.rank[two]
            if left < 0 and right < 0:
                return True
            if left > right:
                limit, one = left, self.parts[one][1]
            else:
                limit, two = right + 1, self.parts[two][0]

    def fits(self, one: int, two: int) -> bool:
        key = one << 32 | two
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self.compatible(one, two)
        return known

    def encode_piece(self, piece: str) -> list[int]:
        letters = piece.encode().decode("latin-1")
        length, shorter, size, fits = self.length, self.shorter, len(letters), self.fits
        longest = self.automaton.iter_long  # leftmost longest matches from a position on
        matches = longest(letters)
        dead = bytearray(size + 1)
        found, at, token = [], 0, next(matches)[1]
        ahead = length[token]  # where the next of the matches starts
        while True:
            end = at + length[token]
            if not dead[end] and (not found or fits(found[-1], token)):
                found.append(token)
                at = end
                if at == size:
                    return found
                if at != ahead:
                    matches = longest(letters, at)
                token = next(matches)[1]
                ahead = at + length[token]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = found.pop()
                at -= length[token]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        parts = []
        start = 0
        for hit in self.cut.finditer(text) if self.cut else ():
            self.add_pieces(text[start:hit.start()], parts)
            parts.append(packed([self.special[hit.group()]]))
            start = hit.end()
        self.add_pieces(text[start:] if start else text, parts)
        return np.frombuffer(b"".join(parts), dtype=np.int32)

    def add_pieces(self, text: str, parts: list[bytes]) -> None:
        """Token numbers of a stretch without special tokens, four bytes each.

        The pattern always cuts before a single space between two other
        characters and on both sides of a single newline between two others,
        so where white space stands alone the words can be looked up whole.
        """
        if not text:
            return
        if text[0].isspace() or text[-1].isspace() or any(pair in text for pair in ("  ", "\n\n", "\n ", " \n")) \
                or self.other_space.search(text):
            parts.extend(self.of_pieces(text))
            return
        for n, line in enumerate(text.split("\n")):
            if n:
                parts.append(self.newline)
            head, *words = line.split(" ")
            parts.append(self.of_word(head, self.heads, ""))
            kept = self.words
            try:
                parts.extend([kept[word] for word in words])
            except KeyError:
                parts.extend([kept.get(word) or self.of_word(word, kept, " ") for word in words])

    def of_word(self, word: str, kept: dict[str, bytes], before: str) -> bytes:
        known = kept.get(word)
        if known is None:
            if len(kept) >= WORDS_KEPT:
                kept.clear()
            known = b"".join(self.of_pieces(before + word))
            if len(word) <= LONGEST_KEPT:
                kept[word] = known
        return known

    def of_pieces(self, text: str) -> list[bytes]:
        return [packed(self.encode_piece(piece)) for piece in self.pattern.findall(text)]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' bytes joined; bytes that are no UTF-8 become U+FFFD."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return ""
        at = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - (ends - lengths), lengths)
        return self.bytes[at].tobytes().decode("utf-8", "replace")


_LOADED: dict[int, Bpe] = {}


def _loaded(text: str) -> Bpe:
    """One vocabulary per worker process."""
    key = hash(text)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(text)
    return _LOADED[key]


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and ids, the token numbers of the whole text. ``vocabulary``: path of a tokenizer file, read on the driver."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())  # a few MB whatever the corpus

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value)
        for chunk in in_chunks(batches):
            found = [bpe.encode(text or "") for text in chunk.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([chunk.column(0), ids], ["doc_id", "ids"])

    rows = pick(docs, "doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(task, schema)


def decode(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """Adds text, what the column ids stands for; null ids give the empty text. Other columns stay."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = tokens.sparkSession.sparkContext.broadcast(file.read())
    columns, at = tokens.columns, tokens.columns.index("ids")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [bpe.decode(ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else ""
                         for ids in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*columns, "text"])

    return tokens.mapInArrow(task, T.StructType([*tokens.schema.fields, T.StructField("text", T.StringType())]))


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of the tokens and of the text they decode to, one row per document."""
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    counted = encode(docs, vocabulary).withColumns(
        {"n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(joined.cast("binary"), 256)})
    return decode(counted, vocabulary).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
