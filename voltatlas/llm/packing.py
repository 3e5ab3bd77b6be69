"""Vector bin packing of training examples into sequences, under limits on tokens, segments and loss-bearing tokens.

Every task packs the examples it reads, so nothing is shuffled. Examples wait in
a pool of fixed size. A sequence is opened with its whole capacity left; of the
pool's examples that fit within every limit the one goes in whose vector has the
greatest dot product with what is left, each limit weighted by the pool's mean
demand for it. When none fits whole, the longest example is cut to fill the rest,
and its remainder goes back to the pool. What is longer than a sequence
is cut first. A sequence that nothing is left to fill (the last one of a task, or
one whose segments are used up) is laid out as sequences of powers of two,
which need no padding.

A piece bears loss on its marked tokens; where an example has no marks, on all
but the piece's first token, which nothing in its segment predicts.

Rows: a null or empty text is an example of the closing id alone; an example
without ids gives no piece. Repeated rows and equal or null ids are examples
each; pieces of one row lie in one task. Marks fewer than the ids count as false, null marks too. An empty
table gives no rows. A long text is cut into as many pieces as it needs. Ties go to
the example that came first. Sequence numbers name the task and the sequence in it, so a task that runs
again gives the same rows as long as it reads the same rows in the same order.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.llm.bpe import PIECES, Bpe, packed
from voltatlas.llm.common import in_chunks, pick

#: Examples waiting in a task, and how many are left when it goes on reading.
POOL, POOL_LEFT = 4096, 1024
#: Id that ends a document.
END_ID = 1


#: A run of characters that may be one long piece, on which the library's time would grow with the square.
LONG_RUN = re.compile(r"\S{1000}|\s{1000}")


class Encoder(Bpe):
    """The same ids as Bpe, by a library that merges pairs by rank, but for texts with very long pieces.

    The library takes a token's id for its rank, which is right where ids follow
    the order of the merges and every token can be reached by merging.
    """

    def __init__(self, text: str):
        super().__init__(text)
        ranks = {self.bytes[at:at + size].tobytes(): n for n, (at, size) in enumerate(zip(self.offsets, self.lengths))
                 if size and n not in self.special.values()}
        order = [n for n in sorted(ranks.values()) if self.rank[n] >= 0]
        plain = [n for token, n in ranks.items() if len(token) == 1]
        fitting = len(order) + len(plain) == len(ranks) and max(plain) < min(order) \
            and all(self.rank[a] < self.rank[b] for a, b in zip(order, order[1:]))
        self.quick = tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}) if fitting else None

    def add_pieces(self, text: str, parts: list[bytes]) -> None:
        if self.quick is None or LONG_RUN.search(text):
            super().add_pieces(text, parts)
        else:
            parts.append(packed(self.quick.encode_ordinary(text)))


_ENCODERS: dict[int, Encoder] = {}


def encoder(text: str) -> Encoder:
    """One vocabulary per worker process."""
    key = hash(text)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(text)
    return _ENCODERS[key]


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2047

    def __post_init__(self):
        if min(self.tokens, self.segments) < 1 or self.loss < 0:
            raise ValueError("a sequence needs room for a token and a segment")


class Example:
    """What is left of an example, as a place in its ids."""

    __slots__ = ("row", "ids", "marks", "start")

    def __init__(self, row: int, ids: np.ndarray, marks: np.ndarray | None, start: int = 0):
        self.row, self.ids, self.marks, self.start = row, ids, marks, start

    def loss(self, end: int) -> int:
        """Loss-bearing tokens from the start to an end."""
        if self.marks is None:
            return max(0, end - self.start - 1)
        return int(self.marks[end] - self.marks[self.start])

    def vector(self) -> tuple[int, int, int]:
        return len(self.ids) - self.start, 1, self.loss(len(self.ids))

    def reach(self, tokens: int, loss: int) -> int:
        """The farthest end within so many tokens and loss-bearing tokens."""
        end = min(len(self.ids), self.start + tokens)
        if self.marks is None:
            return min(end, self.start + loss + 1)
        return min(end, int(np.searchsorted(self.marks, self.marks[self.start] + loss, side="right")) - 1)


Piece = tuple[int, np.ndarray, int, int]  # row, the ids of its example, start, end


class Packer:
    """Packs a stream of examples; gives each finished sequence as a list of pieces."""

    def __init__(self, limits: Limits, cut: bool = True):
        self.limits, self.cut = limits, cut
        self.room = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.int64)
        self.examples: list[Example | None] = []
        self.vectors = np.zeros((2 * POOL, 3), dtype=np.int64)

    def add(self, row: int, ids: np.ndarray, marks: np.ndarray | None = None) -> Iterator[list[Piece]]:
        """Takes an example, and packs the pool once it is full."""
        sums = None if marks is None else np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        left = Example(row, ids, sums)
        while left.start < len(ids):
            end = left.reach(self.limits.tokens, self.limits.loss)
            if end == left.start:
                raise ValueError("a loss-bearing token does not fit where no loss is allowed")
            if end < len(ids) and not self.cut:
                raise ValueError("an example is greater than a sequence and must not be cut")
            if end - left.start == self.limits.tokens:
                yield [(row, ids, left.start, end)]
            else:
                self.put(Example(row, ids[:end], None if sums is None else sums[:end + 1], left.start))
            left.start = end
        if len(self.examples) >= POOL:
            yield from self.packed(POOL_LEFT)

    def put(self, example: Example) -> None:
        at = len(self.examples)
        if at == len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
        self.examples.append(example)
        self.vectors[at] = example.vector()

    def packed(self, leave: int = 0) -> Iterator[list[Piece]]:
        """Sequences, until no more than so many examples are left."""
        while True:
            there = [n for n, example in enumerate(self.examples) if example is not None]
            self.examples = [self.examples[n] for n in there]
            self.vectors[:len(there)] = self.vectors[there]
            if len(there) <= leave:
                return
            waiting = np.ones(len(there), dtype=bool)
            # Mean demand, the rest and the vector all count in sequences; a limit nobody needs weighs nothing.
            weights = self.vectors[:len(there)].mean(0) / np.maximum(self.room, 1).astype(np.float64) ** 3
            count = len(there)
            while count > max(leave, len(there) // 2 if leave else 0):
                pieces, used = self.sequence(waiting, weights)
                count -= used
                yield from ([pieces] if self.full(pieces) or not self.cut else powers(pieces))

    def full(self, pieces: list[Piece]) -> bool:
        return sum(end - start for _, _, start, end in pieces) == self.limits.tokens

    def sequence(self, waiting: np.ndarray, weights: np.ndarray) -> tuple[list[Piece], int]:
        """One sequence from the waiting examples, and how many of them it used up."""
        left, pieces, used = self.room.copy(), [], 0
        vectors = self.vectors[:len(waiting)]
        while left[0] > 0 and left[1] > 0:
            fit = waiting & (vectors[:, 0] <= left[0]) & (vectors[:, 2] <= left[2])
            if self.cut and left[1] == 1 and len(pieces):
                fit &= vectors[:, 0] == left[0]  # the last segment has to fill the rest, whole or cut
            found = np.flatnonzero(fit)
            if len(found):
                at = int(found[np.argmax(vectors[found] @ (weights * left))])
                example = self.examples[at]
                end = len(example.ids)
            else:
                if not self.cut or not waiting.any():
                    break
                at = int(np.argmax(np.where(waiting, vectors[:, 0], -1)))
                example = self.examples[at]
                end = example.reach(int(left[0]), int(left[2]))
                if end == example.start:
                    break
            pieces.append((example.row, example.ids, example.start, end))
            left -= (end - example.start, 1, example.loss(end))
            if end == len(example.ids):
                waiting[at], self.examples[at] = False, None
                used += 1
            else:
                example.start = end
                vectors[at] = example.vector()
        return pieces, used


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """A sequence that is not full, cut into sequences of falling powers of two."""
    total = sum(end - start for _, _, start, end in pieces)
    left = [list(piece) for piece in pieces]
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        part: list[Piece] = []
        while size:
            row, ids, start, end = left[0]
            take = min(size, end - start)
            part.append((row, ids, start, start + take))
            size -= take
            if start + take == end:
                left.pop(0)
            else:
                left[0][2] = start + take
        yield part


def numbered(sequences: Iterable[list[Piece]], first: int) -> Iterator[tuple[int, int, Piece]]:
    """Each piece with its sequence's number and its offset there."""
    for number, pieces in enumerate(sequences, first):
        offset = 0
        for piece in pieces:
            yield number, offset, piece
            offset += piece[3] - piece[2]


PIECES_AT_ONCE = 4096


def pieces_of(examples: Iterator[tuple], limits: Limits, cut: bool, id_type: pa.DataType,
              digests: bool) -> Iterator[pa.RecordBatch]:
    """Arrow rows of the pieces that a task's examples (id, ids, marks) are packed into."""
    packer = Packer(limits, cut)
    names: dict[int, list] = {}  # of examples with pieces to come: id, tokens, tokens still to come

    def sequences() -> Iterator[list[Piece]]:
        for row, (name, ids, marks) in enumerate(examples):
            if len(ids):
                names[row] = [name, len(ids), len(ids)]
                yield from packer.add(row, ids, marks)
        yield from packer.packed()

    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held))
        shared = [pa.array(columns[0], id_type), *(pa.array(column, pa.int64()) for column in columns[1:6])]
        last = pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids in columns[6]], pa.int64()) if digests \
            else pa.array(columns[6], pa.list_(pa.int32()))
        held.clear()
        return pa.RecordBatch.from_arrays([*shared, last], [
            "example_id", "start", "length", "example_tokens", "sequence_id", "offset", "ids"])

    first = TaskContext.get().partitionId() << 40
    for number, offset, (row, ids, start, end) in numbered(sequences(), first):
        known = names[row]
        held.append((known[0], start, end - start, known[1], number, offset, ids[start:end]))
        known[2] -= end - start
        if not known[2]:
            del names[row]
        if len(held) >= PIECES_AT_ONCE:
            yield batch()
    if held:
        yield batch()


def schema_of(kind: T.DataType, digests: bool) -> T.StructType:
    return T.StructType([
        T.StructField("example_id", kind),
        *(T.StructField(name, T.LongType()) for name in ("start", "length", "example_tokens", "sequence_id", "offset")),
        T.StructField("ids", T.LongType() if digests else T.ArrayType(T.IntegerType()))])


def pack(examples: DataFrame, limits: Limits = Limits(), cut: bool = True) -> DataFrame:
    """Pieces of examples, given as example_id, ids (array<int>) and loss (array<boolean> or null: all but a piece's first).

    Columns: example_id, start, length, example_tokens, sequence_id, offset and
    the piece's ids. Without ``cut``, examples stay whole, sequences are padded
    where nothing fits, and an example greater than a sequence is an error.
    """
    rows = pick(examples, "example_id", "ids", "loss").select(
        "example_id", F.coalesce(F.filter("ids", lambda x: x.isNotNull()), F.array().cast("array<int>")).alias("ids"),
        F.col("loss").cast("array<boolean>").alias("loss"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given() -> Iterator[tuple]:
            for batch in batches:
                for n in range(batch.num_rows):
                    ids = np.array(batch.column(1)[n].values.to_numpy(zero_copy_only=False), dtype=np.int32)
                    marks = batch.column(2)[n]
                    if marks.is_valid:
                        known = [bool(mark) for mark in marks.as_py()][:len(ids)]
                        marks = np.array(known + [False] * (len(ids) - len(known)), dtype=bool)
                    else:
                        marks = None
                    yield batch.column(0)[n].as_py(), ids, marks

        yield from pieces_of(given(), limits, cut, id_type, False)

    kind = rows.schema["example_id"].dataType
    id_type = pa_type(kind)
    return rows.mapInArrow(task, schema_of(kind, False))


def pa_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def pack_documents(docs: DataFrame, vocabulary: str, limits: Limits = Limits()) -> DataFrame:
    """Pieces of whole documents, each encoded and ended by END_ID, with a digest of their ids instead of the ids."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())  # a few MB whatever the corpus
    end = np.array([END_ID], dtype=np.int32)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(spec.value)

        def given() -> Iterator[tuple]:
            for chunk in in_chunks(batches):
                for name, text in zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist()):
                    yield name, np.concatenate([bpe.encode(text or ""), end]), None

        yield from pieces_of(given(), limits, True, id_type, True)

    rows = pick(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType
    id_type = pa_type(kind)
    return rows.mapInArrow(task, schema_of(kind, True)).select(
        F.col("example_id").alias("doc_id"), "start", "length", F.col("ids").alias("ids_crc32"),
        F.col("example_tokens").alias("doc_tokens"), "sequence_id", "offset")


def turn_examples(conversations: DataFrame, vocabulary: str, answers: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Every turn of instruction data as an example for ``pack``: example_id (conversation and turn), ids ended by
    END_ID, and loss on the turns of the roles that answer. A null text is empty; a null role bears no loss."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = conversations.sparkSession.sparkContext.broadcast(file.read())
    rows = pick(conversations, "conv_id", "turn", "role", "text").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("example_id"), "text",
        F.coalesce(F.col("role").isin(*answers), F.lit(False)).alias("answer"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(spec.value)
        for chunk in in_chunks(batches):
            ids = [[*bpe.encode(text or "").tolist(), END_ID] for text in chunk.column(1).to_pylist()]
            marks = [[answer] * len(one) for answer, one in zip(chunk.column(2).to_pylist(), ids)]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.bool_()))],
                ["example_id", "ids", "loss"])

    return rows.mapInArrow(task, "example_id string, ids array<int>, loss array<boolean>")
