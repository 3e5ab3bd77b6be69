"""Near copies of embeddings by an epsilon grid order join.

Vectors are scaled to length one, where a cosine of at least c means a
distance of at most epsilon = sqrt(2 - 2c). The leading principal directions
of all vectors span a grid with cells of that width. The vectors are sorted
by their cells, compared coordinate by coordinate, and cut into sequence
intervals. Pairs of intervals are halved recursively; a pair whose boxes lie
further apart than epsilon is dropped with all it contains. The blocks that
remain are compared in double precision.

The vectors are shuffled once, to sort them, and written once, as blocks. Tasks
read the blocks of a pair from those files, as a cartesian product does, so
the number of pairs takes time and no disk. Rows get their node's result
by a digest of the vector, not by the vector.

Equal vectors are one node with a count, so copies are never expanded. A
block pair hands on, for each vector, how many vectors it links to, and only
the links that a spanning forest of the pair needs.

Rows: a vector that is null, empty, zero, or has a null or non-finite component
links with nothing. Vectors of different lengths are never compared. Equal ids
and repeated rows are rows of the result each. A row with a null id links with
nothing and has no component. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.llm.common import pick, stored
from voltatlas.llm.graph import components

COSINE = 0.95
#: Principal directions that make the grid.
DIRECTIONS = 8
#: Vectors and bytes of a block, vectors compared by one product, and parts an interval is cut into.
BLOCK, BLOCK_BYTES, LEAF, FANOUT = 2_048, 2_000_000, 512, 4
#: Rows sorted by one task; one file of blocks holds them.
ROWS_PER_RANGE = 8_192
#: Bytes of the digest that names a vector.
DIGEST = 16
#: Room for rounding where boxes are compared.
SLACK = 1e-6
#: Longest embedding whose second moments are gathered whole; of longer ones a block of directions is.
MOST_DIMENSIONS = 1024
#: Columns of that block beyond the directions used, and how often it is multiplied.
SPARE_DIRECTIONS, POWER_ROUNDS = 4, 3


def vectors(rows: DataFrame) -> DataFrame:
    """vec_id and the vector, floats as floats and all else as doubles; null where it links with nothing."""
    kind = "float" if rows.schema["embedding"].dataType.elementType == T.FloatType() else "double"
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    value = F.transform("embedding", lambda x: x.cast(kind) + F.lit(0.0).cast(kind))  # a negative zero becomes zero
    usable = F.col("embedding").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    return pick(rows, "vec_id", "embedding").select(
        "vec_id", F.when(F.coalesce(usable, F.lit(False)), value).alias("vector"))


def second_moments(nodes: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Sum of the outer products of the unit vectors, with a 1 put before each; every task hands on one matrix."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            x = unit(matrix(batch.column(0)).astype(float))
            x = np.hstack([np.ones((len(x), 1)), x])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["at", "v"])

    found = nodes.select("vector").mapInArrow(task, "at int, v double").groupBy("at").agg(
        F.sum("v").alias("v")).toPandas().sort_values("at")
    whole = found["v"].to_numpy().reshape(width + 1, width + 1) if len(found) else np.zeros((width + 1, width + 1))
    return whole, int(round(whole[0, 0]))


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def lists(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def digest(vector) -> bytes:
    return hashlib.blake2b(vector, digest_size=DIGEST).digest()


def keyed(own: DataFrame) -> DataFrame:
    """vec_id and the digest of the vector; null for a row that links with nothing."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = memoryview(batch.column(1).flatten().to_numpy(zero_copy_only=False)).cast("B")
            size = data.nbytes // max(1, pc.sum(pc.list_value_length(batch.column(1))).as_py() or 0)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy()) * size
            keys = [digest(data[start:end]) if end > start else None
                    for start, end in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["vec_id", "key"])

    rows = own.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("vector")).alias("vector"))
    return rows.mapInArrow(task, T.StructType([rows.schema["vec_id"], T.StructField("key", T.BinaryType())]))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by the greatest component first, so that no square overflows."""
    if not x.size:
        return x
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def directions(nodes: DataFrame, width: int) -> np.ndarray:
    """Leading principal directions of the unit vectors as columns; their signs are fixed."""
    if width > MOST_DIMENSIONS:
        return by_power(nodes, width)
    moments, count = second_moments(nodes, width)
    mean = moments[0, 1:] / max(count, 1)
    values, found = np.linalg.eigh(moments[1:, 1:] / max(count, 1) - np.outer(mean, mean))
    found = found[:, ::-1][:, :DIRECTIONS]
    return found * np.where(found[np.abs(found).argmax(0), np.arange(found.shape[1])] < 0, -1, 1)


def by_power(nodes: DataFrame, width: int) -> np.ndarray:
    """Leading principal directions of wide vectors, by products of their covariance with a block of a few columns.

    Every task hands on sums of the block's size, so no matrix of the width's
    square is made. Which directions come out changes the cost, never the result.
    """
    columns = DIRECTIONS + SPARE_DIRECTIONS
    block = np.linalg.qr(np.random.default_rng(23).standard_normal((width, columns)))[0]
    for _ in range(POWER_ROUNDS):
        shared = nodes.sparkSession.sparkContext.broadcast(block)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width, columns + 1))  # the last column sums the vectors
            count = 0
            for batch in batches:
                if batch.num_rows:
                    x = unit(matrix(batch.column(0)).astype(float))
                    total[:, :-1] += x.T @ (x @ shared.value)
                    total[:, -1] += x.sum(0)
                    count += len(x)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(total.size + 1), pa.int32()), pa.array(np.append(total.ravel(), count))], ["at", "v"])

        found = nodes.select("vector").mapInArrow(task, "at int, v double").groupBy("at").agg(
            F.sum("v").alias("v")).toPandas().sort_values("at")["v"].to_numpy()
        if not len(found) or not found[-1]:
            break
        whole, count = found[:-1].reshape(width, columns + 1), found[-1]
        mean = whole[:, -1] / count
        block = np.linalg.qr(whole[:, :-1] / count - np.outer(mean, mean @ block))[0]
    found = block[:, :DIRECTIONS]
    return found * np.where(found[np.abs(found).argmax(0), np.arange(found.shape[1])] < 0, -1, 1)


def ordered(rows: DataFrame, axes: np.ndarray, epsilon: float, ranges: int) -> DataFrame:
    """vector, copies and least along the grid order; equal vectors are neighbours, and ranges of the order tasks of their own.

    The rows of a batch that are equal go on as one, so a very common vector is no large key.
    """
    kind = rows.schema["vector"].dataType.elementType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(axes)

    def place_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, ids = matrix(batch.column("vector")), batch.column("least").to_numpy(zero_copy_only=False)
                known: dict[bytes, int] = {}
                node = np.array([known.setdefault(row.tobytes(), len(known)) for row in x])
                first = np.unique(node, return_index=True)[1]
                least = ids[first]
                np.minimum.at(least, node, ids)
                x = x[first]
                cells = np.floor(unit(x.astype(float)) @ shared.value / epsilon).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [lists(x), pa.array(np.bincount(node)), pa.array(least), lists(cells)],
                    ["vector", "copies", "least", "cells"])

    grid = rows.select("vector", F.col("vec_id").cast("long").alias("least")).mapInArrow(
        place_task, f"vector array<{kind}>, copies long, least long, cells array<int>")
    return grid.repartitionByRange(ranges, "cells", "vector").sortWithinPartitions("cells", "vector")


def packed(grid: DataFrame, axes: np.ndarray, block: int) -> DataFrame:
    """One row per block of neighbours in the order: its number, its first node's number (at), the nodes' vectors, copies
    and least ids, and the box of their places; written once.

    Blocks end with their range. They and their nodes are numbered within the range after those of the ranges
    before, so no task sees more than its range.
    """
    shared = grid.sparkSession.sparkContext.broadcast(axes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, first = TaskContext.get().partitionId(), 0, 0
        held = None

        def made(x: np.ndarray, copies: np.ndarray, least: np.ndarray) -> pa.RecordBatch:
            nonlocal row, first
            place = unit(x.astype(float)) @ shared.value
            row, first = row + 1, first + len(x)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([row - 1], pa.int64()), pa.array([first - len(x)], pa.int64()),
                 pa.array([len(x)], pa.int64()), pa.array([x.tobytes()]), pa.array([copies.tobytes()]),
                 pa.array([least.tobytes()]), lists(place.min(0)[None]), lists(place.max(0)[None])],
                ["part", "row", "first", "nodes", "vectors", "copies", "least", "low", "high"])

        for batch in batches:
            if batch.num_rows:
                own = [matrix(batch.column("vector")), *(batch.column(name).to_numpy() for name in ("copies", "least"))]
                x, copies, least = own if held is None else (np.concatenate(both) for both in zip(held, own))
                begins = np.flatnonzero(np.append(True, (x[1:] != x[:-1]).any(1)))  # of equal vectors
                x, copies, least = x[begins], np.add.reduceat(copies, begins), np.minimum.reduceat(least, begins)
                done = (len(x) - 1) // block * block  # the last vector may go on in the next batch
                for n in range(0, done, block):
                    yield made(x[n:n + block], copies[n:n + block], least[n:n + block])
                held = x[done:], copies[done:], least[done:]
        if held is not None:
            yield made(*held)

    ranged = stored(grid.select("vector", "copies", "least").mapInArrow(
        task, "part int, row long, first long, nodes long, vectors binary, copies binary, least binary, "
              "low array<double>, high array<double>"), "blocks")
    begins, blocks, nodes = [], 0, 0
    for row in ranged.groupBy("part").agg(F.count(F.lit(1)).alias("blocks"), F.sum("nodes").alias("nodes")).orderBy("part").collect():
        begins.append((row["part"], blocks, nodes))  # one row per range
        blocks, nodes = blocks + row["blocks"], nodes + row["nodes"]
    firsts = grid.sparkSession.createDataFrame(begins, "part int, blocks long, before long")
    return ranged.join(F.broadcast(firsts), "part").select(
        (F.col("blocks") + F.col("row")).alias("block"), (F.col("before") + F.col("first")).alias("at"),
        "vectors", "copies", "least", "low", "high")


def nodes_of(blocks: DataFrame, kind: str, width: int) -> DataFrame:
    """at, key (the vector's digest), copies and least of every node."""
    row_bytes = width * np.dtype(kind).itemsize

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors, copies, least in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                data = memoryview(vectors.as_buffer())
                keys = [digest(data[n:n + row_bytes]) for n in range(0, len(data), row_bytes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(at, at + len(keys))), pa.array(keys, pa.binary()),
                     *(pa.array(np.frombuffer(part.as_buffer(), np.int64)) for part in (copies, least))],
                    ["at", "key", "copies", "least"])

    return blocks.select("at", "vectors", "copies", "least").mapInArrow(task, "at long, key binary, copies long, least long")


def near_blocks(blocks: DataFrame, epsilon: float) -> DataFrame:
    """Pairs a <= b of blocks that may hold a pair within epsilon, by cutting intervals from the whole order down."""
    boxes = stored(blocks.select("block", "low", "high"), "boxes")
    top = boxes.agg(F.max("block")).first()[0]
    level = 0
    while top is not None and FANOUT ** level <= top:
        level += 1
    pairs = blocks.sparkSession.createDataFrame([(0, 0)] if top is not None else [], "a long, b long")
    wide = range(DIRECTIONS)
    for depth in range(level - 1, -1, -1):
        size = FANOUT ** depth
        level_boxes = stored(boxes.groupBy(F.floor(F.col("block") / size).cast("long").alias("at")).agg(
            *(F.min(F.get("low", F.lit(n))).alias(f"low{n}") for n in wide),
            *(F.max(F.get("high", F.lit(n))).alias(f"high{n}") for n in wide)), "boxes")
        side = lambda name: level_boxes.select(
            F.col("at").alias(name), *(F.col(f"{end}{n}").alias(f"{name}_{end}{n}") for end in ("low", "high") for n in wide))
        gaps = [F.greatest(F.lit(0.0), F.col(f"a_low{n}") - F.col(f"b_high{n}"), F.col(f"b_low{n}") - F.col(f"a_high{n}"))
                for n in wide]
        apart = sum((F.coalesce(gap * gap, F.lit(0.0)) for gap in gaps), F.lit(0.0))
        parts = F.sequence(F.lit(0), F.lit(FANOUT - 1))
        halved = pairs.withColumn("i", F.explode(parts)).withColumn("j", F.explode(parts)).select(
            (F.col("a") * FANOUT + F.col("i")).alias("a"), (F.col("b") * FANOUT + F.col("j")).alias("b")).where("a <= b")
        pairs = stored(halved.join(side("a"), "a").join(side("b"), "b").where(
            F.sqrt(apart) <= epsilon + SLACK).select("a", "b"), "block-pairs")
    return pairs


class Tile:
    """Two blocks compared by halving their intervals; gathers the linked pairs."""

    def __init__(self, cosine: float, epsilon: float, one: tuple, two: tuple, same: bool):
        self.cosine, self.epsilon, self.same = cosine, epsilon, same
        (self.x, self.place_x), (self.y, self.place_y) = one, two
        self.x32, self.y32 = self.x.astype(np.float32), self.y.astype(np.float32)
        self.margin = 1e-6 + 2e-7 * self.x.shape[1]  # more than the error of a float32 product
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(self, a: int, b: int, c: int, d: int) -> None:
        """Rows a to b of one block with rows c to d of the other."""
        if self.same and d <= a:
            return  # the mirror image of a part that is compared
        p, q = self.place_x[a:b], self.place_y[c:d]
        gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
        if np.sqrt((gap * gap).sum()) > self.epsilon + SLACK:
            return
        if max(b - a, d - c) <= LEAF:
            rough = self.x32[a:b] @ self.y32[c:d].T
            i, j = np.nonzero(rough >= self.cosine - self.margin)
            close = rough[i, j] < self.cosine + self.margin
            i, j = i + a, j + c
            keep = ~close
            for start in range(0, len(i), 50_000):  # pairs near the limit, in double precision
                some = np.flatnonzero(close[start:start + 50_000]) + start
                keep[some] = (self.x[i[some]] * self.y[j[some]]).sum(1) >= self.cosine
            if self.same:
                keep &= i < j
            if keep.any():
                self.found.append((i[keep], j[keep]))
        elif b - a >= d - c:
            middle = (a + b) // 2
            self.compare(a, middle, c, d)
            self.compare(middle, b, c, d)
        else:
            middle = (c + d) // 2
            self.compare(a, b, c, middle)
            self.compare(a, b, middle, d)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        self.compare(0, len(self.x), 0, len(self.y))
        if not self.found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return tuple(np.concatenate(side) for side in zip(*self.found))


def roots(i: np.ndarray, j: np.ndarray, count: int) -> np.ndarray:
    """For each of a number of nodes the least node it reaches over pairs."""
    label = np.arange(count)
    ends, others = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.argsort(ends, kind="stable")
    ends, others = ends[order], others[order]
    first = np.flatnonzero(np.append(True, ends[1:] != ends[:-1])) if len(ends) else np.empty(0, dtype=np.int64)
    while len(first):
        low = label.copy()
        low[ends[first]] = np.minimum(label[ends[first]], np.minimum.reduceat(label[others], first))
        low = low[low]
        if (low == label).all():
            break
        label = low
    return label


def partners(pairs: DataFrame) -> DataFrame:
    """Each block and the blocks it is compared with; of a pair either may hold the other, so that the lists are alike in length."""
    even = F.pmod(F.col("a") + F.col("b"), F.lit(2)) == 0
    return pairs.groupBy(F.when(even, F.col("a")).otherwise(F.col("b")).alias("block")).agg(
        F.collect_list(F.when(even, F.col("b")).otherwise(F.col("a"))).alias("others"))


def links(blocks: DataFrame, axes: np.ndarray, cosine: float, epsilon: float, kind: str) -> DataFrame:
    """at, links (linked vectors, copies counted) and root (a node of the same component), per block pair and node."""
    width = len(axes)
    shared = blocks.sparkSession.sparkContext.broadcast(axes)
    near = stored(partners(near_blocks(blocks, epsilon)), "partners")
    side = lambda name: blocks.select(F.col("block").alias(name), *(
        F.col(c).alias(f"{c}_{name}") for c in ("at", "copies", "vectors")))
    held = side("a").join(near.withColumnRenamed("block", "a"), "a")
    both = held.join(side("b").hint("shuffle_replicate_nl"), F.array_contains("others", F.col("b"))).drop("others")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), dtype=kind)
                x, y = (unit(get(f"vectors_{name}", kind).reshape(-1, width).astype(float)) for name in "ab")
                same = batch.column("a")[row].as_py() == batch.column("b")[row].as_py()
                i, j = Tile(cosine, epsilon, (x, x @ shared.value), (y, y @ shared.value), same).pairs()
                if not len(i):
                    continue
                copies = np.concatenate([get("copies_a", np.int64), get("copies_b", np.int64)])
                at = np.concatenate([batch.column(f"at_{name}")[row].as_py() + np.arange(len(z)) for name, z in (("a", x), ("b", y))])
                j = j if same else j + len(x)
                count = np.bincount(i, copies[j], len(at)) + np.bincount(j, copies[i], len(at))
                root = roots(i, j, len(at))
                some = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[some]), pa.array(count[some].astype(np.int64)), pa.array(at[root[some]])],
                    ["at", "links", "root"])

    return both.mapInArrow(task, "at long, links long, root long")


def near_copies(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    epsilon = float(np.sqrt(2 - 2 * cosine))
    own = vectors(rows)
    kind = "f4" if own.schema["vector"].dataType.elementType == T.FloatType() else "f8"
    usable = own.where("vector is not null and vec_id is not null")
    known = None
    for row in usable.groupBy(F.size("vector").alias("width")).count().orderBy("width").collect():  # mostly one
        width = row["width"]
        whole = usable.where(F.size("vector") == width)
        axes = directions(whole, width)
        block = max(64, min(BLOCK, BLOCK_BYTES // (8 * width)))
        blocks = packed(ordered(whole, axes, epsilon, -(-row["count"] // ROWS_PER_RANGE)), axes, block)
        linked = stored(links(blocks, axes, cosine, epsilon, kind), "links")
        joined = components(linked.select(F.col("at").alias("a"), F.col("root").alias("b")))
        counts = linked.groupBy("at").agg(F.sum("links").alias("links"))
        # A vector without links or copies is its own component, so it needs no row.
        named = nodes_of(blocks, kind, width).join(
            joined.withColumnRenamed("node", "at"), "at", "left").join(counts, "at", "left").where(
            "component is not null or copies > 1").withColumn("component", F.coalesce("component", "at"))
        least = named.groupBy("component").agg(F.min("least").alias("component_id"))
        part = named.join(least, "component").select(
            "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
        known = part if known is None else known.union(part)
    if known is None:
        return own.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias(
            "component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = keyed(own).join(stored(known, "named"), "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", F.col("vec_id").cast("long")).alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
