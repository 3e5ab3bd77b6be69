"""Quality by multiple-instance learning with gated attention: passages are encoded, weighed, and their mix is scored.

A text is cut into as many passages of equal numbers of words, at most 48, as
hold the whole text, however long it is. A passage is encoded from its surface (letters,
symbols, repeated words). A gate weighs the encodings; the weighted
sum is what the classifier sees, and encoder, gate and classifier learn
together from document labels only.

Rows: a null or empty text is one passage without words and gets the score the
model gives such a passage. Every input row gives one row, repeated rows
included. A null id is neither held out nor learned from. Null labels teach
nothing; without labels every score is one half, with labels of one kind it is
near that kind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.llm.common import id_remainder, in_chunks, pick, spread_sample
from voltatlas.llm.wordhash import words_of

#: Words of a passage at most.
PASSAGE_WORDS = 48
#: Bounds of what is learned from: documents of each label, and passages of a document, spread evenly over it.
DOCUMENTS_PER_LABEL, LEARNED_PASSAGES = 3_000, 512
HIDDEN, ROUNDS, RATE, BATCH = 16, 40, 0.01, 256

#: Bytes whose share in a passage is a feature.
GROUPS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#*$%&<>", "|", "!?", ".,;:",
          "\n", "()[]{}\"'=/\\_@+-~^`")
FEATURES = len(GROUPS) + 7
_GROUP = np.zeros(256, dtype=np.uint8)
for _n, _letters in enumerate(GROUPS):
    _GROUP[np.frombuffer(_letters.encode(), dtype=np.uint8)] = _n + 1
_GROUP[128:] = len(GROUPS) + 1


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts in order, and the number of passages of each text (at least one)."""
    words = words_of(texts, lower=False)
    number = np.maximum(-(-words.counts // PASSAGE_WORDS), 1)
    owner = np.repeat(np.arange(len(texts)), number)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    begin = words.first[owner] + within * words.counts[owner] // number[owner]
    end = words.first[owner] + (within + 1) * words.counts[owner] // number[owner]
    count = end - begin
    out = np.zeros((len(owner), FEATURES), dtype=np.float32)
    some = np.flatnonzero(count)
    if not len(some):
        return out, number
    first, last = words.start[begin[some]], words.end[end[some] - 1]
    size = (last - first).astype(np.float32)
    group = _GROUP[words.data]
    for column in range(1, len(GROUPS) + 2):
        hits = np.flatnonzero(group == column)
        out[some, column - 1] = (np.searchsorted(hits, last) - np.searchsorted(hits, first)) / size
    place = np.repeat(np.arange(len(some)), count[some])  # passages hold all words in order
    length = (words.end - words.start).astype(np.float32)
    again = np.append(False, (words.hash[1:] == words.hash[:-1]) & (place[1:] == place[:-1]))
    order = np.lexsort((words.hash, place))
    fresh = np.append(True, (words.hash[order][1:] != words.hash[order][:-1]) | (np.diff(place) != 0))
    column, per = len(GROUPS) + 1, count[some].astype(np.float32)
    out[some, column] = np.bincount(place, length) / per / 10
    out[some, column + 1] = np.sqrt(np.maximum(
        np.bincount(place, length ** 2) / per - (np.bincount(place, length) / per) ** 2, 0)) / 10
    out[some, column + 2] = np.bincount(place, again) / per
    out[some, column + 3] = np.bincount(place[order], fresh) / per
    out[some, column + 4] = np.bincount(place, length == 1) / per
    out[some, column + 5] = np.log1p(per) / 5
    return out, number


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Encoder, gate and classifier; ``fit`` by Adam on the logistic loss."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.p = {"e": draw(FEATURES, HIDDEN), "eb": np.zeros(HIDDEN), "v": draw(HIDDEN, HIDDEN),
                  "u": draw(HIDDEN, HIDDEN), "w": draw(HIDDEN), "c": draw(HIDDEN), "cb": np.zeros(1)}
        self.constant: float | None = None

    def forward(self, x: np.ndarray, number: np.ndarray) -> dict[str, np.ndarray]:
        """Passages of all documents one after the other; number has how many each document has, at least one."""
        p, first = self.p, np.cumsum(number) - number
        h = np.tanh(x @ p["e"] + p["eb"])
        a, g = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        s = (a * g) @ p["w"]
        power = np.exp(s - np.repeat(np.maximum.reduceat(s, first), number))
        weight = power / np.repeat(np.add.reduceat(power, first), number)
        z = np.add.reduceat(weight[:, None] * h, first)
        return {"h": h, "a": a, "g": g, "weight": weight, "z": z, "score": sigmoid(z @ p["c"] + p["cb"][0])}

    def gradients(self, x: np.ndarray, number: np.ndarray, y: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        p, f, first = self.p, self.forward(x, number), np.cumsum(number) - number
        error = (f["score"] - y) * share
        dz = np.repeat(error, number)[:, None] * p["c"]
        dweight = (dz * f["h"]).sum(1)
        ds = f["weight"] * (dweight - np.repeat(np.add.reduceat(f["weight"] * dweight, first), number))
        gate = ds[:, None] * p["w"]
        da, dg = gate * f["g"] * (1 - f["a"] ** 2), gate * f["a"] * f["g"] * (1 - f["g"])
        dh = f["weight"][:, None] * dz + da @ p["v"].T + dg @ p["u"].T
        pre = dh * (1 - f["h"] ** 2)
        return {"e": x.T @ pre, "eb": pre.sum(0), "v": f["h"].T @ da, "u": f["h"].T @ dg,
                "w": (ds[:, None] * f["a"] * f["g"]).sum(0), "c": f["z"].T @ error, "cb": np.array([error.sum()])}

    def fit(self, x: np.ndarray, number: np.ndarray, y: np.ndarray, share: np.ndarray, seed: int = 5) -> None:
        first = np.cumsum(number) - number
        rng = np.random.default_rng(seed)
        moments = {name: (np.zeros_like(value), np.zeros_like(value)) for name, value in self.p.items()}
        step = 0
        for _ in range(ROUNDS):
            order = rng.permutation(len(y))
            for start in range(0, len(y), BATCH):
                rows = order[start:start + BATCH]
                step += 1
                own = number[rows]
                at = np.arange(own.sum()) + np.repeat(first[rows] - np.cumsum(own) + own, own)
                for name, slope in self.gradients(x[at], own, y[rows], share[rows] / len(rows)).items():
                    one, two = moments[name]
                    slope = slope + 1e-4 * self.p[name]
                    one += 0.1 * (slope - one)
                    two += 0.001 * (slope ** 2 - two)
                    self.p[name] -= RATE * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.999 ** step)) + 1e-8)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if not texts:
            return np.empty(0)
        x, number = passages(texts)
        return self.forward((x - self.mean) / self.spread, number)["score"]


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", held_remainder: int = 0,
          divisor: int = 5) -> Model:
    """Model from at most DOCUMENTS_PER_LABEL labelled documents of each label, spread over all ids.

    Of a document with more than LEARNED_PASSAGES passages so many are learned from; scores look at all.

    Each label weighs as much as it has labelled documents, so the bound does not shift the scores.
    """
    known = pick(labels, "doc_id", label).where(
        F.col(label).isin(0, 1) & (id_remainder("doc_id", divisor) != held_remainder))
    share = {row[0]: row[1] for row in known.groupBy(label).count().collect()}
    chosen = F.broadcast(spread_sample(known, label, DOCUMENTS_PER_LABEL))  # at most twice DOCUMENTS_PER_LABEL ids
    few = pick(docs, "doc_id", "text").join(chosen, "doc_id").select("doc_id", label, "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches):
            x, number = passages(chunk.column(2).to_pylist())
            parts = [part if len(part) <= LEARNED_PASSAGES else part[
                np.arange(LEARNED_PASSAGES) * len(part) // LEARNED_PASSAGES] for part in np.split(x, np.cumsum(number)[:-1])]
            yield pa.RecordBatch.from_arrays([*chunk.columns[:2], pa.array([part.tobytes() for part in parts])],
                                             ["doc_id", "label", "x"])

    schema = T.StructType([few.schema["doc_id"], T.StructField("label", few.schema[label].dataType),
                           T.StructField("x", T.BinaryType())])
    # Rows that repeat an id come once: the bound holds for them too.
    found = few.mapInArrow(task, schema).groupBy("label", "doc_id").agg(F.min("x").alias("x")).orderBy(
        "label", "doc_id").toPandas()
    rows = [np.frombuffer(part, dtype=np.float32).reshape(-1, FEATURES) for part in found["x"]]
    if not rows:
        model = Model(np.zeros(FEATURES), np.ones(FEATURES))
        model.constant = 0.5
        return model
    number, flat = np.array([len(row) for row in rows]), np.concatenate(rows).astype(np.float64)
    model = Model(flat.mean(0), np.maximum(flat.std(0), 1e-3))
    y = found["label"].to_numpy(np.float64)
    if len(set(y)) == 1:
        model.constant = 0.99 if y[0] else 0.01
        return model
    weight = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum())
    model.fit((flat - model.mean) / model.spread, number, y, weight / weight.mean())
    return model


def rate(docs: DataFrame, model: Model, least: float = 0.3, held_remainder: int = 0, divisor: int = 5) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = pick(docs, "doc_id", "text").select(
        "doc_id", F.coalesce(id_remainder("doc_id", divisor) == held_remainder, F.lit(False)).alias("held_out"), "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [*chunk.columns[:2], pa.array(shared.value.score(chunk.column(2).to_pylist()))],
                ["doc_id", "held_out", "score"])

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(task, schema).withColumn("predicted", (F.col("score") >= least).cast("int"))
