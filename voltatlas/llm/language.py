"""Language by string kernels: blended-spectrum presence kernels, Nystroem landmarks, one ridge regression per language.

Two texts are compared by the character n-grams of one to four letters that
both contain, each counted once whatever its number: the kernel is the number
of shared n-grams over the geometric mean of the texts' own numbers. N-grams
are hashed into a fixed number of places, so a stretch of text becomes a vector
of bits; a long text is cut into stretches, so that its n-grams do not fill
all places, and its value is the mean of theirs, weighted by length.
A bounded sample of stretches is compared with a few landmarks per language; kernel
ridge regression in the space the landmarks span gives one weight per landmark
and language. A batch of stretches is scored by two matrix products: bits
times landmark bits, and kernel values times weights. Every language with a
text is learned; the more languages, the fewer texts and landmarks each brings.

Rows: a null text, or one without a letter, is ``und`` with score 0, and so is
every text if no language can be learned. Every input row gives one row,
repeated rows included. A null id is neither held out nor learned from. Equal
scores go to the language that comes first by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.llm.common import id_remainder, in_chunks, pick, spread_sample

#: Lengths of the n-grams and the number of places they are hashed into.
GRAMS = (1, 2, 3, 4)
PLACES = 1 << 14
#: Letters and spaces of a stretch.
STRETCH = 4_000
#: Bounds of what is learned from: texts and landmarks of a language, and of all languages as long as each keeps the least number.
TEXTS_PER_LANGUAGE, TEXTS, LEAST_TEXTS = 400, 40_000, 8
LANDMARKS_PER_LANGUAGE, LANDMARKS, LEAST_LANDMARKS = 24, 2_400, 2
RIDGE = 1e-2
#: Stretches scored together.
BATCH = 128

LETTER = re.compile(r"[^\W\d_]")
NO_LETTERS = re.compile(r"[\W\d_]+")


def stretches(text: str) -> list[np.ndarray]:
    """The letters of a text as code points, words set off by a space, case not told apart, in stretches of like length."""
    words = NO_LETTERS.sub(" ", text.lower()).strip()
    if not words:
        return []
    codes = np.frombuffer(f" {words} ".encode("utf-32-le"), dtype=np.uint32)
    return np.array_split(codes, -(-len(codes) // STRETCH))


def bits(codes: np.ndarray) -> np.ndarray:
    """Places of a stretch's n-grams, as a vector of 0 and 1."""
    out = np.zeros(PLACES, dtype=np.uint8)
    gram = np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, max(GRAMS) + 1):
        if len(codes) < n:
            break
        gram = gram[:len(codes) - n + 1] * np.uint32(0x9E3779B1) + codes[n - 1:]
        if n in GRAMS:
            mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n)
            out[(mixed ^ (mixed >> np.uint32(13))) % np.uint32(PLACES)] = 1
    return out


def kernel(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Normalised presence kernel between the rows of two bit matrices (float32)."""
    sizes = np.sqrt(np.maximum(one.sum(1), 1))[:, None] * np.sqrt(np.maximum(two.sum(1), 1))[None, :]
    return (one @ two.T) / sizes


class Model:
    """Languages, landmark bits, and a weight for each landmark and language."""

    def __init__(self, x: np.ndarray, languages: list[str]):
        """Learns from rows of bits; the first rows of each language are its landmarks, so rows come in no order of their own."""
        self.names = sorted(set(languages))
        if not self.names:
            return
        place = {name: n for n, name in enumerate(self.names)}
        target = np.array([place[name] for name in languages])
        own = share_of(LANDMARKS, LANDMARKS_PER_LANGUAGE, LEAST_LANDMARKS, len(self.names))
        order = np.argsort(target, kind="stable")
        first = np.searchsorted(target[order], np.arange(len(self.names)))
        turn = np.arange(len(order)) - first[target[order]]
        marks = order[turn < own]
        x = x.astype(np.float32)
        self.landmarks = x[marks]
        values, vectors = np.linalg.eigh(kernel(self.landmarks, self.landmarks).astype(np.float64))
        good = values > 1e-6 * values[-1]
        root = vectors[:, good] / np.sqrt(values[good])  # landmarks to Nystroem coordinates
        z = kernel(x, self.landmarks) @ root
        y = np.where(target[:, None] == np.arange(len(self.names)), 1.0, -1.0)
        share = np.bincount(target, minlength=len(self.names))
        weight = (1 / share)[target][:, None]  # languages count alike however many texts they have
        mean = (weight * z).sum(0) / weight.sum()
        self.shift = (weight * y).sum(0) / weight.sum()
        z, y = z - mean, y - self.shift
        coefficients = np.linalg.solve(z.T @ (weight * z) + RIDGE * np.eye(z.shape[1]) * weight.mean(),
                                       z.T @ (weight * y))
        self.weights = (root @ coefficients).astype(np.float32)
        self.shift = (self.shift - mean @ coefficients).astype(np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; the score is the softmax of the regressions' values."""
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        parts = [(n, codes) for n, text in enumerate(texts) if self.names and text and LETTER.search(text)
                 for codes in stretches(text)]
        told = sorted({n for n, _ in parts})
        if not told:
            return names, scores
        total, weight = np.zeros((len(texts), len(self.names))), np.zeros(len(texts))
        for start in range(0, len(parts), BATCH):
            some = parts[start:start + BATCH]
            x = np.stack([bits(codes) for _, codes in some]).astype(np.float32)
            at, length = np.array([n for n, _ in some]), np.array([len(codes) for _, codes in some])
            np.add.at(total, at, length[:, None] * (kernel(x, self.landmarks) @ self.weights + self.shift))
            np.add.at(weight, at, length)
        value = 4 * total[told] / weight[told][:, None]
        power = np.exp(value - value.max(1, keepdims=True))
        power /= power.sum(1, keepdims=True)
        for n, at, score in zip(told, power.argmax(1).tolist(), power.max(1).tolist()):
            names[n], scores[n] = self.names[at], score
        return names, scores


def share_of(total: int, most: int, least: int, languages: int) -> int:
    """What a language may bring of a total: no more than its own bound, and never less than the least number."""
    return max(least, min(most, total // languages))


def learn(docs: DataFrame, held_remainder: int = 2, divisor: int = 4) -> Model:
    """Model of every language that has a text, from at most TEXTS_PER_LANGUAGE texts of each, spread over all ids.

    With many languages it is fewer texts each, TEXTS in all, but LEAST_TEXTS
    at least. Of a long text one stretch is learned from, chosen by a hash of the id.
    """
    rows = pick(docs, "doc_id", "text", "lang").where(
        (id_remainder("doc_id", divisor) != held_remainder) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = max(rows.select("lang").distinct().count(), 1)
    chosen = spread_sample(rows, "lang", share_of(TEXTS, TEXTS_PER_LANGUAGE, LEAST_TEXTS, languages))
    few = rows.join(F.broadcast(chosen.select("doc_id", "lang")), ["doc_id", "lang"], "left_semi").select(
        "doc_id", "text", "lang", F.xxhash64("doc_id", F.lit(29)).alias("at"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches):
            found = []
            for text, at in zip(chunk.column(1).to_pylist(), chunk.column(3).to_pylist()):
                parts = stretches(text)
                found.append(np.packbits(bits(parts[at % len(parts)])).tobytes() if parts else b"")
            yield pa.RecordBatch.from_arrays([chunk.column(0), chunk.column(2), chunk.column(3), pa.array(found, pa.binary())],
                                             ["doc_id", "lang", "at", "bits"])

    schema = T.StructType([rows.schema["doc_id"], rows.schema["lang"], T.StructField("at", T.LongType()),
                           T.StructField("bits", T.BinaryType())])
    # Rows that repeat an id come once: the bound holds for them too.
    found = few.mapInArrow(task, schema).where("length(bits) > 0").groupBy("lang", "doc_id", "at").agg(
        F.min("bits").alias("bits")).toPandas().sort_values(["lang", "at", "doc_id"])
    x = np.unpackbits(np.frombuffer(b"".join(found["bits"]), dtype=np.uint8)).reshape(len(found), PLACES)
    return Model(x, found["lang"].tolist())


def identify(docs: DataFrame, model: Model, held_remainder: int = 2, divisor: int = 4) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = pick(docs, "doc_id", "text").select(
        "doc_id", F.coalesce(id_remainder("doc_id", divisor) == held_remainder, F.lit(False)).alias("held_out"), "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches):
            names, scores = shared.value.predict(chunk.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([*chunk.columns[:2], pa.array(names), pa.array(scores)],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(task, schema)
