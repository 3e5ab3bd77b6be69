"""Toxicity by weak supervision: many voters, a label model that weighs them, and a linear classifier on its labels.

Voters are lexicons (a seed list per language, and words and word beginnings
that a count over labelled documents finds) and patterns of form; each votes
toxic, clean or not at all. A generative label model starts from the known
labels and estimates, by expectation maximisation over labelled and unlabelled documents,
how often each voter votes
what on toxic and on clean documents, and how voters depend on each other
within a class; voters that say the same thing share one vote's weight, and a
known label is a voter of stated accuracy, which anchors the classes. A
logistic regression over the presence of terms and patterns is trained on the
posterior labels of labelled documents, so it also weighs terms that have no voter of their own.

Rows: a null or empty text has no terms and gets the score of such a text.
Every input row gives one row, repeated rows included. A null id is neither held
out nor learned from. Null labels teach nothing; without labels every score
is 0, with labels of one kind it is near that kind.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.llm.common import id_remainder, in_chunks, pick, spread_sample

#: Seed lexicons; a star stands for any ending.
SEEDS = {
    "en": ("idiot*", "stupid*", "moron*", "scum", "pathetic*", "worthless", "loser*", "trash*", "disgusting", "dumb*"),
    "de": ("idiot*", "dumm*", "trottel*", "abschaum", "arschloch*", "widerlich*"),
    "fr": ("idiot*", "stupide*", "imbécile*", "connard*", "ordure*", "minable*"),
    "es": ("idiota*", "estúpid*", "imbécil*", "basura*", "inútil*", "asqueros*"),
}
#: Bounds of what is learned from: documents of each label, terms, and terms with a voter of their own.
DOCUMENTS_PER_LABEL, TERMS, OWN_VOTERS = 6_000, 400, 64
GROUP_VOTERS = 8
#: Unlabelled documents that enter the label model, and what they weigh together beside the labelled ones.
UNLABELLED, UNLABELLED_WEIGHT = 4_000, 0.5
#: How often a known label is taken to be right.
LABEL_RIGHT = 0.98
#: Lengths of word beginnings, and what a term needs: toxic documents, and their share of the documents that hold it.
BEGINNINGS = (3, 4, 5, 6, 7)
LEAST_DOCUMENTS, LEAST_PRECISION = 4, 0.6
#: Terms a task counts before it hands its counts on.
TERMS_COUNTED = 400_000

NO_LETTERS = re.compile(r"[\W\d_]+")
#: Patterns of form: name, pattern on the text as it is, the vote if it occurs.
FORMS = (
    ("shout", re.compile(r"(?:\b[^\W\d_a-zà-ÿ]{3,}\W+){4}"), 0),
    ("marks", re.compile(r"[!?]{3,}"), 1),
    ("address", re.compile(r"\b(?:you|your|du|ihr|tu|vous|tú|usted)\b\W+(?:are|bist|seid|es|êtes|eres)\b", re.I), 1),
    ("licence", re.compile(r"\b(?:licen[cs]ed?|copyright|rights reserved)\b", re.I), -1),
)


def plain(text: str) -> str:
    """Lower-case words set off by single spaces, with one at either end."""
    return f" {NO_LETTERS.sub(' ', text.lower()).strip()} "


def terms_of(text: str) -> set[str]:
    """The words of a text, and the beginnings of longer words with a star."""
    words = set(plain(text).split())
    return words | {f"{word[:n]}*" for word in words for n in BEGINNINGS if len(word) > n}


class Finder:
    """Which of a list of terms a text holds, in one pass."""

    def __init__(self, terms: list[str]):
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[int]] = {}
        for n, term in enumerate(terms):
            places.setdefault(f" {term[:-1]}" if term.endswith("*") else f" {term} ", []).append(n)
        for key, found in places.items():
            self.automaton.add_word(key, found)
        self.empty = not places
        if places:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> set[int]:
        return set() if self.empty else {n for _, found in self.automaton.iter(plain(text)) for n in found}


def forms(text: str) -> list[bool]:
    return [pattern.search(text) is not None for _, pattern, _ in FORMS]


class Model:
    """Terms, the label model's estimates, and the classifier's weights."""

    def __init__(self, terms: list[str], held: list[set[int]], shapes: np.ndarray, y: np.ndarray, share: np.ndarray):
        self.terms, self.constant = terms, None
        presence = np.zeros((len(held), len(terms)))
        for row, found in enumerate(held):
            presence[row, list(found)] = 1
        votes = voter_votes(presence, shapes, len(terms) - SEED_TERMS)
        self.labels = LabelModel(votes, y, share)
        told = y >= 0  # the classifier learns from labelled documents; the others tell how far voters are right
        self.weights = logistic(np.hstack([presence, shapes])[told], self.labels.belief[told], share[told])
        self.finder: Finder | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "finder": None}

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if self.finder is None:
            self.finder = Finder(self.terms)
        out = np.full(len(texts), self.weights[-1])
        for row, text in enumerate(texts):
            if text:
                out[row] += sum(self.weights[n] for n in sorted(self.finder(text)))
                out[row] += self.weights[len(self.terms):-1] @ np.array(forms(text), dtype=float)
        return 1 / (1 + np.exp(-out))


class Constant(Model):
    def __init__(self, value: float):
        self.terms, self.finder, self.constant = [], None, value


SEED_LIST = [(language, term) for language, words in SEEDS.items() for term in words]
SEED_TERMS = len(SEED_LIST)


def voter_votes(presence: np.ndarray, shapes: np.ndarray, mined: int) -> np.ndarray:
    """Votes of all voters: 1 toxic, -1 clean, 0 none. The mined terms come first, then the seeds."""
    own = presence[:, :min(mined, OWN_VOTERS)]
    rest = presence[:, own.shape[1]:mined]
    groups = [rest[:, n::GROUP_VOTERS].any(1) for n in range(GROUP_VOTERS) if rest[:, n::GROUP_VOTERS].shape[1]]
    seeds = [presence[:, mined:][:, [at for at, (name, _) in enumerate(SEED_LIST) if name == language]].any(1)
             for language in SEEDS]
    formal = [shapes[:, n] * vote for n, (_, _, vote) in enumerate(FORMS) if vote]
    nothing = -(~presence.astype(bool).any(1)).astype(float)  # a text without any term speaks for clean
    return np.column_stack([own, *groups, *seeds, *formal, nothing]).astype(float)


class LabelModel:
    """How often each voter casts each vote on toxic and clean documents, and how far voters repeat each other.

    A known label counts as one more voter that is right as often as
    ``LABEL_RIGHT``; a document without one (``y`` below zero) has the voters only, and comes
    in once the labelled ones have given a first estimate. A voter that does not vote says nothing.
    """

    def __init__(self, votes: np.ndarray, y: np.ndarray, share: np.ndarray, rounds: int = 10):
        told = np.where(y == 1, 1, np.where(y == 0, -1, 0)) * math.log(LABEL_RIGHT / (1 - LABEL_RIGHT))
        belief = 1 / (1 + np.exp(-told))
        self.estimate(votes, belief, np.where(y < 0, 0.0, share))
        for _ in range(rounds):
            belief = self.posterior(votes, told)
            self.estimate(votes, belief, share)
        self.belief = self.posterior(votes, told)

    def estimate(self, votes: np.ndarray, belief: np.ndarray, share: np.ndarray) -> None:
        self.rates = {}
        for toxic, part in ((1, belief * share), (0, (1 - belief) * share)):
            self.rates[toxic] = np.stack([((votes == vote) * part[:, None]).sum(0) + 0.5 for vote in (-1, 0, 1)])
            self.rates[toxic] /= part.sum() + 1.5
        self.prior = min(max(float((belief * share).sum() / share.sum()), 1e-4), 1 - 1e-4)
        # Correlation left within the classes: what remains of a vote after the mean vote of its class.
        means = {toxic: rate[2] - rate[0] for toxic, rate in self.rates.items()}
        left = votes - belief[:, None] * means[1] - (1 - belief)[:, None] * means[0]
        spread = np.sqrt((share[:, None] * left ** 2).sum(0) / share.sum()) + 1e-9
        self.correlation = np.clip((left * share[:, None]).T @ left / share.sum() / np.outer(spread, spread), -1, 1)
        strong = np.where(self.correlation > 0.2, self.correlation, 0.0)
        np.fill_diagonal(strong, 1.0)
        self.weight = 1 / strong.sum(0)

    def posterior(self, votes: np.ndarray, told: np.ndarray | float = 0.0) -> np.ndarray:
        odds = np.log(self.rates[1] / self.rates[0])
        each = np.where(votes < 0, odds[0], np.where(votes > 0, odds[2], 0.0))
        total = math.log(self.prior / (1 - self.prior)) + each @ self.weight + told
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def logistic(x: np.ndarray, target: np.ndarray, share: np.ndarray, pull: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Weights of the columns and a last one for all rows, by Newton steps; soft targets."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = share * len(share) / share.sum()
    ridge = np.full(x.shape[1], pull)
    ridge[-1] = 1e-6
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (share * (target - p)) - ridge * weights
        bend = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(bend, slope)
        weights += move * min(1.0, 5 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-6:
            break
    return weights


def mined_terms(few: DataFrame, label: str, scale: float) -> list[str]:
    """Terms that speak for label 1, best first; ``scale`` is how many clean documents a sampled one stands for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for toxic, counter in counts.items():
                if counter:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(list(counter)), pa.array([n * (1 - toxic) for n in counter.values()], pa.int64()),
                        pa.array([n * toxic for n in counter.values()], pa.int64())], ["term", "clean", "toxic"])
                    counter.clear()

        for chunk in in_chunks(batches):
            for toxic, text in zip(chunk.column(1).to_pylist(), chunk.column(2).to_pylist()):
                counts[toxic].update(terms_of(text))
                if len(counts[0]) + len(counts[1]) > TERMS_COUNTED:
                    yield from handed_on()
        yield from handed_on()

    counted = few.mapInArrow(task, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sure = F.col("toxic") / (F.col("toxic") + F.col("clean") * F.lit(scale))
    best = counted.where((F.col("toxic") >= LEAST_DOCUMENTS) & (sure >= LEAST_PRECISION)).orderBy(
        F.desc(F.col("toxic") * sure * sure), F.length("term"), "term").limit(20 * TERMS).collect()
    found: list[str] = []
    starts: set[str] = set()
    for row in best:
        word = row.term.rstrip("*")
        if len(found) < TERMS and not any(word[:n] in starts for n in range(1, len(word) + 1)):
            found.append(row.term)
            if row.term.endswith("*"):
                starts.add(word)
    return found


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_remainder: int = 0, divisor: int = 5) -> Model:
    """Model from at most DOCUMENTS_PER_LABEL labelled documents of each label and UNLABELLED others, spread over all ids.

    Together the unlabelled documents weigh UNLABELLED_WEIGHT times as much as the labelled ones, however many there are.
    """
    known = pick(labels, "doc_id", label).where(
        F.col(label).isin(0, 1) & (id_remainder("doc_id", divisor) != held_remainder))
    total = {row[0]: row[1] for row in known.groupBy(label).count().collect()}
    own = pick(docs, "doc_id", "text").where("text is not null")
    bins = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(UNLABELLED))
    others = own.where(id_remainder("doc_id", divisor) != held_remainder).groupBy(bins.alias("bin")).agg(
        F.min("doc_id").alias("doc_id")).select("doc_id").join(known.select("doc_id"), "doc_id", "left_anti")
    chosen = F.broadcast(spread_sample(known, label, DOCUMENTS_PER_LABEL).select(F.col(label).cast("int").alias(label), "doc_id").union(
        others.select(F.lit(-1).alias(label), "doc_id")))  # at most twice DOCUMENTS_PER_LABEL ids and UNLABELLED more
    few = own.join(chosen, "doc_id").select("doc_id", label, "text")
    sampled = {row[0]: row[1] for row in few.groupBy(label).count().collect()}
    n_others = sampled.pop(-1, 0)
    if len(sampled) < 2:
        return Constant({0: 0.01, 1: 0.99}[next(iter(sampled))] if sampled else 0.0)
    weight = {kind: total[kind] / sampled[kind] for kind in sampled}
    terms = mined_terms(few.where(F.col(label) >= 0), label, weight[0] / weight[1])
    weight[-1] = UNLABELLED_WEIGHT * sum(total.values()) / max(n_others, 1)
    terms = [*terms, *(term for _, term in SEED_LIST)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(terms)
        for chunk in in_chunks(batches):
            texts = chunk.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([
                *chunk.columns[:2], pa.array([sorted(finder(text)) for text in texts], pa.list_(pa.int32())),
                pa.array([forms(text) for text in texts], pa.list_(pa.bool_()))], ["doc_id", "label", "held", "forms"])

    schema = T.StructType([few.schema["doc_id"], T.StructField("label", few.schema[label].dataType),
                           T.StructField("held", T.ArrayType(T.IntegerType())),
                           T.StructField("forms", T.ArrayType(T.BooleanType()))])
    # Rows that repeat an id come once: the bound holds for them too.
    found = few.mapInArrow(task, schema).groupBy("label", "doc_id").agg(
        F.min(F.struct("held", "forms")).alias("one")).select("label", "doc_id", "one.*").orderBy(
        "label", "doc_id").toPandas()
    y = found["label"].to_numpy()
    return Model(terms, [set(held) for held in found["held"]], np.array(found["forms"].tolist(), dtype=float),
                 y, np.select([y == 1, y == 0], [weight[1], weight[0]], weight[-1]).astype(float))


def rate(docs: DataFrame, model: Model, least: float = 0.5, held_remainder: int = 0, divisor: int = 5) -> DataFrame:
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
