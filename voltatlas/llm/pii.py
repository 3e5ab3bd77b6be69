"""Personal data: patterns with checks, and further candidates judged by boosted trees.

The base spans are the matches of one pattern per kind that pass the kind's
check. Greedy patterns lose data that stands next to other numbers, so
generators with high recall propose overlapping candidates: runs of neighbouring
number groups with up to 19 digits, mail addresses and parts of them, and
addresses in which both the sign and a dot are spelled out. Boosted trees score a candidate's format
and context; a spelled address counts as the plain one. They learn from
a bounded sample of documents in which the base spans are the positive
candidates, and what overlaps them otherwise or fails a check the negative ones. One fold of the
sample calibrates the scores and sets each kind's threshold from examples of
that kind; the best candidates that touch no base span and no better candidate are added.
All patterns take time in proportion to the text, also on unbroken runs.

Rows: a null or empty text has no spans. Every input row gives one row,
repeated rows and null ids included. A kind with few examples to calibrate
on is held to the stricter of its own threshold and that of all kinds; only a
kind without any example gets no added spans. Offsets are code points, the
end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.llm.boosting import fit_trees, margins
from voltatlas.llm.common import id_remainder, in_chunks, pick

#: The kinds in their order, and the patterns of the base spans.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Generators: numbers and dots, a stretch of number groups, and the parts of an address with the signs spelled out.
CHAIN = re.compile(r"[0-9][0-9.]*")
NUMBERS = re.compile(r"[+(]?[0-9][0-9().+-]*(?:[\x20][(+]?[0-9][0-9().+-]*)*")
LABELS = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
AT, LABEL = re.compile(r"\(at\)|\[at\]", re.I), re.compile(r"[A-Za-z0-9-]+")
DOT = re.compile(r" ?(?:\(dot\)|\[dot\]) ?|\.", re.I)
SPELLED_AT, SPELLED_DOT = re.compile(r" ?(?:\(at\)|\[at\]) ?", re.I), re.compile(r" ?(?:\(dot\)|\[dot\]) ?", re.I)
#: Fixed value: characters of the longest mail address. A number with all its signs is shorter too.
LONGEST = 254
#: Digits of the longest number of any kind; a group has one at least, so a run has no more groups than that.
MOST_DIGITS = 19
HINTS = {"email": re.compile(r"mail|contact", re.I), "ip": re.compile(r"\bip\b|host|server|address", re.I),
         "card": re.compile(r"card|visa|credit|karte|carte|tarjeta", re.I),
         "phone": re.compile(r"tel|phone|call|fax|mobil", re.I)}

#: Bounds of the training sample: documents with a candidate, and candidates.
SAMPLE_DOCUMENTS, SAMPLE_CANDIDATES = 6_000, 20_000
#: Candidates of a text whose features are held together.
CANDIDATES_AT_ONCE = 20_000
#: Share of right candidates that a threshold must reach on the calibrating fold, and examples from which a kind's own threshold stands alone.
PRECISION, LEAST_EXAMPLES = 0.98, 20

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(number: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(number)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def plain(address: str) -> str:
    """An address with its signs written as signs."""
    return SPELLED_DOT.sub(".", SPELLED_AT.sub("@", address))


def valid(kind: int, text: str) -> bool:
    """The check of a kind; base spans of mail addresses pass it by their pattern."""
    if kind == 0:
        return ADDRESS.fullmatch(plain(text)) is not None
    if kind == 1:
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in text.split("."))
    if kind == 2:
        number = digits(text)
        return 12 <= len(number) <= 19 and luhn(number)
    return 9 <= len(digits(text)) <= 15


def before_sign(text: str, at: int, floor: int) -> int:
    """Where the run of local characters before a place starts, not before the floor."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    return start


def fours(text: str) -> Iterator[tuple[int, int]]:
    """Places of four numbers joined by dots, from the left, none overlapping: what the pattern of addresses finds."""
    for chain in CHAIN.finditer(text):
        if chain.group().count(".") < 3:
            continue
        at, groups = chain.start(), []
        for part in chain.group().split("."):
            groups = [*groups, (at, at + len(part))] if part else []
            at += len(part) + 1
            if len(groups) == 4:
                yield groups[0][0], groups[3][1]
                groups = []


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind's pattern that pass its check, by start and kind."""
    spans, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = before_sign(text, at, end)  # the local part is the whole run before the sign, as far as no match has used it
        hit = DOMAIN.match(text, at) if start < at else None
        if hit:
            end = hit.end()
            spans.append((start, 0, end))
        at = text.find("@", hit.end() if hit else at + 1)
    if "." in text:
        spans.extend((start, 1, end) for start, end in fours(text) if valid(1, text[start:end]))
    for kind, pattern in ((2, CARD), (3, PHONE)):
        if kind == 3 and "+" not in text:
            continue
        spans.extend((hit.start(), kind, hit.end()) for hit in pattern.finditer(text) if valid(kind, hit.group()))
    return sorted(spans)


def addresses(text: str) -> Iterator[Span]:
    """Mail addresses whole, and without their first character or last label; no label need follow a dot."""
    at = text.find("@")
    while at >= 0:
        start = before_sign(text, at, max(0, at - LONGEST))
        hit = LABELS.match(text, at + 1, at + 1 + LONGEST) if start < at else None
        if hit:
            yield start, 0, hit.end()
            if start + 1 < at:
                yield start + 1, 0, hit.end()
            dot = text.rfind(".", at, hit.end())
            if dot > 0:
                yield start, 0, dot
        at = text.find("@", at + 1)


def spelled_addresses(text: str) -> Iterator[Span]:
    """Addresses with the sign and at least one dot spelled out; words around a lone ``(at)`` are none."""
    for hit in AT.finditer(text):
        last = hit.start() - (text[hit.start() - 1:hit.start()] == " ")
        start = before_sign(text, last, max(0, last - LONGEST))
        at = hit.end() + (text[hit.end():hit.end() + 1] == " ")
        most, known = at + LONGEST, False
        label = LABEL.match(text, at, most) if start < last else None
        while label:
            dot = DOT.match(text, label.end(), most)
            label = LABEL.match(text, dot.end(), most) if dot else None
            if label:
                known = known or dot.group() != "."
                if known:
                    yield start, 0, label.end()


def numbers(text: str) -> Iterator[Span]:
    """Runs of neighbouring number groups, as any kind their format allows."""
    for stretch in NUMBERS.finditer(text):
        if stretch.end() - stretch.start() < 7:
            continue
        groups = []  # start, end without a full stop or dash after the number, digits
        at = stretch.start()
        for part in stretch.group().split(" "):
            groups.append((at, at + len(part.rstrip(".-(+")), sum(map(part.count, "0123456789"))))
            at += len(part) + 1
        for first, (start, _, _) in enumerate(groups):
            count = 0
            for place, (_, end, more) in enumerate(groups[first:first + MOST_DIGITS]):
                count += more
                if end - start > LONGEST:
                    break
                part = text[start:end]
                if not place and part.count(".") == 3 and IP.fullmatch(part):
                    yield start, 1, end
                if 12 <= count <= 19 and CARD.fullmatch(part):
                    yield start, 2, end
                if 9 <= count <= 15 and (part[0] == "+" or not part.isdecimal()):
                    yield start, 3, end
                if count >= MOST_DIGITS:
                    break


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of all kinds."""
    return sorted({*addresses(text), *spelled_addresses(text), *numbers(text)})


class Occupied:
    """Stretches of a text that are taken; tells in a few steps whether a span overlaps one."""

    def __init__(self, spans: list[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, span: Span) -> bool:
        before = bisect_left(self.starts, span[2]) - 1
        return before >= 0 and self.ends[before] > span[0]

    def take(self, span: Span) -> None:
        """A span that overlaps nothing taken."""
        at = bisect_left(self.starts, span[0])
        self.starts.insert(at, span[0])
        self.ends.insert(at, span[2])


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    start, kind, end = span
    part = plain(text[start:end]) if kind == 0 else text[start:end]
    number = digits(part)
    groups = re.findall(r"[0-9]+", part)
    before, after = text[max(0, start - 24):start], text[end:end + 2]
    near, next_one = before[-1:], after[:1]
    local, _, domain = part.partition("@") if kind == 0 else ("", "", "")
    labels = domain.split(".") if domain else [""]
    return [
        kind == 0, kind == 1, kind == 2, kind == 3, len(part), len(number), len(groups),
        max(map(len, groups), default=0), min(map(len, groups), default=0), part.count("."), part.count("-"),
        part.count(" "), part.count("("), part.count(")"), part.startswith("+"), part.count("+"),
        part.count("(") == part.count(")"), bool(number) and luhn(number), valid(kind, part),
        int(number[:1] or 0), len(set(number)), len(groups[-1]) if groups else 0,
        near.isalpha(), near.isdigit(), near in ("", " ", "\n", "\t"), near in ("+", "-", ".", "(", "@", "/"),
        next_one.isalpha(), next_one.isdigit(), bool(HINTS[KINDS[kind]].search(before)),
        len(local), len(labels), len(labels[-1]), labels[-1].isalpha(), local[:1].isalnum(), local[-1:].isalnum(),
        next_one in (".", "-", "@") and after[1:].isalnum(), near in LOCAL and near != "",
    ]


def labelled(text: str) -> list[tuple[float, Span]]:
    """Candidates with a label: 1 a base span, 0 one that overlaps a base span otherwise or fails its check."""
    base = base_spans(text)
    known, taken, out = set(base), Occupied(base), []
    for span in candidates(text):
        if span in known:
            out.append((1.0, span))
        elif not valid(span[1], text[span[0]:span[2]]) or taken.overlaps(span):
            out.append((0.0, span))
    return out


def sample(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and fold of at most SAMPLE_CANDIDATES candidates from at most SAMPLE_DOCUMENTS documents.

    Documents and then candidates of each kind and label fall into as many hash bins as there may be
    of them; each bin keeps one. All documents take part.
    """
    rows = pick(docs, "doc_id", "text").where("text rlike '[0-9][0-9 ().+-]{5}|@'")
    bins = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(SAMPLE_DOCUMENTS))
    chosen = rows.where("doc_id is not null").groupBy(bins.alias("bin")).agg(F.min("doc_id").alias("doc_id"))
    few = rows.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")  # at most SAMPLE_DOCUMENTS ids
    few = few.withColumn("fold", (id_remainder("doc_id", 5) == 0).cast("int"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches):
            found = [(doc, fold, label, span, features(text, span))
                     for doc, text, fold in zip(*(column.to_pylist() for column in chunk.columns))
                     for label, span in labelled(text)]
            if found:
                keys = [int.from_bytes(hashlib.blake2b(f"{doc}:{span}".encode(), digest_size=7).digest(), "big")
                        for doc, _, _, span, _ in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.int64()), pa.array([row[3][1] for row in found], pa.int32()),
                    pa.array([row[1] for row in found], pa.int32()),
                    pa.array([row[2] for row in found], pa.float32()),
                    pa.array([list(map(float, row[4])) for row in found], pa.list_(pa.float32()))],
                    ["key", "kind", "fold", "label", "x"])

    made = few.mapInArrow(task, "key long, kind int, fold int, label float, x array<float>")
    per_label = SAMPLE_CANDIDATES // (2 * len(KINDS))
    kept = made.groupBy("label", "kind", F.pmod("key", F.lit(per_label)).alias("bin")).agg(
        F.min_by(F.struct("fold", "x"), "key").alias("one")).select("label", "one.*").orderBy("label", "fold", "x")
    found = kept.toPandas()  # at most SAMPLE_CANDIDATES rows of a few numbers
    x = np.array(found["x"].tolist(), dtype=np.float64).reshape(len(found), -1) if len(found) else np.zeros((0, 1))
    return x, found["label"].to_numpy(np.float64), found["fold"].to_numpy()


class Judge:
    """Trees, a scale that turns their margins into probabilities, and a threshold for each kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray, fold: np.ndarray):
        self.trees = None
        self.scale, self.thresholds = (1.0, 0.0), [2.0] * len(KINDS)
        if len(set(y)) < 2:
            return
        train, held = fold == 0, fold == 1
        if len(set(y[train])) < 2 or len(set(y[held])) < 2:  # so few documents that a fold lacks a label: each is all of them
            train = held = np.ones(len(y), dtype=bool)
        self.trees = fit_trees(x[train], y[train])
        self.scale = platt(margins(self.trees, x[held]), y[held])
        score, right = self.score(x[held]), y[held]
        common = in_the_gap(score, threshold(score, right))
        for kind in range(len(KINDS)):
            if not (y[x[:, kind] == 1] == 1).any():
                continue  # a kind without any example gets nothing added
            own = x[held][:, kind] == 1
            examples = (right[own] == 1).sum()
            limit = in_the_gap(score[own], threshold(score[own], right[own])) if examples else common
            self.thresholds[kind] = limit if examples >= LEAST_EXAMPLES else max(limit, common)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale[0] * margins(self.trees, x) + self.scale[1])))

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates above the threshold, best first, that overlap neither a base span nor a better candidate."""
        if self.trees is None:
            return []
        taken = Occupied(base)
        free = [span for span in candidates(text) if not taken.overlaps(span)]
        if not free:
            return []
        scores = np.concatenate([
            self.score(np.array([features(text, span) for span in free[n:n + CANDIDATES_AT_ONCE]], dtype=np.float64))
            for n in range(0, len(free), CANDIDATES_AT_ONCE)])
        out: list[Span] = []
        for score, span in sorted(zip(-scores, free), key=lambda pair: (pair[0], pair[1][0] - pair[1][2], pair[1])):
            if -score >= self.thresholds[span[1]] and not taken.overlaps(span):
                taken.take(span)
                out.append(span)
        return out


def platt(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, by Newton steps with a small pull to 1 and 0."""
    slope, shift = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(slope * margin + shift)))
        w = p * (1 - p)
        g = np.array([((y - p) * margin).sum() - (slope - 1), (y - p).sum() - shift])
        h = np.array([[(w * margin * margin).sum() + 1, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1]])
        move = np.linalg.solve(h, g)
        slope, shift = slope + move[0], shift + move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(slope), float(shift)


def threshold(score: np.ndarray, y: np.ndarray) -> float:
    """Least score, at least one half, from which on the share of right candidates is high enough; above 1 if none is."""
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    ends = np.append(score[order][1:] != score[order][:-1], True)  # equal scores stand or fall together
    good = np.flatnonzero((right >= PRECISION) & ends & (score[order] >= 0.5))
    return float(score[order][good[-1]]) if len(good) else 2.0


def in_the_gap(score: np.ndarray, least: float) -> float:
    """A threshold halfway between the least score that passes and the next one below, but not below one half."""
    if least > 1:
        return least
    return max(0.5, (least + score[score < least].max(initial=0.0)) / 2)


def overlapping_free(text: str, judge: Judge) -> tuple[list[Span], list[Span]]:
    base = base_spans(text)
    return base, judge.added(text, base)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one of the first kind."""
    parts, last = [], 0
    merged: list[list] = []
    for start, kind, end in sorted(spans):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    for start, kind, end in merged:
        parts += [text[last:start], f"[{KINDS[kind].upper()}]"]
        last = end
    return "".join([*parts, text[last:]])


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, digest of the base spans, all spans, and how many the trees added."""
    judge = docs.sparkSession.sparkContext.broadcast(Judge(*sample(docs)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches):
            found = [overlapping_free(text or "", judge.value) for text in chunk.column(1).to_pylist()]
            counts = np.array([[sum(span[1] == kind for span in base) for kind in range(len(KINDS))]
                               for base, _ in found], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                chunk.column(0), *(pa.array(counts[:, kind]) for kind in range(len(KINDS))),
                pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]),
                pa.array([joined(base + more) for base, more in found]),
                pa.array([len(more) for _, more in found], pa.int64())],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"])

    rows = pick(docs, "doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                           T.StructField("n_added", T.LongType())])
    return rows.mapInArrow(task, schema)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced; n_chars follows the new text. A null text stays null."""
    judge = docs.sparkSession.sparkContext.broadcast(Judge(*sample(docs)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches):
            texts = [None if text is None else redacted(text, sum(overlapping_free(text, judge.value), []))
                     for text in chunk.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(texts, pa.string()), *chunk.columns[2:4],
                 pa.array([None if text is None else len(text) for text in texts], pa.int64())],
                ["doc_id", "text", "lang", "source", "n_chars"])

    rows = pick(docs, "doc_id", "text", "lang", "source")
    return rows.mapInArrow(task, T.StructType([*rows.schema.fields, T.StructField("n_chars", T.LongType())]))
