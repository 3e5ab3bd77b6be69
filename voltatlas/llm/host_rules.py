"""Quality rules decided by host: rule failures are counted per host, shrunk, and the verdict goes back to its documents.

A document is measured alone (words, symbols, repeated lines, repeated 3-word
windows). A host's failure rate of a rule is drawn towards the rate of all
hosts by a beta prior fitted to the spread of the host rates, so a host with
few documents is not judged by them alone. A host whose shrunk rate of some
rule passes that rule's limit is rejected with all its documents.

Rows: a null or empty text has no words and fails the base rules. A null host
is no host: its documents are judged alone. Every input row gives one row,
repeated rows and null ids included. An empty table gives no rows. Windows whose
hashes meet are told apart by their words, so counts are exact whatever the
length of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltatlas.llm.common import SPACES, pick, stored

#: Shrunk share of a host's documents that may fail a rule.
HOST_LIMITS = {"short": 0.8, "repeating": 0.5, "symbols": 0.5, "copied_lines": 0.5}
#: Least and greatest weight of the prior, in documents.
PRIOR_WEIGHT = (2.0, 10_000.0)
#: Rejected hosts that may be broadcast.
BROADCAST_HOSTS = 100_000
#: Least number of low bits of a window's sort key that hold its position in the text.
LEAST_POSITION_BITS = 8
#: Windows looked at on both sides of one whose hash meets that of other words, before the whole run is.
LOOK_AROUND = 64


def measured(docs: DataFrame, *keep: str, texts: bool = False) -> DataFrame:
    """doc_id, source, further columns to keep, and the measures of the whole text; with ``texts`` also the text."""
    rows = pick(docs, "doc_id", "source", "text", *keep).withColumn("text", F.coalesce("text", F.lit("")))
    text, bare = F.col("text"), F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.select(
        "doc_id", "source", *keep, "text",
        F.when(bare == "", F.array().cast("array<string>")).otherwise(
            F.split(bare, f"[{SPACES}]+")).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACES}]")).alias("lines"))
    counted = rows.select(
        "doc_id", "source", *keep, "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", f"[{SPACES}]+", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "words", window_keys(F.col("words")).alias("keys"))
    return with_repeats(counted).drop("words", "repeats", *([] if texts else ["text"]))


def position_bits(size: Column) -> Column:
    """Low bits of a window's sort key that hold its position: as many as the text needs."""
    return F.greatest(F.lit(LEAST_POSITION_BITS), F.length(F.bin(size)))


def window_keys(words: Column) -> Column:
    """Sorted keys of all 3-word windows: hash bits above, position below."""
    size = F.size(words)
    one = lambda at: F.call_function("shiftleft", F.xxhash64(
        F.get(words, at), F.get(words, at + 1), F.get(words, at + 2)), position_bits(size)).bitwiseOR(at.cast("long"))
    return F.when(size >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), size - 3), one))).otherwise(
        F.array().cast("array<bigint>"))


def with_repeats(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in 3-word windows that occur twice or more.

    Windows with equal hash bits are neighbours in the sorted keys, and a window
    counts if another one of this run has its very words. Mostly that is a direct neighbour.
    Where a neighbour has the same hash bits but other words, more of the run is looked at, if need be all of it.
    """
    words, keys, bits = F.col("words"), F.col("keys"), F.col("bits")
    at = lambda key: key.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")
    high = lambda key: F.call_function("shiftright", key, bits)
    meet = lambda one, two: F.coalesce(high(one) == high(two), F.lit(False))

    def same(one: Column, two: Column) -> Column:
        alike = high(one) == high(two)
        for step in range(3):
            alike = alike & (F.get(words, at(one) + step) == F.get(words, at(two) + step))
        return F.coalesce(alike, F.lit(False))

    def repeated(key: Column, n: Column) -> Column:
        before, after = F.get(keys, n - 1), F.get(keys, n + 1)
        again = lambda part: F.exists(part, lambda other: (other != key) & same(key, other))
        # The neighbours up to LOOK_AROUND on both sides, and whether the run goes on beyond them.
        around = F.slice(keys, F.greatest(n + 1 - LOOK_AROUND, F.lit(1)), F.lit(2 * LOOK_AROUND + 1))
        beyond = meet(key, F.get(keys, n - LOOK_AROUND - 1)) | meet(key, F.get(keys, n + LOOK_AROUND + 1))
        return same(key, before) | same(key, after) | (
            (meet(key, before) | meet(key, after)) & (again(around) | (beyond & again(keys))))

    found = rows.withColumn("bits", position_bits(F.size("words"))).withColumn(
        "repeats", F.sort_array(F.transform(F.filter(keys, repeated), at))).drop("keys", "bits")
    starts = F.col("repeats")
    fresh = F.transform(starts, lambda start, n: F.when(n == 0, 3).otherwise(
        F.least(F.lit(3), start - F.get(starts, n - 1))))
    return found.withColumn("n_repeat_words", F.aggregate(fresh, F.lit(0).cast("long"), lambda total, x: total + x))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Rules whose failures are counted by host."""
    return {
        "short": F.col("n_words") < 50,
        "repeating": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "copied_lines": 10 * F.col("n_dup_lines") > F.col("n_words"),
    }


def host_rates(measures: DataFrame) -> DataFrame:
    """source, n_docs and the number of its documents that fail each rule."""
    return measures.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *(F.sum(failed.cast("long")).alias(name) for name, failed in rules().items()))


def rejected_hosts(hosts: DataFrame, limits: dict[str, float] = HOST_LIMITS) -> DataFrame:
    """source of each host with a shrunk failure rate above the limit of a rule.

    The prior of a rule has the rate of all documents as its mean and a weight
    by the method of moments from the unweighted variance of the host rates.
    """
    share = {name: F.sum(name) / F.sum("n_docs") for name in limits}
    spread = {name: F.var_pop(F.col(name) / F.col("n_docs")) for name in limits}
    prior = hosts.agg(*(share[name].alias(name) for name in limits),
                      *(spread[name].alias(f"{name}_spread") for name in limits)).first()
    above = F.lit(False)
    for name, limit in limits.items():
        mean, variance = prior[name] or 0.0, prior[f"{name}_spread"] or 0.0
        weight = mean * (1 - mean) / variance - 1 if variance > 0 else PRIOR_WEIGHT[1]
        weight = min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
        above = above | ((F.col(name) + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight)) > F.lit(limit))
    return hosts.where(above).select("source")


def judge(docs: DataFrame, limits: dict[str, float] = HOST_LIMITS) -> DataFrame:
    """Measures of every document, base_failed, and kept: false where the base rules or the host's verdict say so."""
    measures = stored(measured(docs), "measures")  # two readers: the hosts' counts and the result
    failed = F.coalesce(base_failed(), F.lit(True))
    return with_verdict(measures, rejected_hosts(host_rates(measures), limits)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~F.col("host_rejected")).alias("kept"))


def with_verdict(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """Adds host_rejected. A short list of rejected hosts is broadcast; a long one is joined by shuffle."""
    few = rejected.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    verdicts = rejected.withColumn("host_rejected", F.lit(True))
    return rows.join(F.broadcast(verdicts) if few else verdicts, "source", "left").withColumn(
        "host_rejected", F.coalesce("host_rejected", F.lit(False)))


def kept_documents(docs: DataFrame, limits: dict[str, float] = HOST_LIMITS) -> DataFrame:
    """doc_id, text, lang, source and n_chars of the documents that neither the base rules nor their host reject.

    Measured rows are written once with the texts that pass the base rules, so
    no text is measured twice and none is shuffled.
    """
    own = measured(docs, "lang", "n_chars", texts=True).withColumn("failed", F.coalesce(base_failed(), F.lit(True)))
    rows = stored(own.withColumn("text", F.when(~F.col("failed"), F.col("text"))), "measured-texts")
    rejected = rejected_hosts(host_rates(rows), limits)
    return with_verdict(rows.where(~F.col("failed")), rejected).where(~F.col("host_rejected")).select(
        "doc_id", "text", "lang", "source", "n_chars")
