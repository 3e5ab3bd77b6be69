"""Mixing sources to target weights: a temperature found by bisection, realised as budgeted permutations of blocks.

A source's weight is its token share raised to an exponent between 0 (all
sources alike) and 1 (as they are). The exponent is the greatest at which the
weights reach the wanted entropy, but never so small that a source would be
repeated more often than allowed. The weights times the budget give each source whole
epochs and a rest. The documents of a source lie in blocks by a hash of their
id; every epoch runs through the blocks in its own order, and the last, partial
one ends in the block where the budget runs out, at a position by hash.

Without a budget, the smallest one is taken that passes every document of the
source with the greatest share once, so no document is left out.

Rows: a null source is a source of its own. A null or empty text has no tokens;
it costs nothing and goes with its block. A source without any token is passed
once. Repeated rows and rows with equal ids are kept or left together. A null id
is hashed like any other value. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.llm.common import SPACES, pick, stored

#: Blocks of a source; a power of two, so that an odd step visits all.
BLOCKS = 4096
#: Interior points of one pass over the shares: each pass does four steps of the bisection.
POINTS = 15
PASSES = 6
#: Sources whose plan may be broadcast.
BROADCAST_SOURCES = 100_000


def with_size(docs: DataFrame, *keep: str) -> DataFrame:
    """Adds mix_source (never null), n_tokens (words of the whole text), block and place within the block."""
    bare = F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    rows = pick(docs, "doc_id", "source", "text", *(name for name in keep if name != "text"))
    return rows.withColumns({
        "mix_source": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
        "n_tokens": F.when(bare == "", 0).otherwise(F.size(F.split(bare, f"[{SPACES}]+"))).cast("long"),
        "block": F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(BLOCKS)).cast("int"),
        "place": F.xxhash64("doc_id", F.lit(2))})


def bisected(sources: DataFrame, tokens: float, holds) -> tuple[float, float]:
    """Exponents between which a condition ends to hold that holds at small exponents.

    ``holds`` gets an exponent, the sum of the powered shares and the sum of
    the powered shares times the log of the share.
    """
    share, power = F.col("tokens") / F.lit(tokens), F.pow(F.col("tokens") / F.lit(tokens), F.col("point"))
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        points = [low + (high - low) * n / (POINTS + 1) for n in range(POINTS + 2)]
        sums = sources.withColumn("point", F.explode(F.array(*map(F.lit, points)))).groupBy("point").agg(
            F.sum(power).alias("mass"), F.sum(power * F.log(share)).alias("weighted")).collect()
        held = {row.point: holds(row.point, row.mass, row.weighted) for row in sums}
        low = max((point for point in points if held[point]), default=0.0)
        high = min((point for point in points if point > low), default=low)
        if not any(held.values()):
            return 0.0, 0.0
    return low, high


def exponent(sources: DataFrame, target_entropy: float | None, most_repeats: float,
             budget: int | None) -> tuple[float, float]:
    """The exponent and the epochs per unit of share**(exponent - 1), from a table of mix_source and tokens.

    ``target_entropy`` is a share of the entropy of equal weights; with None
    the weights become as even as the repetitions allow.
    """
    shares = sources.where("tokens > 0")
    total, most, least, count = shares.agg(
        F.sum("tokens").cast("double"), F.max("tokens"), F.min("tokens"), F.count(F.lit(1))).first()
    if not count:
        return 1.0, 1.0
    most, least = most / total, least / total

    def unit(point: float, mass: float) -> float:
        return most ** (1 - point) if budget is None else budget / total / mass

    def too_often(point: float, mass: float, _: float) -> bool:
        return unit(point, mass) * least ** (point - 1) > most_repeats * (1 + 1e-9)

    def even_enough(point: float, mass: float, weighted: float) -> bool:
        return math.log(mass) - point * weighted / mass >= target_entropy * math.log(count)

    found = bisected(shares, total, too_often)[1]
    if target_entropy is not None:
        found = max(found, bisected(shares, total, even_enough)[0])
    mass = shares.agg(F.sum(F.pow(F.col("tokens") / F.lit(total), F.lit(found)))).first()[0]
    return found, unit(found, mass)


def step(epoch: Column | int) -> tuple[Column, Column]:
    """Odd step and start by which an epoch runs through the blocks."""
    number = F.lit(epoch) if isinstance(epoch, int) else epoch
    return (F.pmod(F.xxhash64(number, F.lit(3)), F.lit(BLOCKS // 2)) * 2 + 1,
            F.pmod(F.xxhash64(number, F.lit(4)), F.lit(BLOCKS)))


def turn(epoch: Column) -> Column:
    """When an epoch comes to a document's block, from 0; another order for every epoch."""
    odd, start = step(epoch)
    return F.pmod(F.col("block") * odd + start, F.lit(BLOCKS))


def plan(sized: DataFrame, target_entropy: float | None, most_repeats: float, budget: int | None) -> DataFrame:
    """One row per source: weight, whole epochs, and where the partial epoch after them ends.

    A document belongs to the partial epoch if its block's turn is before
    ``last_turn``, or at it and its place at most ``last_place``. Neither step
    looks at more than the blocks of a source or the documents of a block.
    """
    blocks = stored(sized.groupBy("mix_source", "block").agg(F.sum("n_tokens").alias("tokens")), "mix-blocks")
    sources = blocks.groupBy("mix_source").agg(F.sum("tokens").alias("tokens"))
    point, unit = exponent(sources, target_entropy, most_repeats, budget)
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    share = F.col("tokens") / F.lit(float(total))
    epochs = F.when(F.col("tokens") > 0, F.lit(unit) * F.pow(share, F.lit(point - 1))).otherwise(1.0)
    # Rounding must not cost a source its last whole epoch.
    whole = F.floor(epochs + 1e-9)
    goals = sources.withColumn("epochs", epochs).select(
        "mix_source", whole.cast("int").alias("whole"), (F.col("tokens") * epochs).alias("goal"),
        F.floor(F.greatest(epochs - whole, F.lit(0.0)) * F.col("tokens")).cast("long").alias("rest"))
    goals = goals.withColumn("weight", F.col("goal") / F.lit(goals.agg(F.sum("goal")).first()[0] or 1.0)).drop("goal")
    turns = blocks.join(goals, "mix_source").withColumn("turn", turn(F.col("whole")))
    upto = Window.partitionBy("mix_source").orderBy("turn")
    ends = turns.withColumn("after", F.sum("tokens").over(upto.rowsBetween(Window.unboundedPreceding, 0))).where(
        F.col("after") > F.col("rest")).groupBy("mix_source").agg(
        F.min("turn").alias("last_turn"), F.min(F.struct("turn", F.col("after") - F.col("tokens"))).alias("end"))
    ends = goals.join(ends, "mix_source", "left").select(
        "mix_source", "weight", "whole", F.coalesce("last_turn", F.lit(BLOCKS)).alias("last_turn"),
        (F.col("rest") - F.coalesce(F.col("end.col2"), F.col("rest"))).alias("left"))
    edge = with_plan(sized, ends).where(turn(F.col("whole")) == F.col("last_turn")).groupBy(
        "mix_source", "place", "left").agg(F.sum("n_tokens").alias("tokens"))
    upto = Window.partitionBy("mix_source").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    places = edge.withColumn("after", F.sum("tokens").over(upto)).where(F.col("after") <= F.col("left")).groupBy(
        "mix_source").agg(F.max("place").alias("last_place"))
    return stored(ends.drop("left").join(places, "mix_source", "left"), "mix-plan")


def with_plan(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Joins the plan of each document's source; broadcast if the sources are few, by shuffle if they are many."""
    few = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(sources) if few else sources, "mix_source")


def mix(docs: DataFrame, *keep: str, target_entropy: float | None = None, most_repeats: float = 2.0,
        budget: int | None = None) -> DataFrame:
    """One row for each time a document is passed: doc_id, source, further columns, epoch, turn, n_tokens, weight.

    ``budget`` is in tokens; without it every document is passed at least once.
    """
    sized = stored(with_size(docs).drop("text", "doc_id", "source"), "mix-sizes")
    rows = with_plan(with_size(docs, *keep), plan(sized, target_entropy, most_repeats, budget))
    own = turn(F.col("whole"))
    partial = (own < F.col("last_turn")) | ((own == F.col("last_turn")) & (F.col("place") <= F.col("last_place")))
    epochs = F.col("whole") + F.when(F.coalesce(partial, F.lit(False)) & (F.col("last_turn") < BLOCKS), 1).otherwise(0)
    return rows.withColumn("epochs", epochs).where("epochs > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1))).withColumn("turn", turn(F.col("epoch"))).select(
        "doc_id", "source", *keep, "epoch", F.col("turn").cast("int").alias("turn"), "n_tokens", "weight")


def mixed_documents(docs: DataFrame, **limits) -> DataFrame:
    """The documents as often as the mix passes them, with the columns of documents."""
    return mix(docs, "text", "lang", "n_chars", **limits).select("doc_id", "text", "lang", "source", "n_chars")
