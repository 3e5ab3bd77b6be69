"""Models kept up to date from what changes only.

Rows come with a sign: new ones count once or more, withdrawn ones less than
zero. Sums and counts merge by addition, so a group is left out once none of
its rows is left, and a sum is NULL again once none of its values is. Joins of
counted sides are bilinear in the signed counts, so changed pairs are
``changed left x all right`` plus ``old left x changed right``.

Models that do not merge (maxima, minima, distinct counts, windows) read a
counted multiset of the rows they are made of: what changes in the merged
sums goes in with its sign, and a value is there as long as its count is not
zero, so no withdrawal needs a rebuild.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltatlas.operators import adoption, curated
from voltatlas.sources import versions
from voltatlas.sources.changes import TIMES, counted, difference, with_times
from voltatlas.streaming.sink import FOLD_EVERY, BatchLog, fold, run


def _as_is(df: DataFrame) -> DataFrame:
    return df


#: Added to the measures of a group: how many rows it has, and of each measure how many are not NULL.
ROWS, KNOWN = "n_rows", "_known"


@dataclass(frozen=True)
class SumModel:
    """``rows`` turns raw rows into what each brings to a key (``times`` stays), ``finish`` turns merged sums into the model."""

    keys: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame] = _as_is

    def partial(self, raw: DataFrame) -> DataFrame:
        """Signed sums per key."""
        rows = self.rows(with_times(raw))
        measures = [name for name in rows.columns if name not in (*self.keys, TIMES)]
        return rows.groupBy(*self.keys).agg(
            F.sum(TIMES).alias(ROWS),
            *[F.sum(F.col(name) * F.col(TIMES)).alias(name) for name in measures],
            *[F.coalesce(F.sum(F.when(F.col(name).isNotNull(), F.col(TIMES))), F.lit(0)).alias(name + KNOWN) for name in measures])

    def settled(self, sums: DataFrame) -> DataFrame:
        """The model from merged sums."""
        measures = [name for name in sums.columns if name + KNOWN in sums.columns]
        return self.finish(sums.where(F.col(ROWS) != 0).select(
            *self.keys, *[F.when(F.col(name + KNOWN) != 0, F.col(name)).alias(name) for name in measures]))


SUM_MODELS = {
    "ev_by_region": SumModel(
        ("postal_area",), lambda raw: curated.region_rows(raw, TIMES), curated.region_from_sums),
    "charging_by_area": SumModel(("area_manager_id",), lambda raw: curated.charging_rows(raw, TIMES)),
    "ev_growth_trends": SumModel(
        ("registration_year", "fuel_category"),
        lambda raw: adoption.growth_rows(curated.vehicles_with_fuel(raw, TIMES), 2015, TIMES),
        adoption.growth_from_sums,
    ),
    "brandstof_per_postcode": SumModel(
        ("postcode", "brandstof"), lambda raw: adoption.postcode_fuel_rows(raw, TIMES)),
}


@dataclass(frozen=True)
class CountedModel:
    """A model over the rows of a sum model that is not a sum itself.

    ``rows`` picks the rows and columns it is made of; ``summary`` makes the
    model of these rows, each as often as ``times`` says, which is above zero.
    """

    source: str
    rows: Callable[[DataFrame], DataFrame]
    summary: Callable[[DataFrame], DataFrame]


def national_model(min_total: int = 1000) -> CountedModel:
    """Extremes and distinct areas of the regions that are large enough."""
    return CountedModel("ev_by_region", lambda regions: regions.where(F.col("total_vehicles") > min_total),
                        lambda rows: adoption.national_ev_summary(rows.where(F.col(TIMES) > 0), min_total))


COUNTED_MODELS = {
    "national_ev_summary": national_model(),
    "ev_yoy_growth": CountedModel("ev_growth_trends", _as_is, adoption.yoy_from_sums),
}


#: Where the models of an update go, and the raw tables they read.
SUM_TABLES = {
    "ev_by_region": ("curated", "vehicles_by_postcode_raw"),
    "charging_by_area": ("curated", "charging_capacity_raw"),
    "ev_growth_trends": ("analytics", "vehicles_fuel_raw"),
    "brandstof_per_postcode": ("analytics", "vehicles_by_postcode_raw"),
}
JOIN_TABLES = {
    "brandstof_per_postcode_datum": ("analytics", "vehicles_raw", "vehicles_fuel_raw"),
    "laadpalen_per_postcode": ("analytics", "parking_address_raw", "charging_capacity_raw"),
}


def sums_log(spark: SparkSession, model: SumModel, state: str) -> BatchLog:
    return BatchLog(spark, state, lambda partials: fold(partials, list(model.keys)))


def refresh_sums(
    new_rows: DataFrame, model: SumModel, state: str, checkpoint: str, trigger: dict[str, object] | None = None,
    fold_every: int = FOLD_EVERY, counted_models: dict[str, CountedModel] | None = None,
) -> StreamingQuery:
    """Adds the signed partial sums of each micro-batch of raw rows to the model's state.

    ``counted_models`` are models over this one that are kept along with it,
    under their names.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = sums_log(spark, model, state)
        log.put(model.partial(batch), batch_id)
        for name, above in (counted_models or {}).items():
            follow(spark, model, state, name, above, batch_id, fold_every)
        log.fold_now_and_then(batch_id, fold_every)

    return run(new_rows, each_batch, checkpoint, trigger=trigger)


def follow(spark: SparkSession, model: SumModel, state: str, name: str, above: CountedModel, batch_id: int,
           fold_every: int = FOLD_EVERY) -> None:
    """Writes what a batch has changed in the rows of a counted model: of the keys it touched, the rows before and after."""
    log, multiset = sums_log(spark, model, state), counted_log(spark, state, name)
    touched = spark.read.parquet(f"{log.batches}/batch_id={batch_id}")
    sides = []
    for upto in (batch_id - 1, batch_id):
        known = log.read(upto=upto)
        if known is not None:
            keys = touched.select(*[F.col(key).alias(f"touched_{key}") for key in model.keys]).distinct()
            same = [F.col(key).eqNullSafe(F.col(f"touched_{key}")) for key in model.keys]
            known = above.rows(model.settled(log.fold(known.join(keys, same, "left_semi"))))
        sides.append(known)
    multiset.put(difference(*sides), batch_id)
    multiset.fold_now_and_then(batch_id, fold_every)


def counted_log(spark: SparkSession, state: str, name: str) -> BatchLog:
    return BatchLog(spark, f"{state}/counted/{name}", counted)


def read_counted(spark: SparkSession, state: str, name: str, above: CountedModel) -> DataFrame:
    """The counted model as of the last finished batch."""
    log = counted_log(spark, state, name)
    return above.summary(log.fold(_written(log)))


def read_sums(spark: SparkSession, model: SumModel, state: str) -> DataFrame:
    """The model as of the last finished batch."""
    log = sums_log(spark, model, state)
    return model.settled(log.fold(_written(log)))


def _written(log: BatchLog) -> DataFrame:
    rows = log.read()
    if rows is None:
        raise LookupError(f"no batch has been written to {log.folder}")
    return rows


@dataclass(frozen=True)
class JoinModel:
    """Two counted sides, their product summed per key, and the final shape.

    ``on`` is the column the sides join on; ``left_keys`` and ``right_keys`` are what each side is counted by.
    ``left`` and ``right`` turn raw rows into what each brings (``times`` stays); no value is NULL.
    """

    keys: tuple[str, ...]
    on: str
    left_keys: tuple[str, ...]
    right_keys: tuple[str, ...]
    left: Callable[[DataFrame], DataFrame]
    right: Callable[[DataFrame], DataFrame]
    product: Callable[[DataFrame, DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame] = _as_is


def _signed(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Signed sums of one side per key."""
    measures = [name for name in rows.columns if name not in (*keys, TIMES)]
    return rows.groupBy(*keys).agg(*[F.sum(F.col(name) * F.col(TIMES)).alias(name) for name in measures])


def _without_empty(sums: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Leaves out keys all of whose rows have been withdrawn."""
    measures = [name for name in sums.columns if name not in (*keys, "slot")]
    left = F.lit(False)
    for name in measures:
        left = left | (F.col(name) != 0)
    return sums.where(left)


JOIN_MODELS = {
    "brandstof_per_postcode_datum": JoinModel(
        ("datum",), "kenteken", ("kenteken", "datum"), ("kenteken",),
        lambda raw: adoption.plate_month_rows(raw, 2015, TIMES), lambda raw: adoption.plate_fuel_rows(raw, TIMES),
        adoption.month_fuel_sums, adoption.fuel_rows),
    "laadpalen_per_postcode": JoinModel(
        ("postcode",), "areamanagerid", ("areamanagerid", "postcode"), ("areamanagerid",),
        lambda raw: adoption.address_rows(raw, TIMES), lambda raw: adoption.capacity_rows(raw, TIMES),
        adoption.postcode_charger_sums, lambda sums: sums.where(F.col("aantal") != 0)),
}


def _tagged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both inputs as one stream, so that one batch id covers both."""
    left_type, right_type = left.schema.simpleString(), right.schema.simpleString()
    return left.select(
        F.struct(*left.columns).alias("l"), F.lit(None).cast(right_type).alias("r")
    ).unionByName(right.select(F.lit(None).cast(left_type).alias("l"), F.struct(*right.columns).alias("r")))


#: Ranges of the join key by hash. A batch reads those of the other side that its own keys fall into.
SLOTS = 16


def _slotted(counted: DataFrame, key: str) -> DataFrame:
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")
    return counted.withColumn("slot", slot).hint("rebalance", "slot")


def side_logs(spark: SparkSession, model: JoinModel, state: str) -> tuple[BatchLog, BatchLog]:
    def log(side: str, keys: tuple[str, ...]) -> BatchLog:
        def folded(rows: DataFrame) -> DataFrame:
            return _without_empty(fold(rows, [*keys, "slot"]), keys).hint("rebalance", "slot")

        return BatchLog(spark, f"{state}/{side}", folded, ("slot",))

    return log("left", model.left_keys), log("right", model.right_keys)


def join_log(spark: SparkSession, model: JoinModel, state: str) -> BatchLog:
    return BatchLog(spark, f"{state}/sums", lambda partials: fold(partials, list(model.keys)))


def refresh_join(
    new_left: DataFrame,
    new_right: DataFrame,
    model: JoinModel,
    state: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Adds the pairs each micro-batch brings, or withdraws, to the model's sums.

    The counted sides are kept by ranges of the join key. A batch joins its new
    rows with the ranges of the other side they fall into, as plain scans: the
    new side is normally small enough to be broadcast by its measured size, and
    when it is not, the shuffled join can still split a hot key. A batch that
    touches all ranges reads all of the other side; where the batches of a
    minute do, a longer trigger costs less.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        logs = side_logs(spark, model, state)
        fresh = [
            _slotted(_signed(model.left(with_times(batch.where(F.col("l").isNotNull()).select("l.*"))), model.left_keys), model.on),
            _slotted(_signed(model.right(with_times(batch.where(F.col("r").isNotNull()).select("r.*"))), model.right_keys), model.on),
        ]
        for log, counted in zip(logs, fresh):
            log.put(counted, batch_id)
        new = [_one_batch(log, batch_id) for log in logs]
        old = [log.read(upto=batch_id - 1) for log in logs]
        pairs = []
        if new[0] is not None:
            for right in (old[1], new[1]):
                pairs.append(_pairs(model, new[0], right, new[0]))
        if new[1] is not None:
            pairs.append(_pairs(model, old[0], new[1], new[1]))
        pairs = [product for product in pairs if product is not None]
        total = join_log(spark, model, state)
        if pairs:
            whole = pairs[0]
            for product in pairs[1:]:
                whole = whole.unionByName(product)
            total.put(total.fold(whole), batch_id)
        for log in (*logs, total):
            log.fold_now_and_then(batch_id, fold_every)

    return run(_tagged(new_left, new_right), each_batch, checkpoint, trigger=trigger)


def _one_batch(log: BatchLog, batch_id: int) -> DataFrame | None:
    """What a batch has written to one side; None if it brought nothing there."""
    folder = f"{log.batches}/batch_id={batch_id}"
    if not versions.names(log.spark, folder):
        return None
    return log.spark.read.option("basePath", folder).parquet(folder)


def _pairs(model: JoinModel, left: DataFrame | None, right: DataFrame | None, new: DataFrame) -> DataFrame | None:
    """Product of the sides over the key ranges the new rows fall into."""
    if left is None or right is None:
        return None
    touched = [row["slot"] for row in new.select("slot").distinct().collect()]  # at most SLOTS numbers
    within = F.col("slot").isin(touched)
    return model.product(left.where(within).drop("slot"), right.where(within).drop("slot"))


def read_join(spark: SparkSession, model: JoinModel, state: str) -> DataFrame:
    """The model as of the last finished batch."""
    log = join_log(spark, model, state)
    return model.finish(log.fold(_written(log)))
