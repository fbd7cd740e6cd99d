"""What streams leave behind: mergeable bars and averages, high-water marks, late rows.

The handlers here take micro-batches of ``ticks.run_batches`` and keep tables of versions (see
``sources.versions``). Each write bears the number of its batch, so a batch that Spark repeats
after a failure changes nothing, wherever it had stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import sinks, versions

Handler = Callable[[DataFrame, int], None]

#: Bars merge by their first and last moments, extremes and sums.
BAR_STATES: dict[str, Callable[[], Column]] = {
    "first_at": lambda: F.min("first_at"),
    "open_price": lambda: F.min_by("open_price", "first_at"),
    "high_price": lambda: F.max("high_price"),
    "low_price": lambda: F.min("low_price"),
    "last_at": lambda: F.max("last_at"),
    "close_price": lambda: F.max_by("close_price", "last_at"),
    "volume": lambda: F.sum("volume"),
    "ticks": lambda: F.sum("ticks"),
}
AVERAGE_STATES: dict[str, Callable[[], Column]] = {
    "price_sum": lambda: F.sum("price_sum"),
    "ticks": lambda: F.sum("ticks"),
}


def made(states: Mapping[str, Callable[[], Column]]) -> dict[str, Column]:
    return {name: e() for name, e in states.items()}


def partial_bars(ticks: DataFrame, by: Sequence[str], price: str, volume: Column, tie: str, width: str = "1 day") -> DataFrame:
    """Bars of one batch, with the moments that let them be merged with others."""
    at = F.struct("ts", tie)
    rows = ticks.groupBy(*by, F.window("ts", width)["start"].alias("bar_start")).agg(
        F.min(at).alias("first_at"), F.min_by(price, at).alias("open_price"), F.max(price).alias("high_price"), F.min(price).alias("low_price"),
        F.max(at).alias("last_at"), F.max_by(price, at).alias("close_price"), F.sum(volume).alias("volume"), F.count(F.lit(1)).alias("ticks"),
    )
    return rows.withColumn("day", F.to_date("bar_start"))


def partial_averages(ticks: DataFrame, by: Sequence[str], price: str, width: str, slide: str) -> DataFrame:
    """Sums and counts of one batch in overlapping windows; divide at read time."""
    w = F.window("ts", width, slide)
    rows = ticks.groupBy(*by, w["start"].alias("window_start"), w["end"].alias("window_end")).agg(F.sum(price).alias("price_sum"), F.count(price).alias("ticks"))
    return rows.withColumn("day", F.to_date("window_start"))


def merged_batches(
    path: str, partial: Callable[[DataFrame], DataFrame], keys: Sequence[str], states: Mapping[str, Callable[[], Column]],
    partition_by: Sequence[str] = ("day",), stream: str = "stream",
) -> Handler:
    """Handler that merges each batch's partial states into a table with one row per key.

    No watermark is needed: a tick that comes late, however late, is merged into its window.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        spark, coming = df.sparkSession, partial(df)
        sinks.create_table(spark, path, coming.schema)
        sinks.combine_into(spark, path, coming, [*keys, *partition_by], partition_by, made(states), (stream, batch_id))

    return handle


# ---- late rows ---------------------------------------------------------------------------

ON_TIME, LATE, MARKS = "on_time", "late", "marks"
BUCKETS = 16


def create_late(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str]) -> None:
    """Empty tables of rows in time, late rows and marks."""
    for name in (ON_TIME, LATE):
        sinks.create_table(spark, f"{path}/{name}", schema)
    marks = [schema[c] for c in by] + [T.StructField("newest", T.TimestampType()), T.StructField("bucket", T.IntegerType())]
    sinks.create_table(spark, f"{path}/{MARKS}", T.StructType(marks))


def late_batches(
    path: str, by: Sequence[str], keys: Sequence[str], partition_by: Sequence[str], order: Sequence, lateness: str, stream: str = "stream"
) -> Handler:
    """Handler that keeps each entity's newest event time and sets rows aside that lie too far behind.

    A row is late if its ``ts`` is more than ``lateness`` before the newest one of its entity in
    all earlier batches; rows of one batch don't make each other late. Rows of unknown entities
    are in time. The marks are stored last: a batch that stopped before that is judged again by
    the same marks, and one that stopped after it is done.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        spark, batch = df.sparkSession, (stream, batch_id)
        known = f"{path}/{MARKS}"
        if versions.written(versions.newest(spark, known), batch):
            return
        marks = sinks.read_table(spark, known).drop("bucket")
        edge = F.col("newest") - F.expr(f"interval {lateness}")
        judged = df.join(marks, list(by), "left").withColumn("_late", F.coalesce(F.col("ts") < edge, F.lit(False))).drop("newest").persist()
        try:
            for name, some in ((ON_TIME, ~F.col("_late")), (LATE, F.col("_late"))):
                rows = judged.where(some).drop("_late")
                sinks.upsert_table(spark, f"{path}/{name}", rows, keys, partition_by, order, contest=True, batch=batch)
            seen = judged.groupBy(*by).agg(F.max("ts").alias("newest")).where(" and ".join(f"`{c}` is not null" for c in by))
            seen = seen.withColumn("bucket", F.pmod(F.xxhash64(*by), F.lit(BUCKETS)).cast("int"))
            sinks.combine_into(spark, known, seen, [*by, "bucket"], ["bucket"], {"newest": F.max("newest")}, batch)
        finally:
            judged.unpersist()

    return handle


def merge_late(spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str], order: Sequence) -> dict[str, int]:
    """Batch upsert of the late rows that came since the last merge into the rows in time."""
    side = f"{path}/{LATE}"
    rows, upto = versions.changes(spark, side, versions.newest(spark, side).columns, "merge")
    counts = sinks.upsert_table(spark, f"{path}/{ON_TIME}", rows, keys, partition_by, order, contest=True)
    versions.advance(spark, side, "merge", upto)
    return counts
