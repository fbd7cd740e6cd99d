"""Live valuation: a stream of ticks keeps bars, price facts and metrics current.

Each micro-batch is merged into daily bars. From there the changes run through the tables of the
daily run: the bars that changed into staged prices, those into price facts, and those into the
metrics of exactly the companies and days touched. Months that no tick falls in keep their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import short_shuffles
from ..sources import sinks
from ..streaming.state import BAR_STATES, Handler, made
from . import daily

_MOMENT = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("seq", T.DecimalType(38, 0))])
_PRICE = T.DecimalType(20, 4)
_COLUMNS = {
    "symbol": T.StringType(), "price_date": T.DateType(), "first_at": _MOMENT, "open_price": _PRICE, "high_price": _PRICE, "low_price": _PRICE,
    "last_at": _MOMENT, "close_price": _PRICE, "volume": T.LongType(), "ticks": T.LongType(),
}
BARS = daily.Stored(
    "live/bars",
    T.StructType([T.StructField(name, kind) for name, kind in _COLUMNS.items()]),
    ["symbol", "price_date"],
    "month",
    lambda: daily.month_of(F.col("price_date")),
)
daily.TABLES["live_bars"] = BARS


def partial_days(ticks: DataFrame) -> DataFrame:
    """Daily bars of one batch of ticks (``symbol``, ``ts``, ``seq``, ``price``, ``volume``)."""
    at = F.struct("ts", F.col("seq").cast("decimal(38,0)").alias("seq"))
    rows = ticks.groupBy("symbol", F.to_date("ts").alias("price_date")).agg(
        F.min(at).alias("first_at"), F.min_by("price", at).alias("open_price"), F.max("price").alias("high_price"), F.min("price").alias("low_price"),
        F.max(at).alias("last_at"), F.max_by("price", at).alias("close_price"), F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("ticks"),
    )
    return BARS.stamped(rows)


def stage_bars(spark: SparkSession, root: str, changed: DataFrame) -> dict[str, int]:
    """The changed bars, as they are now, to the staged prices."""
    now = daily.read(spark, root, "live_bars").join(changed.select("symbol", "price_date", "month").distinct(), ["symbol", "price_date", "month"], "left_semi")
    rows = now.select("symbol", "price_date", "open_price", "high_price", "low_price", "close_price", "volume", F.localtimestamp().alias("loaded_timestamp"))
    lacking = [f for f in daily.TABLES["price"].schema.fields if f.name not in rows.columns]
    return daily.store(spark, root, "price", rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking}), near=changed)


def valued_batches(root: str, stream: str = "ticks") -> Handler:
    """Handler that brings bars, price facts and metrics up to each batch.

    The companies and statements are those of the daily run on the same root. A batch that is
    repeated, or that follows one that stopped half way, leaves the same tables.
    """

    def handle(ticks: DataFrame, batch_id: int) -> None:
        spark = ticks.sparkSession
        with short_shuffles(spark):
            keys = [*BARS.keys, BARS.part]
            months = BARS.stamped(ticks.select(F.to_date("ts").alias("price_date")))
            sinks.combine_into(spark, f"{root}/{BARS.folder}", partial_days(ticks), keys, [BARS.part], made(BAR_STATES), (stream, batch_id), near=months)
            daily.follow(spark, root, "price", ["live_bars"], lambda c: stage_bars(spark, root, c["live_bars"]))
            daily.follow(spark, root, "prices", ["price"], lambda c: daily.update_prices(spark, root, changed=c["price"]))
            daily.follow(spark, root, "metrics", daily.METRIC_SOURCES, lambda c: daily.metrics_after(spark, root, c))

    return handle
