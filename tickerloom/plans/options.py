"""Option chain reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import exact_mean, ratio


def daily_chain(options: DataFrame, by: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Mean volatility, volume and open interest per symbol and day."""
    return options.groupBy(*by).agg(
        exact_mean("implied_volatility").alias("avg_implied_vol"),
        F.sum("volume").alias("total_volume"),
        F.sum("open_interest").alias("total_open_interest"),
    )


def chain_metrics(options: DataFrame, by: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Call and put volumes, their ratio, mean volatilities and their skew (put minus call)."""
    call, put = F.col("option_type") == "CALL", F.col("option_type") == "PUT"
    sums = options.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(call, F.col("volume"))), F.lit(0)).alias("total_call_volume"),
        F.coalesce(F.sum(F.when(put, F.col("volume"))), F.lit(0)).alias("total_put_volume"),
        exact_mean(F.when(call, F.col("implied_volatility"))).alias("avg_call_iv"),
        exact_mean(F.when(put, F.col("implied_volatility"))).alias("avg_put_iv"),
        F.sum("open_interest").alias("total_open_interest"),
    )
    return sums.withColumns(
        {
            "call_put_ratio": ratio("total_call_volume", "total_put_volume"),
            "put_call_skew": F.round(F.col("avg_put_iv") - F.col("avg_call_iv"), 6),
        }
    )


def volatility_rank(daily: DataFrame, by: Sequence[str] = ("symbol",), value: str = "avg_implied_vol") -> DataFrame:
    """Where a day's mean volatility stands among the symbol's days, from 0 to 1.

    Ranks daily rows, of which a symbol has one per calendar day.
    """
    return daily.withColumn("iv_rank", F.percent_rank().over(Window.partitionBy(*by).orderBy(value)))
