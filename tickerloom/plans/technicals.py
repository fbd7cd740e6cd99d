"""Daily equity metrics: returns, moving averages, volatility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.series import moving_averages, returns, volatility

# Rows back per return, rows per average.
RETURN_OFFSETS = {
    "return_1d": 1, "return_5d": 5, "return_1m": 21, "return_3m": 63, "return_6m": 126, "return_1y": 252,
}
AVERAGE_SPANS = {"sma_20": 20, "sma_50": 50, "sma_200": 200}
VOLATILITY_ROWS = 20
VOLATILITY_DAYS = 30


def daily_equity_metrics(
    prices: DataFrame, by: Sequence[str] = ("symbol",), day: str = "price_date", price: str = "close_price"
) -> DataFrame:
    """All technical columns of every day, from one sort of each entity's series.

    Cut to the wanted day afterwards; a window over an already cut series sees nothing.
    """
    df = returns(prices, by, day, price, RETURN_OFFSETS)
    df = moving_averages(df, by, day, price, AVERAGE_SPANS)
    return volatility(df, by, day, "return_1d", rows=VOLATILITY_ROWS, name="volatility_20d")


def trailing_volatility(
    prices: DataFrame, as_of, by: Sequence[str] = ("symbol",), days: int = VOLATILITY_DAYS
) -> DataFrame:
    """Volatility per entity over the calendar days before ``as_of``, as one figure each."""
    recent = prices.where(
        (F.col("price_date") >= F.date_sub(as_of, days)) & (F.col("price_date") <= as_of)
    )
    daily = returns(recent, by, "price_date", "close_price", {"return_1d": 1})
    value = F.stddev_samp("return_1d") * F.sqrt(F.lit(252.0))
    return (
        daily.where(F.col("return_1d").isNotNull())
        .groupBy(*by)
        .agg(F.max("price_date").alias("date"), F.round(value, 6).alias("volatility_20d"))
    )


def latest_day(metrics: DataFrame, as_of, day: str = "price_date") -> DataFrame:
    return metrics.where(F.col(day) == as_of)
