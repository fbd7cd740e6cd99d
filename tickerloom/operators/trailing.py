"""Trailing-twelve-month sums over quarterly statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Measures that add up over a year.
FLOWS = (
    "revenue",
    "cost_of_revenue",
    "gross_profit",
    "operating_expenses",
    "operating_income",
    "net_income",
    "eps",
    "eps_diluted",
    "operating_cash_flow",
    "investing_cash_flow",
    "financing_cash_flow",
    "free_cash_flow",
    "capital_expenditures",
    "dividends_paid",
)
# Measures that hold at a date, taken from the newest quarter.
STOCKS = (
    "shares_outstanding",
    "total_assets",
    "current_assets",
    "total_liabilities",
    "current_liabilities",
    "total_equity",
    "cash_and_equivalents",
    "total_debt",
    "net_debt",
)
QUARTERS_NEEDED = 4
LOOKBACK_MONTHS = 15


def _framed(by: Sequence[str]) -> dict[str, Column]:
    """Trailing columns of each quarter over itself and the three before it."""
    frame = Window.partitionBy(*by).orderBy("fiscal_date").rowsBetween(1 - QUARTERS_NEEDED, 0)
    return {
        "calculation_date": F.to_date("accepted_date"),
        "quarters_included": F.count(F.lit(1)).over(frame).cast("int"),
        "oldest_quarter_date": F.min("fiscal_date").over(frame),
        "newest_quarter_date": F.col("fiscal_date"),
        **{f"ttm_{c}": F.sum(c).over(frame) for c in FLOWS},
        **{f"latest_{c}": F.col(c) for c in STOCKS},
    }


def _complete() -> Column:
    return (F.col("quarters_included") == QUARTERS_NEEDED) & (
        F.col("oldest_quarter_date") > F.add_months("calculation_date", -LOOKBACK_MONTHS)
    )


def ttm_in_order(quarters: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per quarter that completes a year, for filings that arrive in fiscal order.

    ``quarters`` has one row per entity and fiscal date. One shuffle; the frame spans four
    rows. Use ``ttm_as_known`` where a later quarter may be accepted before an earlier one.
    """
    return quarters.select(
        *by, "accepted_date", *[e.alias(n) for n, e in _framed(by).items()]
    ).where(_complete())


def with_ttm(quarters: DataFrame, by: Sequence[str], name: str = "ttm") -> DataFrame:
    """Each quarter with its trailing year as a struct, NULL where the year is incomplete.

    Saves deriving the quarters twice where filing and trailing year are both wanted.
    """
    cols = _framed(by)
    framed = quarters.withColumns(cols)
    return framed.withColumn(name, F.when(_complete(), F.struct(*cols))).drop(*cols)


def calculation_dates(quarters: DataFrame, by: Sequence[str]) -> DataFrame:
    """Days on which an entity filed, with the last acceptance time of that day."""
    return (
        quarters.where(F.col("accepted_date").isNotNull())
        .groupBy(*by, F.to_date("accepted_date").alias("calculation_date"))
        .agg(F.max("accepted_date").alias("known_at"))
    )


def quarters_as_known(quarters: DataFrame, by: Sequence[str]) -> DataFrame:
    """For each filing day the distinct quarters known then, newest first as ``quarter_rank``.

    A quarter can only serve days from its acceptance until 15 months after its fiscal
    date, so it is listed under the one to three calendar years of that span and meets
    the filing days of those years only.
    """
    days = calculation_dates(quarters, by).withColumn("_year", F.year("calculation_date"))
    until = F.add_months("fiscal_date", LOOKBACK_MONTHS + 1)
    usable = quarters.where(
        F.col("accepted_date").isNotNull() & (F.to_date("accepted_date") <= until)
    ).withColumn("_year", F.explode(F.sequence(F.year("accepted_date"), F.year(until))))

    known = days.join(usable, [*by, "_year"]).where(
        (F.col("accepted_date") <= F.col("known_at"))
        & (F.col("fiscal_date") > F.add_months("calculation_date", -LOOKBACK_MONTHS))
    )
    # of several versions of one quarter the last accepted counts
    newest = Window.partitionBy(*by, "calculation_date").orderBy(
        F.desc("fiscal_date"), F.desc("accepted_date")
    )
    once = known.withColumn("_newer", F.lag("fiscal_date").over(newest)).where(
        F.col("_newer").isNull() | (F.col("_newer") != F.col("fiscal_date"))
    )
    return once.withColumn("quarter_rank", F.row_number().over(newest)).drop("_newer", "_year")


def opportunities(quarters: DataFrame, by: Sequence[str]) -> DataFrame:
    """Filing days with at least four distinct quarters known, and the span they cover."""
    return (
        quarters_as_known(quarters, by)
        .groupBy(*by, "calculation_date", "known_at")
        .agg(
            F.count(F.lit(1)).alias("quarters_available"),
            F.min("fiscal_date").alias("oldest_quarter_date"),
            F.max("fiscal_date").alias("newest_quarter_date"),
        )
        .where(F.col("quarters_available") >= QUARTERS_NEEDED)
        .withColumnRenamed("known_at", "accepted_date")
    )


def ttm_as_known(quarters: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per entity and filing day with four quarters known, whatever their order."""
    first = F.col("quarter_rank") == 1

    def newest(c: str) -> Column:
        return F.max(F.when(first, F.col(c))).alias(f"latest_{c}")

    return (
        quarters_as_known(quarters, by)
        .where(F.col("quarter_rank") <= QUARTERS_NEEDED)
        .groupBy(*by, "calculation_date", "known_at")
        .agg(
            F.count(F.lit(1)).cast("int").alias("quarters_included"),
            F.min("fiscal_date").alias("oldest_quarter_date"),
            F.max("fiscal_date").alias("newest_quarter_date"),
            *[F.sum(c).alias(f"ttm_{c}") for c in FLOWS],
            *[newest(c) for c in STOCKS],
        )
        .where(F.col("quarters_included") == QUARTERS_NEEDED)
        .withColumnRenamed("known_at", "accepted_date")
    )


def ttm_integrity(ttm: DataFrame) -> DataFrame:
    """Rows that break a trailing-year rule, with the names of the broken rules."""
    span = F.months_between("newest_quarter_date", "oldest_quarter_date")
    broken = F.array_compact(
        F.array(
            F.when(F.col("quarters_included") != QUARTERS_NEEDED, "quarter count"),
            F.when((span < 8) | (span > 11), "quarter span"),
            F.when(F.col("newest_quarter_date") > F.col("calculation_date"), "future quarter"),
            F.when(F.col("ttm_revenue").isNull(), "no revenue"),
            F.when(F.col("latest_shares_outstanding").isNull(), "no shares"),
        )
    )
    return ttm.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)
