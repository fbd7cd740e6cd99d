"""Growth between periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import cagr, growth_pct
from .asof import asof_join
from .series import previous

# Measures of the growth fact.
GROWTH_MEASURES = (
    "revenue",
    "net_income",
    "eps",
    "eps_diluted",
    "operating_income",
    "gross_profit",
    "operating_cash_flow",
    "free_cash_flow",
    "total_assets",
    "total_equity",
    "book_value_per_share",
    "revenue_per_share",
)


def sequential(df: DataFrame, by: Sequence[str], period: str, measures: Sequence[str]) -> DataFrame:
    """Previous period's date and values as ``prev_*``; rows without one are dropped."""
    cols = {f"prev_{m}": m for m in (*measures, period)}
    return previous(df, by, [period], cols).where(F.col(f"prev_{period}").isNotNull())


def against_earlier(
    df: DataFrame,
    by: Sequence[str],
    period: str,
    months: int,
    measures: Sequence[str],
    how: str = "inner",
    prefix: str = "prior_",
    source: DataFrame | None = None,
) -> DataFrame:
    """Join each row to the row dated exactly ``months`` earlier, values as ``prior_*``.

    ``by`` may hold more than the entity, such as the period label. The earlier rows come
    from ``source``, or from ``df`` itself.
    """
    earlier = (df if source is None else source).select(
        *by,
        F.col(period).alias("_meets"),
        F.col(period).alias(f"{prefix}{period}"),
        *[F.col(m).alias(f"{prefix}{m}") for m in measures],
    )
    return (
        df.withColumn("_meets", F.add_months(period, -months))
        .join(earlier, [*by, "_meets"], how)
        .drop("_meets")
    )


def against_nearest(
    df: DataFrame, by: Sequence[str], period: str, months: int, measures: Sequence[str]
) -> DataFrame:
    """As ``against_earlier``, but the last row at or before that date serves."""
    earlier = df.select(
        *by,
        F.col(period).alias(f"prior_{period}"),
        *[F.col(m).alias(f"prior_{m}") for m in measures],
    )
    aimed = df.withColumn("_aim", F.add_months(period, -months))
    return asof_join(aimed, earlier, by, "_aim", f"prior_{period}", how="inner").drop("_aim")


def rates(measures: Sequence[str], prefix: str = "prior_", suffix: str = "_growth_rate") -> dict[str, Column]:
    return {f"{m}{suffix}": growth_pct(m, f"{prefix}{m}") for m in measures}


def with_cagr(
    df: DataFrame, by: Sequence[str], period: str, measure: str, years: Sequence[int]
) -> DataFrame:
    """``{measure}_cagr_{n}y`` for each n; NULL where no row lies exactly n years back."""
    base = df
    for n in years:
        df = against_earlier(df, by, period, 12 * n, [measure], "left", f"_{n}y_", base)
        df = df.withColumn(f"{measure}_cagr_{n}y", cagr(measure, f"_{n}y_{measure}", n)).drop(
            f"_{n}y_{measure}", f"_{n}y_{period}"
        )
    return df


def growth_quality(
    df: DataFrame, by: Sequence[str], period: str, rate: str, span: int = 4
) -> DataFrame:
    """Moving average, spread and change of a growth rate over the last ``span`` periods."""
    w = Window.partitionBy(*by).orderBy(period)
    frame = w.rowsBetween(1 - span, 0)
    return df.withColumns(
        {
            "growth_moving_average": F.round(F.avg(rate).over(frame), 6),
            "growth_consistency_score": F.round(F.stddev_samp(rate).over(frame), 6),
            "growth_acceleration": F.col(rate) - F.lag(rate).over(w),
        }
    )


def growth_rows(
    df: DataFrame,
    by: Sequence[str],
    period: str,
    calculation_date: str,
    period_type: str,
    periods_back: int,
    measures: Mapping[str, str],
) -> DataFrame:
    """Shape of the growth fact: ``{m}_growth_rate``, ``{m}_current`` and ``{m}_prior``.

    ``df`` carries each measure and its prior as ``prior_*``; ``measures`` maps the name in
    the fact to the column.
    """
    cells: list[Column] = []
    for name, column in measures.items():
        cells += [
            growth_pct(column, f"prior_{column}").alias(f"{name}_growth_rate"),
            F.col(column).alias(f"{name}_current"),
            F.col(f"prior_{column}").alias(f"{name}_prior"),
        ]
    return df.select(
        *by,
        F.col(calculation_date).alias("calculation_date"),
        F.lit(period_type).alias("period_type"),
        F.col(period).alias("current_period_date"),
        F.col(f"prior_{period}").alias("prior_period_date"),
        F.lit(periods_back).alias("periods_back"),
        *cells,
    )
