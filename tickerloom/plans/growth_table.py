"""The growth fact: quarters, fiscal years and trailing years against earlier ones, and what it serves.

All statements of a company are shuffled together once, to as many tasks as their number asks for. Each period has its place on a fiscal
index that counts calendar quarters, so "n quarters back" is one value of the index: a range frame
of a window finds the period there or none, whatever periods are missing between. Quarters, years
and trailing years are three kinds of rows in the same partition and share these windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import growth_pct, ratio
from ..functions.dates import is_quarter
from ..functions.valuation import peg
from ..operators.growth import GROWTH_MEASURES, growth_quality
from ..operators.trailing import with_ttm
from ..session import work_dir
from .facts import market_metrics

#: For each kind of row how many quarters lie between a period and the one ``periods_back`` of its kind.
PERIODS = {
    "QUARTERLY": {1: 1, 4: 4, 12: 12, 20: 20},
    "ANNUAL": {1: 4, 3: 12, 5: 20},
    "TTM": {1: 4, 3: 12, 5: 20},
}
#: Statements that a task has on average: each becomes up to eight wide rows, which are sorted several times.
EACH = 8192
_SHARE = ("book_value_per_share", "revenue_per_share")
_HELD = ("total_assets", "total_equity")


def fiscal_index(day: Column | str) -> Column:
    """Calendar quarters since year 0: the quarter before has the index before."""
    return (F.year(day) * 4 + F.quarter(day)).cast("int")


def _measured(values: dict[str, Column]) -> Column:
    """Measures in common types, so that all kinds of rows fit one column."""
    kinds = {m: "double" if m in _SHARE else "decimal(38,4)" for m in GROWTH_MEASURES}
    return F.struct(*[values[m].cast(kind).alias(m) for m, kind in kinds.items()])


def _kinds(statements: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, calculation_date, fiscal_date, _index, period_type, measures): each period's own row,
    and the trailing year's that a quarter completes."""
    quarter = is_quarter("period_type")
    # stored, as their number is needed before they are dealt
    spark, path = statements.sparkSession, work_dir(statements.sparkSession, "growth-statements")
    some = statements.where(quarter | (F.col("period_type") == "FY")).withColumn("_quarter", quarter)
    some.write.parquet(path)
    some = spark.read.schema(some.schema).parquet(path)
    # dealt by entity alone, which serves every window below; an entity has few statements, and more
    # statements get more tasks, so that none has to sort more of them
    together = some.repartition(max(2, -(-some.count() // EACH)), *by)
    framed = with_ttm(together, [*by, "_quarter"])
    own = _measured({m: F.col(m) for m in GROWTH_MEASURES})
    year = {m: F.col(f"ttm.latest_{m}" if m in _HELD else f"ttm.ttm_{m}") for m in GROWTH_MEASURES if m not in _SHARE}
    year["book_value_per_share"] = F.col("book_value_per_share")
    year["revenue_per_share"] = ratio(F.col("ttm.ttm_revenue"), F.col("ttm.latest_shares_outstanding"))
    rows = F.array_compact(
        F.array(
            F.struct(F.when(F.col("_quarter"), "QUARTERLY").otherwise("ANNUAL").alias("period_type"), own.alias("now")),
            F.when(F.col("_quarter") & F.col("ttm").isNotNull(), F.struct(F.lit("TTM").alias("period_type"), _measured(year).alias("now"))),
        )
    )
    head = [*by, F.to_date("accepted_date").alias("calculation_date"), "fiscal_date", fiscal_index("fiscal_date").alias("_index")]
    return framed.select(*head, F.explode(rows).alias("_r")).select(*by, "calculation_date", "fiscal_date", "_index", "_r.period_type", "_r.now.*")


def growth_fact(statements: DataFrame, by: Sequence[str] = ("company_key",)) -> DataFrame:
    """One row per entity, calculation date, period type and ``periods_back``.

    ``statements`` are integrated rows of quarters and fiscal years with their ratios. A growth
    rate is in percent of a positive prior value, else NULL. ``growth_moving_average``,
    ``growth_consistency_score`` (spread) and ``growth_acceleration`` are taken of the revenue's
    rate over the last four rows of the same kind. A period without the prior one has no row for
    that distance; one without acceptance time has no row but serves as prior. Of several
    periods that became known on one day the newest has the row.
    """
    by = list(by)
    rows = _kinds(statements, by)
    place = Window.partitionBy(*by, "period_type").orderBy("_index")
    known = F.struct("fiscal_date", *GROWTH_MEASURES)
    backs = sorted({back for kind in PERIODS.values() for back in kind.values()})
    rows = rows.withColumns({f"_{back}": F.max(known).over(place.rangeBetween(-back, -back)) for back in backs})
    met = [
        F.when((F.col("period_type") == kind) & F.col(f"_{back}").isNotNull(), F.struct(F.lit(n).alias("periods_back"), F.col(f"_{back}").alias("prior")))
        for kind, periods in PERIODS.items()
        for n, back in periods.items()
    ]
    rows = rows.where(F.col("calculation_date").isNotNull()).select(
        *by, "calculation_date", "period_type", F.col("fiscal_date").alias("current_period_date"), *GROWTH_MEASURES, F.explode(F.array_compact(F.array(*met))).alias("_m")
    )
    cells = [
        e
        for m in GROWTH_MEASURES
        for e in (
            growth_pct(m, f"_m.prior.{m}").alias(f"{m}_growth_rate"),
            F.col(m).alias(f"{m}_current"),
            F.col(f"_m.prior.{m}").alias(f"{m}_prior"),
        )
    ]
    rows = rows.select(
        *by, "calculation_date", "period_type", "current_period_date", F.col("_m.prior.fiscal_date").alias("prior_period_date"),
        F.col("_m.periods_back").alias("periods_back"), *cells,
    )
    same = [*by, "period_type", "periods_back"]
    newest = Window.partitionBy(*same, "calculation_date").orderBy(F.desc("current_period_date"))
    rows = rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
    return growth_quality(rows, same, "current_period_date", "revenue_growth_rate")


def fast_growers(fact: DataFrame, least: float = 15, spread: float = 0.8) -> DataFrame:
    """Rows whose revenue grows by more than ``least`` percent, operating income by more than
    that, and whose rates spread by more than ``spread``."""
    rate = F.col("revenue_growth_rate")
    return fact.where((rate > least) & (F.col("operating_income_growth_rate") > rate) & (F.col("growth_consistency_score") > spread))


def with_year_before(filings: DataFrame, by: Sequence[str], ttm: str = "ttm") -> DataFrame:
    """Quarters with their trailing year, which also tells the year before it: its last quarter
    and how earnings per share have grown since. The quarters are already together, so it costs
    one more frame and no shuffle."""
    place = Window.partitionBy(*by).orderBy("_index").rangeBetween(-4, -4)
    earlier = F.struct(F.col(f"{ttm}.newest_quarter_date").alias("day"), F.col(f"{ttm}.ttm_eps_diluted").alias("eps"))
    rows = filings.withColumn("_index", fiscal_index("fiscal_date"))
    rows = rows.withColumn("_before", F.max(F.when(F.col(ttm).isNotNull(), earlier)).over(place))
    grown = growth_pct(F.col(f"{ttm}.ttm_eps_diluted"), F.col("_before.eps"))
    told = F.col(ttm).withField("prior_quarter_date", F.col("_before.day")).withField("eps_growth", grown)
    return rows.withColumn(ttm, F.when(F.col(ttm).isNotNull(), told)).drop("_index", "_before")


def peg_ratios(prices: DataFrame, filings: DataFrame, by: Sequence[str] = ("company_key",), day: str = "price_date") -> DataFrame:
    """Price/earnings over the growth of trailing earnings, for every price whose trailing year
    and the year before it are known. ``filings`` are quarters with their ratios."""
    told = with_year_before(with_ttm(filings, by), by)
    rows = market_metrics(prices, told, by=by, day=day, carry=("prior_quarter_date", "eps_growth")).where("prior_quarter_date is not null")
    return rows.select(*by, day, "pe_ratio_ttm", "eps_growth", peg("pe_ratio_ttm", "eps_growth").alias("peg_ratio"))
