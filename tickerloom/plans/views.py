"""Reports over the staging tables: latest rows, completeness, coverage, freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import dbl, exact_mean
from ..functions.dates import hour_boundaries, period_rank
from ..functions.labels import completeness_label, freshness_label, gap_label, rating
from ..operators.keyed import latest, newest_n
from ..operators.quality import detect, standard_detectors
from ..operators.series import gaps
from .facts import STATEMENT_KEYS


def missing_statements(income: DataFrame, balance: DataFrame, cash: DataFrame) -> DataFrame:
    """Income periods without a balance sheet, a cash flow, or both."""
    has_b = balance.select(*STATEMENT_KEYS, F.lit(True).alias("_b"))
    has_c = cash.select(*STATEMENT_KEYS, F.lit(True).alias("_c"))
    no_b, no_c = F.col("_b").isNull(), F.col("_c").isNull()
    return (
        income.select(*STATEMENT_KEYS)
        .join(has_b, STATEMENT_KEYS, "left")
        .join(has_c, STATEMENT_KEYS, "left")
        .where(no_b | no_c)
        .select(
            *STATEMENT_KEYS,
            F.when(no_b, "Missing Balance Sheet").alias("balance_sheet_status"),
            F.when(no_c, "Missing Cash Flow").alias("cash_flow_status"),
            completeness_label(no_b, no_c).alias("data_completeness"),
        )
    )


def price_gaps(prices: DataFrame, longer_than: int = 3) -> DataFrame:
    return gaps(prices, ["symbol"], "price_date", longer_than).withColumn(
        "gap_type", gap_label("days_gap")
    )


def latest_company(profiles: DataFrame, *ties: str) -> DataFrame:
    """The newest loaded profile of each symbol; ``ties`` are further columns, the larger first."""
    return latest(profiles, ["symbol"], [F.desc(c) for c in ("loaded_timestamp", "company_name", *ties)])


def latest_financials(income: DataFrame, balance: DataFrame, cash: DataFrame) -> DataFrame:
    """The newest statement of each kind per symbol, on one row where their periods agree.

    Balance and cash rows attach to another row only when they are their symbol's newest.
    A row stays if any of its three parts is a newest one. So an older balance row still
    shows, on a row of its own, where the newest cash flow has its period.
    """

    def ranked(df: DataFrame, measures: Sequence[str], tag: str) -> DataFrame:
        order = [F.desc("fiscal_date"), period_rank("period").asc_nulls_last()]
        top = F.row_number().over(Window.partitionBy("symbol").orderBy(*order)) == 1
        return df.select(
            *[F.col(k).alias(f"{tag}_{k}") for k in STATEMENT_KEYS], *measures, top.alias(f"{tag}_top")
        )

    i = ranked(
        income,
        ["revenue", "gross_profit", "operating_income", "net_income", "eps_diluted", "shares_outstanding"],
        "i",
    )
    b = ranked(
        balance,
        ["total_assets", "total_liabilities", "total_equity", "cash_and_equivalents", "total_debt"],
        "b",
    )
    c = ranked(cash, ["operating_cash_flow", "free_cash_flow", "dividends_paid"], "c").where("c_top")

    on_b = reduce(lambda x, y: x & y, [F.col(f"i_{k}") == F.col(f"b_{k}") for k in STATEMENT_KEYS])
    ib = i.join(b, on_b & F.col("b_top"), "full_outer").withColumns(
        {f"ib_{k}": F.coalesce(f"i_{k}", f"b_{k}") for k in STATEMENT_KEYS}
    )
    on_c = reduce(lambda x, y: x & y, [F.col(f"ib_{k}") == F.col(f"c_{k}") for k in STATEMENT_KEYS])
    kept = F.coalesce("i_top", F.lit(False)) | F.coalesce("b_top", F.lit(False)) | F.col("c_top").isNotNull()
    return (
        ib.join(c, on_c, "full_outer")
        .where(kept)
        .select(
            *[F.coalesce(f"ib_{k}", f"c_{k}").alias(k) for k in STATEMENT_KEYS],
            "revenue", "gross_profit", "operating_income", "net_income", "eps_diluted",
            "shares_outstanding", "total_assets", "total_liabilities", "total_equity",
            "cash_and_equivalents", "total_debt", "operating_cash_flow", "free_cash_flow",
            "dividends_paid",
        )
    )


def latest_per_period_type(facts: DataFrame, by: Sequence[str], since: Column) -> DataFrame:
    """The newest row per entity and period type among those not older than ``since``."""
    return latest(
        facts.where(F.col("fiscal_date") >= since), [*by, "period_type"], [F.desc("fiscal_date")]
    )


def latest_periods(facts: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    return newest_n(facts, by, [F.desc("fiscal_date"), period_rank("period").asc_nulls_last()], n)


def dq_issues(income: DataFrame, balance: DataFrame, prices: DataFrame, today: Column) -> DataFrame:
    return detect(standard_detectors(income, balance, prices, today))


def dq_scorecard(income: DataFrame, balance: DataFrame) -> DataFrame:
    """Share of income rows with revenue, and with a matching balance sheet, with a rating."""
    n = F.count(F.lit(1))
    complete = income.agg(
        F.when(n > 0, dbl(F.count("revenue")) * F.lit(100.0) / dbl(n)).alias("score")
    ).select(F.lit("Completeness").alias("metric_type"), F.lit("Financial Data").alias("category"), "score")
    marks = balance.select(*STATEMENT_KEYS, F.lit(1).alias("_b"))
    consistent = (
        income.select(*STATEMENT_KEYS)
        .join(marks, STATEMENT_KEYS, "left")
        .agg(F.when(n > 0, dbl(F.count("_b")) * F.lit(100.0) / dbl(n)).alias("score"))
        .select(F.lit("Consistency").alias("metric_type"), F.lit("Financial Statements").alias("category"), "score")
    )
    return complete.unionByName(consistent).select(
        "metric_type", "category", F.round("score", 2).alias("score_percentage"),
        rating("score").alias("quality_rating"),
    )


def staging_freshness(tables: Mapping[str, DataFrame], as_of: Column) -> DataFrame:
    """Row count, last load and hours since then per table."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("record_count"),
            F.max("loaded_timestamp").alias("last_load_time"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "hours_since_load", hour_boundaries("last_load_time", as_of)
    )


def freshness_monitor(tables: Mapping[str, tuple[DataFrame, int, int | None]], as_of: Column) -> DataFrame:
    """Last update, symbols covered and a status; per table its warning and critical hours."""
    parts = []
    for name, (df, warn, critical) in tables.items():
        one = df.agg(
            F.max("loaded_timestamp").alias("last_update"),
            F.count_distinct("symbol").alias("symbol_count"),
        ).withColumn("hours_since_update", hour_boundaries("last_update", as_of))
        parts.append(
            one.select(
                F.lit(name).alias("data_type"), "last_update", "hours_since_update", "symbol_count",
                freshness_label("hours_since_update", warn, critical).alias("freshness_status"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def recent_load_check(
    prices: DataFrame, as_of: Column, name: str, days: int = 3, stale_hours: int = 24
) -> DataFrame:
    """Whether anything loaded in the last ``days`` is older than ``stale_hours``."""
    recent = prices.where(F.col("loaded_timestamp") >= as_of - F.make_interval(days=F.lit(days)))
    return (
        recent.agg(
            F.max("price_date").alias("last_date"),
            F.count_distinct("symbol").alias("symbol_count"),
            F.max("loaded_timestamp").alias("last_load"),
        )
        .withColumn("hours_since_load", hour_boundaries("last_load", as_of))
        .select(
            F.lit(name).alias("table_name"), "last_date", "symbol_count", "hours_since_load",
            (F.col("hours_since_load") > stale_hours).alias("is_stale"),
        )
    )


def age_by_source(sources: Mapping[str, tuple[DataFrame, str, str]], as_of: Column) -> DataFrame:
    """Newest date per source and its age in the unit given for it, ``hour`` or ``day``."""
    parts = []
    for name, (df, day, unit) in sources.items():
        newest = df.agg(F.max(day).alias("latest_date"))
        age = (
            hour_boundaries(F.col("latest_date").cast("timestamp_ntz"), as_of)
            if unit == "hour"
            else F.date_diff(F.to_date(as_of), F.col("latest_date"))
        )
        parts.append(
            newest.select(
                F.lit(name).alias("data_type"), "latest_date",
                age.cast("bigint").alias("age"), F.lit(unit).alias("age_unit"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def summary_stats(profiles: DataFrame, prices: DataFrame, income: DataFrame) -> DataFrame:
    """Coverage figures as name, text value and unit.

    The income figures come from one aggregate. Distinct symbols and dates are counted
    after map-side deduplication.
    """

    def line(df: DataFrame, name: str, value: Column, unit: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("metric_name"), value.cast("string").alias("metric_value"),
            F.lit(unit).alias("metric_unit"),
        )

    one = income.agg(
        F.count(F.lit(1)).alias("n"), F.max("fiscal_date").alias("hi"), F.min("fiscal_date").alias("lo")
    )

    def cell(name: str, column: str, unit: str) -> Column:
        return F.struct(
            F.lit(name).alias("metric_name"), F.col(column).cast("string").alias("metric_value"),
            F.lit(unit).alias("metric_unit"),
        )

    statements = one.select(
        F.explode(
            F.array(
                cell("Financial Statements", "n", "records"),
                cell("Latest Data Date", "hi", "date"),
                cell("Earliest Data Date", "lo", "date"),
            )
        ).alias("c")
    ).select("c.*")
    return (
        line(profiles.agg(F.count_distinct("symbol").alias("v")), "Company Coverage", F.col("v"), "companies")
        .unionByName(line(prices.agg(F.count_distinct("price_date").alias("v")), "Price History Days", F.col("v"), "days"))
        .unionByName(statements)
    )


def symbol_coverage(companies: DataFrame, prices: DataFrame, facts: DataFrame) -> DataFrame:
    """How many symbols there are, how many have prices and how many statements."""
    p = prices.select("symbol").distinct().withColumn("_p", F.lit(True))
    f = facts.select("symbol").distinct().withColumn("_f", F.lit(True))
    return (
        companies.select("symbol")
        .distinct()
        .join(p, "symbol", "left")
        .join(f, "symbol", "left")
        .agg(
            F.count(F.lit(1)).alias("total_symbols"),
            F.count("_p").alias("symbols_with_prices"),
            F.count("_f").alias("symbols_with_financials"),
        )
    )


def without_recent_prices(companies: DataFrame, prices: DataFrame, since: Column) -> DataFrame:
    """Symbols with no price on or after ``since``."""
    recent = prices.where(F.col("price_date") >= since).select("symbol").distinct()
    return companies.select("symbol").distinct().join(recent, "symbol", "left_anti")


def daily_coverage(prices: DataFrame, threshold: int) -> DataFrame:
    """Dates on which fewer than ``threshold`` companies have a price."""
    return (
        prices.groupBy("price_date")
        .agg(F.count_distinct("symbol").alias("companies"))
        .where(F.col("companies") < threshold)
    )


def latest_coverage(prices: DataFrame, since: Column) -> DataFrame:
    """The newest price date and the companies covered since a date."""
    return prices.where(F.col("price_date") >= since).agg(
        F.max("price_date").alias("latest_date"), F.count_distinct("symbol").alias("companies")
    )


def monthly_valuation(metrics: DataFrame, by: Sequence[str], value: str = "pe_ratio_ttm") -> DataFrame:
    """Mean, lowest and highest stored value per entity and month."""
    return metrics.groupBy(
        *by, F.year("price_date").alias("year"), F.month("price_date").alias("month")
    ).agg(
        exact_mean(value).alias("avg_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def valuation_rollup(metrics: DataFrame, levels: Sequence[str], value: str = "pe_ratio_ttm") -> DataFrame:
    """The same figures at every level of a hierarchy, the grand total included."""
    return metrics.rollup(*levels).agg(
        F.grouping_id().alias("level"),
        F.count(value).alias("rows"),
        exact_mean(value).alias("avg_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def load_verification(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, first and last date and number of dates per fact."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(day).alias("first_date"),
            F.max(day).alias("last_date"),
            F.count_distinct(day).alias("dates"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, (df, day) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
