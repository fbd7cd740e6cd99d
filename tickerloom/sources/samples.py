"""Equity-shaped staging tables derived from the sample order tables.

A supplier stands for a company, a line item for a trade, and the trades of a quarter or
year for its statements. Every amount is cast to decimal before any arithmetic, which is
lossless here and makes sums exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def symbol_of(key: Column) -> Column:
    text = key.cast("string")
    return F.concat(F.lit("S"), F.lpad(text, 6, "0"))


def companies(spark: SparkSession, folder: str) -> DataFrame:
    """Company profiles, one per supplier."""
    s, n, r = (table(spark, folder, t) for t in ("supplier", "nation", "region"))
    key = F.col("s_suppkey")
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            key.alias("company_key"),
            symbol_of(key).alias("symbol"),
            F.col("s_name").alias("company_name"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("industry"),
            F.when(key % 2 == 0, "NASDAQ").otherwise("NYSE").alias("exchange"),
            (F.col("s_acctbal").cast("decimal(12,2)") * F.lit(30_000_000).cast("decimal(9,0)")).alias("market_cap"),
            F.when(key % 7 != 0, F.col("s_name")).alias("headquarters_city"),
            F.lit(None).cast("string").alias("headquarters_state"),
            F.col("n_name").alias("headquarters_country"),
        )
    )


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("company_key"),
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("p"),
        F.col("l_discount").cast("decimal(4,2)").alias("disc"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars: first and last trade by order number, extremes, volume."""
    # one exact number that sorts by order, line and price: a number keeps the hash
    # aggregate, where a struct would sort every partition first
    order = (
        F.col("ok").cast("decimal(19,0)") * F.lit(10**6).cast("decimal(7,0)") + F.col("ln").cast("decimal(6,0)")
    ) * F.lit(10**12).cast("decimal(13,0)") + (F.col("p") * 100).cast("decimal(12,0)")
    order = order.cast("decimal(38,0)")
    return (
        trades(spark, folder)
        .groupBy("company_key", F.col("d").alias("price_date"))
        .agg(
            F.min_by("p", order).alias("open_price"),
            F.max("p").alias("high_price"),
            F.min("p").alias("low_price"),
            F.max_by("p", order).alias("close_price"),
            F.sum("q").alias("volume"),
        )
        .withColumn("symbol", symbol_of(F.col("company_key")))
    )


def periods(spark: SparkSession, folder: str) -> DataFrame:
    """Sums per company and quarter, and per company and year under the period ``FY``.

    Trades are combined once, to quarters; the years add up the quarters.
    """
    sums = {"sp": "sp", "sd": "sd", "st": "st", "sq": "sq", "n": "n"}
    quarters = (
        trades(spark, folder)
        .groupBy("company_key", F.year("d").alias("y"), F.quarter("d").alias("qtr"))
        .agg(
            F.sum("p").alias("sp"),
            F.sum(F.col("p") * F.col("disc")).alias("sd"),
            F.sum(F.col("p") * F.col("tax")).alias("st"),
            F.sum("q").alias("sq"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    quarter = F.concat(F.lit("Q"), F.col("qtr").cast("string"))
    both = quarters.withColumn("period", F.explode(F.array(quarter, F.lit("FY"))))
    end_month = F.when(F.col("period") == "FY", 12).otherwise(F.substring("period", 2, 1).cast("int") * 3)
    return (
        both.groupBy("company_key", "y", "period")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            "company_key",
            symbol_of(F.col("company_key")).alias("symbol"),
            F.last_day(F.make_date("y", end_month, F.lit(1))).alias("fiscal_date"),
            "period",
            F.col("sp").cast("decimal(24,2)").alias("sp"),
            F.col("sd").cast("decimal(24,4)").alias("sd"),
            F.col("st").cast("decimal(24,4)").alias("st"),
            "sq",
            "n",
        )
    )


def _filed(df: DataFrame) -> DataFrame:
    filed = F.date_add("fiscal_date", 35)
    return df.withColumns(
        {
            "filing_date": filed,
            # accepted at 16:05 on the filing day
            "accepted_date": filed.cast("timestamp_ntz") + F.expr("interval '965' minute"),
        }
    )


STATEMENT_HEAD = ["company_key", "symbol", "fiscal_date", "period", "filing_date", "accepted_date"]


def _income_measures() -> dict[str, Column]:
    sp, sd, st, sq, n = (F.col(c) for c in ("sp", "sd", "st", "sq", "n"))
    return {
        "revenue": sp,
        "cost_of_revenue": sd,
        "gross_profit": sp - sd,
        "operating_expenses": st,
        "operating_income": sp - sd - st,
        "net_income": sp - sd - st - sq * 100,
        "eps": n * F.lit("0.05").cast("decimal(3,2)"),
        "eps_diluted": n * F.lit("0.04").cast("decimal(3,2)"),
        "shares_outstanding": sq * 1000,
    }


def _balance_measures() -> dict[str, Column]:
    sp, sd, st = (F.col(c) for c in ("sp", "sd", "st"))
    off = F.when(F.col("company_key") % 17 == 0, 1).otherwise(0)
    return {
        "total_assets": sp * 3,
        "current_assets": sp,
        "total_liabilities": sp + sd * 2,
        "current_liabilities": sd,
        "total_equity": sp * 2 - sd * 2 + off,
        "cash_and_equivalents": st,
        "total_debt": sd * 2,
        "net_debt": sd * 2 - st,
    }


def _cash_measures() -> dict[str, Column]:
    sp, sd, st = (F.col(c) for c in ("sp", "sd", "st"))
    return {
        "operating_cash_flow": sp - sd,
        "investing_cash_flow": -st,
        "financing_cash_flow": -sd,
        "free_cash_flow": sp - sd - st,
        "capital_expenditures": -st,
        "dividends_paid": F.when(F.col("company_key") % 4 == 0, F.lit(0).cast("decimal(24,4)")).otherwise(-sd),
    }


def _has_balance() -> Column:
    return (F.col("company_key") + F.month("fiscal_date")) % 11 != 0


def _has_cash() -> Column:
    return (F.col("company_key") + F.month("fiscal_date")) % 13 != 0


def _named(measures: dict[str, Column], present: Column | None = None) -> list[Column]:
    return [(e if present is None else F.when(present, e)).alias(n) for n, e in measures.items()]


def statements(spark: SparkSession, folder: str) -> DataFrame:
    """Integrated statements as the fact table holds them: one scan, no joins.

    Equal to joining ``income``, ``balance`` and ``cash``.
    """
    return _filed(periods(spark, folder)).select(
        *STATEMENT_HEAD,
        F.col("period").alias("period_type"),
        *_named(_income_measures()),
        *_named(_balance_measures(), _has_balance()),
        *_named(_cash_measures(), _has_cash()),
    )


def income(spark: SparkSession, folder: str) -> DataFrame:
    return _filed(periods(spark, folder)).select(*STATEMENT_HEAD, *_named(_income_measures()))


def balance(spark: SparkSession, folder: str) -> DataFrame:
    """Balance sheets; about one in eleven is missing and some do not add up."""
    rows = _filed(periods(spark, folder)).where(_has_balance())
    return rows.select(*STATEMENT_HEAD, *_named(_balance_measures()))


def cash(spark: SparkSession, folder: str) -> DataFrame:
    """Cash flows; about one in thirteen is missing and a quarter of companies pay nothing."""
    rows = _filed(periods(spark, folder)).where(_has_cash())
    return rows.select(*STATEMENT_HEAD, *_named(_cash_measures()))


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Job runs, one per event."""
    e = F.col("event_id")
    took = F.col("value").cast("decimal(20,2)")
    return table(spark, folder, "events").select(
        e.cast("string").alias("job_id"),
        F.col("event_type").alias("job_name"),
        F.when(e % 10 == 0, "FAILED").when(e % 10 == 1, "PARTIAL").otherwise("SUCCESS").alias("status"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(secs=took)).alias("end_time"),
        took.alias("duration_seconds"),
        (e % 1000).alias("records_loaded"),
        F.when(e % 10 <= 1, 1).otherwise(0).alias("error_count"),
        F.col("user_id").alias("symbols_processed"),
    )


def job_errors(spark: SparkSession, folder: str) -> DataFrame:
    """An error for each run that did not succeed."""
    code = (F.col("symbols_processed") % 5).cast("string")
    return (
        jobs(spark, folder)
        .where(F.col("status") != "SUCCESS")
        .select(
            F.col("job_id").cast("bigint").alias("error_id"),
            "job_id",
            "job_name",
            F.col("start_time").alias("error_timestamp"),
            F.lit("ETL_ERROR").alias("error_type"),
            F.concat(F.lit("failed with code "), code).alias("error_message"),
        )
    )


def options(spark: SparkSession, folder: str) -> DataFrame:
    """Option quotes: clicks are calls, views are puts."""
    return (
        table(spark, folder, "events")
        .where(F.col("event_type").isin("click", "view"))
        .select(
            F.col("user_id").alias("symbol"),
            F.col("ts").cast("date").alias("date"),
            F.when(F.col("event_type") == "click", "CALL").otherwise("PUT").alias("option_type"),
            F.col("value").alias("implied_volatility"),
            (F.col("event_id") % 100).alias("volume"),
            (F.col("event_id") % 1000).alias("open_interest"),
        )
    )
