"""Coverage, freshness, job monitoring and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.operators import keyed, quality
from tickerloom.operators.series import multiple_of_average, price_change
from tickerloom.plans import dims, monitoring, views
from tickerloom.sources import samples, sinks

from . import facts as facts_checks
from .layout import LISTED, snapshots
from .registry import dbl, plain, query

BY = ["company_key"]
def today():
    return F.lit("2001-06-30").cast("date")

def now():
    return F.lit("2024-02-01 00:30:00").cast("timestamp_ntz")

_NOW = "timestamp '2024-02-01 00:30:00'"


# ---- latest, top, duplicates -------------------------------------------------------------

@query(
    "latest_company",
    """select symbol, company_name, loaded_timestamp, cast(o_totalprice as double) as market_cap from (
      select 'S' || lpad(cast(o_custkey as varchar), 6, '0') as symbol, o_orderpriority as company_name, o_orderdate as loaded_timestamp,
        o_totalprice, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderpriority desc, o_orderkey desc) as rn from orders) where rn = 1""",
)
def latest_company(spark, d):
    """Orders stand for repeated profile loads of a customer."""
    history = samples.table(spark, d, "orders").select(
        samples.symbol_of(F.col("o_custkey")).alias("symbol"),
        F.col("o_orderpriority").alias("company_name"),
        F.col("o_orderdate").alias("loaded_timestamp"),
        F.col("o_totalprice").alias("market_cap"),
        "o_orderkey",
    )
    return views.latest_company(history, "o_orderkey").drop("o_orderkey")


_FILLED = ("gross_profit", "total_assets", "operating_cash_flow", "dividends_paid")


@query(
    "field_completeness",
    "select symbol, " + ", ".join(f"cast(count({c}) as double) / cast(count(*) as double) * 100 as {c}" for c in _FILLED) + " from v_fact group by symbol",
)
def field_completeness(spark, d):
    """Share of a company's statements that have a value, for fields of each kind of statement."""
    rows = facts_checks.statements(spark, d)
    return rows.groupBy("symbol").agg(*[e.alias(c) for c, e in quality.field_completeness(rows, _FILLED).items()])


@query(
    "latest_n_periods",
    f"""select symbol, fiscal_date, period, {dbl('revenue')} from (
      select *, row_number() over (partition by symbol order by fiscal_date desc,
        case period when 'FY' then 1 when 'Q4' then 2 when 'Q3' then 3 when 'Q2' then 4 when 'Q1' then 5 end) as rn from v_income) where rn <= 5""",
)
def latest_n_periods(spark, d):
    rows = samples.income(spark, d).select("symbol", "fiscal_date", "period", "revenue")
    return plain(views.latest_periods(rows, ["symbol"], 5))


@query(
    "top_n_market_cap",
    "select symbol, cast(market_cap as double) as market_cap from v_company order by coalesce(market_cap, 0) desc, symbol limit 25",
)
def top_n_market_cap(spark, d):
    order = [F.desc(F.coalesce("market_cap", F.lit(0))), "symbol"]
    return plain(keyed.top_n(samples.companies(spark, d).select("symbol", "market_cap"), order, 25))


@query(
    "duplicate_keys",
    "select l_orderkey, l_linenumber, count(*) as row_count from lineitem group by 1, 2 having count(*) > 1",
)
def duplicate_keys(spark, d):
    return keyed.duplicates(samples.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "keep_latest",
    """select l_orderkey, l_linenumber, l_shipdate, l_suppkey, l_partkey, l_extendedprice from (
      select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_suppkey desc, l_partkey desc, l_extendedprice desc) as rn
      from lineitem) where rn = 1""",
)
def keep_latest(spark, d):
    cols = ["l_shipdate", "l_suppkey", "l_partkey", "l_extendedprice"]
    rows = samples.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    return keyed.latest(rows, ["l_orderkey", "l_linenumber"], [F.desc(c) for c in cols])


# ---- upsert ------------------------------------------------------------------------------

def _price_sides(spark, d):
    """What is stored up to a day, and a load that starts earlier and corrects some closes."""
    p = samples.prices(spark, d).select("symbol", "price_date", "close_price", "volume")
    stored = p.where(F.col("price_date") <= "1999-12-31")
    coming = p.where(F.col("price_date") >= "1999-07-01").withColumn(
        "close_price", F.when(F.col("volume") > 40, F.col("close_price") + 1).otherwise(F.col("close_price"))
    )
    return stored, coming


_SIDES = """stored as (select symbol, price_date, close_price, volume from v_prices where price_date <= date '1999-12-31'),
coming as (select symbol, price_date, case when volume > 40 then close_price + 1 else close_price end as close_price, volume
           from v_prices where price_date >= date '1999-07-01')"""


@query(
    "upsert_prices",
    f"""with {_SIDES} select symbol, price_date, cast(coalesce(c.close_price, s.close_price) as double) as close_price,
      coalesce(c.volume, s.volume) as volume from stored s full outer join coming c using (symbol, price_date)""",
)
def upsert_prices(spark, d):
    stored, coming = _price_sides(spark, d)
    return plain(keyed.upsert(stored, coming, ["symbol", "price_date"]))


@query(
    "upsert_report",
    f"""with {_SIDES} select count(*) filter (s.symbol is null) as inserted,
      count(*) filter (s.symbol is not null and c.symbol is not null and (s.close_price <> c.close_price or s.volume <> c.volume)) as updated,
      count(*) filter (s.symbol is not null and (c.symbol is null or (s.close_price = c.close_price and s.volume = c.volume))) as unchanged
      from stored s full outer join coming c on s.symbol = c.symbol and s.price_date = c.price_date""",
)
def upsert_report(spark, d):
    stored, coming = _price_sides(spark, d)
    return keyed.merge_counts(keyed.merged(stored, coming, ["symbol", "price_date"]))


@query(
    "update_columns_only",
    f"""with {_SIDES} select s.symbol, s.price_date, cast(coalesce(c.close_price, s.close_price) as double) as close_price, s.volume
      from stored s left join coming c using (symbol, price_date)""",
)
def update_columns_only(spark, d):
    """Matched rows only, one column: nothing is inserted and the volume stays."""
    stored, coming = _price_sides(spark, d)
    coming = coming.withColumn("volume", F.lit(-1).cast("bigint"))
    return plain(keyed.upsert(stored, coming, ["symbol", "price_date"], update=["close_price"], insert=False))


@query(
    "high_water_marks",
    "select symbol, cast(max(price_date) + 1 as date) as load_from from v_prices group by symbol",
)
def high_water_marks(spark, d):
    return keyed.high_water(samples.prices(spark, d), ["symbol"], "price_date", "2020-01-01")


@query(
    "earliest_staged",
    """select min(lo) as load_from from (select min(fiscal_date) as lo from v_income union all
      select min(fiscal_date) from v_balance union all select min(fiscal_date) from v_cash)""",
)
def earliest_staged(spark, d):
    tables = [(f(spark, d), "fiscal_date") for f in (samples.income, samples.balance, samples.cash)]
    return keyed.earliest_of(tables, "2020-01-01")


@query(
    "archive_split",
    """select case when start_time < timestamp '2024-01-15 00:00:00' then 'archive' else 'keep' end as part,
      count(*) as rows, min(start_time) as first_run, max(start_time) as last_run from v_jobs group by 1""",
)
def archive_split(spark, d):
    old, kept = keyed.split_by_age(samples.jobs(spark, d), "start_time", F.lit("2024-01-15").cast("timestamp_ntz"))
    both = old.withColumn("part", F.lit("archive")).unionByName(kept.withColumn("part", F.lit("keep")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("start_time").alias("first_run"), F.max("start_time").alias("last_run")
    )


# ---- coverage and freshness --------------------------------------------------------------

def _loaded(df, day):
    return df.withColumn("loaded_timestamp", F.col(day).cast("timestamp_ntz") + F.expr("interval '95' minute"))


_AT = "timestamp '2001-12-05 12:10:00'"
def as_of():
    return F.lit("2001-12-05 12:10:00").cast("timestamp_ntz")



def _fresh(name: str, view: str, day: str) -> str:
    return f"""select '{name}' as table_name, count(*) as record_count, max(cast({day} as timestamp) + interval 95 minute) as last_load_time,
      date_diff('hour', max(cast({day} as timestamp) + interval 95 minute), {_AT}) as hours_since_load from {view}"""


@query(
    "staging_freshness",
    " union all ".join(
        [
            _fresh("STG_HISTORICAL_PRICES", "v_prices", "price_date"),
            _fresh("STG_INCOME_STATEMENT", "v_income", "fiscal_date"),
            _fresh("STG_BALANCE_SHEET", "v_balance", "fiscal_date"),
            _fresh("STG_CASH_FLOW", "v_cash", "fiscal_date"),
        ]
    ),
)
def staging_freshness(spark, d):
    tables = {
        "STG_HISTORICAL_PRICES": _loaded(samples.prices(spark, d), "price_date"),
        "STG_INCOME_STATEMENT": _loaded(samples.income(spark, d), "fiscal_date"),
        "STG_BALANCE_SHEET": _loaded(samples.balance(spark, d), "fiscal_date"),
        "STG_CASH_FLOW": _loaded(samples.cash(spark, d), "fiscal_date"),
    }
    return views.staging_freshness(tables, as_of())


def _monitor(name: str, view: str, day: str, warn: int, critical: int | None) -> str:
    crit = f"when h > {critical} then 'CRITICAL' " if critical else ""
    return f"""select '{name}' as data_type, last_update, h as hours_since_update, symbol_count,
      case {crit}when h > {warn} then 'WARNING' else 'OK' end as freshness_status from (
      select max(cast({day} as timestamp) + interval 95 minute) as last_update, count(distinct symbol) as symbol_count,
        date_diff('hour', max(cast({day} as timestamp) + interval 95 minute), {_AT}) as h from {view})"""


@query(
    "freshness_monitor",
    " union all ".join(
        [
            _monitor("Daily Prices", "v_prices", "price_date", 24, 48),
            _monitor("Financial Statements", "v_income", "fiscal_date", 168, None),
        ]
    ),
)
def freshness_monitor(spark, d):
    return views.freshness_monitor(
        {
            "Daily Prices": (_loaded(samples.prices(spark, d), "price_date"), 24, 48),
            "Financial Statements": (_loaded(samples.income(spark, d), "fiscal_date"), 168, None),
        },
        as_of(),
    )


@query(
    "recent_load_check",
    """select 'EQUITY_PRICES' as table_name, max(price_date) as last_date, count(distinct symbol) as symbol_count,
      date_diff('hour', max(t), timestamp '2000-03-04 12:10:00') as hours_since_load,
      date_diff('hour', max(t), timestamp '2000-03-04 12:10:00') > 24 as is_stale
      from (select *, cast(price_date as timestamp) + interval 95 minute as t from v_prices)
      where t >= timestamp '2000-03-04 12:10:00' - interval 3 day""",
)
def recent_load_check(spark, d):
    at = F.lit("2000-03-04 12:10:00").cast("timestamp_ntz")
    return views.recent_load_check(_loaded(samples.prices(spark, d), "price_date"), at, "EQUITY_PRICES")


@query(
    "age_by_source",
    f"""select 'PRICES' as data_type, max(price_date) as latest_date, date_diff('hour', cast(max(price_date) as timestamp), {_AT}) as age, 'hour' as age_unit from v_prices
      union all select 'FINANCIALS', max(fiscal_date), cast(date '2001-12-05' - max(fiscal_date) as bigint), 'day' from v_fact""",
)
def age_by_source(spark, d):
    return views.age_by_source(
        {
            "PRICES": (samples.prices(spark, d), "price_date", "hour"),
            "FINANCIALS": (facts_checks.statements(spark, d), "fiscal_date", "day"),
        },
        as_of(),
    )


@query(
    "summary_stats",
    """select 'Company Coverage' as metric_name, cast(count(distinct symbol) as varchar) as metric_value, 'companies' as metric_unit from v_company
      union all select 'Price History Days', cast(count(distinct price_date) as varchar), 'days' from v_prices
      union all select 'Financial Statements', cast(count(*) as varchar), 'records' from v_income
      union all select 'Latest Data Date', cast(max(fiscal_date) as varchar), 'date' from v_income
      union all select 'Earliest Data Date', cast(min(fiscal_date) as varchar), 'date' from v_income""",
)
def summary_stats(spark, d):
    return views.summary_stats(samples.companies(spark, d), samples.prices(spark, d), samples.income(spark, d))


@query(
    "symbol_coverage",
    """with c as (select symbol from v_company union all select symbol || 'X' from v_company where company_key % 5 = 0)
      select (select count(distinct symbol) from c) as total_symbols,
      (select count(*) from (select symbol from c intersect select symbol from v_prices)) as symbols_with_prices,
      (select count(*) from (select symbol from c intersect select symbol from v_balance)) as symbols_with_financials""",
)
def symbol_coverage(spark, d):
    """All companies, and as many again as a fifth of them that have neither prices nor statements."""
    c = samples.companies(spark, d)
    bare = c.where("company_key % 5 = 0").withColumn("symbol", F.concat("symbol", F.lit("X")))
    return views.symbol_coverage(c.unionByName(bare), samples.prices(spark, d), samples.balance(spark, d))


@query(
    "without_recent_prices",
    """select symbol from v_company c where not exists (select 1 from v_prices p where p.symbol = c.symbol and p.price_date >= date '2001-11-01')""",
)
def without_recent_prices(spark, d):
    return views.without_recent_prices(samples.companies(spark, d), samples.prices(spark, d), F.lit("2001-11-01").cast("date"))


@query(
    "daily_coverage",
    "select price_date, count(distinct symbol) as companies from v_prices group by price_date having count(distinct symbol) < 20",
)
def daily_coverage(spark, d):
    return views.daily_coverage(samples.prices(spark, d), 20)


@query(
    "latest_coverage",
    "select max(price_date) as latest_date, count(distinct symbol) as companies from v_prices where price_date >= date '2001-10-01'",
)
def latest_coverage(spark, d):
    return views.latest_coverage(samples.prices(spark, d), F.lit("2001-10-01").cast("date"))


# through text, so that the decimal is the shortest one that names the double
_STORED_PE = "cast(round_even(cast(cast(pe_ratio_ttm as varchar) as decimal(38,12)), 2) as decimal(20,2)) as pe"


@query(
    "monthly_stats",
    f"""select symbol, cast(year(price_date) as int) as year, cast(month(price_date) as int) as month, cast(sum(pe) as double) / nullif(count(pe), 0) as avg_value,
      cast(min(pe) as double) as min_value, cast(max(pe) as double) as max_value from (select *, {_STORED_PE} from v_metrics) group by 1, 2, 3""",
)
def monthly_stats(spark, d):
    return plain(views.monthly_valuation(facts_checks.metrics(spark, d, places=2), ["symbol"]))


@query(
    "valuation_rollup",
    f"""select sector, industry, cast(grouping_id(sector, industry) as bigint) as level, count(pe) as rows,
      cast(sum(pe) as double) / nullif(count(pe), 0) as avg_value, cast(min(pe) as double) as min_value, cast(max(pe) as double) as max_value
      from (select *, {_STORED_PE} from v_metrics) join (select symbol, sector, industry from v_company) using (symbol) group by rollup (sector, industry)""",
)
def valuation_rollup(spark, d):
    c = samples.companies(spark, d).select("symbol", "sector", "industry")
    return plain(views.valuation_rollup(facts_checks.metrics(spark, d, places=2).join(c, "symbol"), ["sector", "industry"]))


@query(
    "load_verification",
    """select 'FACT_DAILY_PRICES' as table_name, count(*) as row_count, min(price_date) as first_date, max(price_date) as last_date, count(distinct price_date) as dates from v_prices
      union all select 'FACT_FINANCIALS', count(*), min(fiscal_date), max(fiscal_date), count(distinct fiscal_date) from v_fact
      union all select 'FACT_FINANCIALS_TTM', count(*), min(calculation_date), max(calculation_date), count(distinct calculation_date) from v_ttm""",
)
def load_verification(spark, d):
    return views.load_verification(
        {
            "FACT_DAILY_PRICES": (samples.prices(spark, d), "price_date"),
            "FACT_FINANCIALS": (facts_checks.statements(spark, d), "fiscal_date"),
            "FACT_FINANCIALS_TTM": (
                facts_checks.trailing.ttm_in_order(facts_checks.quarters(spark, d), BY), "calculation_date",
            ),
        }
    )


@query(
    "layer_summary",
    """select layer, count(distinct t) as table_count, cast(sum(n) as bigint) as total_rows from (
      select 'RAW' as layer, 'lineitem' as t, count(*) as n from lineitem union all select 'RAW', 'supplier', count(*) from supplier
      union all select 'STAGING', 'prices', count(*) from v_prices union all select 'STAGING', 'income', count(*) from v_income
      union all select 'ANALYTICS', 'ttm', count(*) from v_ttm) group by layer""",
)
def layer_summary(spark, d):
    return sinks.layer_summary(
        {
            "RAW": {t: samples.table(spark, d, t) for t in ("lineitem", "supplier")},
            "STAGING": {"prices": samples.prices(spark, d), "income": samples.income(spark, d)},
            "ANALYTICS": {"ttm": facts_checks.trailing.ttm_in_order(facts_checks.quarters(spark, d), BY)},
        }
    )


@query(
    "table_profile",
    """select 'symbol' as column_name, count(*) as row_count, count(symbol) as present from v_balance
      union all select 'period', count(*), count(period) from v_balance""",
)
def table_profile(spark, d):
    rows = samples.balance(spark, d).select("symbol", "period")
    return sinks.table_profile(rows).drop("approx_distinct")


@query(
    "index_members",
    f"""select symbol, cast(close_price as double) as close_price, price_date from v_prices
      where symbol in (select symbol from ({LISTED}) where taken_at = (select max(taken_at) from ({LISTED})))""",
)
def index_members(spark, d):
    """Bars of the members of the newest list."""
    lists = snapshots(spark, d)
    members = lists.join(lists.agg(F.max("taken_at").alias("taken_at")), "taken_at").select("symbol")
    rows = samples.prices(spark, d).select("symbol", "close_price", "price_date")
    return plain(keyed.only_in(rows, members, "symbol"))


@query(
    "entity_and_dates",
    """select symbol, sector, price_date, volume from v_prices join (select symbol, sector from v_company) using (symbol)
      where sector in ('ASIA', 'EUROPE') and price_date between date '1996-01-01' and date '1997-12-31'""",
)
def entity_and_dates(spark, d):
    sectors = samples.companies(spark, d).select("symbol", "sector")
    rows = samples.prices(spark, d).select("symbol", "price_date", "volume").join(sectors, "symbol")
    rows = keyed.only_in(rows, ["ASIA", "EUROPE"], "sector")
    return keyed.between(rows, "price_date", *[F.lit(x).cast("date") for x in ("1996-01-01", "1997-12-31")])


# ---- jobs --------------------------------------------------------------------------------

@query(
    "job_status",
    """select job_name, max(start_time) as last_run_time, arg_max(status, {'a': start_time, 'b': job_id}) as last_status,
      cast(arg_max(duration_seconds, {'a': start_time, 'b': job_id}) as double) as last_duration_seconds,
      arg_max(records_loaded, {'a': start_time, 'b': job_id}) as last_records_loaded, count(*) as total_runs,
      count(*) filter (status = 'SUCCESS') as successful_runs, count(*) filter (status = 'FAILED') as failed_runs,
      cast(sum(duration_seconds) as double) / count(duration_seconds) as avg_duration_seconds from v_jobs group by job_name""",
)
def job_status(spark, d):
    return plain(monitoring.job_status(samples.jobs(spark, d)))


@query(
    "job_daily",
    """select job_name, cast(start_time as date) as run_date, count(*) as run_count, count(*) filter (status = 'SUCCESS') as success_count,
      cast(sum(duration_seconds) as double) / count(duration_seconds) as avg_duration_seconds, cast(max(duration_seconds) as double) as max_duration_seconds,
      cast(sum(records_loaded) as bigint) as total_records_loaded, max(end_time) as last_run_time
      from v_jobs where start_time >= timestamp '2024-01-10 00:00:00' group by 1, 2""",
)
def job_daily(spark, d):
    return plain(monitoring.job_daily(samples.jobs(spark, d), F.lit("2024-01-10").cast("timestamp_ntz")))


_HEALTH_AT = "timestamp '2024-01-30 12:00:00'"


@query(
    "run_health",
    f"""select cast(count(*) filter (status = 'SUCCESS') as double) * 100 / count(*) as success_rate_7d,
      count(*) filter (status = 'SUCCESS' and start_time >= {_HEALTH_AT} - interval 24 hour) as success_24h,
      count(*) filter (status = 'PARTIAL' and start_time >= {_HEALTH_AT} - interval 24 hour) as partial_24h,
      count(*) filter (status = 'FAILED' and start_time >= {_HEALTH_AT} - interval 24 hour) as failed_24h
      from v_jobs where start_time >= {_HEALTH_AT} - interval 7 day""",
)
def run_health(spark, d):
    return monitoring.run_health(samples.jobs(spark, d), F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"))


def since():
    return F.lit("2024-01-20").cast("timestamp_ntz")



@query(
    "recent_errors",
    """select j.job_name, start_time, error_timestamp, error_type, error_message from v_errors e join v_jobs j using (job_id)
      where error_timestamp >= timestamp '2024-01-20 00:00:00'""",
)
def recent_errors(spark, d):
    return monitoring.recent_errors(samples.job_errors(spark, d).drop("job_name"), samples.jobs(spark, d), since())


@query(
    "error_frequency",
    """select job_name, error_message, count(*) as error_count from v_errors where error_timestamp >= timestamp '2024-01-20 00:00:00' group by 1, 2""",
)
def error_frequency(spark, d):
    return monitoring.error_frequency(samples.job_errors(spark, d), since())


@query(
    "recent_error_count",
    "select count(*) as recent_errors from v_errors where error_timestamp >= timestamp '2024-01-20 00:00:00'",
)
def recent_error_count(spark, d):
    return monitoring.error_count(samples.job_errors(spark, d), since())


@query(
    "job_performance",
    """select job_name, cast(sum(s) as double) / count(s) as avg_duration_seconds, max(s) as max_duration_seconds,
      cast(sum(records_loaded) as double) / count(records_loaded) as avg_records
      from (select *, date_diff('second', start_time, end_time) as s from v_jobs where status = 'SUCCESS') group by job_name""",
)
def job_performance(spark, d):
    return monitoring.job_performance(samples.jobs(spark, d))


@query(
    "throughput",
    """select cast(sum(duration_seconds) as double) / count(*) as avg_duration, cast(sum(symbols_processed) as bigint) as total_symbols,
      cast(count(*) filter (error_count = 0) as double) / count(*) as success_rate,
      cast(sum(records_loaded) as double) / cast(sum(duration_seconds) as double) as throughput
      from v_jobs where start_time >= timestamp '2024-01-20 00:00:00'""",
)
def throughput(spark, d):
    return monitoring.throughput(samples.jobs(spark, d), since())


@query(
    "recent_jobs",
    """select job_id, job_name, status, start_time, records_loaded from v_jobs where job_name = 'purchase' and status = 'FAILED'
      order by start_time desc, job_id desc limit 10""",
)
def recent_jobs(spark, d):
    return monitoring.recent_jobs(samples.jobs(spark, d), "purchase", "FAILED", 10).select(
        "job_id", "job_name", "status", "start_time", "records_loaded"
    )


@query(
    "slowest_job",
    """select job_name, cast(max(duration_seconds) as double) as duration_seconds, arg_max(job_id, {'a': duration_seconds, 'b': job_id}) as job_id
      from v_jobs group by job_name""",
)
def slowest_job(spark, d):
    return plain(monitoring.slowest_job(samples.jobs(spark, d)))


@query(
    "first_errors",
    """select job_name, error_timestamp, error_message, cast(no as int) as error_no from (
      select *, row_number() over (partition by job_name order by error_timestamp, error_id) as no from v_errors) where no <= 3""",
)
def first_errors(spark, d):
    return monitoring.first_errors(samples.job_errors(spark, d)).select("job_name", "error_timestamp", "error_message", "error_no")


def _phase_events(spark, d):
    """A user's day stands for a job run; its clicks extract, views transform, the rest loads."""
    e = samples.table(spark, d, "events")
    kind = F.col("event_type")
    return e.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("job_id"),
        F.concat(F.lit("job "), (F.col("user_id") % 7).cast("string")).alias("job_name"),
        F.when(kind == "click", "EXTRACT").when(kind == "view", "TRANSFORM").otherwise("LOAD").alias("phase"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.expr("interval '2' second")).alias("ended_at"),
        (F.col("event_id") % 50).alias("records"),
        F.when(kind == "error", F.concat(F.lit("error at "), F.col("event_id").cast("string"))).alias("error"),
        ((kind == "error") & (F.col("event_id") % 4 == 0)).alias("fatal"),
    )


_PHASES = """phases as (
  select cast(user_id as varchar) || '-' || strftime(ts, '%Y%m%d') as job_id, 'job ' || cast(user_id % 7 as varchar) as job_name,
    case when event_type = 'click' then 'EXTRACT' when event_type = 'view' then 'TRANSFORM' else 'LOAD' end as phase,
    ts as started_at, ts + interval 2 second as ended_at, event_id % 50 as records,
    case when event_type = 'error' then 'error at ' || cast(event_id as varchar) end as error,
    event_type = 'error' and event_id % 4 = 0 as fatal from events)"""


@query(
    "audit_job_history",
    f"""with {_PHASES}, runs as (
      select job_id, job_name, min(started_at) as start_time, max(ended_at) as end_time,
        cast(coalesce(sum(records) filter (phase = 'EXTRACT'), 0) as bigint) as records_extracted,
        cast(coalesce(sum(records) filter (phase = 'TRANSFORM'), 0) as bigint) as records_transformed,
        cast(coalesce(sum(records) filter (phase = 'LOAD'), 0) as bigint) as records_loaded,
        count(error) as error_count, bool_or(fatal) as failed,
        count(*) filter (phase = 'EXTRACT') * 2 as e, count(*) filter (phase = 'TRANSFORM') * 2 as t, count(*) filter (phase = 'LOAD') * 2 as l
      from phases group by job_id, job_name)
    select job_id, job_name, start_time, end_time, records_extracted, records_transformed, records_loaded, error_count,
      case when e > 0 then cast(e as double) end as extract_duration, case when t > 0 then cast(t as double) end as transform_duration,
      case when l > 0 then cast(l as double) end as load_duration,
      case when failed or (error_count > 0 and records_loaded = 0) then 'FAILED' when error_count > 0 then 'PARTIAL' else 'SUCCESS' end as status,
      cast(round(date_diff('microsecond', start_time, end_time) * cast('0.000001' as decimal(7,6)), 2) as double) as duration_seconds from runs""",
)
def audit_job_history(spark, d):
    return plain(monitoring.job_history(_phase_events(spark, d)))


@query(
    "audit_job_errors",
    f"""with {_PHASES} select job_id, ended_at as error_timestamp, 'ETL_ERROR' as error_type, error as error_message, '{{}}' as error_details
      from phases where error is not null""",
)
def audit_job_errors(spark, d):
    return monitoring.job_errors(_phase_events(spark, d))


@query(
    "audit_job_metrics",
    """select cast(event_id as varchar) as job_id, ts as recorded_at, 'value' as metric_name, cast(cast(value as decimal(20,4)) as double) as metric_value,
        'sec' as metric_unit, 'LOAD' as phase from events
      union all select cast(event_id as varchar), ts, 'user', cast(user_id as double), '', '' from events""",
)
def audit_job_metrics(spark, d):
    def entry(value, unit, phase):
        return F.struct(
            value.cast("decimal(20,4)").alias("value"),
            F.lit(unit).cast("string").alias("unit"),
            F.lit(phase).cast("string").alias("phase"),
        )

    reported = samples.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("job_id"),
        F.col("ts").alias("recorded_at"),
        F.create_map(
            F.lit("value"), entry(F.col("value"), "sec", "LOAD"), F.lit("user"), entry(F.col("user_id"), None, None)
        ).alias("metrics"),
    )
    return plain(monitoring.job_metrics(reported))


@query(
    "audit_quality_issues",
    """select 'load-1' as job_id, 'STG_COMPANY_PROFILE' as table_name, symbol as record_identifier, 'market_cap_sign' as issue_type,
      'market_cap below zero: ' || cast(market_cap as varchar) as issue_description, '{}' as issue_details, 'ERROR' as severity, timestamp '2024-02-01 00:30:00' as detected_at
      from v_company where market_cap < 0""",
)
def audit_quality_issues(spark, d):
    checked = quality.validate(samples.companies(spark, d).withColumn("employees", F.lit(None).cast("bigint")), quality.profile_rules())
    found = quality.issue_rows(checked, ["symbol"])
    return monitoring.quality_issues(found, F.lit("load-1"), "STG_COMPANY_PROFILE", F.col("symbol"), now())


# ---- record rules ------------------------------------------------------------------------

def _rules_out(checked, keys):
    text = F.array_join(F.transform("issues", lambda i: i["message"]), "; ")
    return checked.select(*keys, text.alias("issues"), "is_valid")


def _issues_sql(keys: str, view: str, rules: list[tuple[str, str, str]]) -> str:
    """``rules``: (condition, message expression, severity)."""
    texts = ", ".join(f"case when {c} then {m} end" for c, m, _ in rules)
    errors = " or ".join(f"coalesce({c}, false)" for c, _, s in rules if s == "ERROR")
    return f"select {keys}, concat_ws('; ', {texts}) as issues, not ({errors}) as is_valid from {view}"


@query(
    "validate_profile",
    _issues_sql(
        "symbol",
        """(select case when s_suppkey % 20 = 4 then '' else 'S-' || cast(s_suppkey as varchar) end as symbol,
            case when s_suppkey % 11 <> 0 then s_name end as company_name, cast(s_acctbal as decimal(12,2)) as market_cap,
            s_suppkey % 30 - 2 as employees from supplier)""",
        [
            ("symbol is null or symbol = ''", "'no value: symbol'", "ERROR"),
            ("company_name is null or company_name = ''", "'no value: company_name'", "ERROR"),
            ("symbol <> '' and (length(symbol) > 10 or not regexp_matches(symbol, '^[A-Za-z0-9]+$'))", "'symbol out of form: ' || symbol", "ERROR"),
            ("market_cap < 0", "'market_cap below zero: ' || cast(market_cap as varchar)", "ERROR"),
            ("employees < 0", "'employees below zero: ' || cast(employees as varchar)", "ERROR"),
        ],
    ),
)
def validate_profile(spark, d):
    key = F.col("s_suppkey")
    rows = samples.table(spark, d, "supplier").select(
        F.when(key % 20 == 4, "").otherwise(F.concat(F.lit("S-"), key.cast("string"))).alias("symbol"),
        F.when(key % 11 != 0, F.col("s_name")).alias("company_name"),
        F.col("s_acctbal").cast("decimal(12,2)").alias("market_cap"),
        (key % 30 - 2).alias("employees"),
    )
    return _rules_out(quality.validate(rows, quality.profile_rules()), ["symbol"])


def _odd_prices(spark, d):
    """Daily bars with some of the faults a feed can have."""
    key, day = F.col("company_key"), F.dayofmonth("price_date")
    p = samples.prices(spark, d)
    return p.select(
        "symbol",
        "price_date",
        "open_price",
        F.when(day == 7, F.col("low_price") - 1).otherwise(F.col("high_price")).alias("high_price"),
        "low_price",
        F.when(day == 9, F.lit(0)).when(day == 11, -F.col("close_price")).otherwise(F.col("close_price")).alias("close_price"),
        F.col("close_price").alias("adj_close"),
        F.when(key % 10 == 3, -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
    )


_ODD = """(select symbol, price_date, open_price, case when day(price_date) = 7 then low_price - 1 else high_price end as high_price, low_price,
  case when day(price_date) = 9 then 0 when day(price_date) = 11 then -close_price else close_price end as close_price, close_price as adj_close,
  case when company_key % 10 = 3 then -volume else volume end as volume from v_prices)"""
_PRICE_RULES = [
    ("close_price is null or close_price = 0", "'no value: close_price'", "ERROR"),
    ("close_price < 0", "'close_price below zero: ' || cast(close_price as varchar)", "ERROR"),
    ("high_price > 0 and low_price > 0 and low_price > high_price",
     "'low_price ' || cast(low_price as varchar) || ' above high_price ' || cast(high_price as varchar)", "ERROR"),
    ("high_price > 0 and low_price > 0 and open_price > 0 and (open_price > high_price or open_price < low_price)",
     "'open_price ' || cast(open_price as varchar) || ' beyond low and high'", "WARNING"),
    ("high_price > 0 and low_price > 0 and close_price > 0 and (close_price > high_price or close_price < low_price)",
     "'close_price ' || cast(close_price as varchar) || ' beyond low and high'", "WARNING"),
    ("volume < 0", "'volume below zero: ' || cast(volume as varchar)", "ERROR"),
    ("price_date > date '2001-06-30'", "'price_date after today: ' || cast(price_date as varchar)", "ERROR"),
]


@query("validate_price", _issues_sql("symbol, price_date", _ODD, _PRICE_RULES))
def validate_price(spark, d):
    return _rules_out(quality.validate(_odd_prices(spark, d), quality.price_rules(today())), ["symbol", "price_date"])


@query(
    "validation_summary",
    f"""select count(*) as total_records, count(*) filter (is_valid) as valid_records, count(*) filter (not is_valid) as invalid_records,
      cast(coalesce(sum(w) filter (is_valid), 0) as bigint) as warnings from (
      select not ({' or '.join(f'coalesce({c}, false)' for c, _, s in _PRICE_RULES if s == 'ERROR')}) as is_valid,
        {' + '.join(f'case when {c} then 1 else 0 end' for c, _, s in _PRICE_RULES if s != 'ERROR')} as w from {_ODD})""",
)
def validation_summary(spark, d):
    return quality.validation_summary(quality.validate(_odd_prices(spark, d), quality.price_rules(today())))


@query(
    "quarantined_prices",
    f"""select symbol, price_date, cast(close_price as double) as close_price, volume from {_ODD}
      where {' or '.join(f'coalesce({c}, false)' for c, _, s in _PRICE_RULES if s == 'ERROR')}""",
)
def quarantined_prices(spark, d):
    _, bad = quality.split_valid(quality.validate(_odd_prices(spark, d), quality.price_rules(today())))
    return plain(bad.select("symbol", "price_date", "close_price", "volume"))


_FUTURE = ("fiscal_date > date '2001-06-30'", "'fiscal_date after today: ' || cast(fiscal_date as varchar)", "ERROR")
_NAMED = ("period not in ('FY', 'Q1', 'Q2', 'Q3', 'Q4')", "'unknown period: ' || period", "ERROR")


@query(
    "validate_income",
    _issues_sql(
        "symbol, fiscal_date, period",
        """(select symbol, fiscal_date, case when period = 'Q2' and company_key % 8 = 5 then 'H1' else period end as period,
            case when company_key % 9 = 2 then -revenue else revenue end as revenue, cost_of_revenue,
            case when company_key % 6 = 4 then gross_profit + 5 else gross_profit end as gross_profit from v_income)""",
        [
            _NAMED, _FUTURE,
            ("revenue < 0", "'revenue below zero: ' || cast(revenue as varchar)", "ERROR"),
            ("revenue > 0 and cost_of_revenue >= 0 and abs(gross_profit - (revenue - cost_of_revenue)) > 0.01",
             "'gross_profit is not revenue less cost: ' || cast(gross_profit as varchar) || ' != ' || cast(revenue as varchar) || ' - ' || cast(cost_of_revenue as varchar)", "ERROR"),
        ],
    ),
)
def validate_income(spark, d):
    key = F.col("company_key")
    rows = samples.income(spark, d).withColumns(
        {
            "period": F.when((F.col("period") == "Q2") & (key % 8 == 5), "H1").otherwise(F.col("period")),
            "revenue": F.when(key % 9 == 2, -F.col("revenue")).otherwise(F.col("revenue")),
            "gross_profit": F.when(key % 6 == 4, F.col("gross_profit") + 5).otherwise(F.col("gross_profit")),
        }
    )
    return _rules_out(quality.validate(rows, quality.income_rules(today())), ["symbol", "fiscal_date", "period"])


@query(
    "validate_balance",
    _issues_sql(
        "symbol, fiscal_date, period", "v_balance",
        [
            _FUTURE,
            ("total_assets > 0 and total_liabilities >= 0 and total_equity <> 0 and abs(total_assets - (total_liabilities + total_equity)) > 0.01",
             "'assets are not liabilities and equity: ' || cast(total_assets as varchar) || ' != ' || cast(total_liabilities as varchar) || ' + ' || cast(total_equity as varchar)", "ERROR"),
        ],
    ),
)
def validate_balance(spark, d):
    return _rules_out(quality.validate(samples.balance(spark, d), quality.balance_rules(today())), ["symbol", "fiscal_date", "period"])


@query(
    "validate_cashflow",
    _issues_sql(
        "symbol, fiscal_date, period",
        """(select symbol, fiscal_date, period, operating_cash_flow, capital_expenditures,
            case when company_key % 7 = 3 then free_cash_flow - 2 else free_cash_flow end as free_cash_flow from v_cash)""",
        [
            _FUTURE,
            ("operating_cash_flow <> 0 and capital_expenditures <> 0 and abs(free_cash_flow - (operating_cash_flow - abs(capital_expenditures))) > 0.01",
             "'free_cash_flow is not operating less capital: ' || cast(free_cash_flow as varchar) || ' != ' || cast(operating_cash_flow as varchar) || ' - ' || cast(abs(capital_expenditures) as varchar)", "ERROR"),
        ],
    ),
)
def validate_cashflow(spark, d):
    key = F.col("company_key")
    rows = samples.cash(spark, d).withColumn(
        "free_cash_flow", F.when(key % 7 == 3, F.col("free_cash_flow") - 2).otherwise(F.col("free_cash_flow"))
    )
    return _rules_out(quality.validate(rows, quality.cash_rules(today())), ["symbol", "fiscal_date", "period"])


@query(
    "filing_plausibility",
    _issues_sql(
        "symbol, fiscal_date, period",
        """(select *, case when company_key % 5 = 1 then fiscal_date - 3 when company_key % 5 = 2 then fiscal_date + 200 else filing_date end as filed from v_fact)""",
        [
            ("filed < fiscal_date", "'Filed before period end'", "WARNING"),
            ("date_diff('day', fiscal_date, cast(filed as date)) > 180", "'Filed after 180 days'", "WARNING"),
            ("cast(accepted_date as date) < filed", "'Accepted before filing'", "WARNING"),
            ("shares_outstanding <= 0", "'Shares not positive'", "WARNING"),
            ("total_liabilities < 0", "'Negative liabilities'", "WARNING"),
            ("dividends_paid > 0", "'Dividends not an outflow'", "INFO"),
            ("capital_expenditures > 0", "'Capital expenditure not an outflow'", "INFO"),
            ("false", "''", "ERROR"),
        ],
    ),
)
def filing_plausibility(spark, d):
    key = F.col("company_key")
    rows = facts_checks.statements(spark, d).withColumn(
        "filing_date",
        F.when(key % 5 == 1, F.date_sub("fiscal_date", 3)).when(key % 5 == 2, F.date_add("fiscal_date", 200)).otherwise(F.col("filing_date")),
    )
    return _rules_out(quality.validate(rows, quality.filing_rules()), ["symbol", "fiscal_date", "period"])


@query(
    "generic_record_rules",
    _issues_sql(
        "event_id",
        """(select event_id, case when user_id % 9 <> 0 then cast(user_id as varchar) else '' end as symbol,
            case when event_type = 'error' then 'n/a' else cast(event_id as varchar) end as price, event_id % 100 - 3 as volume from events)""",
        [
            ("symbol is null or symbol = ''", "'Missing symbol'", "ERROR"),
            ("price is not null and try_cast(price as double) is null", "'Invalid price: ' || price", "ERROR"),
            ("volume < 0", "'Negative volume'", "ERROR"),
        ],
    ),
)
def generic_record_rules(spark, d):
    e = samples.table(spark, d, "events").select(
        "event_id",
        F.when(F.col("user_id") % 9 != 0, F.col("user_id").cast("string")).otherwise("").alias("symbol"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("event_id").cast("string")).alias("price"),
        (F.col("event_id") % 100 - 3).alias("volume"),
    )
    return _rules_out(quality.validate(e, quality.record_rules()), ["event_id"])


# ---- checks across rows ------------------------------------------------------------------

@query(
    "dq_issues",
    """select 'Negative Revenue' as issue_type, 'STG_INCOME_STATEMENT' as table_name, symbol, cast(fiscal_date as varchar) as reference_date, period,
        'Revenue: ' || cast(-revenue as varchar) as issue_detail from v_income where company_key % 9 = 2
      union all select 'Future Filing Date', 'STG_INCOME_STATEMENT', symbol, cast(fiscal_date as varchar), period, 'Filing Date: ' || cast(filing_date as varchar)
        from v_income where filing_date > date '2001-06-30'
      union all select 'Zero Total Assets', 'STG_BALANCE_SHEET', symbol, cast(fiscal_date as varchar), period, 'Total Assets: 0' from v_balance where company_key % 15 = 6
      union all select 'Price Outlier', 'STG_HISTORICAL_PRICES', symbol, cast(price_date as varchar), 'DAILY', 'Close Price: ' || cast(close_price as varchar)
        from v_prices where close_price > 100000 or close_price <= 0""",
)
def dq_issues(spark, d):
    key = F.col("company_key")
    income = samples.income(spark, d).withColumn("revenue", F.when(key % 9 == 2, -F.col("revenue")).otherwise(F.col("revenue")))
    balance = samples.balance(spark, d).withColumn("total_assets", F.when(key % 15 == 6, F.lit(0)).otherwise(F.col("total_assets")))
    return views.dq_issues(income, balance, samples.prices(spark, d), today())


@query(
    "dq_scorecard",
    """with marks as (select avg(if(company_key % 6 <> 1 and revenue is not null, 100.0::double, 0)) as has_revenue,
        avg(if((symbol, fiscal_date, period) in (select (symbol, fiscal_date, period) from v_balance), 100.0::double, 0)) as has_balance from v_income),
      lines as (select 'Completeness' as metric_type, 'Financial Data' as category, has_revenue as score from marks
        union all select 'Consistency', 'Financial Statements', has_balance from marks)
      select metric_type, category, round(score, 2) as score_percentage,
        case when score >= 95 then 'EXCELLENT' when score >= 90 then 'GOOD' when score >= 80 then 'FAIR' else 'POOR' end as quality_rating from lines""",
)
def dq_scorecard(spark, d):
    income = samples.income(spark, d).withColumn("revenue", F.when(F.col("company_key") % 6 != 1, F.col("revenue")))
    return views.dq_scorecard(income, samples.balance(spark, d))


@query(
    "missing_quarters",
    """select symbol, fiscal_date, prev as previous_quarter, cast(floor((date_diff('month', prev, fiscal_date) - 1) / 3) as int) as quarters_missing
      from (select symbol, fiscal_date, lag(fiscal_date) over (partition by symbol order by fiscal_date) as prev from v_balance where period <> 'FY')
      where floor((date_diff('month', prev, fiscal_date) - 1) / 3) > 0""",
)
def missing_quarters(spark, d):
    return quality.missing_quarters(samples.balance(spark, d).where("period <> 'FY'"), ["symbol"])


@query(
    "year_against_quarters",
    f"""select symbol, cast(y as int) as fiscal_year, {dbl('annual', 'quarter_total')}, quarters from (
      select symbol, year(fiscal_date) as y, max(r) filter (period = 'FY') as annual, sum(r) filter (period <> 'FY') as quarter_total,
        count(*) filter (period <> 'FY') as quarters
      from (select *, case when period = 'FY' and company_key % 6 = 1 then revenue + 1 else revenue end as r from v_income) group by 1, 2)
      where annual <> quarter_total and quarters = 4""",
)
def year_against_quarters(spark, d):
    rows = samples.income(spark, d).withColumn(
        "revenue", F.when((F.col("period") == "FY") & (F.col("company_key") % 6 == 1), F.col("revenue") + 1).otherwise(F.col("revenue"))
    )
    return plain(quality.year_against_quarters(rows, ["symbol"], "revenue"))


@query(
    "revenue_jumps",
    f"""select symbol, fiscal_date, {dbl('revenue', 'prior_value')}, cast(revenue - prior_value as double) / cast(prior_value as double) * 100 as change_pct
      from (select *, lag(revenue) over (partition by symbol order by fiscal_date) as prior_value from v_income where period <> 'FY')
      where prior_value > 0 and abs(cast(revenue - prior_value as double) / cast(prior_value as double) * 100) > 40""",
)
def revenue_jumps(spark, d):
    rows = samples.income(spark, d).where("period <> 'FY'").select("symbol", "fiscal_date", "revenue")
    return plain(quality.jumps(rows, ["symbol"], "fiscal_date", "revenue", 40.0))


@query(
    "volume_spikes",
    """select symbol, price_date, volume, cast(volume as double) / (cast(s as double) / n) as times_average from (
      select symbol, price_date, volume, sum(volume) over w as s, count(*) over w as n from v_prices
      window w as (partition by symbol order by price_date rows between 50 preceding and 1 preceding)) where n > 0 and cast(volume as double) / (cast(s as double) / n) > 3""",
)
def volume_spikes(spark, d):
    rows = samples.prices(spark, d).select("symbol", "price_date", "volume")
    return multiple_of_average(rows, ["symbol"], "price_date", "volume", 50, "times_average").where("times_average > 3")


@query(
    "pe_outside_history",
    """select symbol, price_date, pe_ratio_ttm, lo as seen_low, hi as seen_high from (
      select symbol, price_date, pe_ratio_ttm, min(pe_ratio_ttm) over w as lo, max(pe_ratio_ttm) over w as hi, count(pe_ratio_ttm) over w as n from v_metrics
      window w as (partition by symbol order by price_date rows between unbounded preceding and 1 preceding))
      where n >= 20 and (pe_ratio_ttm < lo or pe_ratio_ttm > hi)""",
)
def pe_outside_history(spark, d):
    rows = facts_checks.metrics(spark, d).select("symbol", "price_date", "pe_ratio_ttm")
    return quality.outside_history(rows, ["symbol"], "price_date", "pe_ratio_ttm")


@query(
    "peer_outliers",
    """select industry, symbol, fiscal_date, gross_margin, round((gross_margin - m) / s, 6) as z_score from (
      select industry, r.symbol, fiscal_date, gross_margin, avg(gross_margin) over (partition by industry) as m, stddev_samp(gross_margin) over (partition by industry) as s
      from v_ratio r join (select symbol, industry from v_company) c on r.symbol = c.symbol where period <> 'FY') where s > 0 and abs(round((gross_margin - m) / s, 6)) > 2""",
)
def peer_outliers(spark, d):
    c = samples.companies(spark, d).select("symbol", "industry")
    rows = facts_checks.filings(spark, d).join(c, "symbol")
    return quality.outside_sigma(rows, ["industry"], "gross_margin", ["symbol", "fiscal_date"], 2.0)


@query(
    "revenue_three_sigma",
    """select symbol, fiscal_date, revenue, round((revenue - m) / s, 6) as z_score from (
      select symbol, fiscal_date, cast(revenue as double) as revenue, avg(cast(revenue as double)) over (partition by symbol) as m,
        stddev_samp(cast(revenue as double)) over (partition by symbol) as s from v_income where period <> 'FY') where s > 0 and abs(round((revenue - m) / s, 6)) > 2""",
)
def revenue_three_sigma(spark, d):
    rows = plain(samples.income(spark, d).where("period <> 'FY'").select("symbol", "fiscal_date", "revenue"))
    return quality.outside_sigma(rows, ["symbol"], "revenue", ["fiscal_date"], 2.0)


@query(
    "orphan_symbols",
    """select symbol || 'X' as symbol, count(*) as row_count from v_prices where company_key % 9 = 4 group by symbol""",
)
def orphan_symbols(spark, d):
    """Bars of which a ninth of the companies bear a name that the dimension doesn't know."""
    known = dims.company_versions(samples.companies(spark, d))
    marked = F.when(F.col("company_key") % 9 == 4, F.concat("symbol", F.lit("X"))).otherwise(F.col("symbol"))
    return quality.orphans(samples.prices(spark, d).withColumn("symbol", marked), known)


@query(
    "unrepairable_prices",
    "select symbol, price_date, cast(close_price as double) as close_price, volume from v_prices where close_price >= 90000",
)
def unrepairable_prices(spark, d):
    """Bars priced too high to be repaired, as they came."""
    rows = price_change(samples.prices(spark, d), ["symbol"], ["price_date"], "close_price")
    return plain(quality.repaired_prices(rows, 90000)[1].select("symbol", "price_date", "close_price", "volume"))


@query(
    "repaired_prices",
    """select symbol, price_date, cast(close_price as double) as close_price, greatest(volume, 0) as volume,
      case when change_percent between -100 and 1000 then change_percent end as change_percent from (
      select symbol, price_date, close_price, case when company_key % 10 = 3 then -volume else volume end as volume,
        case when prev > 0 then cast(close_price - prev as double) / cast(prev as double) * 100 end as change_percent
      from (select *, lag(close_price) over (partition by symbol order by price_date) as prev from v_prices)) where close_price < 90000""",
)
def repaired_prices(spark, d):
    rows = price_change(samples.prices(spark, d), ["symbol"], ["price_date"], "close_price").withColumn(
        "volume", F.when(F.col("company_key") % 10 == 3, -F.col("volume")).otherwise(F.col("volume"))
    )
    fixed = quality.repair_prices(rows, 90000)
    return plain(fixed.select("symbol", "price_date", "close_price", "volume", "change_percent"))


@query(
    "repaired_websites",
    r"""select page_id, case when regexp_matches(url, '^https?://[^\s/$.?#].[^\s]*$') then url end as website from
      (select page_id, case when page_id % 7 = 0 then replace(url, '://', ':/') else url end as url from pages)""",
)
def repaired_websites(spark, d):
    url = F.when(F.col("page_id") % 7 == 0, F.replace("url", F.lit("://"), F.lit(":/"))).otherwise(F.col("url"))
    return samples.table(spark, d, "pages").select("page_id", quality.repair_website(url).alias("website"))
