"""Tables as they are stored: clustering, sketches, backfill by ledger, appends, snapshots, membership."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tickerloom.operators import membership
from tickerloom.plans import daily
from tickerloom.session import work_dir
from tickerloom.sources import samples, sinks

from .registry import plain, query

_MONTH = "year(price_date) * 100 + month(price_date)"


def stored_prices(spark, d):
    """The bars as a table of versions with yearly partitions."""
    path = work_dir(spark, "layout") + "/table"
    rows = samples.prices(spark, d).withColumn("year", F.year("price_date"))
    sinks.replace_partitions(rows, path, ["year"])
    return path


@query(
    "clustered_prices",
    "select company_key, symbol, price_date, cast(close_price as double) as close_price, volume from v_prices",
)
def clustered_prices(spark, d):
    """The bars after their partitions were rewritten by interleaved company and date."""
    path = stored_prices(spark, d)
    sinks.cluster_table(spark, path, ["year"], ["company_key", "price_date"], 8)
    return plain(sinks.read_table(spark, path).select("company_key", "symbol", "price_date", "close_price", "volume"))


@query(
    "sketched_profile",
    """select 'company_key' as column_name, count(*) as row_count, count(company_key) as present, true as near from v_prices
      union all select 'price_date', count(*), count(price_date), true from v_prices
      union all select 'close_price', count(*), count(close_price), true from v_prices
      union all select 'volume', count(*), count(volume), true from v_prices""",
)
def sketched_profile(spark, d):
    """Rows and present values from sketches kept while the table grew year by year; each distinct
    count is within five standard errors of the exact one."""
    bars = samples.prices(spark, d).select("company_key", "price_date", "close_price", "volume", F.year("price_date").alias("year"))
    path = work_dir(spark, "sketched")
    for part in (F.col("year") < 1997, F.col("year") >= 1997):
        sinks.replace_partitions(bars.where(part), f"{path}/table", ["year"])
        sinks.update_sketches(spark, f"{path}/table", f"{path}/sketches")
    exact = bars.agg(*[F.count_distinct(c).alias(c) for c in bars.columns])
    exact = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in bars.columns])).alias("e")).select("e.*")
    rows = sinks.profile_from_sketches(spark, f"{path}/table", f"{path}/sketches").join(exact, "column_name").where("column_name <> 'year'")
    near = F.abs(F.col("approx_distinct") - F.col("n")) <= 5 * 0.016 * F.col("n") + 1
    return rows.select("column_name", "row_count", "present", near.alias("near"))


@query(
    "backfilled_prices",
    f"""select company_key, price_date, cast(close_price as double) as close_price, volume, {_MONTH} as month,
      cast(sum(case when year(price_date) = 1998 then 2 else 1 end) over () as bigint) as rows_written from v_prices""",
)
def backfilled_prices(spark, d):
    """Months filled from a stored table, stopped on the way, run again, and again after one year of
    the input was written anew: only open and changed slices are built."""
    source, target = stored_prices(spark, d), work_dir(spark, "backfilled") + "/table"
    span = samples.prices(spark, d).agg(F.min("price_date").alias("low"), F.max("price_date").alias("high")).first()
    start, end = date(span.low.year, 1, 1), date(span.high.year, 12, 31)

    def build(low, high, until=None):
        if until and low > until:
            raise InterruptedError(low)
        rows = sinks.read_table(spark, source).where(F.col("year").between(low.year, high.year) & F.col("price_date").between(F.lit(low), F.lit(high)))
        return rows.withColumn("month", daily.month_of(F.col("price_date"))).drop("year")

    def position(low, high):
        return sinks.input_position(spark, source, lambda p: low.year <= int(p.removeprefix("year=")) <= high.year)

    def run(until=None):
        # slices of half years end with months
        total = 0
        for year in range(start.year, end.year + 1):
            for low, high in ((date(year, 1, 1), date(year, 6, 30)), (date(year, 7, 1), date(year, 12, 31))):
                total += sinks.backfill(lambda a, b: build(a, b, until), low, high, target, ["month"], 366, position)
        return total

    written = 0
    try:
        run(date(1997, 1, 1))
    except InterruptedError:
        written += sinks.read_table(spark, target).count()
    written += run()
    again = sinks.read_table(spark, source).where("year = 1998")
    sinks.replace_partitions(again, source, ["year"])
    written += run() + run()
    rows = sinks.read_table(spark, target).select("company_key", "price_date", "close_price", "volume", "month")
    return plain(rows.withColumn("rows_written", F.lit(written).cast("bigint")))


# quarters' ends are the snapshots; a member's sales are above the average of the quarter
LISTED = """select symbol, fiscal_date as taken_at from (select symbol, fiscal_date, sp, avg(cast(sp as double)) over (partition by fiscal_date) as mean
  from v_period where period <> 'FY') where sp > mean"""
_STAYS = f"""with listed as ({LISTED}),
  times as (select taken_at, row_number() over (order by taken_at) as no, lead(taken_at) over (order by taken_at) as next from (select distinct taken_at from listed)),
  runs as (select symbol, taken_at, no, next, no - row_number() over (partition by symbol order by no) as stay from listed join times using (taken_at)),
  stays as (select symbol, min(taken_at) as member_from, arg_max(coalesce(next, date '9999-01-01'), no) as ends, count(*) as snapshots from runs group by symbol, stay)"""


def snapshots(spark, d):
    sales = samples.periods(spark, d).where("period <> 'FY'").select("company_key", "fiscal_date", "sp")
    mean = sales.groupBy("fiscal_date").agg(F.avg(F.col("sp").cast("double")).alias("mean"))
    listed = sales.join(mean, "fiscal_date").where("sp > mean")
    return listed.select(samples.symbol_of(F.col("company_key")).alias("symbol"), F.col("fiscal_date").alias("taken_at"))


@query("membership_stays", _STAYS + " select symbol, member_from, nullif(ends, date '9999-01-01') as member_to, snapshots from stays")
def membership_stays(spark, d):
    """Companies that come and go: each unbroken stay in the quarterly lists."""
    return membership.intervals(snapshots(spark, d), ["symbol"])


@query(
    "members_prices",
    _STAYS + " select p.symbol, p.price_date, cast(p.close_price as double) as close_price, member_from from v_prices p join stays s on p.symbol = s.symbol and p.price_date >= member_from and p.price_date < ends",
)
def members_prices(spark, d):
    """Bars of companies on days on which they were listed."""
    bars = samples.prices(spark, d).select("symbol", "price_date", "close_price")
    return plain(membership.members_on(bars, membership.intervals(snapshots(spark, d), ["symbol"]), ["symbol"], "price_date"))


@query("appended_runs", "select event_id, user_id, event_type, year(ts) * 100 + month(ts) as month, 2 as loads from events")
def appended_runs(spark, d):
    """Events appended in two parts, with the counts that the writes return, and a run that is repeated."""
    path = work_dir(spark, "appended")
    e = samples.table(spark, d, "events").select("event_id", "user_id", "event_type", (F.year("ts") * 100 + F.month("ts")).alias("month"))
    even = F.col("event_id") % 2 == 0
    appended = sum(sinks.append(e.where(part), f"{path}/events", ["month"]) for part in (even, ~even))
    repeated = sum(sinks.write_run(e, f"{path}/runs", "1") for _ in range(2))
    # both writes of the run count all rows, but only one of them is there
    once = spark.read.schema(e.schema).parquet(f"{path}/runs").select("event_id")
    rows = spark.read.schema(e.schema).parquet(f"{path}/events").join(once, "event_id")
    return rows.withColumn("loads", F.lit(repeated // appended).cast("int"))


@query(
    "snapshot_files",
    f"""select symbol, cast(taken_at as varchar) as taken_at, count(*) over (partition by taken_at) as member_count from ({LISTED})
      where year(taken_at) = (select max(year(taken_at)) from ({LISTED}))""",
)
def snapshot_files(spark, d):
    """The lists of the last year as files of their own, read back together."""
    path = work_dir(spark, "snapshots")
    # made once: the year, its days, the counts and the files all read what is stored
    made = snapshots(spark, d)
    made.write.parquet(f"{path}/lists")
    lists = spark.read.schema(made.schema).parquet(f"{path}/lists")
    newest = lists.agg(F.max(F.year("taken_at"))).first()[0]
    days = [r.taken_at for r in lists.where(F.year("taken_at") == newest).select("taken_at").distinct().collect()]
    for day in days:
        sinks.write_snapshot(lists.where(F.col("taken_at") == day), f"{path}/{day}", str(day))
    return spark.read.schema("symbol string, taken_at string, member_count bigint").json([f"{path}/{day}" for day in days])
