"""Payload feeds: JSON made from the sample tables, parsed, mapped and checked again."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.session import work_dir
from tickerloom.sources import landing, mapping, samples, sinks

from .registry import dbl, plain, query


def loaded_at():
    return F.lit("2024-01-01 06:00:00").cast("timestamp_ntz")


def _text(c: str):
    return F.col(c).cast("string")


# ---- profiles ----------------------------------------------------------------------------

def _profile_payloads(spark, d):
    """One payload per company: a lone object or an array; some broken, some error objects."""
    key = F.col("company_key")
    record = F.struct(
        F.when(key % 17 != 3, F.col("symbol")).alias("symbol"),
        F.col("company_name").alias("companyName"),
        "sector",
        "industry",
        "exchange",
        F.col("market_cap").cast("decimal(20,2)").alias("marketCap"),
        F.when(key % 6 == 0, F.lit("")).when(key % 6 == 1, F.lit("0")).when(key % 19 == 8, F.lit("many")).otherwise(
            (key * 100).cast("string")
        ).alias("fullTimeEmployees"),
        F.col("headquarters_city").alias("city"),
        F.col("headquarters_country").alias("country"),
    )
    good = F.when(key % 2 == 0, F.to_json(F.array(record))).otherwise(F.to_json(record))
    payload = (
        F.when(key % 13 == 5, F.lit('{"symbol": "S0'))
        .when(key % 13 == 6, F.lit('{"Error Message": "Limit reached"}'))
        .otherwise(good)
    )
    return samples.companies(spark, d).select("company_key", payload.alias("payload"))


_USABLE = "company_key % 13 not in (5, 6) and company_key % 17 <> 3"
_BAD_STAFF = "(company_key % 6 not in (0, 1) and company_key % 19 = 8)"


def _profiles(spark, d):
    records, rejects = landing.parse_feed(_profile_payloads(spark, d), "payload", "profile")
    return records, rejects


@query(
    "map_profiles",
    f"""select symbol, company_name, sector, industry, exchange, cast(market_cap as double) as market_cap,
      case when company_key % 6 in (0, 1) then null else nullif(company_key * 100, 0) end as employees,
      headquarters_city, headquarters_state, headquarters_country from v_company where {_USABLE} and not {_BAD_STAFF}""",
)
def map_profiles(spark, d):
    records, _ = _profiles(spark, d)
    _, staged, _ = mapping.map_feed(records, "profile", loaded_at())
    return plain(staged.drop("description", "website", "ceo", "loaded_timestamp"))


@query(
    "profile_rejects",
    f"""select 'malformed payload' as reject_reason, count(*) as records from v_company where company_key % 13 = 5 having count(*) > 0
      union all select 'error payload', count(*) from v_company where company_key % 13 = 6 having count(*) > 0
      union all select 'missing symbol', count(*) from v_company where company_key % 13 not in (5, 6) and company_key % 17 = 3 having count(*) > 0
      union all select 'unreadable fullTimeEmployees', count(*) from v_company where {_USABLE} and {_BAD_STAFF} having count(*) > 0""",
)
def profile_rejects(spark, d):
    records, rejects = _profiles(spark, d)
    _, _, unmapped = mapping.map_feed(records, "profile", loaded_at())
    both = rejects.select("reject_reason").unionByName(unmapped.select("reject_reason"))
    return both.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


@query(
    "mapping_stats",
    f"""select count(*) filter ({_USABLE} and not {_BAD_STAFF}) as processed,
      count(*) filter (company_key % 13 not in (5, 6) and (company_key % 17 = 3 or {_BAD_STAFF})) as failed from v_company""",
)
def mapping_stats(spark, d):
    records, _ = _profiles(spark, d)
    _, staged, rejects = mapping.map_feed(records, "profile", loaded_at())
    return mapping.mapping_stats(staged, rejects)


# ---- prices ------------------------------------------------------------------------------

def _price_payloads(spark, d):
    """A month of daily bars per payload, as a bare array or under ``historical``."""
    bar = F.struct(
        F.col("price_date").cast("string").alias("date"),
        F.col("open_price").alias("open"),
        F.col("high_price").alias("high"),
        F.col("low_price").alias("low"),
        F.col("close_price").alias("close"),
        F.when(F.dayofmonth("price_date") % 2 == 0, F.col("close_price") - 1).alias("adjClose"),
        F.when(F.dayofmonth("price_date") % 9 != 0, F.col("volume")).alias("volume"),
    )
    # a month has at most 31 bars
    months = samples.prices(spark, d).groupBy("symbol", F.trunc("price_date", "month").alias("month")).agg(
        F.collect_list(bar).alias("bars")
    )
    return months.select(
        "symbol",
        F.when(F.month("month") % 2 == 0, F.to_json("bars"))
        .otherwise(F.to_json(F.struct(F.col("symbol"), F.col("bars").alias("historical"))))
        .alias("payload"),
    )


def _prices(spark, d):
    records, _ = landing.parse_feed(_price_payloads(spark, d), "payload", "price", symbol="symbol")
    return records


_STAGED_PRICE = """select symbol, price_date, {money},
  cast(case when day(price_date) % 2 = 0 then close_price - 1 else close_price end as double) as adj_close,
  case when day(price_date) % 9 <> 0 then volume else 0 end as volume from v_prices""".format(
    money=dbl("open_price", "high_price", "low_price", "close_price")
)


@query("map_prices", _STAGED_PRICE)
def map_prices(spark, d):
    _, staged, _ = mapping.map_feed(_prices(spark, d), "price", loaded_at())
    return plain(staged.drop("change_percent", "loaded_timestamp"))


@query(
    "raw_prices",
    f"""select symbol, price_date, 'FMP' as api_source, close_price, volume from ({_STAGED_PRICE})""",
)
def raw_prices(spark, d):
    """Raw history rows, read back by path from the variant."""
    raw, _, _ = mapping.map_feed(_prices(spark, d), "price", loaded_at())
    v = mapping.as_variant(raw)
    return v.select(
        "symbol",
        "price_date",
        "api_source",
        F.variant_get("raw_data", "$.close_price", "double").alias("close_price"),
        F.variant_get("raw_data", "$.volume", "bigint").alias("volume"),
    )


@query(
    "plain_prices",
    f"""select symbol, price_date as date, open_price as open, high_price as high, low_price as low, close_price as close,
      adj_close, volume, 'FMP' as source from ({_STAGED_PRICE})""",
)
def plain_prices(spark, d):
    _, staged, _ = mapping.map_feed(_prices(spark, d), "price", loaded_at())
    return plain(mapping.plain_prices(staged.drop("change_percent", "loaded_timestamp")))


# ---- statements --------------------------------------------------------------------------

def _filing(accepted_date_only):
    """Filing fields of a payload; some acceptance times come as a bare date, which is unreadable."""
    stamp = F.date_format("accepted_date", "yyyy-MM-dd HH:mm:ss")
    return [
        "symbol",
        F.col("fiscal_date").cast("string").alias("date"),
        F.when(F.col("period") != "FY", F.col("period")).alias("period"),
        F.col("filing_date").cast("string").alias("filingDate"),
        F.when(accepted_date_only, F.substring(stamp, 1, 10)).otherwise(stamp).alias("acceptedDate"),
    ]


def _bad():
    return (F.col("company_key") % 10 == 7) & (F.month("fiscal_date") == 3)


_OK = "not (company_key % 10 = 7 and month(fiscal_date) = 3)"


def _parsed(df, fields, feed):
    payload = df.select(F.to_json(F.struct(*_filing(_bad()), *fields)).alias("payload"))
    records, _ = landing.parse_feed(payload, "payload", feed)
    return records


def _money(c):
    return F.col(c).cast("decimal(20,2)")


def _income(spark, d):
    return _parsed(
        samples.income(spark, d),
        [
            _money("revenue").alias("revenue"),
            _money("cost_of_revenue").alias("costOfRevenue"),
            _money("net_income").alias("netIncome"),
            F.col("eps_diluted").alias("epsDiluted"),
            F.col("shares_outstanding").cast("double").alias("weightedAverageShsOut"),
        ],
        "income",
    )


@query(
    "map_income",
    f"""select symbol, fiscal_date, period, filing_date, accepted_date, cast(cast(revenue as decimal(20,2)) as double) as revenue,
      cast(cast(cost_of_revenue as decimal(20,2)) as double) as cost_of_revenue, cast(cast(net_income as decimal(20,2)) as double) as net_income,
      cast(eps_diluted as double) as eps_diluted, shares_outstanding from v_income where {_OK}""",
)
def map_income(spark, d):
    _, staged, _ = mapping.map_feed(_income(spark, d), "income", loaded_at())
    return plain(
        staged.select(
            "symbol", "fiscal_date", "period", "filing_date", "accepted_date", "revenue", "cost_of_revenue", "net_income",
            "eps_diluted", "shares_outstanding",
        )
    )


@query(
    "statement_rejects",
    f"select symbol, 'unreadable acceptedDate' as reject_reason from v_income where not ({_OK})",
)
def statement_rejects(spark, d):
    _, _, rejects = mapping.map_feed(_income(spark, d), "income", loaded_at())
    return rejects.select("symbol", "reject_reason")


@query(
    "statement_versions",
    f"""select symbol, fiscal_date, period, accepted_date, cast(cast(revenue as decimal(20,2)) as double) as revenue from v_income where {_OK}
      union all select symbol, fiscal_date, period, accepted_date + interval 200 day, cast(cast(revenue as decimal(20,2)) + 1000 as double)
      from v_income where {_OK} and revenue > 1000000""",
)
def statement_versions(spark, d):
    """Raw history of first releases and of restatements accepted 200 days later; both were
    loaded twice."""
    _, mapped, _ = mapping.map_feed(_income(spark, d), "income", loaded_at())
    # mapped once and read from there: four histories of mapped fields in one plan fill the driver
    path = work_dir(spark, "mapped-income")
    mapped.write.parquet(path)
    staged = spark.read.schema(mapped.schema).parquet(path)
    restated = staged.where("revenue > 1000000").withColumns(
        {"accepted_date": F.col("accepted_date") + F.expr("interval 200 days"), "revenue": F.col("revenue") + 1000}
    )
    first = mapping.raw_rows(staged, "income").unionByName(mapping.raw_rows(restated, "income"))
    again = first.withColumn("loaded_timestamp", F.col("loaded_timestamp") + F.expr("interval 1 day"))
    versions = mapping.statement_versions(first.unionByName(again), "income")
    return plain(versions.select("symbol", "fiscal_date", "period", "accepted_date", "revenue"))


@query(
    "map_balance",
    f"""select symbol, fiscal_date, period, cast(cast(total_assets as decimal(20,2)) as double) as total_assets,
      cast(cast(case when company_key % 3 = 1 then total_assets else total_equity end as decimal(20,2)) as double) as total_equity from v_balance where {_OK}""",
)
def map_balance(spark, d):
    """Every third company reports zero equity, which falls through to the other field."""
    key = F.col("company_key")
    records = _parsed(
        samples.balance(spark, d),
        [
            _money("total_assets").alias("totalAssets"),
            F.when(key % 3 == 1, F.lit(0).cast("decimal(20,2)")).when(key % 3 == 2, _money("total_equity")).alias("totalEquity"),
            F.when(key % 3 == 1, _money("total_assets")).otherwise(_money("total_equity")).alias("totalStockholdersEquity"),
        ],
        "balance",
    )
    _, staged, _ = mapping.map_feed(records, "balance", loaded_at())
    return plain(staged.select("symbol", "fiscal_date", "period", "total_assets", "total_equity"))


@query(
    "map_cashflow",
    f"""select symbol, fiscal_date, period, cast(cast(operating_cash_flow as decimal(20,2)) as double) as operating_cash_flow,
      cast(cast(dividends_paid as decimal(20,2)) as double) as dividends_paid from v_cash where {_OK}""",
)
def map_cashflow(spark, d):
    key = F.col("company_key")
    records = _parsed(
        samples.cash(spark, d),
        [
            _money("operating_cash_flow").alias("operatingCashFlow"),
            F.when(key % 2 == 0, _money("dividends_paid")).alias("commonDividendsPaid"),
            F.when(key % 2 == 1, _money("dividends_paid")).otherwise(F.lit(0).cast("decimal(20,2)")).alias("netDividendsPaid"),
        ],
        "cashflow",
    )
    _, staged, _ = mapping.map_feed(records, "cashflow", loaded_at())
    return plain(staged.select("symbol", "fiscal_date", "period", "operating_cash_flow", "dividends_paid"))


@query(
    "statement_periods",
    """select symbol, cast(fiscal_date as varchar) as date, period from (select *, row_number() over (partition by symbol order by fiscal_date desc) as rn
      from v_income where period <> 'FY') where rn <= 8""",
)
def statement_periods(spark, d):
    return landing.statement_periods(_income(spark, d), "quarterly", 8).select("symbol", "date", "period")


@query(
    "plain_fundamentals",
    f"""select symbol, fiscal_date, cast(year(fiscal_date) as int) as fiscal_year, cast(replace(period, 'Q', '') as int) as fiscal_quarter,
      {dbl('revenue', 'gross_profit', 'operating_income', 'net_income', 'eps', 'total_assets', 'total_liabilities', 'total_equity', 'operating_cash_flow', 'free_cash_flow')},
      'FMP' as source from v_fact where period <> 'FY'""",
)
def plain_fundamentals(spark, d):
    tables = [f(spark, d).drop("company_key") for f in (samples.income, samples.balance, samples.cash)]
    return plain(mapping.plain_fundamentals(*tables))


# ---- other feeds -------------------------------------------------------------------------

@query(
    "map_options",
    """select cast(user_id as varchar) as symbol, cast(cast(ts as date) + 30 as date) as expiration_date, value as strike_price,
      case when event_type = 'click' then 'CALL' else 'PUT' end as option_type, 'C' || cast(event_id as varchar) as contract_symbol,
      event_id % 100 as volume, event_id % 3 = 0 as in_the_money from events where event_type in ('click', 'view')""",
)
def map_options(spark, d):
    e = samples.table(spark, d, "events").where(F.col("event_type").isin("click", "view"))
    payload = e.select(
        F.to_json(
            F.struct(
                F.col("user_id").cast("string").alias("symbol"),
                F.date_add(F.col("ts").cast("date"), 30).cast("string").alias("expirationDate"),
                F.col("value").alias("strike"),
                F.when(F.col("event_type") == "click", "call").otherwise("put").alias("optionType"),
                F.concat(F.lit("C"), F.col("event_id").cast("string")).alias("contractSymbol"),
                (F.col("event_id") % 100).alias("volume"),
                (F.col("event_id") % 3 == 0).alias("inTheMoney"),
            )
        ).alias("payload")
    )
    records, _ = landing.parse_feed(payload, "payload", "option")
    _, staged, _ = mapping.map_feed(records, "option", loaded_at())
    return staged.select(
        "symbol", "expiration_date", "strike_price", "option_type", "contract_symbol", "volume", "in_the_money"
    )


# payload field -> measure of the sample it carries
_VENDOR = {"revenueTTM": "revenue", "totalAssetsTTM": "total_assets", "totalDebtTTM": "total_debt"}


@query(
    "vendor_metrics",
    " union all ".join(
        f"select symbol, fiscal_date, '{name}' as metric, cast(cast({c} as decimal(20,6)) as double) as value from v_fact where {c} is not null"
        for name, c in _VENDOR.items()
    ).replace(" as value from", " as value, cast(null as varchar) as text from")
    + " union all select symbol, fiscal_date, 'reportedCurrency', null, 'USD' from v_fact",
)
def vendor_metrics(spark, d):
    """A wide metric payload per statement, read into rows; its text field has a text and no value."""
    record = F.struct(
        "symbol",
        *[F.col(c).cast("decimal(20,6)").alias(name) for name, c in _VENDOR.items()],
        F.lit("USD").alias("reportedCurrency"),
    )
    payloads = samples.statements(spark, d).select("fiscal_date", F.to_json(F.array(record)).alias("payload"))
    return landing.metrics_long(payloads, "payload")


@query(
    "json_props",
    """select event_type, count(*) as events, cast(sum(cast(json_extract(props, '$.k') as bigint)) as bigint) as k_sum,
      max(cast(json_extract(props, '$.k') as bigint)) as k_max from events group by event_type""",
)
def json_props(spark, d):
    records = landing.payload_records(samples.table(spark, d, "events").select("event_type", "props"), "props")
    e = landing.fields(records, "payload", {"k": ("$.k", "bigint")})
    return e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("k").alias("k_sum"), F.max("k").alias("k_max")
    )


_PRIORITIES = {"month1": "1-URGENT", "month3": "2-HIGH", "year1": "3-MEDIUM", "year10": "4-NOT SPECIFIED", "year30": "5-LOW"}


@query(
    "unpivot_rates",
    "select * from (select cast(cast(o_orderdate as date) as varchar) as date, "
    + ", ".join(f"max(o_totalprice) filter (o_orderpriority = '{p}') as {c}" for c, p in _PRIORITIES.items())
    + " from orders group by 1) unpivot include nulls (rate for maturity in (month1, month3, year1, year10, year30))",
)
def unpivot_rates(spark, d):
    wide = samples.table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").cast("string").alias("date")).agg(
        *[F.max(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice"))).alias(c) for c, p in _PRIORITIES.items()]
    )
    return landing.rates_long(wide)


@query(
    "constituent_changes",
    """with old as (select symbol from v_company), new as (select case when company_key % 8 = 1 then symbol || 'N' else symbol end as symbol from v_company)
      select symbol, 'added' as change from new where symbol not in (select symbol from old)
      union all select symbol, 'removed' from old where symbol not in (select symbol from new)""",
)
def constituent_changes(spark, d):
    """The whole list against a second one in which an eighth of the members go by another name."""
    c = samples.companies(spark, d)
    renamed = c.withColumn("symbol", F.when(F.col("company_key") % 8 == 1, F.concat("symbol", F.lit("N"))).otherwise(F.col("symbol")))
    return landing.constituent_changes(landing.constituents(c), landing.constituents(renamed))


@query(
    "payload_history",
    """select symbol, s_name as company_name, cast(length(s_name) as bigint) as name_length, s_suppkey % 3 as board_size, false as lost
      from supplier join v_company on company_key = s_suppkey
      union all select 'X' || symbol, null, null, null, true from v_company where company_key % 10 = 0""",
)
def payload_history(spark, d):
    """Records kept as they came and read back by path, fields among them that no mapping knows; of
    each tenth company also a file that isn't JSON."""
    path = work_dir(spark, "payloads")
    c = samples.companies(spark, d)
    record = F.struct("symbol", F.col("company_name").alias("companyName"), F.struct((F.col("company_key") % 3).alias("boardSize"), F.length("company_name").alias("nameLength")).alias("extra"))
    good = c.select("symbol", F.to_json(F.array(record)).alias("value"))
    bad = c.where("company_key % 10 = 0").select(F.concat(F.lit("X"), "symbol").alias("symbol"), F.lit('[{"symbol": ').alias("value"))
    texts = good.unionByName(bad).withColumnRenamed("symbol", "file")
    rows = landing.payload_records(texts, symbol=F.col("file"))
    sinks.write_run(rows, f"{path}/payload", "1")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/payload/run=1")
    wanted = {"company_name": ("$.companyName", "string"), "name_length": ("$.extra.nameLength", "bigint"), "board_size": ("$.extra.boardSize", "bigint")}
    out = landing.fields(stored, "payload", wanted)
    return out.select("symbol", *wanted, F.col("unparsed").isNotNull().alias("lost"))


@query(
    "bulk_lines",
    "select symbol, cast(price_date as varchar) as date, cast(cast(close_price as decimal(12,2)) as double) as close, false as refused from v_prices where company_key % 10 <> 3"
    " union all select null, cast(price_date as varchar), null, true from v_prices where company_key % 10 = 3",
)
def bulk_lines(spark, d):
    """One record a line, with names in another case, a field of no mapping and, for a tenth of the
    companies, text that isn't JSON; bad lines are set apart and stop nothing."""
    p = samples.prices(spark, d)
    record = F.struct("symbol", F.col("price_date").cast("string").alias("DATE"), F.col("close_price").alias("Close"), F.lit(1).alias("unknown"))
    text = F.when(F.col("company_key") % 10 == 3, F.concat(F.col("price_date").cast("string"), F.lit(" oops {"))).otherwise(F.to_json(record))
    path = work_dir(spark, "lines")
    p.select(text.alias("value")).write.text(path)
    good, bad = landing.read_lines(spark, path, "price")
    kept = good.select("symbol", "date", F.col("close").cast("double").alias("close"), F.lit(False).alias("refused"))
    return kept.unionByName(bad.select(F.lit(None).cast("string").alias("symbol"), F.substring("detail", 1, 10).alias("date"), F.lit(None).cast("double").alias("close"), F.lit(True).alias("refused")))


@query(
    "historical_market_cap",
    """select symbol, cast(price_date as varchar) as date, "marketCap" from (
      select symbol, price_date, volume * 1000 as "marketCap", row_number() over (partition by symbol order by price_date desc) as rn
      from v_prices where price_date between date '1999-01-01' and date '2000-12-31') where rn <= 100""",
)
def historical_market_cap(spark, d):
    records = samples.prices(spark, d).select(
        "symbol", F.col("price_date").cast("string").alias("date"), (F.col("volume") * 1000).alias("marketCap")
    )
    return landing.historical_market_cap(records, "1999-01-01", "2000-12-31", limit=100)


@query(
    "sector_pe",
    """select date, sector, exchange, pe from (
      select cast(price_date as varchar) as date, sector, exchange, cast(max(close_price) as double) as pe
      from v_prices join (select symbol, sector, exchange from v_company) using (symbol) group by 1, 2, 3)
      where date = '1998-03-02' and exchange = 'NYSE'""",
)
def sector_pe(spark, d):
    c = samples.companies(spark, d).select("symbol", "sector", "exchange")
    feed = (
        samples.prices(spark, d)
        .join(c, "symbol")
        .groupBy(F.col("price_date").cast("string").alias("date"), "sector", "exchange")
        .agg(F.max("close_price").cast("double").alias("pe"))
    )
    return landing.sector_pe(feed, "1998-03-02", exchange="NYSE")


@query(
    "indicator",
    """select name, date, value from (
      select o_orderpriority as name, cast(cast(o_orderdate as date) as varchar) as date, max(o_totalprice) as value from orders group by 1, 2)
      where name = '1-URGENT' and date between '1997-01-01' and '1998-06-30'""",
)
def indicator(spark, d):
    feed = samples.table(spark, d, "orders").groupBy(
        F.col("o_orderpriority").alias("name"), F.col("o_orderdate").cast("date").cast("string").alias("date")
    ).agg(F.max("o_totalprice").alias("value"))
    return landing.indicator(feed, "1-URGENT", "1997-01-01", "1998-06-30")


