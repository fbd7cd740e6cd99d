"""Dimensions, facts, ratios, trailing sums, valuation, growth and technicals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.functions.ratios import fundamental_ratios, with_extra_ratios
from tickerloom.functions.valuation import METRICS
from tickerloom.operators import growth, keyed, trailing
from tickerloom.operators.asof import asof_join, known_at
from tickerloom.operators.scd2 import apply_changes, change_counts, detect_changes, first_load
from tickerloom.operators.series import balanced_slots, gaps, price_change, sessions, volatility
from tickerloom.plans import daily, dims, facts, growth_table, options, technicals, views
from tickerloom.schemas import BALANCE_MEASURES, CASH_MEASURES, INCOME_MEASURES
from tickerloom.session import work_dir
from tickerloom.sources import samples

from .registry import ORACLE, dbl, plain, query

BY = ["company_key"]
MEASURES = (*INCOME_MEASURES, *BALANCE_MEASURES, *CASH_MEASURES)


def statements(spark, d):
    return samples.statements(spark, d)


def quarters(spark, d):
    return facts.quarters_of(statements(spark, d))


def filings(spark, d):
    return facts.ratios_fact(quarters(spark, d))


def metrics(spark, d, places=None):
    q = trailing.with_ttm(filings(spark, d), BY)
    return facts.market_metrics(samples.prices(spark, d), q, places=places)


def shipping_days(spark, d):
    day = F.col("l_shipdate").cast("date")
    span = samples.table(spark, d, "lineitem").agg(F.min(day).alias("start"), F.max(day).alias("end"))
    return dims.calendar(span)


# ---- dimensions --------------------------------------------------------------------------

_CALENDAR_SQL = """
select cast(strftime(date, '%Y%m%d') as int) as date_key, date, cast(year(date) as int) as year,
  cast(quarter(date) as int) as quarter, cast(month(date) as int) as month, cast(day(date) as int) as day,
  cast(dayofweek(date) + 1 as int) as day_of_week, left(dayname(date), 3) as day_name,
  left(monthname(date), 3) as month_name, isodow(date) in (6, 7) as is_weekend,
  date = last_day(date) as is_month_end, date = last_day(date) and month(date) in (3, 6, 9, 12) as is_quarter_end,
  date = last_day(date) and month(date) = 12 as is_year_end, cast(weekofyear(date) as int) as week
from (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date
      from (select min(cast(l_shipdate as date)) as lo, max(cast(l_shipdate as date)) as hi from lineitem))"""


@query("dim_date", _CALENDAR_SQL)
def dim_date(spark, d):
    return shipping_days(spark, d)


@query(
    "incremental_dates",
    f"select * from ({_CALENDAR_SQL}) where date not in (select cast(o_orderdate as date) from orders)",
)
def incremental_dates(spark, d):
    stored = samples.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return dims.new_dates(shipping_days(spark, d), stored)


_BAND = """case when coalesce(market_cap, 0) >= 200000000000 then 'Mega Cap'
  when coalesce(market_cap, 0) >= 10000000000 then 'Large Cap' when coalesce(market_cap, 0) >= 2000000000 then 'Mid Cap'
  when coalesce(market_cap, 0) >= 300000000 then 'Small Cap' else 'Micro Cap' end"""
_PLACE = "nullif(concat_ws(', ', headquarters_city, headquarters_state, headquarters_country), '')"


@query(
    "dim_company_current",
    f"""select symbol, company_name, sector, industry, exchange, {_BAND} as market_cap_category,
      {_PLACE} as headquarters_location from v_company""",
)
def dim_company_current(spark, d):
    dim = first_load(dims.company_versions(samples.companies(spark, d)), F.lit("2020-01-01").cast("timestamp_ntz"))
    return dims.current_only(dim).drop("company_key", "is_current", "valid_from", "valid_to")


def _snapshots(spark, d):
    """Yesterday's profiles, without the largest companies, and today's, without the smallest and
    with some changes."""
    base = samples.companies(spark, d)
    key = F.col("company_key")
    before = base.where(F.col("market_cap") < 250_000_000_000)
    after = base.withColumns(
        {
            "company_name": F.when(key % 5 == 0, F.concat("company_name", F.lit(" Inc"))).otherwise(F.col("company_name")),
            "sector": F.when(key % 8 == 1, F.lit("RENAMED")).otherwise(F.col("sector")),
            "market_cap": F.when(key % 6 == 2, F.col("market_cap") * 2).otherwise(F.col("market_cap")),
        }
    ).where(F.col("market_cap") >= 0)
    return before, after


_SNAPSHOT_SQL = """
after as (
  select company_key, symbol, case when company_key % 5 = 0 then company_name || ' Inc' else company_name end as company_name,
    case when company_key % 8 = 1 then 'RENAMED' else sector end as sector, industry, exchange,
    case when company_key % 6 = 2 then market_cap * 2 else market_cap end as market_cap,
    headquarters_city, headquarters_state, headquarters_country
  from v_company where market_cap >= 0),
before as (select * from v_company where market_cap < 250000000000),
detected as (
  select a.*, b.symbol is null as is_new,
    case when b.symbol is null then 'all' else concat_ws(',',
      case when a.company_name is distinct from b.company_name then 'name' end,
      case when a.sector is distinct from b.sector then 'sector' end,
      case when a.industry is distinct from b.industry then 'industry' end,
      case when coalesce(b.market_cap, 0) > 0
        and cast(abs(coalesce(a.market_cap, 0) - b.market_cap) as double) / cast(b.market_cap as double) > 0.1 then 'market_cap' end) end as changed_fields
  from after a left join before b on a.symbol = b.symbol)"""


@query(
    "scd2_changes",
    f"with {_SNAPSHOT_SQL} select symbol, is_new, changed_fields, changed_fields <> '' as has_changes from detected",
)
def scd2_changes(spark, d):
    before, after = _snapshots(spark, d)
    found = detect_changes(after, before)
    return found.select("symbol", "is_new", F.array_join("changed_fields", ",").alias("changed_fields"), "has_changes")


@query(
    "scd2_change_counts",
    f"""with {_SNAPSHOT_SQL} select count(*) filter (is_new) as new_companies,
      count(*) filter (not is_new and changed_fields <> '') as updated_companies,
      count(*) filter (changed_fields = '') as unchanged_companies from detected""",
)
def scd2_change_counts(spark, d):
    before, after = _snapshots(spark, d)
    return change_counts(detect_changes(after, before))


_VERSION = f"symbol, company_name, sector, industry, exchange, {_BAND} as market_cap_category, {_PLACE} as headquarters_location"
_T0, _T1 = "timestamp '2020-01-01 00:00:00'", "timestamp '2021-06-30 12:00:00'"
_OPEN = "timestamp '9999-12-31 00:00:00'"


def _scd2_sql(closes: str) -> str:
    return f"""with {_SNAPSHOT_SQL},
changed as (select * from detected where changed_fields <> ''),
marked as (select *, ({closes}) as closes from before)
select {_VERSION}, not closes as is_current, {_T0} as valid_from, case when closes then {_T1} else {_OPEN} end as valid_to from marked
union all
select {_VERSION}, true as is_current, {_T1} as valid_from, {_OPEN} as valid_to from changed"""


def _scd2(spark, d, close_missing: bool):
    before, after = _snapshots(spark, d)
    dim = first_load(dims.company_versions(before), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    versions = dims.company_versions(detect_changes(after, before).where("has_changes"))
    at = F.lit("2021-06-30 12:00:00").cast("timestamp_ntz")
    # far-away timestamps do not fit every client's nanosecond type
    return apply_changes(dim, versions, at, present=after if close_missing else None).drop("company_key").withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("valid_from", "valid_to")}
    )


def _as_text(sql: str) -> str:
    return sql.replace(
        f"{_T0} as valid_from", "'2020-01-01 00:00:00' as valid_from"
    ).replace(f"{_T1} as valid_from", "'2021-06-30 12:00:00' as valid_from").replace(
        f"case when closes then {_T1} else {_OPEN} end as valid_to",
        "case when closes then '2021-06-30 12:00:00' else '9999-12-31 00:00:00' end as valid_to",
    ).replace(f"{_OPEN} as valid_to", "'9999-12-31 00:00:00' as valid_to")


@query("scd2_apply", _as_text(_scd2_sql("symbol in (select symbol from changed)")))
def scd2_apply(spark, d):
    return _scd2(spark, d, close_missing=False)


@query(
    "scd2_close_missing",
    _as_text(_scd2_sql("symbol in (select symbol from changed) or symbol not in (select symbol from after)")),
)
def scd2_close_missing(spark, d):
    return _scd2(spark, d, close_missing=True)


# ---- prices ------------------------------------------------------------------------------

_CHANGED = """
select company_key, symbol, price_date, open_price, high_price, low_price, close_price, volume,
  close_price - prev as change_amount,
  case when prev > 0 then cast(close_price - prev as double) / cast(prev as double) * 100 end as change_percent
from (select *, lag(close_price) over (partition by symbol order by price_date) as prev from v_prices)"""


@query(
    "daily_price_change",
    f"select symbol, price_date, {dbl('open_price', 'high_price', 'low_price', 'close_price', 'change_amount')}, volume, change_percent from ({_CHANGED})",
)
def daily_price_change(spark, d):
    return plain(price_change(samples.prices(spark, d), ["symbol"], ["price_date"], "close_price")).drop("company_key")


_PRICE_FACT = f"""select symbol, cast(strftime(price_date, '%Y%m%d') as int) as date_key,
  {dbl('open_price', 'high_price', 'low_price', 'close_price', 'change_amount')}, volume, change_percent
  from ({_CHANGED}) join (select symbol from v_company) using (symbol)"""


def _price_fact(spark, d, start=None):
    companies = dims.company_versions(samples.companies(spark, d))
    prices = samples.prices(spark, d).withColumn("adj_close", F.col("close_price"))
    fact = facts.daily_prices_fact(prices, companies, shipping_days(spark, d), start=start)
    return plain(fact.join(companies.select("company_key", "symbol"), "company_key").drop("company_key", "adj_close"))


@query("fact_daily_prices", _PRICE_FACT)
def fact_daily_prices(spark, d):
    return _price_fact(spark, d)


@query("fact_daily_prices_from", _PRICE_FACT + " where price_date >= date '2001-06-01'")
def fact_daily_prices_from(spark, d):
    """A load window: each company's first row is compared with its last row before it."""
    return _price_fact(spark, d, start="2001-06-01")


@query(
    "trade_price_change",
    """select company_key, ok, ln, cast(p as double) as p, d, cast(p - prev as double) as change_amount,
      case when prev > 0 then cast(p - prev as double) / cast(prev as double) * 100 end as change_percent
      from (select *, lag(p) over (partition by company_key order by d, ok, ln, p, q, disc, tax) as prev from v_line)""",
)
def trade_price_change(spark, d):
    """Change from trade to trade: a company has no bound on trades, so its series is cut by quarter."""
    order = ["d", "ok", "ln", "p", "q", "disc", "tax"]
    rows = price_change(samples.trades(spark, d), BY, order, "p", slot=F.trunc("d", "quarter"))
    return plain(rows.select("company_key", "ok", "ln", "p", "d", "change_amount", "change_percent"))


@query("trade_price_change_balanced", ORACLE["trade_price_change"])
def trade_price_change_balanced(spark, d):
    """The same over slots of equal size, which also holds when trades bunch in time."""
    order = ["d", "ok", "ln", "p", "q", "disc", "tax"]
    cut = balanced_slots(samples.trades(spark, d), BY, order, work_dir(spark, "slots"), 16)
    rows = price_change(cut, BY, order, "p", slot=F.col("slot"))
    return plain(rows.select("company_key", "ok", "ln", "p", "d", "change_amount", "change_percent"))


@query(
    "price_gaps",
    """select symbol, prev as gap_start, price_date as gap_end, cast(price_date - prev as int) as days_gap,
      case when price_date - prev > 5 then 'Significant Gap' when price_date - prev > 3 then 'Weekend/Holiday' else 'Normal' end as gap_type
      from (select symbol, price_date, lag(price_date) over (partition by symbol order by price_date) as prev from v_prices)
      where price_date - prev > 3""",
)
def price_gaps(spark, d):
    return views.price_gaps(samples.prices(spark, d))


@query(
    "tick_gaps",
    """select distinct user_id, prev as gap_start, day as gap_end, cast(day - prev as int) as days_gap
      from (select user_id, day, lag(day) over (partition by user_id order by day) as prev
            from (select distinct user_id, cast(ts as date) as day from events)) where day - prev > 1""",
)
def tick_gaps(spark, d):
    days = samples.table(spark, d, "events").select("user_id", F.col("ts").cast("date").alias("day")).distinct()
    return gaps(days, ["user_id"], "day", 1)


@query(
    "tick_sessions",
    """select user_id, min(ts) as session_start, max(ts) as session_end, count(*) as ticks
      from (select user_id, ts, sum(starts) over (partition by user_id order by ts, event_id rows unbounded preceding) as no
            from (select user_id, ts, event_id, case when prev is null or date_diff('microsecond', prev, ts) >= 21600000000 then 1 else 0 end as starts
                  from (select *, lag(ts) over (partition by user_id order by ts, event_id) as prev from events)))
      group by user_id, no""",
)
def tick_sessions(spark, d):
    return sessions(samples.table(spark, d, "events"), ["user_id"], "ts", "event_id", 6 * 3600)


# ---- statements --------------------------------------------------------------------------

@query(
    "statement_fact",
    f"""select symbol, fiscal_date, cast(strftime(fiscal_date, '%Y%m%d') as int) as fiscal_date_key,
      case when f.filing_date <= hi then cast(strftime(f.filing_date, '%Y%m%d') as int) end as filing_date_key,
      accepted_date, period_type, shares_outstanding, {dbl(*[m for m in MEASURES if m != 'shares_outstanding'])}
      from v_fact f join v_company using (symbol),
        (select max(cast(l_shipdate as date)) + 400 as hi from lineitem) where fiscal_date <= hi""",
)
def statement_fact(spark, d):
    day = F.col("l_shipdate").cast("date")
    span = samples.table(spark, d, "lineitem").agg(F.min(day).alias("start"), F.date_add(F.max(day), 400).alias("end"))
    fact = facts.financials_fact(
        dims.company_versions(samples.companies(spark, d)),
        samples.income(spark, d), samples.balance(spark, d), samples.cash(spark, d), dims.calendar(span),
    )
    return plain(fact.drop("financial_key", "company_key"))


@query(
    "missing_statements",
    """with kinds as (select symbol, fiscal_date, period, 1 as b, 0 as c from v_balance
        union all select symbol, fiscal_date, period, 0, 1 from v_cash
        union all select symbol, fiscal_date, period, 0, 0 from v_income),
      found as (select symbol, fiscal_date, period, max(b) as b, max(c) as c from kinds group by all)
      select symbol, fiscal_date, period, if(b = 0, 'Missing Balance Sheet', null) as balance_sheet_status,
        if(c = 0, 'Missing Cash Flow', null) as cash_flow_status,
        case when b = 0 and c = 0 then 'Missing Both' when b = 0 then 'Missing Balance Sheet Only' when c = 0 then 'Missing Cash Flow Only' end as data_completeness
      from found semi join v_income using (symbol, fiscal_date, period) where b + c < 2""",
)
def missing_statements(spark, d):
    return views.missing_statements(samples.income(spark, d), samples.balance(spark, d), samples.cash(spark, d))


# three kinds of rows: an income row of any newest period; a balance row that no income row
# takes up; a cash row that meets neither
_I = ("revenue", "gross_profit", "operating_income", "net_income", "eps_diluted")
_B = ("total_assets", "total_liabilities", "total_equity", "cash_and_equivalents", "total_debt")
_C = ("operating_cash_flow", "free_cash_flow", "dividends_paid")


def _newest(view: str) -> str:
    order = "{'d': fiscal_date, 'p': list_position(['Q1', 'Q2', 'Q3', 'Q4', 'FY'], period)}"
    return f"select symbol, max(fiscal_date) as fiscal_date, arg_max(period, {order}) as period from {view} group by symbol"


def _side(prefix: str, cols: tuple[str, ...], shares: bool = False) -> str:
    extra = f"{prefix}.shares_outstanding, " if shares else ""
    return extra + dbl(*cols, prefix=f"{prefix}.")


def _no_side(cols: tuple[str, ...], shares: bool = False) -> str:
    extra = "null as shares_outstanding, " if shares else ""
    return extra + ", ".join(f"cast(null as double) as {c}" for c in cols)


_LATEST = f"""with ni as ({_newest('v_income')}), nb as ({_newest('v_balance')}), nc as ({_newest('v_cash')}),
tb as (select v_balance.* from v_balance semi join nb using (symbol, fiscal_date, period)),
tc as (select v_cash.* from v_cash semi join nc using (symbol, fiscal_date, period)),
wanted as (from ni union from nb union from nc)
select i.symbol, i.fiscal_date, i.period, {_side('i', _I, True)}, {_side('tb', _B)}, {_side('tc', _C)}
from v_income i semi join wanted using (symbol, fiscal_date, period)
left join tb using (symbol, fiscal_date, period) left join tc using (symbol, fiscal_date, period)
union all
select b.symbol, b.fiscal_date, b.period, {_no_side(_I, True)}, {_side('b', _B)}, {_side('tc', _C)}
from v_balance b left join tc using (symbol, fiscal_date, period)
where case when (b.symbol, b.fiscal_date, b.period) in (select (symbol, fiscal_date, period) from nb)
  then (b.symbol, b.fiscal_date, b.period) not in (select (symbol, fiscal_date, period) from v_income) else tc.symbol is not null end
union all
select tc.symbol, tc.fiscal_date, tc.period, {_no_side(_I, True)}, {_no_side(_B)}, {_side('tc', _C)}
from tc anti join v_income using (symbol, fiscal_date, period) anti join v_balance using (symbol, fiscal_date, period)"""


def _latest(spark, d):
    return plain(views.latest_financials(samples.income(spark, d), samples.balance(spark, d), samples.cash(spark, d)))


@query("latest_financials", _LATEST)
def latest_financials(spark, d):
    return _latest(spark, d)


@query("latest_quarterly", f"select * from ({_LATEST}) where period in ('Q1', 'Q2', 'Q3', 'Q4')")
def latest_quarterly(spark, d):
    return facts.quarters_of(_latest(spark, d), "period")


@query("latest_annual", f"select * from ({_LATEST}) where period = 'FY'")
def latest_annual(spark, d):
    return _latest(spark, d).where(F.col("period") == "FY")


@query(
    "latest_per_period_type",
    f"""select symbol, period_type, fiscal_date, {dbl('revenue', 'net_income', 'total_assets')} from (
      select *, row_number() over (partition by company_key, period_type order by fiscal_date desc) as rn
      from v_fact where fiscal_date >= date '1999-12-31') where rn = 1""",
)
def latest_per_period_type(spark, d):
    rows = views.latest_per_period_type(statements(spark, d), BY, F.lit("1999-12-31").cast("date"))
    return plain(rows.select("symbol", "period_type", "fiscal_date", "revenue", "net_income", "total_assets"))


RATIOS = daily.RATIO_NAMES


@query("financial_ratios", f"select company_key, fiscal_date, period_type, {', '.join(RATIOS)} from v_ratio")
def financial_ratios(spark, d):
    return facts.ratios_fact(statements(spark, d)).select("company_key", "fiscal_date", "period_type", *RATIOS)


@query(
    "financial_ratios_rounded",
    f"""select company_key, fiscal_date, period_type, {', '.join(f'cast(round_even(cast({r} as decimal(38,12)), 2) as double) as {r}' for r in ('gross_margin', 'roe', 'debt_to_equity', 'book_value_per_share'))} from v_ratio""",
)
def financial_ratios_rounded(spark, d):
    kept = ("gross_margin", "roe", "debt_to_equity", "book_value_per_share")
    rounded = statements(spark, d).select(
        "company_key", "fiscal_date", "period_type", *[e.alias(n) for n, e in fundamental_ratios(2).items() if n in kept]
    )
    return plain(rounded)


@query(
    "staging_ratios",
    """select i.symbol, i.fiscal_date, i.period,
      case when revenue > 0 then cast(gross_profit as double) / cast(revenue as double) * 100 end as gross_margin_pct,
      case when revenue > 0 then cast(operating_income as double) / cast(revenue as double) * 100 end as operating_margin_pct,
      case when revenue > 0 then cast(net_income as double) / cast(revenue as double) * 100 end as net_margin_pct,
      case when total_equity > 0 then cast(total_debt as double) / cast(total_equity as double) end as debt_to_equity,
      case when total_assets > 0 then cast(total_debt as double) / cast(total_assets as double) end as debt_to_assets,
      case when current_liabilities > 0 then cast(current_assets as double) / cast(current_liabilities as double) end as current_ratio,
      case when shares_outstanding > 0 then cast(revenue as double) / cast(shares_outstanding as double) end as revenue_per_share,
      case when shares_outstanding > 0 then cast(total_equity as double) / cast(shares_outstanding as double) end as book_value_per_share
      from v_income i join v_balance b on i.symbol = b.symbol and i.fiscal_date = b.fiscal_date and i.period = b.period""",
)
def staging_ratios(spark, d):
    return facts.staging_ratios(samples.income(spark, d), samples.balance(spark, d))


@query(
    "average_balance_ratios",
    """select company_key, fiscal_date,
      case when current_liabilities > 0 then cast(cash_and_equivalents as double) / cast(current_liabilities as double) end as cash_ratio,
      case when shares_outstanding > 0 then cast(cash_and_equivalents as double) / cast(shares_outstanding as double) end as cash_per_share,
      case when shares_outstanding > 0 then cast(free_cash_flow as double) / cast(shares_outstanding as double) end as free_cash_flow_per_share,
      round(case when total_equity + pe > 0 then cast(net_income as double) / (cast(total_equity + pe as double) / 2) * 100 end, 6) as roe_average,
      round(case when total_assets + pa > 0 then cast(net_income as double) / (cast(total_assets + pa as double) / 2) * 100 end, 6) as roa_average
      from (select *, lag(total_equity) over w as pe, lag(total_assets) over w as pa from v_fact where period <> 'FY'
            window w as (partition by company_key order by fiscal_date))""",
)
def average_balance_ratios(spark, d):
    cols = ["cash_ratio", "cash_per_share", "free_cash_flow_per_share"]
    rows = with_extra_ratios(quarters(spark, d), BY)
    return rows.select(
        "company_key", "fiscal_date", *cols, *[F.round(c, 6).alias(c) for c in ("roe_average", "roa_average")]
    )


# ---- trailing twelve months --------------------------------------------------------------

_TTM_MONEY = [f"ttm_{c}" for c in trailing.FLOWS] + [f"latest_{c}" for c in trailing.STOCKS if c != "shares_outstanding"]
_TTM_HEAD = "company_key, calculation_date, accepted_date, quarters_included, oldest_quarter_date, newest_quarter_date, latest_shares_outstanding"


@query("ttm_rolling", f"select {_TTM_HEAD}, {dbl(*_TTM_MONEY)} from v_ttm")
def ttm_rolling(spark, d):
    return plain(trailing.ttm_in_order(quarters(spark, d), BY))


_OPPORTUNITY = """
calc as (select company_key, cast(accepted_date as date) as calculation_date, max(accepted_date) as accepted_date
         from v_fact where period <> 'FY' group by 1, 2),
known as (
  select c.company_key as ck, c.calculation_date, c.accepted_date as known_at, q.*,
    row_number() over (partition by c.company_key, c.calculation_date order by q.fiscal_date desc) as quarter_rank
  from calc c join (select * from v_fact where period <> 'FY') q on c.company_key = q.company_key
    and q.accepted_date <= c.accepted_date and q.fiscal_date > cast(c.calculation_date - interval 15 month as date))"""


@query(
    "ttm_opportunities",
    f"""with {_OPPORTUNITY} select ck as company_key, calculation_date, known_at as accepted_date, count(distinct fiscal_date) as quarters_available,
      min(fiscal_date) as oldest_quarter_date, max(fiscal_date) as newest_quarter_date from known group by 1, 2, 3
      having count(distinct fiscal_date) >= 4""",
)
def ttm_opportunities(spark, d):
    return trailing.opportunities(quarters(spark, d), BY)


@query(
    "ttm_point_in_time",
    f"""with {_OPPORTUNITY} select ck as company_key, calculation_date, known_at as accepted_date, cast(count(*) as int) as quarters_included,
      min(fiscal_date) as oldest_quarter_date, max(fiscal_date) as newest_quarter_date,
      {', '.join(f'cast(sum({c}) as double) as ttm_{c}' for c in trailing.FLOWS)},
      max(case when quarter_rank = 1 then shares_outstanding end) as latest_shares_outstanding,
      {', '.join(f'cast(max(case when quarter_rank = 1 then {c} end) as double) as latest_{c}' for c in trailing.STOCKS if c != 'shares_outstanding')}
      from known where quarter_rank <= 4 group by 1, 2, 3 having count(*) = 4""",
)
def ttm_point_in_time(spark, d):
    return plain(trailing.ttm_as_known(quarters(spark, d), BY))


_PER_PRICE = ("ttm_revenue", "ttm_net_income", "ttm_operating_income", "ttm_operating_cash_flow", "ttm_dividends_paid", "latest_total_equity", "latest_total_assets", "latest_total_debt")


@query(
    "ttm_per_price",
    f"""select p.company_key, p.price_date, cast(p.close_price as double) as close_price, t.quarters_included,
      {dbl(*_PER_PRICE, prefix='t.')}
      from v_prices p asof join v_ttm t on p.company_key = t.company_key and cast(p.price_date as timestamp) >= t.accepted_date""",
)
def ttm_per_price(spark, d):
    rows = facts.ttm_per_price(samples.prices(spark, d), quarters(spark, d))
    return plain(
        rows.select(
            "company_key", "price_date", "close_price", "quarters_included", *_PER_PRICE
        )
    )


@query(
    "ttm_integrity",
    """with broken as (
      select company_key, calculation_date, oldest_quarter_date, newest_quarter_date,
        case when company_key % 9 = 0 then 3 else quarters_included end as quarters_included,
        case when company_key % 13 = 0 then null else ttm_revenue end as ttm_revenue,
        case when company_key % 10 = 3 then null else latest_shares_outstanding end as latest_shares_outstanding from v_ttm)
    select * from (select company_key, calculation_date, concat_ws(',',
        case when quarters_included <> 4 then 'quarter count' end,
        case when date_diff('month', oldest_quarter_date, newest_quarter_date) not between 8 and 11 then 'quarter span' end,
        case when newest_quarter_date > calculation_date then 'future quarter' end,
        case when ttm_revenue is null then 'no revenue' end,
        case when latest_shares_outstanding is null then 'no shares' end) as broken_rules from broken) where broken_rules <> ''""",
)
def ttm_integrity(spark, d):
    """The sample's own rows are sound, so some are broken first."""
    key = F.col("company_key")
    ttm = trailing.ttm_in_order(quarters(spark, d), BY).withColumns(
        {
            "quarters_included": F.when(key % 9 == 0, 3).otherwise(F.col("quarters_included")),
            "ttm_revenue": F.when(key % 13 != 0, F.col("ttm_revenue")),
            "latest_shares_outstanding": F.when(key % 10 != 3, F.col("latest_shares_outstanding")),
        }
    )
    bad = trailing.ttm_integrity(ttm)
    return bad.select("company_key", "calculation_date", F.array_join("broken_rules", ",").alias("broken_rules"))


# ---- as-of and valuation -----------------------------------------------------------------

@query(
    "asof_latest_filing",
    f"""select p.company_key, p.price_date, cast(p.close_price as double) as close_price, q.fiscal_date, q.period_type, q.accepted_date,
      cast(q.revenue as double) as revenue, cast(q.eps_diluted as double) as eps_diluted
      from v_prices p asof left join (select * from v_fact where period <> 'FY') q
        on p.company_key = q.company_key and cast(p.price_date as timestamp) >= q.accepted_date""",
)
def asof_latest_filing(spark, d):
    q = quarters(spark, d).select(*BY, "fiscal_date", "period_type", "accepted_date", "revenue", "eps_diluted")
    p = samples.prices(spark, d).select(*BY, "price_date", "close_price")
    return plain(asof_join(p, q, BY, "price_date", "accepted_date", ["fiscal_date"]))


@query(
    "market_metrics",
    f"select company_key, symbol, price_date, cast(close_price as double) as close_price, fiscal_period, filing_fiscal_date, ttm_quarter_date, {', '.join(METRICS)} from v_metrics",
)
def market_metrics(spark, d):
    return plain(metrics(spark, d).drop("open_price", "high_price", "low_price", "volume"))


@query(
    "market_metrics_as_known",
    f"select company_key, price_date, fiscal_period, filing_fiscal_date, ttm_quarter_date, {', '.join(METRICS)} from v_metrics",
)
def market_metrics_as_known(spark, d):
    """The same valuation from two event streams, for filings that may come out of order."""
    q = filings(spark, d)
    ttm = trailing.ttm_as_known(q, BY)
    rows = facts.market_metrics(samples.prices(spark, d), q, ttm)
    return plain(rows.drop("symbol", "open_price", "high_price", "low_price", "close_price", "volume"))


@query("incremental_metrics", "select company_key, price_date, market_cap, pe_ratio_ttm from v_metrics")
def incremental_metrics(spark, d):
    """Prices of two thirds of the companies are valued and stored; then only those whose day is not
    stored yet. Both together are the valuation of all prices."""
    q, path = trailing.with_ttm(filings(spark, d), BY), work_dir(spark, "valued")
    prices = samples.prices(spark, d)
    first = facts.market_metrics(prices.where(F.col("company_key") % 3 != 0), q).select(*BY, "price_date", "market_cap", "pe_ratio_ttm")
    first.write.parquet(path)
    stored = spark.read.schema(first.schema).parquet(path)
    todo = facts.not_yet_computed(prices, stored, [*BY, "price_date"])
    return plain(stored.unionByName(facts.market_metrics(todo, q).select(*first.columns)))


@query(
    "incremental_ratios",
    f"""select company_key, fiscal_date, period_type, {', '.join(RATIOS)} from v_ratio r
      where not exists (select 1 from v_balance b where b.company_key = r.company_key and b.fiscal_date = r.fiscal_date and b.period = r.period)""",
)
def incremental_ratios(spark, d):
    """Ratios of statements not stored yet; stored ones are those with a balance sheet."""
    stored = samples.balance(spark, d).select("symbol", "fiscal_date", "period")
    todo = facts.not_yet_computed(statements(spark, d), stored, ["symbol", "fiscal_date", "period"])
    return facts.ratios_fact(todo).select("company_key", "fiscal_date", "period_type", *RATIOS)


@query(
    "incremental_ttm",
    f"""select company_key, calculation_date, cast(ttm_revenue as double) as ttm_revenue from v_ttm t
      where not exists (select 1 from v_cash c where c.company_key = t.company_key and cast(c.accepted_date as date) = t.calculation_date)""",
)
def incremental_ttm(spark, d):
    stored = samples.cash(spark, d).select(*BY, F.to_date("accepted_date").alias("calculation_date"))
    todo = facts.not_yet_computed(trailing.ttm_in_order(quarters(spark, d), BY), stored, [*BY, "calculation_date"])
    return plain(todo.select("company_key", "calculation_date", "ttm_revenue"))


@query(
    "annual_metrics",
    """with joined as (
      select p.company_key, p.price_date, p.close_price, f.accepted_date as fa, f.revenue, f.net_income, f.total_equity, f.total_debt, f.shares_outstanding as fs
      from v_prices p asof left join (select * from v_fact where period = 'FY') f
        on p.company_key = f.company_key and cast(p.price_date as timestamp) >= f.accepted_date),
    t as (
      select j.*, t.accepted_date as ta, t.ttm_net_income, t.ttm_operating_income, t.latest_shares_outstanding as ts
      from joined j asof left join v_ttm t on j.company_key = t.company_key and cast(j.price_date as timestamp) >= t.accepted_date),
    s as (select *, coalesce(fs, ts) as shares, case when close_price > 0 and coalesce(fs, ts) > 0 then close_price * coalesce(fs, ts) end as cap
          from t where fa is not null or ta is not null)
    select company_key, price_date, cast(cap as double) as market_cap, cast(cap + coalesce(total_debt, 0) as double) as enterprise_value,
      case when net_income > 0 and shares > 0 then cast(close_price as double) / (cast(net_income as double) / cast(shares as double)) end as pe_ratio,
      case when ttm_net_income > 0 and ts > 0 then cast(close_price as double) / (cast(ttm_net_income as double) / cast(ts as double)) end as pe_ratio_ttm,
      case when total_equity > 0 and shares > 0 then cast(close_price as double) / (cast(total_equity as double) / cast(shares as double)) end as pb_ratio,
      case when revenue > 0 and shares > 0 then cast(close_price as double) / (cast(revenue as double) / cast(shares as double)) end as ps_ratio,
      case when revenue > 0 then cast(cap + coalesce(total_debt, 0) as double) / cast(revenue as double) end as ev_to_revenue,
      case when ttm_operating_income > 0 then cast(cap + coalesce(total_debt, 0) as double) / cast(ttm_operating_income as double) end as ev_to_ebit
    from s""",
)
def annual_metrics(spark, d):
    rows = statements(spark, d)
    annual = rows.where(F.col("period") == "FY")
    ttm = trailing.ttm_in_order(facts.quarters_of(rows), BY)
    p = samples.prices(spark, d).select(*BY, "price_date", "close_price")
    return plain(facts.annual_metrics(p, annual, ttm).drop("close_price"))


@query(
    "point_in_time_snapshot",
    f"""select company_key, fiscal_date, period_type, accepted_date, {dbl('revenue', 'net_income', 'total_assets')} from (
      select *, row_number() over (partition by company_key order by accepted_date desc, fiscal_date desc) as rn from v_fact
      where period <> 'FY' and accepted_date <= timestamp '1998-06-30 00:00:00') where rn = 1""",
)
def point_in_time_snapshot(spark, d):
    at = F.lit("1998-06-30 00:00:00").cast("timestamp_ntz")
    rows = known_at(quarters(spark, d), BY, "accepted_date", at, [F.desc("fiscal_date")])
    return plain(rows.select("company_key", "fiscal_date", "period_type", "accepted_date", "revenue", "net_income", "total_assets"))


# ---- growth ------------------------------------------------------------------------------

def _rate(cur: str, prior: str) -> str:
    return f"case when {prior} > 0 then cast({cur} - {prior} as double) / cast({prior} as double) * 100 end"


@query(
    "quarterly_growth",
    f"""select symbol, fiscal_date, period, {dbl('revenue', 'net_income', 'prev_revenue', 'prev_net_income')},
      {_rate('revenue', 'prev_revenue')} as revenue_growth_pct, {_rate('net_income', 'prev_net_income')} as net_income_growth_pct,
      cast(fiscal_date - pd as int) as days_between_quarters
      from (select *, lag(revenue) over w as prev_revenue, lag(net_income) over w as prev_net_income, lag(fiscal_date) over w as pd
            from v_income where period <> 'FY' window w as (partition by symbol order by fiscal_date)) where pd is not null""",
)
def quarterly_growth(spark, d):
    q = facts.quarters_of(samples.income(spark, d), "period").select("symbol", "fiscal_date", "period", "revenue", "net_income")
    rows = growth.sequential(q, ["symbol"], "fiscal_date", ["revenue", "net_income"])
    rows = rows.withColumns(growth.rates(["revenue", "net_income"], "prev_", "_growth_pct")).withColumn(
        "days_between_quarters", F.date_diff("fiscal_date", "prev_fiscal_date")
    )
    return plain(rows.drop("prev_fiscal_date"))


@query(
    "yoy_growth",
    f"""select c.company_key, c.period_type, c.fiscal_date, p.fiscal_date as prior_fiscal_date,
      {_rate('c.revenue', 'p.revenue')} as revenue_growth_rate, {_rate('c.net_income', 'p.net_income')} as net_income_growth_rate,
      {_rate('c.total_assets', 'p.total_assets')} as total_assets_growth_rate
      from v_fact c join v_fact p on c.company_key = p.company_key and c.period_type = p.period_type
        and cast(c.fiscal_date - interval 1 year as date) = p.fiscal_date""",
)
def yoy_growth(spark, d):
    measures = ["revenue", "net_income", "total_assets"]
    rows = growth.against_earlier(statements(spark, d), [*BY, "period_type"], "fiscal_date", 12, measures)
    rates = growth.rates(measures)
    return rows.select("company_key", "period_type", "fiscal_date", "prior_fiscal_date", *[e.alias(n) for n, e in rates.items()])


@query(
    "ttm_yoy_growth",
    f"""select c.company_key, c.calculation_date, p.calculation_date as prior_calculation_date,
      {_rate('c.ttm_revenue', 'p.ttm_revenue')} as ttm_revenue_growth_rate, {_rate('c.ttm_eps_diluted', 'p.ttm_eps_diluted')} as ttm_eps_diluted_growth_rate
      from v_ttm c join v_ttm p on c.company_key = p.company_key and cast(c.calculation_date - interval 1 year as date) = p.calculation_date""",
)
def ttm_yoy_growth(spark, d):
    measures = ["ttm_revenue", "ttm_eps_diluted"]
    ttm = trailing.ttm_in_order(quarters(spark, d), BY)
    rows = growth.against_earlier(ttm, BY, "calculation_date", 12, measures)
    return rows.select("company_key", "calculation_date", "prior_calculation_date", *[e.alias(n) for n, e in growth.rates(measures).items()])


@query(
    "ttm_yoy_growth_nearest",
    f"""select c.company_key, c.calculation_date, p.calculation_date as prior_calculation_date,
      {_rate('c.ttm_revenue', 'p.ttm_revenue')} as ttm_revenue_growth_rate, {_rate('c.ttm_eps_diluted', 'p.ttm_eps_diluted')} as ttm_eps_diluted_growth_rate
      from (select *, cast(calculation_date - interval 1 year as date) as aim from v_ttm) c
      asof join v_ttm p on c.company_key = p.company_key and c.aim >= p.calculation_date""",
)
def ttm_yoy_growth_nearest(spark, d):
    measures = ["ttm_revenue", "ttm_eps_diluted"]
    ttm = trailing.ttm_in_order(quarters(spark, d), BY).select(*BY, "calculation_date", *measures)
    rows = growth.against_nearest(ttm, BY, "calculation_date", 12, measures)
    return rows.select("company_key", "calculation_date", "prior_calculation_date", *[e.alias(n) for n, e in growth.rates(measures).items()])


def _cagr(n: int) -> str:
    return f"""case when c.revenue > 0 and p{n}.revenue > 0 then round(pow(cast(c.revenue as double) / cast(p{n}.revenue as double),
      cast(1 as double) / {n}) - 1, 6) end as revenue_cagr_{n}y"""


@query(
    "cagr",
    f"""select c.company_key, c.period_type, c.fiscal_date, {_cagr(3)}, {_cagr(5)} from v_fact c
      left join v_fact p3 on c.company_key = p3.company_key and c.period_type = p3.period_type and cast(c.fiscal_date - interval 3 year as date) = p3.fiscal_date
      left join v_fact p5 on c.company_key = p5.company_key and c.period_type = p5.period_type and cast(c.fiscal_date - interval 5 year as date) = p5.fiscal_date""",
)
def cagr(spark, d):
    rows = growth.with_cagr(statements(spark, d).select(*BY, "period_type", "fiscal_date", "revenue"), [*BY, "period_type"], "fiscal_date", "revenue", [3, 5])
    return rows.drop("revenue")


_YOY = f"""select c.company_key, c.fiscal_date, {_rate('c.revenue', 'p.revenue')} as revenue_growth_rate,
  {_rate('c.operating_income', 'p.operating_income')} as operating_income_growth_rate,
  {_rate('c.gross_profit', 'p.gross_profit')} as gross_profit_growth_rate
  from v_fact c join v_fact p on c.company_key = p.company_key and c.period_type = p.period_type
    and cast(c.fiscal_date - interval 1 year as date) = p.fiscal_date where c.period <> 'FY'"""
_QUALITY = f"""select *, round(avg(revenue_growth_rate) over f, 6) as growth_moving_average,
  round(stddev_samp(revenue_growth_rate) over f, 6) as growth_consistency_score,
  revenue_growth_rate - lag(revenue_growth_rate) over w as growth_acceleration
  from ({_YOY}) window w as (partition by company_key order by fiscal_date),
    f as (partition by company_key order by fiscal_date rows between 3 preceding and current row)"""


def _quality(spark, d):
    measures = ["revenue", "operating_income", "gross_profit"]
    rows = growth.against_earlier(quarters(spark, d), [*BY, "period_type"], "fiscal_date", 12, measures)
    rates = growth.rates(measures)
    rows = rows.select(*BY, "fiscal_date", *[e.alias(n) for n, e in rates.items()])
    return growth.growth_quality(rows, BY, "fiscal_date", "revenue_growth_rate")


@query("growth_quality", _QUALITY)
def growth_quality(spark, d):
    return _quality(spark, d)


@query(
    "growth_screen",
    f"""select * from ({_QUALITY}) where revenue_growth_rate > 15 and operating_income_growth_rate > revenue_growth_rate
      and growth_consistency_score > 0.8""",
)
def growth_screen(spark, d):
    return growth_table.fast_growers(_quality(spark, d))


_FACT_MEASURES = list(growth.GROWTH_MEASURES)
_PER_SHARE = ("book_value_per_share", "revenue_per_share")


def _cells(cur: str, prior: str) -> str:
    return ", ".join(
        f"{_rate(f'{cur}.{m}', f'{prior}.{m}')} as {m}_growth_rate, cast({cur}.{m} as double) as {m}_current, cast({prior}.{m} as double) as {m}_prior"
        for m in _FACT_MEASURES
    )


_TTM_MEASURES = ", ".join(
    f"q.{m}" if m == "book_value_per_share"
    else "case when latest_shares_outstanding > 0 then cast(ttm_revenue as double) / cast(latest_shares_outstanding as double) end" if m in _PER_SHARE
    else f"t.latest_{m}" if m in ("total_assets", "total_equity") else f"t.ttm_{m}"
    for m in _FACT_MEASURES
)
_STEPS = ", ".join(f"('{kind}', {n}, {back})" for kind, periods in growth_table.PERIODS.items() for n, back in periods.items())
_GROWTH = f"""
with r as (
  select company_key, case when period = 'FY' then 'ANNUAL' else 'QUARTERLY' end as kind, fiscal_date, cast(accepted_date as date) as calculation_date, {", ".join(_FACT_MEASURES)} from v_ratio
  union all
  select t.company_key, 'TTM', t.newest_quarter_date, t.calculation_date, {_TTM_MEASURES}
  from v_ttm t join v_ratio q on q.company_key = t.company_key and q.fiscal_date = t.newest_quarter_date and q.period <> 'FY'),
placed as (select *, year(fiscal_date) * 4 + quarter(fiscal_date) as pos from r),
steps(kind, periods_back, back) as (values {_STEPS}),
g as (
  select c.company_key, c.calculation_date, c.kind as period_type, c.fiscal_date as current_period_date, p.fiscal_date as prior_period_date,
    cast(s.periods_back as int) as periods_back, {_cells('c', 'p')}
  from placed c join steps s on s.kind = c.kind join placed p on p.company_key = c.company_key and p.kind = c.kind and p.pos = c.pos - s.back),
fact as (
  select *, round(avg(revenue_growth_rate) over f, 6) as growth_moving_average, round(stddev_samp(revenue_growth_rate) over f, 6) as growth_consistency_score,
    revenue_growth_rate - lag(revenue_growth_rate) over w as growth_acceleration
  from g window w as (partition by company_key, period_type, periods_back order by current_period_date),
    f as (partition by company_key, period_type, periods_back order by current_period_date rows between 3 preceding and current row))
"""


def _growth_fact(spark, d):
    return growth_table.growth_fact(facts.ratios_fact(statements(spark, d)))


@query("growth_fact", _GROWTH + "select * from fact")
def growth_fact(spark, d):
    """Quarters, fiscal years and trailing years against one to five years before."""
    return plain(_growth_fact(spark, d))


@query(
    "growth_fast_years",
    _GROWTH + """select company_key, current_period_date, revenue_growth_rate, operating_income_growth_rate, growth_consistency_score from fact
      where period_type = 'TTM' and periods_back = 1 and revenue_growth_rate > 15 and operating_income_growth_rate > revenue_growth_rate and growth_consistency_score > 0.8""",
)
def growth_fast_years(spark, d):
    """Trailing years with fast growth and operating leverage."""
    rows = growth_table.fast_growers(_growth_fact(spark, d).where("period_type = 'TTM' and periods_back = 1"))
    return rows.select("company_key", "current_period_date", "revenue_growth_rate", "operating_income_growth_rate", "growth_consistency_score")


@query(
    "peg_ratio",
    f"""with g as (
      select c.company_key, c.accepted_date, c.newest_quarter_date, {_rate('c.ttm_eps_diluted', 'p.ttm_eps_diluted')} as eps_growth
      from v_ttm c join v_ttm p on c.company_key = p.company_key and cast(c.newest_quarter_date - interval 1 year as date) = p.newest_quarter_date)
    select m.company_key, m.price_date, m.pe_ratio_ttm, g.eps_growth,
      case when g.eps_growth > 0 then m.pe_ratio_ttm / g.eps_growth end as peg_ratio
    from v_metrics m join g on m.company_key = g.company_key and m.ttm_quarter_date = g.newest_quarter_date""",
)
def peg_ratio(spark, d):
    return growth_table.peg_ratios(samples.prices(spark, d).select(*BY, "price_date", "close_price"), filings(spark, d))


# ---- technicals --------------------------------------------------------------------------

_RETURNS = ", ".join(
    f"cast(close_price as double) / cast(nullif(lag(close_price, {n}) over w, 0) as double) - 1 as {name}"
    for name, n in technicals.RETURN_OFFSETS.items()
)
_SMAS = ", ".join(
    f"""cast(sum(close_price) over (partition by symbol order by price_date rows between {n - 1} preceding and current row) as double)
      / count(close_price) over (partition by symbol order by price_date rows between {n - 1} preceding and current row) as {name}"""
    for name, n in technicals.AVERAGE_SPANS.items()
)


@query("returns", f"select symbol, price_date, {_RETURNS} from v_prices window w as (partition by symbol order by price_date)")
def price_returns(spark, d):
    p = samples.prices(spark, d).select("symbol", "price_date", "close_price")
    return technicals.returns(p, ["symbol"], "price_date", "close_price", technicals.RETURN_OFFSETS).drop("close_price")


@query("sma", f"select symbol, price_date, {_SMAS} from v_prices")
def sma(spark, d):
    p = samples.prices(spark, d).select("symbol", "price_date", "close_price")
    return technicals.moving_averages(p, ["symbol"], "price_date", "close_price", technicals.AVERAGE_SPANS).drop("close_price")


@query(
    "equity_metrics_of_a_day",
    f"""select * from (select symbol, price_date, {_RETURNS}, {_SMAS} from v_prices window w as (partition by symbol order by price_date))
      where price_date = (select max(price_date) from v_prices)""",
)
def equity_metrics_of_a_day(spark, d):
    """Returns and averages of the newest day, from whole histories."""
    p = samples.prices(spark, d).select("symbol", "price_date", "close_price")
    rows = technicals.latest_day(technicals.daily_equity_metrics(p), p.agg(F.max("price_date")).scalar())
    return plain(rows.drop("close_price", "volatility_20d"))


@query(
    "daily_equity_metrics",
    f"""select *, round(stddev_samp(return_1d) over (partition by symbol order by price_date rows between 19 preceding and current row) * sqrt(252.0), 6) as volatility_20d
      from (select symbol, price_date, cast(close_price as double) as close_price, {_RETURNS}, {_SMAS}
            from v_prices window w as (partition by symbol order by price_date))""",
)
def daily_equity_metrics(spark, d):
    return plain(technicals.daily_equity_metrics(samples.prices(spark, d).select("symbol", "price_date", "close_price")))


_RETURN1 = """select symbol, price_date, cast(close_price as double) / cast(nullif(lag(close_price) over (partition by symbol order by price_date), 0) as double) - 1 as return_1d
  from v_prices"""


@query(
    "volatility_calendar",
    f"""select symbol, price_date, round(stddev_samp(return_1d) over (partition by symbol order by price_date
      range between interval 29 day preceding and current row) * sqrt(252.0), 6) as volatility from ({_RETURN1})""",
)
def volatility_calendar(spark, d):
    p = samples.prices(spark, d).select("symbol", "price_date", "close_price")
    r = technicals.returns(p, ["symbol"], "price_date", "close_price", {"return_1d": 1})
    return volatility(r, ["symbol"], "price_date", "return_1d", days=30).select("symbol", "price_date", "volatility")


@query(
    "trailing_volatility",
    """select symbol, max(price_date) as date, round(stddev_samp(r) * sqrt(252.0), 6) as volatility_20d from (
      select symbol, price_date, cast(close_price as double) / cast(nullif(lag(close_price) over (partition by symbol order by price_date), 0) as double) - 1 as r
      from v_prices where price_date between date '1998-06-30' - 30 and date '1998-06-30') where r is not null group by symbol""",
)
def trailing_volatility(spark, d):
    return technicals.trailing_volatility(samples.prices(spark, d), F.lit("1998-06-30").cast("date"))


@query(
    "option_daily",
    """select symbol, date, cast(sum(cast(implied_volatility as decimal(28,6))) as double) / count(implied_volatility) as avg_implied_vol, cast(sum(volume) as bigint) as total_volume,
      cast(sum(open_interest) as bigint) as total_open_interest from v_options group by symbol, date""",
)
def option_daily(spark, d):
    return options.daily_chain(samples.options(spark, d))


@query(
    "option_metrics",
    """select *, case when total_put_volume > 0 then cast(total_call_volume as double) / cast(total_put_volume as double) end as call_put_ratio,
      round(avg_put_iv - avg_call_iv, 6) as put_call_skew from (
      select symbol, date, cast(coalesce(sum(volume) filter (option_type = 'CALL'), 0) as bigint) as total_call_volume,
        cast(coalesce(sum(volume) filter (option_type = 'PUT'), 0) as bigint) as total_put_volume,
        cast(sum(cast(implied_volatility as decimal(28,6))) filter (option_type = 'CALL') as double) / nullif(count(*) filter (option_type = 'CALL'), 0) as avg_call_iv,
        cast(sum(cast(implied_volatility as decimal(28,6))) filter (option_type = 'PUT') as double) / nullif(count(*) filter (option_type = 'PUT'), 0) as avg_put_iv,
        cast(sum(open_interest) as bigint) as total_open_interest from v_options group by symbol, date)""",
)
def option_metrics(spark, d):
    return options.chain_metrics(samples.options(spark, d))


@query(
    "option_daily_merge",
    """select symbol, date, cast(sum(cast(implied_volatility as decimal(28,6))) as double) / count(implied_volatility) as avg_implied_vol, cast(sum(volume) as bigint) as total_volume,
      cast(sum(open_interest) as bigint) as total_open_interest from v_options group by symbol, date""",
)
def option_daily_merge(spark, d):
    """Days up to one are stored, from incomplete quotes on the last of them; the load of that
    day and later ones corrects and extends them."""
    quotes = samples.options(spark, d)
    stored = options.daily_chain(quotes.where("date < '2024-01-15' or (date = '2024-01-15' and option_type = 'CALL')"))
    load = options.daily_chain(quotes.where("date >= '2024-01-15'"))
    return keyed.upsert(stored, load, ["symbol", "date"])


@query(
    "iv_percent_rank",
    """select *, percent_rank() over (partition by symbol order by avg_implied_vol) as iv_rank from (
      select symbol, date, cast(sum(cast(implied_volatility as decimal(28,6))) as double) / count(implied_volatility) as avg_implied_vol, cast(sum(volume) as bigint) as total_volume,
        cast(sum(open_interest) as bigint) as total_open_interest from v_options group by symbol, date)""",
)
def iv_percent_rank(spark, d):
    return options.volatility_rank(options.daily_chain(samples.options(spark, d)))


