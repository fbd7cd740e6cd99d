"""The sample views of ``tickerloom.sources.samples`` as DuckDB SQL."""

from tickerloom.operators.trailing import FLOWS, STOCKS
from tickerloom.schemas import BALANCE_MEASURES, CASH_MEASURES, INCOME_MEASURES

_AGG = (
    "cast(sum(p) as decimal(20,2)) as sp, cast(sum(p*disc) as decimal(24,4)) as sd,"
    " cast(sum(p*tax) as decimal(24,4)) as st, cast(sum(q) as bigint) as sq, count(*) as n"
)
_HEAD = (
    "company_key, symbol, fiscal_date, period, cast(fiscal_date + 35 as date) as filing_date,"
    " cast(fiscal_date + 35 as timestamp) + interval 965 minute as accepted_date"
)
_FRAME = "over (partition by company_key order by fiscal_date rows between 3 preceding and current row)"

VIEWS = {
    "v_company": """
select s_suppkey as company_key, 'S' || lpad(cast(s_suppkey as varchar), 6, '0') as symbol,
  s_name as company_name, r_name as sector, n_name as industry,
  case when s_suppkey % 2 = 0 then 'NASDAQ' else 'NYSE' end as exchange,
  cast(s_acctbal as decimal(12,2)) * cast(30000000 as decimal(9,0)) as market_cap,
  case when s_suppkey % 7 <> 0 then s_name end as headquarters_city,
  cast(null as varchar) as headquarters_state, n_name as headquarters_country
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "v_line": """
select l_suppkey as company_key, 'S' || lpad(cast(l_suppkey as varchar), 6, '0') as symbol,
  cast(l_shipdate as date) as d, l_orderkey as ok, l_linenumber as ln,
  cast(l_extendedprice as decimal(12,2)) as p, cast(l_discount as decimal(4,2)) as disc,
  cast(l_tax as decimal(4,2)) as tax, cast(l_quantity as bigint) as q
from lineitem""",
    "v_prices": """
select company_key, symbol, d as price_date, arg_min(p, {'a': ok, 'b': ln, 'c': p}) as open_price,
  max(p) as high_price, min(p) as low_price, arg_max(p, {'a': ok, 'b': ln, 'c': p}) as close_price,
  cast(sum(q) as bigint) as volume
from v_line group by company_key, symbol, d""",
    "v_period": f"""
select company_key, symbol, last_day(make_date(cast(year(d) as int), cast(quarter(d) * 3 as int), 1)) as fiscal_date,
  'Q' || cast(quarter(d) as varchar) as period, {_AGG} from v_line group by 1, 2, 3, 4
union all
select company_key, symbol, make_date(cast(year(d) as int), 12, 31) as fiscal_date, 'FY' as period, {_AGG}
from v_line group by 1, 2, 3, 4""",
    "v_income": f"""
select {_HEAD}, sp as revenue, sd as cost_of_revenue, sp - sd as gross_profit, st as operating_expenses,
  sp - sd - st as operating_income, sp - sd - st - sq * 100 as net_income,
  n * cast('0.05' as decimal(3,2)) as eps, n * cast('0.04' as decimal(3,2)) as eps_diluted,
  sq * 1000 as shares_outstanding
from v_period""",
    "v_balance": f"""
select {_HEAD}, sp * 3 as total_assets, sp as current_assets, sp + sd * 2 as total_liabilities,
  sd as current_liabilities,
  sp * 2 - sd * 2 + case when company_key % 17 = 0 then 1 else 0 end as total_equity,
  st as cash_and_equivalents, sd * 2 as total_debt, sd * 2 - st as net_debt
from v_period where (company_key + month(fiscal_date)) % 11 <> 0""",
    "v_cash": f"""
select {_HEAD}, sp - sd as operating_cash_flow, -st as investing_cash_flow, -sd as financing_cash_flow,
  sp - sd - st as free_cash_flow, -st as capital_expenditures,
  case when company_key % 4 = 0 then cast(0 as decimal(24,4)) else -sd end as dividends_paid
from v_period where (company_key + month(fiscal_date)) % 13 <> 0""",
    "v_fact": f"""
select i.company_key, i.symbol, i.fiscal_date, i.period, i.period as period_type, i.filing_date, i.accepted_date,
  {', '.join('i.' + c for c in INCOME_MEASURES)}, {', '.join('b.' + c for c in BALANCE_MEASURES)},
  {', '.join('c.' + c for c in CASH_MEASURES)}
from v_income i left join v_balance b using (company_key, fiscal_date, period)
left join v_cash c using (company_key, fiscal_date, period)""",
    "v_ratio": """
select *,
  case when revenue > 0 then cast(coalesce(gross_profit, 0) as double) / cast(revenue as double) * 100 end as gross_margin,
  case when revenue > 0 then cast(coalesce(operating_income, 0) as double) / cast(revenue as double) * 100 end as operating_margin,
  case when revenue > 0 then cast(coalesce(net_income, 0) as double) / cast(revenue as double) * 100 end as profit_margin,
  case when total_equity > 0 then cast(coalesce(net_income, 0) as double) / cast(total_equity as double) * 100 end as roe,
  case when total_assets > 0 then cast(coalesce(net_income, 0) as double) / cast(total_assets as double) * 100 end as roa,
  case when current_liabilities > 0 then cast(coalesce(current_assets, 0) as double) / cast(current_liabilities as double) end as current_ratio,
  case when current_liabilities > 0 then cast(coalesce(current_assets, 0) as double) / cast(current_liabilities as double) end as quick_ratio,
  case when total_equity > 0 then cast(coalesce(total_debt, 0) as double) / cast(total_equity as double) end as debt_to_equity,
  case when total_assets > 0 then cast(coalesce(total_debt, 0) as double) / cast(total_assets as double) end as debt_to_assets,
  case when revenue > 0 and total_assets > 0 then cast(revenue as double) / cast(total_assets as double) end as asset_turnover,
  case when total_equity > 0 and shares_outstanding > 0 then cast(total_equity as double) / cast(shares_outstanding as double) end as book_value_per_share,
  case when revenue > 0 and shares_outstanding > 0 then cast(revenue as double) / cast(shares_outstanding as double) end as revenue_per_share
from v_fact""",
    "v_ttm": f"""
select * from (
  select company_key, symbol, cast(accepted_date as date) as calculation_date, accepted_date,
    cast(count(*) {_FRAME} as int) as quarters_included, min(fiscal_date) {_FRAME} as oldest_quarter_date,
    fiscal_date as newest_quarter_date,
    {', '.join(f'sum({c}) {_FRAME} as ttm_{c}' for c in FLOWS)},
    {', '.join(f'{c} as latest_{c}' for c in STOCKS)}
  from v_fact where period <> 'FY')
where quarters_included = 4 and oldest_quarter_date > cast(calculation_date - interval 15 month as date)""",
    "v_metrics": """
with joined as (
  select p.*, q.accepted_date as q_accepted, q.fiscal_date as filing_fiscal_date, q.period_type, q.eps_diluted,
    q.book_value_per_share, q.revenue_per_share, q.shares_outstanding, q.total_debt, q.cash_and_equivalents
  from v_prices p asof left join (select * from v_ratio where period <> 'FY') q
    on p.company_key = q.company_key and cast(p.price_date as timestamp) >= q.accepted_date),
both_sides as (
  select j.*, t.accepted_date as t_accepted, t.newest_quarter_date as ttm_quarter_date, t.ttm_revenue, t.ttm_net_income,
    t.ttm_eps_diluted, t.ttm_operating_income, t.ttm_dividends_paid,
    coalesce(nullif(t.latest_shares_outstanding, 0), nullif(j.shares_outstanding, 0), 0) as shares,
    coalesce(nullif(t.latest_total_debt, 0), nullif(j.total_debt, 0), 0) as debt,
    coalesce(nullif(t.latest_cash_and_equivalents, 0), nullif(j.cash_and_equivalents, 0), 0) as cash
  from joined j asof left join v_ttm t
    on j.company_key = t.company_key and cast(j.price_date as timestamp) >= t.accepted_date),
sized as (
  select *, case when close_price > 0 and shares > 0 then close_price * shares end as market_cap,
    case when close_price > 0 and shares > 0 then close_price * shares + debt - cash end as enterprise_value
  from both_sides where q_accepted is not null or t_accepted is not null)
select company_key, symbol, price_date, open_price, high_price, low_price, close_price, volume,
  coalesce(upper(period_type), 'TTM') as fiscal_period, filing_fiscal_date, ttm_quarter_date,
  cast(market_cap as double) as market_cap, cast(enterprise_value as double) as enterprise_value,
  case when eps_diluted > 0 then cast(close_price as double) / cast(eps_diluted as double) end as pe_ratio,
  case when ttm_eps_diluted > 0 then cast(close_price as double) / cast(ttm_eps_diluted as double) end as pe_ratio_ttm,
  case when book_value_per_share > 0 then cast(close_price as double) / book_value_per_share end as pb_ratio,
  case when revenue_per_share > 0 then cast(close_price as double) / revenue_per_share end as ps_ratio,
  case when ttm_revenue > 0 and shares > 0
    then cast(close_price as double) / (cast(ttm_revenue as double) / cast(shares as double)) end as ps_ratio_ttm,
  case when enterprise_value > 0 and revenue_per_share > 0 and shares > 0
    then cast(enterprise_value as double) / (revenue_per_share * cast(shares as double)) end as ev_to_revenue,
  case when enterprise_value > 0 and ttm_revenue > 0
    then cast(enterprise_value as double) / cast(ttm_revenue as double) end as ev_to_revenue_ttm,
  case when enterprise_value > 0 and ttm_operating_income > 0
    then cast(enterprise_value as double) / cast(ttm_operating_income as double) end as ev_to_ebitda,
  case when enterprise_value > 0 and ttm_operating_income > 0
    then cast(enterprise_value as double) / cast(ttm_operating_income as double) end as ev_to_ebit,
  case when close_price > 0 and shares > 0 and ttm_dividends_paid < 0
    then cast(abs(ttm_dividends_paid) as double) / cast(shares as double) / cast(close_price as double) * 100 end as dividend_yield,
  case when ttm_net_income > 0 and ttm_dividends_paid < 0
    then cast(abs(ttm_dividends_paid) as double) / cast(ttm_net_income as double) * 100 end as payout_ratio
from sized""",
    "v_jobs": """
select cast(event_id as varchar) as job_id, event_type as job_name,
  case when event_id % 10 = 0 then 'FAILED' when event_id % 10 = 1 then 'PARTIAL' else 'SUCCESS' end as status,
  ts as start_time, ts + to_microseconds(cast(cast(value as decimal(20,2)) * 1000000 as bigint)) as end_time,
  cast(value as decimal(20,2)) as duration_seconds, event_id % 1000 as records_loaded,
  case when event_id % 10 <= 1 then 1 else 0 end as error_count, user_id as symbols_processed
from events""",
    "v_errors": """
select event_id as error_id, cast(event_id as varchar) as job_id, event_type as job_name, ts as error_timestamp,
  'ETL_ERROR' as error_type, 'failed with code ' || cast(user_id % 5 as varchar) as error_message
from events where event_id % 10 <= 1""",
    "v_options": """
select user_id as symbol, cast(ts as date) as date, case when event_type = 'click' then 'CALL' else 'PUT' end as option_type,
  value as implied_volatility, event_id % 100 as volume, event_id % 1000 as open_interest
from events where event_type in ('click', 'view')""",
}
