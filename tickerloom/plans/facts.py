"""Facts derived from staging tables and dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arith import dbl, nz, ratio
from ..functions.dates import is_quarter
from ..functions.ratios import fundamental_ratios, statement_view_ratios
from ..functions.valuation import METRICS, with_valuation
from ..operators.asof import asof_join, carried_forward, intervals, one_timeline
from ..operators.keyed import latest, not_in
from ..operators.series import price_change
from ..operators.trailing import ttm_as_known
from ..schemas import BALANCE_MEASURES, CASH_MEASURES, INCOME_MEASURES

STATEMENT_KEYS = ["symbol", "fiscal_date", "period"]
# columns of the two event streams that valuation reads
FILING_COLUMNS = (
    "period_type", "eps_diluted", "shares_outstanding", "total_debt", "cash_and_equivalents",
    "revenue_per_share", "book_value_per_share",
)
TTM_COLUMNS = (
    "ttm_revenue", "ttm_net_income", "ttm_eps_diluted", "ttm_operating_income",
    "ttm_dividends_paid", "latest_shares_outstanding", "latest_total_debt",
    "latest_cash_and_equivalents",
)


def with_predecessor(
    prices: DataFrame, by: Sequence[str], day: str, start, recent_days: int = 31,
    part: tuple[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """The rows from ``start`` on, and for each of their entities the last row before it.

    Predecessors are looked for in the ``recent_days`` before ``start`` first. Older rows are
    read only for entities that have none there; when there are no such entities, the
    adaptive planner drops that scan. ``part`` has the partition column, if the table has
    one, and how it follows from a date, so that both reads are pruned.
    """
    start = F.lit(start).cast("date")
    recent_from = F.date_sub(start, recent_days)

    def span(low: Column | None, high: Column | None) -> DataFrame:
        df = prices
        if low is not None:
            df = df.where(F.col(day) >= low)
            df = df.where(F.col(part[0]) >= part[1](low)) if part else df
        if high is not None:
            df = df.where(F.col(day) < high)
            df = df.where(F.col(part[0]) <= part[1](high)) if part else df
        return df

    by = list(by)
    loaded = span(start, None)
    entities = loaded.select(*by).distinct()
    near = latest(span(recent_from, start).join(entities, by, "left_semi"), by, [F.desc(day)])
    lacking = entities.join(near, by, "left_anti")
    far = latest(span(None, recent_from).join(lacking, by, "left_semi"), by, [F.desc(day)])
    return loaded.unionByName(near).unionByName(far)


def daily_prices_fact(
    prices: DataFrame, companies: DataFrame, dates: DataFrame, start=None,
    part: tuple[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Price rows with keys and the change against the previous stored day.

    With ``start`` only the rows from then on are made, each entity's first one against its
    predecessor. The dimensions join without a hint: the planner broadcasts them while
    they are small and sort-merges beyond that.
    """
    if start is not None:
        prices = with_predecessor(prices, ["symbol"], "price_date", start, part=part)
    cols = ["symbol", "price_date", "open_price", "high_price", "low_price", "close_price", "adj_close", "volume"]
    changed = price_change(prices.select(*cols), ["symbol"], ["price_date"], "close_price")
    if start is not None:
        changed = changed.where(F.col("price_date") >= F.lit(start))
    return (
        changed.join(companies.select("symbol", "company_key"), "symbol")
        .join(dates.select(F.col("date").alias("price_date"), "date_key"), "price_date")
        .select(
            "company_key", "date_key", "open_price", "high_price", "low_price", "close_price",
            "adj_close", "volume", "change_amount", "change_percent",
        )
    )


def combined_statements(income: DataFrame, balance: DataFrame, cash: DataFrame) -> DataFrame:
    """One row per income statement with the balance and cash measures of its period."""

    def side(df: DataFrame, measures: Sequence[str], tag: str) -> DataFrame:
        return df.select(
            *STATEMENT_KEYS,
            F.col("filing_date").alias(f"_{tag}_filed"),
            F.col("accepted_date").alias(f"_{tag}_accepted"),
            *measures,
        )

    joined = (
        side(income, INCOME_MEASURES, "i")
        .join(side(balance, BALANCE_MEASURES, "b"), STATEMENT_KEYS, "left")
        .join(side(cash, CASH_MEASURES, "c"), STATEMENT_KEYS, "left")
    )
    return joined.select(
        *STATEMENT_KEYS,
        F.coalesce("_i_filed", "_b_filed", "_c_filed").alias("filing_date"),
        F.coalesce("_i_accepted", "_b_accepted", "_c_accepted").alias("accepted_date"),
        *INCOME_MEASURES,
        *BALANCE_MEASURES,
        *CASH_MEASURES,
    )


def financials_fact(
    companies: DataFrame,
    income: DataFrame,
    balance: DataFrame,
    cash: DataFrame,
    dates: DataFrame,
    start=None,
) -> DataFrame:
    """Integrated statements with company and date keys.

    The fiscal date must be in the calendar; the filing date may be missing there. The
    calendar plays both roles.
    """
    rows = combined_statements(income, balance, cash).where(F.col("fiscal_date").isNotNull())
    if start is not None:
        rows = rows.where(F.col("fiscal_date") >= F.lit(start))
    fiscal = dates.select(F.col("date").alias("fiscal_date"), F.col("date_key").alias("fiscal_date_key"))
    filing = dates.select(F.col("date").alias("filing_date"), F.col("date_key").alias("filing_date_key"))
    return (
        rows.join(companies.select("symbol", "company_key"), "symbol")
        .join(fiscal, "fiscal_date")
        .join(filing, "filing_date", "left")
        .select(
            F.xxhash64("company_key", "fiscal_date", "period").alias("financial_key"),
            "company_key", "symbol", "fiscal_date", "fiscal_date_key", "filing_date_key",
            "accepted_date",
            F.col("period").alias("period_type"),
            *INCOME_MEASURES, *BALANCE_MEASURES, *CASH_MEASURES,
        )
    )


def quarters_of(facts: DataFrame, period: str = "period_type") -> DataFrame:
    return facts.where(is_quarter(period))


def ratios_fact(facts: DataFrame, places: int | None = None) -> DataFrame:
    """Twelve ratios per integrated statement row, next to its keys."""
    return facts.withColumns(fundamental_ratios(places))


def staging_ratios(income: DataFrame, balance: DataFrame) -> DataFrame:
    """Ratios of the periods that have both statements."""
    b = balance.select(
        *STATEMENT_KEYS, "total_equity", "total_assets", "total_debt", "current_assets",
        "current_liabilities",
    )
    exprs = statement_view_ratios()
    return income.join(b, STATEMENT_KEYS).select(
        *STATEMENT_KEYS, *[e.alias(n) for n, e in exprs.items()]
    )


def known_valuation_inputs(
    filings: DataFrame, ttm: DataFrame | None, by: Sequence[str], at: str = "known_from", carry: Sequence[str] = ()
) -> DataFrame:
    """Per entity and acceptance time the newest quarter and trailing year known then.

    Without ``ttm`` the filings carry their trailing year themselves (``with_ttm``). ``carry``
    names further columns of the trailing year.
    """
    by = list(by)
    quarter = ["accepted_date", "fiscal_date", *FILING_COLUMNS]
    year = ["newest_quarter_date", *TTM_COLUMNS, *carry]
    if ttm is None:
        once = intervals(filings, by, "accepted_date", ["fiscal_date"], "_end")
        year_struct = F.when(
            F.col("ttm").isNotNull(), F.struct(*[F.col(f"ttm.{c}").alias(c) for c in year])
        )
        events = once.select(
            *by,
            F.col("accepted_date").alias(at),
            F.struct(*quarter).alias("filing"),
            year_struct.alias("ttm"),
        )
    else:
        events = one_timeline(
            {
                "filing": (filings.select(*by, *quarter), "accepted_date", ["fiscal_date"]),
                "ttm": (ttm.select(*by, "accepted_date", *year), "accepted_date", ["newest_quarter_date"]),
            },
            by,
            at,
        )
    return carried_forward(events, by, at, ["filing", "ttm"])


def market_metrics(
    prices: DataFrame,
    filings: DataFrame,
    ttm: DataFrame | None = None,
    by: Sequence[str] = ("company_key",),
    day: str = "price_date",
    places: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Valuation of every price by the newest quarter and trailing year known that day.

    ``filings`` are quarterly rows with their ratios. What is known is laid on one
    timeline, so the prices take part in a single as-of join. A filing accepted during a
    day counts from the next day. Prices before any filing are dropped. ``carry`` names further
    columns of the trailing year to return.
    """
    state = known_valuation_inputs(filings, ttm, by, carry=carry)
    known = asof_join(prices, state, list(by), day, "known_from", how="inner")
    return with_valuation(known, places).select(
        *prices.columns,
        "fiscal_period",
        F.col("filing.fiscal_date").alias("filing_fiscal_date"),
        F.col("ttm.newest_quarter_date").alias("ttm_quarter_date"),
        *METRICS,
        *[F.col(f"ttm.{c}").alias(c) for c in carry],
    )


def not_yet_computed(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold yet: the increment to compute and append."""
    return not_in(rows, stored.select(*keys), list(keys))


def ttm_per_price(
    prices: DataFrame, quarters: DataFrame, by: Sequence[str] = ("company_key",), day: str = "price_date"
) -> DataFrame:
    """Trailing sums as they would be taken on each price day itself.

    What is known changes only when a filing is accepted, so the sums are formed once per
    filing day and the prices look them up.
    """
    by = list(by)
    sums = ttm_as_known(quarters, by).select(
        *by,
        F.col("accepted_date").alias("known_from"),
        "quarters_included",
        "ttm_revenue",
        "ttm_net_income",
        "ttm_operating_income",
        "ttm_operating_cash_flow",
        "ttm_dividends_paid",
        "latest_total_equity",
        "latest_total_assets",
        "latest_total_debt",
        "latest_shares_outstanding",
    )
    return asof_join(prices, sums, by, day, "known_from", how="inner")


def annual_metrics(
    prices: DataFrame, annual: DataFrame, ttm: DataFrame, by: Sequence[str] = ("company_key",), day: str = "price_date"
) -> DataFrame:
    """Earlier valuation basis: full-year statements, earnings per share as income over
    shares, and enterprise value without the cash deduction. Years and trailing years are laid on
    one timeline, so the prices take part in a single join."""
    by = list(by)
    of_year = ("revenue", "net_income", "total_equity", "total_debt", "shares_outstanding")
    of_ttm = ("ttm_revenue", "ttm_net_income", "ttm_operating_income", "ttm_dividends_paid", "latest_shares_outstanding")
    events = one_timeline(
        {
            "year": (annual.select(*by, "accepted_date", "fiscal_date", *of_year), "accepted_date", ["fiscal_date"]),
            "ttm": (ttm.select(*by, "accepted_date", "newest_quarter_date", *of_ttm), "accepted_date", ["newest_quarter_date"]),
        },
        by,
        "known_from",
    )
    state = carried_forward(events, by, "known_from", ["year", "ttm"])
    known = asof_join(prices, state, by, day, "known_from", how="inner")
    rows = known.select(*prices.columns, *[F.col(f"year.{c}").alias(f"fy_{c}") for c in of_year], *[F.col(f"ttm.{c}").alias(c) for c in of_ttm])
    close, shares = F.col("close_price"), F.coalesce("fy_shares_outstanding", "latest_shares_outstanding")
    rows = rows.withColumn("market_cap", F.when((close > 0) & (shares > 0), close * shares))
    rows = rows.withColumn("enterprise_value", F.col("market_cap") + nz("fy_total_debt"))

    def per_share(c: str, s: Column) -> Column:
        return F.when((F.col(c) > 0) & (s > 0), dbl(c) / dbl(s))

    ttm_shares = F.col("latest_shares_outstanding")
    return rows.select(
        *prices.columns,
        "market_cap",
        "enterprise_value",
        ratio(close, per_share("fy_net_income", shares)).alias("pe_ratio"),
        ratio(close, per_share("ttm_net_income", ttm_shares)).alias("pe_ratio_ttm"),
        ratio(close, per_share("fy_total_equity", shares)).alias("pb_ratio"),
        ratio(close, per_share("fy_revenue", shares)).alias("ps_ratio"),
        ratio("enterprise_value", "fy_revenue").alias("ev_to_revenue"),
        ratio("enterprise_value", "ttm_operating_income").alias("ev_to_ebit"),
    )
