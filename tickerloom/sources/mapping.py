"""Payload records to typed staging rows and to raw history rows.

A mapping is a dict of output column to expression, so a new feed is a new dict. A value
that is present but cannot be read makes the record a reject instead of a silent NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.arith import blank
from ..operators.keyed import latest
from ..schemas import MONEY, PRICE, RATE, STAGING, STAGING_KEYS
from .landing import REFUSED

# Source tag of a raw row and the payload's date formats.
API_SOURCE = "FMP"
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def as_date(c: str) -> Column:
    return F.try_to_date(F.col(c), DATE_FORMAT)


def as_time(c: str) -> Column:
    return F.try_to_timestamp(F.col(c), F.lit(TIME_FORMAT)).cast("timestamp_ntz")


def number(c: str, kind: str = MONEY) -> Column:
    return F.col(c).try_cast(kind)


def whole(c: str) -> Column:
    """Integer from text that may carry a decimal point."""
    return F.col(c).try_cast("decimal(38,6)").try_cast("bigint")


#: A measure's kind when it is read by ``whole``.
WHOLE = "whole"


def unreadable(field: str, kind: str) -> Column:
    """The field is there, but isn't a number of its kind or is too large for it."""
    return ~blank(field) & (whole(field) if kind == WHOLE else number(field, kind)).isNull()


def or_else(first: str, second: str, kind: str = MONEY) -> Column:
    """The first measure unless it is missing or zero."""
    return F.coalesce(F.nullif(number(first, kind), F.lit(0)), number(second, kind))


def _statement(measures: dict[str, Column]) -> dict[str, Column]:
    return {
        "symbol": F.col("symbol"),
        "fiscal_date": as_date("date"),
        "period": F.coalesce("period", F.lit("FY")),
        "filing_date": as_date("filingDate"),
        "accepted_date": as_time("acceptedDate"),
        **measures,
    }


def profile_columns() -> dict[str, Column]:
    return {
        "symbol": F.col("symbol"),
        "company_name": F.col("companyName"),
        "sector": F.col("sector"),
        "industry": F.col("industry"),
        "exchange": F.col("exchange"),
        "market_cap": number("marketCap"),
        "description": F.col("description"),
        "website": F.col("website"),
        "ceo": F.col("ceo"),
        "employees": F.nullif(whole("fullTimeEmployees"), F.lit(0)),
        "headquarters_city": F.col("city"),
        "headquarters_state": F.col("state"),
        "headquarters_country": F.col("country"),
    }


def price_columns() -> dict[str, Column]:
    def or_zero(c: str) -> Column:
        return F.when(F.col(c).isNull(), F.lit(0).cast(PRICE)).otherwise(number(c, PRICE))

    return {
        "symbol": F.col("symbol"),
        "price_date": as_date("date"),
        "open_price": or_zero("open"),
        "high_price": or_zero("high"),
        "low_price": or_zero("low"),
        "close_price": or_zero("close"),
        "adj_close": F.when(F.col("adjClose").isNull(), or_zero("close")).otherwise(
            number("adjClose", PRICE)
        ),
        "volume": F.when(F.col("volume").isNull(), F.lit(0).cast("bigint")).otherwise(whole("volume")),
        "change_percent": number("changePercent", RATE),
    }


def income_columns() -> dict[str, Column]:
    return _statement(
        {
            "revenue": number("revenue"),
            "cost_of_revenue": number("costOfRevenue"),
            "gross_profit": number("grossProfit"),
            "operating_expenses": number("operatingExpenses"),
            "operating_income": number("operatingIncome"),
            "net_income": number("netIncome"),
            "eps": number("eps", RATE),
            "eps_diluted": number("epsDiluted", RATE),
            "shares_outstanding": whole("weightedAverageShsOut"),
            "shares_outstanding_diluted": whole("weightedAverageShsOutDil"),
        }
    )


def balance_columns() -> dict[str, Column]:
    return _statement(
        {
            "total_assets": number("totalAssets"),
            "current_assets": number("totalCurrentAssets"),
            "total_liabilities": number("totalLiabilities"),
            "current_liabilities": number("totalCurrentLiabilities"),
            "total_equity": or_else("totalEquity", "totalStockholdersEquity"),
            "cash_and_equivalents": number("cashAndCashEquivalents"),
            "total_debt": number("totalDebt"),
            "net_debt": number("netDebt"),
        }
    )


def cashflow_columns() -> dict[str, Column]:
    return _statement(
        {
            "operating_cash_flow": number("operatingCashFlow"),
            "investing_cash_flow": number("netCashProvidedByInvestingActivities"),
            "financing_cash_flow": number("netCashProvidedByFinancingActivities"),
            "free_cash_flow": number("freeCashFlow"),
            "capital_expenditures": number("capitalExpenditure"),
            "dividends_paid": or_else("commonDividendsPaid", "netDividendsPaid"),
        }
    )


def option_columns() -> dict[str, Column]:
    return {
        "symbol": F.col("symbol"),
        "expiration_date": as_date("expirationDate"),
        "strike_price": F.col("strike"),
        "option_type": F.upper("optionType"),
        "contract_symbol": F.col("contractSymbol"),
        "last_price": F.col("lastPrice"),
        "bid": F.col("bid"),
        "ask": F.col("ask"),
        "volume": F.col("volume"),
        "open_interest": F.col("openInterest"),
        "implied_volatility": F.col("impliedVolatility"),
        "in_the_money": F.col("inTheMoney"),
        "last_trade_date": as_time("lastTradeDate"),
    }


# feed -> (columns, keys a record must have, payload field -> staged column that must be
# readable whenever the field is present)
MAPPINGS: dict[str, tuple[Callable[[], dict[str, Column]], Sequence[str], dict[str, str]]] = {
    "profile": (profile_columns, ["symbol"], {}),
    "price": (price_columns, ["symbol", "date"], {"date": "price_date"}),
    "income": (income_columns, ["symbol", "date"], {}),
    "balance": (balance_columns, ["symbol", "date"], {}),
    "cashflow": (cashflow_columns, ["symbol", "date"], {}),
    "option": (option_columns, ["symbol", "contractSymbol"], {"expirationDate": "expiration_date"}),
}
_STATEMENT_READABLE = {
    "date": "fiscal_date",
    "filingDate": "filing_date",
    "acceptedDate": "accepted_date",
}
# feed -> payload measure and the kind of number that it must be if it is present
MEASURES: dict[str, dict[str, str]] = {
    "profile": {"marketCap": MONEY, "fullTimeEmployees": WHOLE},
    "price": {
        **dict.fromkeys(("open", "high", "low", "close", "adjClose"), PRICE), "volume": WHOLE, "changePercent": RATE,
    },
    "income": {
        **dict.fromkeys(
            ("revenue", "costOfRevenue", "grossProfit", "operatingExpenses", "operatingIncome", "netIncome"), MONEY
        ),
        "eps": RATE, "epsDiluted": RATE, "weightedAverageShsOut": WHOLE, "weightedAverageShsOutDil": WHOLE,
    },
    "balance": dict.fromkeys(
        ("totalAssets", "totalCurrentAssets", "totalLiabilities", "totalCurrentLiabilities", "totalEquity",
         "totalStockholdersEquity", "cashAndCashEquivalents", "totalDebt", "netDebt"), MONEY,
    ),
    "cashflow": dict.fromkeys(
        ("operatingCashFlow", "netCashProvidedByInvestingActivities", "netCashProvidedByFinancingActivities",
         "freeCashFlow", "capitalExpenditure", "commonDividendsPaid", "netDividendsPaid"), MONEY,
    ),
}


def map_feed(
    records: DataFrame, feed: str, loaded_at: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw rows, staging rows and rejects of one feed.

    All three are projections of ``records``; nothing is shuffled.
    """
    judged = judged_records(records, feed, loaded_at)
    staged = judged.where(F.col(REJECT).isNull()).drop(REJECT)
    return raw_rows(staged, feed), staged, judged.where(F.col(REJECT).isNotNull()).select(f"{REJECT}.*")


#: What is wrong with a record that cannot be mapped.
REJECT = "_reject"


def judged_records(records: DataFrame, feed: str, loaded_at: Column) -> DataFrame:
    """One staging row for each record, with its reject (feed, symbol, reason, the record as JSON)
    in ``_reject`` if it cannot be mapped or was refused before (``landing.read_judged``)."""
    if feed not in MAPPINGS:
        raise ValueError(f"Unknown data type: {feed}")
    columns, required, readable = MAPPINGS[feed]
    if feed in ("income", "balance", "cashflow"):
        readable = _STATEMENT_READABLE
    typed = records.withColumns({f"_{name}": e for name, e in columns().items()})

    reason = F.lit(None).cast("string")
    for field, kind in reversed(list(MEASURES.get(feed, {}).items())):
        reason = F.when(unreadable(field, kind), f"unreadable {field}").otherwise(reason)
    for field, staged in reversed(list(readable.items())):
        lost = ~blank(field) & F.col(f"_{staged}").isNull()
        reason = F.when(lost, f"unreadable {field}").otherwise(reason)
    for field in reversed(required):
        reason = F.when(blank(field), f"missing {field}").otherwise(reason)
    typed = typed.withColumn("_reason", reason)

    names = [f.name for f in STAGING[feed].fields if f.name != "loaded_timestamp"]
    reject = F.struct(
        F.lit(feed).alias("feed"),
        F.col("symbol"),
        F.col("_reason").alias("reject_reason"),
        F.to_json(F.struct(*[c for c in records.columns if c != REFUSED])).alias("detail"),
    )
    reject = F.when(F.col("_reason").isNotNull(), reject)
    if REFUSED in records.columns:
        reject = F.coalesce(REFUSED, reject)
    return typed.select(
        *[F.col(f"_{n}").alias(n) for n in names],
        loaded_at.alias("loaded_timestamp"),
        reject.alias(REJECT),
    )


def raw_rows(staged: DataFrame, feed: str, source: str = API_SOURCE) -> DataFrame:
    """Append-only history: business key, the whole record as JSON, source and load time."""
    keys = STAGING_KEYS[feed]
    body = [c for c in staged.columns if c != "loaded_timestamp"]
    return staged.select(
        *keys,
        F.to_json(
            F.struct(*body),
            {
                "dateFormat": "yyyy-MM-dd",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss",
                "ignoreNullFields": "false",
            },
        ).alias("raw_data"),
        F.lit(source).alias("api_source"),
        "loaded_timestamp",
    )


def statement_versions(raw: DataFrame, feed: str) -> DataFrame:
    """Every version of every statement in the raw history, typed as in staging.

    Staging keeps the last version of a period; the raw history also holds what was known
    before a restatement. One row per business key and acceptance time, the last loaded.
    The point-in-time joins take several versions of a period as they are.
    """
    keys = STAGING_KEYS[feed]
    body = StructType([f for f in STAGING[feed].fields if f.name not in (*keys, "loaded_timestamp")])
    options = {"dateFormat": "yyyy-MM-dd", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    typed = raw.select(*keys, F.from_json("raw_data", body, options).alias("_r"), "loaded_timestamp").select(
        *keys, "_r.*", "loaded_timestamp"
    )
    return latest(typed, [*keys, "accepted_date"], [F.desc("loaded_timestamp")])


def as_variant(raw: DataFrame, column: str = "raw_data") -> DataFrame:
    """The JSON text column as a variant, for path access without a schema."""
    return raw.withColumn(column, F.parse_json(column))


def mapping_stats(staged: DataFrame, rejects: DataFrame) -> DataFrame:
    """Records processed and failed."""
    parts = [
        staged.select(F.lit("processed").alias("s")),
        rejects.select(F.lit("failed").alias("s")),
    ]
    return reduce(DataFrame.unionByName, parts).agg(
        F.count_if(F.col("s") == "processed").alias("processed"),
        F.count_if(F.col("s") == "failed").alias("failed"),
    )


def plain_prices(prices: DataFrame) -> DataFrame:
    """Price columns under the short names of the simple loader."""
    return prices.withColumnsRenamed(
        {
            "price_date": "date",
            "open_price": "open",
            "high_price": "high",
            "low_price": "low",
            "close_price": "close",
            "adj_close": "adj_close",
        }
    ).withColumn("source", F.lit(API_SOURCE))


def plain_fundamentals(income: DataFrame, balance: DataFrame, cash: DataFrame) -> DataFrame:
    """One row per symbol and quarter from the three statements, the quarter as a number."""
    keys = ["symbol", "fiscal_date", "period"]
    joined = (
        income.join(balance.drop("filing_date", "accepted_date", "loaded_timestamp"), keys, "left")
        .join(cash.drop("filing_date", "accepted_date", "loaded_timestamp"), keys, "left")
        .where(F.col("period") != "FY")
    )
    return joined.select(
        "symbol",
        "fiscal_date",
        F.year("fiscal_date").alias("fiscal_year"),
        F.regexp_replace("period", "Q", "").cast("int").alias("fiscal_quarter"),
        "revenue",
        "gross_profit",
        "operating_income",
        "net_income",
        "eps",
        "total_assets",
        "total_liabilities",
        "total_equity",
        "operating_cash_flow",
        "free_cash_flow",
        F.lit(API_SOURCE).alias("source"),
    )
