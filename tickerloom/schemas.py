"""Declared schemas: incoming payloads and the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(20,2)"
PRICE = "decimal(10,2)"
RATE = "decimal(10,4)"


_SIMPLE = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    MONEY: T.DecimalType(20, 2),
    PRICE: T.DecimalType(10, 2),
    RATE: T.DecimalType(10, 4),
    "decimal(20,4)": T.DecimalType(20, 4),
}


def _struct(fields: str) -> T.StructType:
    """Schema from ``name type`` pairs; usable before a session exists."""
    pairs = [f.split() for f in fields.split(", ")]
    return T.StructType([T.StructField(name, _SIMPLE[kind]) for name, kind in pairs])


# Field names and types of the incoming payloads. Numbers arrive as JSON
# numbers or text, so measures are read as text and cast by the mappings.
PAYLOADS: dict[str, T.StructType] = {
    "profile": _struct(
        "symbol string, companyName string, sector string, industry string, exchange string,"
        " marketCap string, description string, website string, ceo string,"
        " fullTimeEmployees string, city string, state string, country string"
    ),
    "price": _struct(
        "symbol string, date string, open string, high string, low string, close string,"
        " adjClose string, volume string, changePercent string"
    ),
    "income": _struct(
        "symbol string, date string, period string, reportedCurrency string, filingDate string,"
        " acceptedDate string, revenue string, costOfRevenue string, grossProfit string,"
        " operatingExpenses string, operatingIncome string, netIncome string, eps string,"
        " epsDiluted string, weightedAverageShsOut string, weightedAverageShsOutDil string"
    ),
    "balance": _struct(
        "symbol string, date string, period string, reportedCurrency string, filingDate string,"
        " acceptedDate string, totalAssets string, totalCurrentAssets string,"
        " totalLiabilities string, totalCurrentLiabilities string, totalEquity string,"
        " totalStockholdersEquity string, cashAndCashEquivalents string, totalDebt string,"
        " netDebt string"
    ),
    "cashflow": _struct(
        "symbol string, date string, period string, reportedCurrency string, filingDate string,"
        " acceptedDate string, operatingCashFlow string,"
        " netCashProvidedByInvestingActivities string,"
        " netCashProvidedByFinancingActivities string, freeCashFlow string,"
        " capitalExpenditure string, commonDividendsPaid string, netDividendsPaid string"
    ),
    "constituent": _struct(
        "symbol string, name string, sector string, subSector string, headQuarter string,"
        " dateFirstAdded string, cik string, founded string"
    ),
    "sector_pe": _struct("date string, sector string, exchange string, pe double"),
    "treasury": _struct(
        "date string, month1 double, month2 double, month3 double, month6 double, year1 double,"
        " year2 double, year3 double, year5 double, year7 double, year10 double, year20 double,"
        " year30 double"
    ),
    "indicator": _struct("name string, date string, value double"),
    "market_cap": _struct("symbol string, date string, marketCap long"),
    "option": _struct(
        "symbol string, expirationDate string, strike double, optionType string,"
        " contractSymbol string, lastPrice double, bid double, ask double, volume long,"
        " openInterest long, impliedVolatility double, inTheMoney boolean, lastTradeDate string"
    ),
}

_STATEMENT_KEYS = (
    "symbol string, fiscal_date date, period string, filing_date date, accepted_date timestamp_ntz, "
)
_AUDITED = ", loaded_timestamp timestamp_ntz"

STAGING: dict[str, T.StructType] = {
    "profile": _struct(
        f"symbol string, company_name string, sector string, industry string, exchange string,"
        f" market_cap {MONEY}, description string, website string, ceo string, employees bigint,"
        f" headquarters_city string, headquarters_state string, headquarters_country string"
        + _AUDITED
    ),
    "price": _struct(
        f"symbol string, price_date date, open_price {PRICE}, high_price {PRICE},"
        f" low_price {PRICE}, close_price {PRICE}, adj_close {PRICE}, volume bigint,"
        f" change_percent {RATE}" + _AUDITED
    ),
    "income": _struct(
        _STATEMENT_KEYS + f"revenue {MONEY}, cost_of_revenue {MONEY}, gross_profit {MONEY},"
        f" operating_expenses {MONEY}, operating_income {MONEY}, net_income {MONEY}, eps {RATE},"
        f" eps_diluted {RATE}, shares_outstanding bigint, shares_outstanding_diluted bigint"
        + _AUDITED
    ),
    "balance": _struct(
        _STATEMENT_KEYS + f"total_assets {MONEY}, current_assets {MONEY},"
        f" total_liabilities {MONEY}, current_liabilities {MONEY}, total_equity {MONEY},"
        f" cash_and_equivalents {MONEY}, total_debt {MONEY}, net_debt {MONEY}" + _AUDITED
    ),
    "cashflow": _struct(
        _STATEMENT_KEYS + f"operating_cash_flow {MONEY}, investing_cash_flow {MONEY},"
        f" financing_cash_flow {MONEY}, free_cash_flow {MONEY}, capital_expenditures {MONEY},"
        f" dividends_paid {MONEY}" + _AUDITED
    ),
    "option": _struct(
        "symbol string, expiration_date date, strike_price double, option_type string,"
        " contract_symbol string, last_price double, bid double, ask double, volume bigint,"
        " open_interest bigint, implied_volatility double, in_the_money boolean,"
        " last_trade_date timestamp_ntz" + _AUDITED
    ),
}

# Business key of each staging table.
STAGING_KEYS: dict[str, list[str]] = {
    "profile": ["symbol"],
    "price": ["symbol", "price_date"],
    "income": ["symbol", "fiscal_date", "period"],
    "balance": ["symbol", "fiscal_date", "period"],
    "cashflow": ["symbol", "fiscal_date", "period"],
    "option": ["contract_symbol"],
}

RAW = _struct("symbol string, raw_data string, api_source string, loaded_timestamp timestamp_ntz")

INCOME_MEASURES = (
    "revenue", "cost_of_revenue", "gross_profit", "operating_expenses", "operating_income",
    "net_income", "eps", "eps_diluted", "shares_outstanding",
)
BALANCE_MEASURES = (
    "total_assets", "current_assets", "total_liabilities", "current_liabilities", "total_equity",
    "cash_and_equivalents", "total_debt", "net_debt",
)
CASH_MEASURES = (
    "operating_cash_flow", "investing_cash_flow", "financing_cash_flow", "free_cash_flow",
    "capital_expenditures", "dividends_paid",
)

_MEASURE_DDL = ", ".join(
    f"{c} {'bigint' if c == 'shares_outstanding' else RATE if c.startswith('eps') else MONEY}"
    for c in (*INCOME_MEASURES, *BALANCE_MEASURES, *CASH_MEASURES)
)

ANALYTICS: dict[str, T.StructType] = {
    "dim_company": _struct(
        "company_key bigint, symbol string, company_name string, sector string, industry string,"
        " exchange string, market_cap_category string, headquarters_location string,"
        " is_current boolean, valid_from timestamp_ntz, valid_to timestamp_ntz"
    ),
    "dim_date": _struct(
        "date_key int, date date, year int, quarter int, month int, day int, day_of_week int,"
        " day_name string, month_name string, is_weekend boolean, is_month_end boolean,"
        " is_quarter_end boolean, is_year_end boolean, week int"
    ),
    "fact_daily_prices": _struct(
        f"company_key bigint, date_key int, open_price {PRICE}, high_price {PRICE},"
        f" low_price {PRICE}, close_price {PRICE}, adj_close {PRICE}, volume bigint,"
        f" change_amount {PRICE}, change_percent {RATE}"
    ),
    # the filing columns stay nullable: a statement may arrive without its filing record
    "fact_financials": _struct(
        "financial_key bigint, company_key bigint, fiscal_date_key int, filing_date_key int,"
        f" accepted_date timestamp_ntz, period_type string, {_MEASURE_DDL}"
    ),
    "job_history": _struct(
        "job_id string, job_name string, status string, start_time timestamp_ntz,"
        " end_time timestamp_ntz, duration_seconds decimal(10,2), records_extracted bigint,"
        " records_transformed bigint, records_loaded bigint, error_count bigint, metadata string"
    ),
    "job_errors": _struct(
        "job_id string, error_timestamp timestamp_ntz, error_type string, error_message string,"
        " error_details string"
    ),
    "job_metrics": _struct(
        "job_id string, metric_name string, metric_value decimal(20,4), metric_unit string,"
        " phase string, recorded_at timestamp_ntz"
    ),
    "data_quality_issues": _struct(
        "job_id string, table_name string, record_identifier string, issue_type string,"
        " issue_description string, severity string, detected_at timestamp_ntz"
    ),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order and type; a column ``df`` lacks is filled with NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
