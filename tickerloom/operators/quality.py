"""Declarative record rules, quarantine, repair and cross-row checks.

A rule is a boolean column for "this row breaks it". ``validate`` evaluates a whole rule
list in one projection, so checking costs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import blank, dbl, nz, unset
from ..functions.dates import is_quarter

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
# Limits of the record rules.
PERIODS = ("FY", "Q1", "Q2", "Q3", "Q4")
MAX_SYMBOL_LENGTH = 10
SYMBOL_PATTERN = r"^[\p{L}\p{N}]+$"
LOOSE_SYMBOL_PATTERN = r"^[A-Za-z0-9.\-]+$"
TOLERANCE = "0.01"
MAX_PRICE = 1_000_000
BOUNDED = ("open_price", "high_price", "low_price", "close_price")
PRICE_FIELDS = ("open_price", "high_price", "low_price", "close_price", "adj_close")


@dataclass(frozen=True)
class Rule:
    """``broken`` may be NULL, which counts as not broken."""

    name: str
    broken: Column
    message: Column
    severity: str = ERROR


def say(*parts: Column | str) -> Column:
    """Message text; strings are literals, columns are cast, NULL prints as ``None``."""
    out = [
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("None"))
        for p in parts
    ]
    return F.concat(*out)


def _required(texts: Sequence[str], numbers: Sequence[str] = ()) -> list[Rule]:
    checks = [(c, blank(c)) for c in texts] + [(c, unset(c)) for c in numbers]
    return [Rule(f"required_{c}", bad, say("no value: ", c)) for c, bad in checks]


def profile_rules(symbol_pattern: str = SYMBOL_PATTERN) -> list[Rule]:
    symbol, cap, staff = F.col("symbol"), F.col("market_cap"), F.col("employees")
    malformed = (F.length(symbol) > MAX_SYMBOL_LENGTH) | ~symbol.rlike(symbol_pattern)
    return [
        *_required(["symbol", "company_name"]),
        Rule("symbol_format", ~blank(symbol) & malformed, say("symbol out of form: ", symbol)),
        Rule("market_cap_sign", cap < 0, say("market_cap below zero: ", cap)),
        Rule("employees_sign", staff < 0, say("employees below zero: ", staff)),
    ]


def price_rules(today: Column) -> list[Rule]:
    high, low = nz("high_price"), nz("low_price")
    ranged = (high > 0) & (low > 0)
    day = F.col("price_date")

    def outside(field: str) -> Rule:
        v = nz(field)
        return Rule(
            f"{field}_range",
            ranged & (v > 0) & ((v > high) | (v < low)),
            say(f"{field} ", F.col(field), " beyond low and high"),
            WARNING,
        )

    return [
        *_required(["symbol", "price_date"], ["close_price"]),
        *[
            Rule(f"{f}_sign", F.col(f) < 0, say(f"{f} below zero: ", F.col(f)))
            for f in PRICE_FIELDS
        ],
        Rule(
            "low_above_high",
            ranged & (low > high),
            say("low_price ", F.col("low_price"), " above high_price ", F.col("high_price")),
        ),
        outside("open_price"),
        outside("close_price"),
        Rule("volume_sign", F.col("volume") < 0, say("volume below zero: ", F.col("volume"))),
        Rule("future_price_date", day > today, say("price_date after today: ", day)),
    ]


def _statement_rules(today: Column) -> list[Rule]:
    period, day = F.col("period"), F.col("fiscal_date")
    return [
        *_required(["symbol", "fiscal_date", "period"]),
        Rule("period_name", ~blank(period) & ~period.isin(*PERIODS), say("unknown period: ", period)),
        Rule("future_fiscal_date", day > today, say("fiscal_date after today: ", day)),
    ]


def _off_by(a: Column, b: Column) -> Column:
    return F.abs(a - b) > F.lit(TOLERANCE).cast("decimal(3,2)")


def income_rules(today: Column) -> list[Rule]:
    revenue, cost, gross = F.col("revenue"), F.col("cost_of_revenue"), F.col("gross_profit")
    return [
        *_statement_rules(today),
        Rule("revenue_sign", revenue < 0, say("revenue below zero: ", revenue)),
        Rule(
            "gross_profit_identity",
            (nz(revenue) > 0) & (nz(cost) >= 0) & _off_by(gross, nz(revenue) - nz(cost)),
            say("gross_profit is not revenue less cost: ", gross, " != ", revenue, " - ", cost),
        ),
    ]


def balance_rules(today: Column) -> list[Rule]:
    a, l, e = F.col("total_assets"), F.col("total_liabilities"), F.col("total_equity")
    return [
        *_statement_rules(today),
        Rule(
            "balance_identity",
            (nz(a) > 0) & (nz(l) >= 0) & (nz(e) != 0) & _off_by(nz(a), nz(l) + nz(e)),
            say("assets are not liabilities and equity: ", a, " != ", l, " + ", e),
        ),
    ]


def cash_rules(today: Column) -> list[Rule]:
    ocf, capex, fcf = F.col("operating_cash_flow"), F.col("capital_expenditures"), F.col("free_cash_flow")
    return [
        *_statement_rules(today),
        Rule(
            "free_cash_flow_identity",
            (nz(ocf) != 0) & (nz(capex) != 0) & _off_by(fcf, ocf - F.abs(capex)),
            say("free_cash_flow is not operating less capital: ", fcf, " != ", ocf, " - ", F.abs(capex)),
        ),
    ]


def filing_rules() -> list[Rule]:
    """Plausibility of filing dates, share counts and signs."""
    fiscal, filed, accepted = F.col("fiscal_date"), F.col("filing_date"), F.col("accepted_date")
    return [
        Rule("filing_before_period_end", filed < fiscal, say("Filed before period end"), WARNING),
        Rule("filing_late", F.date_diff(filed, fiscal) > 180, say("Filed after 180 days"), WARNING),
        Rule("accepted_before_filing", F.to_date(accepted) < filed, say("Accepted before filing"), WARNING),
        Rule("shares_sign", F.col("shares_outstanding") <= 0, say("Shares not positive"), WARNING),
        Rule("liabilities_sign", F.col("total_liabilities") < 0, say("Negative liabilities"), WARNING),
        Rule("dividends_sign", F.col("dividends_paid") > 0, say("Dividends not an outflow"), INFO),
        Rule("capex_sign", F.col("capital_expenditures") > 0, say("Capital expenditure not an outflow"), INFO),
    ]


def record_rules(symbol: str = "symbol", price: str = "price", volume: str = "volume") -> list[Rule]:
    """Rules for any feed whose price arrives as text."""
    p = F.col(price)
    return [
        Rule("required_symbol", blank(symbol), say("Missing symbol")),
        Rule("price_number", p.isNotNull() & p.try_cast("double").isNull(), say("Invalid price: ", p)),
        Rule("volume_sign", F.col(volume) < 0, say("Negative volume")),
    ]


def range_rules(low: int = 0, high: int = MAX_PRICE) -> list[Rule]:
    """Every price that is there lies strictly between the bounds."""
    return [
        Rule(f"{c}_bounds", (F.col(c) <= low) | (F.col(c) >= high), say(f"{c} not between {low} and {high}: ", F.col(c)))
        for c in BOUNDED
    ]


RULE_SETS = {
    "profile": lambda today: profile_rules(),
    "price": lambda today: [*price_rules(today), *range_rules()],
    "income": income_rules,
    "balance": balance_rules,
    "cashflow": cash_rules,
}


def rules_for(data_type: str, today: Column) -> list[Rule]:
    if data_type not in RULE_SETS:
        raise ValueError(f"Unknown data type: {data_type}")
    return RULE_SETS[data_type](today)


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``issues`` (rule, severity, message per broken rule) and ``is_valid`` (no error)."""
    said = F.array_compact(
        F.array(
            *[
                F.when(
                    r.broken,
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.lit(r.severity).alias("severity"),
                        r.message.alias("message"),
                    ),
                )
                for r in rules
            ]
        )
    )

    def any_of(some: Sequence[Rule]) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(r.broken, F.lit(False)) for r in some], F.lit(False))

    # conditions are compiled, lists of issues are not: they are made for rows that have some
    none = F.array().cast("array<struct<rule:string,severity:string,message:string>>")
    return df.withColumn("issues", F.when(any_of(rules), said).otherwise(none)).withColumn(
        "is_valid", ~any_of([r for r in rules if r.severity == ERROR])
    )


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows without the check columns, and rejects with their issues."""
    return (
        checked.where("is_valid").drop("issues", "is_valid"),
        checked.where(~F.col("is_valid")).drop("is_valid"),
    )


def issue_rows(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per issue."""
    return checked.select(*keys, F.explode("issues").alias("i")).select(*keys, "i.*")


def validation_summary(checked: DataFrame) -> DataFrame:
    """Total, valid and invalid records, and the number of warnings on valid ones."""
    warned = F.size(F.filter("issues", lambda i: i["severity"] != ERROR))
    return checked.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("invalid_records"),
        F.sum(F.when(F.col("is_valid"), warned).otherwise(0)).alias("warnings"),
    )


def repaired_prices(df: DataFrame, max_price: int = MAX_PRICE) -> tuple[DataFrame, DataFrame]:
    """Null implausible changes and floor volume at zero; apart, unchanged, the rows priced at
    ``max_price`` or above, which can't be repaired."""
    change = F.col("change_percent")
    beyond = nz("close_price") >= max_price
    fixed = df.where(~beyond).withColumns(
        {
            "change_percent": F.when((change >= -100) & (change <= 1000), change),
            "volume": F.greatest(F.col("volume"), F.lit(0)),
        }
    )
    return fixed, df.where(beyond)


def repair_prices(df: DataFrame, max_price: int = MAX_PRICE) -> DataFrame:
    """The rows that can be repaired, see ``repaired_prices``."""
    return repaired_prices(df, max_price)[0]


def in_price_range(df: DataFrame, low: int = 0, high: int = MAX_PRICE) -> tuple[DataFrame, DataFrame]:
    """Bars whose prices all lie strictly between ``low`` and ``high``, and the others with the first
    field that doesn't. A missing price is judged by the rule on required fields, not here."""
    field = F.coalesce(*[F.when(r.broken, c) for c, r in zip(BOUNDED, range_rules(low, high))])
    judged = df.withColumn("field", field)
    return judged.where(F.col("field").isNull()).drop("field"), judged.where(F.col("field").isNotNull())


def repair_website(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(r"^https?://[^\s/$.?#].[^\s]*$"), c)


# ---- detectors with a uniform row shape -------------------------------------------------

@dataclass(frozen=True)
class Detector:
    """Rows of ``df`` where ``broken`` holds, reported under ``issue_type``."""

    issue_type: str
    table_name: str
    df: DataFrame
    broken: Column
    day: str
    period: Column
    detail: Column


def detect(detectors: Sequence[Detector]) -> DataFrame:
    parts = [
        d.df.where(d.broken).select(
            F.lit(d.issue_type).alias("issue_type"),
            F.lit(d.table_name).alias("table_name"),
            "symbol",
            F.col(d.day).cast("string").alias("reference_date"),
            d.period.alias("period"),
            d.detail.alias("issue_detail"),
        )
        for d in detectors
    ]
    return reduce(DataFrame.unionByName, parts)


def standard_detectors(
    income: DataFrame, balance: DataFrame, prices: DataFrame, today: Column
) -> list[Detector]:
    close = F.col("close_price")
    return [
        Detector(
            "Negative Revenue", "STG_INCOME_STATEMENT", income, F.col("revenue") < 0,
            "fiscal_date", F.col("period"), say("Revenue: ", F.col("revenue")),
        ),
        Detector(
            "Future Filing Date", "STG_INCOME_STATEMENT", income, F.col("filing_date") > today,
            "fiscal_date", F.col("period"), say("Filing Date: ", F.col("filing_date")),
        ),
        Detector(
            "Zero Total Assets", "STG_BALANCE_SHEET", balance,
            F.col("total_assets").isNull() | (F.col("total_assets") == 0),
            "fiscal_date", F.col("period"), say("Total Assets: 0"),
        ),
        Detector(
            "Price Outlier", "STG_HISTORICAL_PRICES", prices, (close > 100000) | (close <= 0),
            "price_date", F.lit("DAILY"), say("Close Price: ", close),
        ),
    ]


# ---- checks across rows ------------------------------------------------------------------

def missing_quarters(quarters: DataFrame, by: Sequence[str]) -> DataFrame:
    """Neighbouring fiscal quarters that lie more than three months apart."""
    w = Window.partitionBy(*by).orderBy("fiscal_date")
    apart = F.round(F.months_between("fiscal_date", "previous_quarter")).cast("int")
    return (
        quarters.select(*by, "fiscal_date", F.lag("fiscal_date").over(w).alias("previous_quarter"))
        .withColumn("quarters_missing", F.floor((apart - 1) / 3).cast("int"))
        .where(F.col("quarters_missing") > 0)
    )


def year_against_quarters(
    statements: DataFrame, by: Sequence[str], measure: str, period: str = "period"
) -> DataFrame:
    """Full years whose value is not the sum of their four quarters."""
    q = is_quarter(period)
    total = F.sum(F.when(q, F.col(measure)))
    annual = F.max(F.when(F.col(period) == "FY", F.col(measure)))
    off = (F.col("annual") != F.col("quarter_total")) & (F.col("quarters") == 4)
    return (
        statements.groupBy(*by, F.year("fiscal_date").alias("fiscal_year"))
        .agg(annual.alias("annual"), total.alias("quarter_total"), F.count_if(q).alias("quarters"))
        .where(off)
    )


def jumps(df: DataFrame, by: Sequence[str], day: str, measure: str, limit_pct: float = 100.0) -> DataFrame:
    """Rows whose measure moved by more than ``limit_pct`` against the period before."""
    w = Window.partitionBy(*by).orderBy(day)
    prior = F.lag(measure).over(w)
    moved = df.withColumn("prior_value", prior).where(F.col("prior_value") > 0)
    pct = dbl(F.col(measure) - F.col("prior_value")) / dbl("prior_value") * F.lit(100.0)
    return moved.withColumn("change_pct", pct).where(F.abs("change_pct") > limit_pct)


def outside_sigma(
    df: DataFrame, groups: Sequence[str], value: str, keep: Sequence[str], sigmas: float = 3.0
) -> DataFrame:
    """Rows further than ``sigmas`` deviations from their group's mean.

    The mean and deviation per group are aggregated first and joined back, so a large
    group is never held in one task.
    """
    stats = df.groupBy(*groups).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_dev")
    )
    z = F.round((dbl(value) - F.col("_mean")) / F.col("_dev"), 6)
    return (
        df.join(stats, list(groups))
        .where(F.col("_dev") > 0)
        .withColumn("z_score", z)
        .where(F.abs("z_score") > sigmas)
        .select(*groups, *[c for c in keep if c not in groups], value, "z_score")
    )


def outside_history(
    df: DataFrame, by: Sequence[str], day: str, value: str, min_rows: int = 20
) -> DataFrame:
    """Rows above or below everything seen before for the entity, once ``min_rows`` were seen."""
    before = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumns(
            {
                "seen_low": F.min(value).over(before),
                "seen_high": F.max(value).over(before),
                "_seen": F.count(value).over(before),
            }
        )
        .where(F.col("_seen") >= min_rows)
        .where((F.col(value) < F.col("seen_low")) | (F.col(value) > F.col("seen_high")))
        .drop("_seen")
    )


def orphans(df: DataFrame, dim: DataFrame, key: str = "symbol") -> DataFrame:
    """Keys used in ``df`` that the dimension does not hold, with their row counts."""
    used = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(dim.select(key), key, "left_anti")


def field_completeness(df: DataFrame, fields: Sequence[str]) -> Mapping[str, Column]:
    """Share of rows with a value, in percent, per field."""
    n = F.count(F.lit(1))
    return {f: F.when(n > 0, dbl(F.count(f)) / dbl(n) * F.lit(100.0)) for f in fields}
