from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import quality

TODAY = date(2024, 6, 30)


def messages(spark, ddl, row, rules):
    checked = quality.validate(spark.createDataFrame([row], ddl), rules).first()
    return [i.message for i in checked.issues], checked.is_valid


PROFILE = "symbol string, company_name string, market_cap bigint, employees bigint"


def test_profile_rules(spark):
    rules = quality.profile_rules()
    got = messages(spark, PROFILE, ("TOOLONGSYMBOL", "Name", -1000, -10), rules)
    assert got == (
        ["symbol out of form: TOOLONGSYMBOL", "market_cap below zero: -1000", "employees below zero: -10"], False,
    )
    assert messages(spark, PROFILE, (None, "", None, None), rules)[0] == [
        "no value: symbol", "no value: company_name",
    ]
    assert messages(spark, PROFILE, ("ÄÖ1", "Name", 0, 0), rules) == ([], True)
    assert messages(spark, PROFILE, ("BRK-B", "Name", 1, 1), rules)[1] is False
    loose = quality.profile_rules(quality.LOOSE_SYMBOL_PATTERN)
    assert messages(spark, PROFILE, ("BRK-B", "Name", 1, 1), loose)[1] is True


PRICE = (
    "symbol string, price_date date, open_price decimal(10,2), high_price decimal(10,2), low_price decimal(10,2),"
    " close_price decimal(10,2), adj_close decimal(10,2), volume bigint"
)


def price(o, h, l, c, volume=1, day=date(2024, 1, 2)):
    return ("A", day, *[None if x is None else Decimal(x) for x in (o, h, l, c)], None, volume)


@pytest.mark.parametrize(
    ("row", "expected", "valid"),
    [
        (price(120, 100, 150, 120), ["low_price 150.00 above high_price 100.00", "open_price 120.00 beyond low and high", "close_price 120.00 beyond low and high"], False),
        (price(None, None, None, -100, -1000), ["close_price below zero: -100.00", "volume below zero: -1000"], False),
        (price(90, 80, 70, 75), ["open_price 90.00 beyond low and high"], True),
        (price(75, 80, 70, 0), ["no value: close_price"], False),
        (price(75, 80, 70, 75, day=date(2025, 1, 1)), ["price_date after today: 2025-01-01"], False),
        (price(75, 80, 70, 75), [], True),
    ],
)
def test_price_rules(spark, row, expected, valid):
    assert messages(spark, PRICE, row, quality.price_rules(F.lit(TODAY))) == (expected, valid)


STATEMENT = "symbol string, fiscal_date date, period string, "


def test_statement_rules(spark):
    today = F.lit(TODAY)
    head = ("A", date(2024, 3, 31), "Q1")
    d = Decimal
    income = STATEMENT + "revenue decimal(20,2), cost_of_revenue decimal(20,2), gross_profit decimal(20,2)"
    assert messages(spark, income, (*head, d(100), d(60), d(40)), quality.income_rules(today)) == ([], True)
    assert messages(spark, income, (*head, d(100), d(60), d(41)), quality.income_rules(today))[0] == [
        "gross_profit is not revenue less cost: 41.00 != 100.00 - 60.00"
    ]
    assert messages(spark, income, (*head, d(-5), None, None), quality.income_rules(today))[0] == ["revenue below zero: -5.00"]
    balance = STATEMENT + "total_assets decimal(20,2), total_liabilities decimal(20,2), total_equity decimal(20,2)"
    assert messages(spark, balance, (*head, d(1_000_000), d(600_000), d(500_000)), quality.balance_rules(today))[0] == [
        "assets are not liabilities and equity: 1000000.00 != 600000.00 + 500000.00"
    ]
    cash = STATEMENT + "operating_cash_flow decimal(20,2), capital_expenditures decimal(20,2), free_cash_flow decimal(20,2)"
    assert messages(spark, cash, (*head, d(100), d(-30), d(70)), quality.cash_rules(today)) == ([], True)
    assert messages(spark, cash, (*head, d(100), d(-30), d(80)), quality.cash_rules(today))[0] == [
        "free_cash_flow is not operating less capital: 80.00 != 100.00 - 30.00"
    ]
    bad = messages(spark, income, (None, date(2030, 1, 1), "H1", None, None, None), quality.income_rules(today))[0]
    assert bad == ["no value: symbol", "unknown period: H1", "fiscal_date after today: 2030-01-01"]


def test_batch_summary_and_split(spark):
    df = spark.createDataFrame([("A", "Apple", 1, 1), ("B", "Bee", 1, 1), (None, "None", 1, 1)], PROFILE)
    checked = quality.validate(df, quality.rules_for("profile", F.lit(TODAY)))
    assert tuple(quality.validation_summary(checked).first()) == (3, 2, 1, 0)
    good, bad = quality.split_valid(checked)
    assert good.columns == df.columns and good.count() == 2 and bad.count() == 1
    assert [r.rule for r in quality.issue_rows(checked, ["symbol"]).collect()] == ["required_symbol"]
    with pytest.raises(ValueError):
        quality.rules_for("other", F.lit(TODAY))


def test_repairs(spark):
    df = spark.createDataFrame(
        [(Decimal("5"), Decimal("-150"), -3), (Decimal("2000000"), Decimal("1"), 1), (None, Decimal("12"), 4)],
        "close_price decimal(20,2), change_percent decimal(10,2), volume bigint",
    )
    got = [(r.change_percent, r.volume) for r in quality.repair_prices(df).collect()]
    assert got == [(None, 0), (Decimal("12.00"), 4)]
    sites = spark.createDataFrame([("https://a.b/c",), ("nope",), (None,)], "w string")
    assert [r[0] for r in sites.select(quality.repair_website("w")).collect()] == ["https://a.b/c", None, None]


def test_missing_quarters_and_years(spark):
    rows = [("A", date(2023, 3, 31), "Q1", 1), ("A", date(2023, 12, 31), "Q4", 4)]
    df = spark.createDataFrame(rows, "s string, fiscal_date date, period string, v int")
    (r,) = quality.missing_quarters(df, ["s"]).collect()
    assert r.quarters_missing == 2 and r.previous_quarter == date(2023, 3, 31)
    year = [("A", date(2023, m, 28), f"Q{i + 1}", 10) for i, m in enumerate((2, 5, 8, 11))] + [("A", date(2023, 12, 31), "FY", 41)]
    df = spark.createDataFrame(year, "s string, fiscal_date date, period string, v int")
    (r,) = quality.year_against_quarters(df, ["s"], "v").collect()
    assert (r.annual, r.quarter_total) == (41, 40)


def test_outside_history_needs_enough_rows(spark):
    df = spark.createDataFrame([("A", i, float(v)) for i, v in enumerate([5, 6, 7, 20, 6])], "s string, d int, v double")
    got = quality.outside_history(df, ["s"], "d", "v", min_rows=2).collect()
    assert sorted(r.v for r in got) == [7.0, 20.0]


def test_prices_out_of_range_are_set_apart(spark):
    rows = [("A", 1, 2, 1, 2), ("B", -1, 2, 1, 2), ("C", 1, 2_000_000, 1, 3_000_000), ("D", None, 0, 0, 1_000_000)]
    df = spark.createDataFrame(rows, "symbol string, open_price int, high_price int, low_price int, close_price int")
    good, bad = quality.in_price_range(df)
    assert [r.symbol for r in good.collect()] == ["A"] and good.columns == df.columns
    # the bounds themselves are out, a missing price is not
    assert [(r.symbol, r.field) for r in bad.collect()] == [("B", "open_price"), ("C", "high_price"), ("D", "high_price")]
    rules = {r.name for r in quality.rules_for("price", F.lit(TODAY))}
    assert {f"{c}_bounds" for c in quality.BOUNDED} <= rules
