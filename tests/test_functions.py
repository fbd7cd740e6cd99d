from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickerloom.functions import arith, dates, labels
from tickerloom.functions.ratios import fundamental_ratios
from tickerloom.functions.valuation import peg, with_valuation


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def money(x):
    return F.lit(x).cast("decimal(20,2)")


@pytest.mark.parametrize(
    ("values", "expected"), [((0, 5, 7), 5), ((None, 0, 7), 7), ((None, 0), 0), ((3, 5), 3)]
)
def test_first_nonzero(spark, values, expected):
    assert one(spark, arith.first_nonzero(*[F.lit(v).cast("bigint") for v in values])) == expected


def test_ratio_is_null_for_zero_and_negative_denominators(spark):
    assert one(spark, arith.ratio(money(1), money(0))) is None
    assert one(spark, arith.ratio(money(1), money(-2))) is None
    assert one(spark, arith.ratio(money(1), F.lit(None).cast("decimal(20,2)"))) is None
    assert one(spark, arith.ratio(money(1), money(4))) == 0.25


def test_half_even(spark):
    assert one(spark, arith.half_even(F.lit(2.665), 2)) == Decimal("2.66")
    assert one(spark, arith.half_even(F.lit(2.675), 2)) == Decimal("2.68")


def test_cagr_needs_positive_ends(spark):
    assert one(spark, arith.cagr(money(800), money(100), 3)) == 1.0
    assert one(spark, arith.cagr(money(-1), money(100), 3)) is None


def test_unset_and_blank(spark):
    assert one(spark, arith.unset(F.lit(None).cast("int"))) is True
    assert one(spark, arith.unset(F.lit(0))) is True
    assert one(spark, arith.blank(F.lit(""))) is True
    assert one(spark, arith.blank(F.lit("x"))) is False


def test_hours_count_boundaries(spark):
    a, b = (F.lit(f"2024-01-01 {t}").cast("timestamp_ntz") for t in ("00:59:00", "02:00:00"))
    assert one(spark, dates.hour_boundaries(a, b)) == 2


def test_month_slots_do_not_decrease(spark):
    rows = spark.sql("select explode(sequence(date'1999-01-01', date'2004-12-31')) as d")
    got = [r[0] for r in rows.select(dates.month_slot("d", 7)).collect()]
    assert got == sorted(got) and len(set(got)) == 12


@pytest.mark.parametrize(
    ("cap", "band"),
    [
        (200_000_000_000, "Mega Cap"),
        (199_999_999_999, "Large Cap"),
        (2_000_000_000, "Mid Cap"),
        (300_000_000, "Small Cap"),
        (299_999_999, "Micro Cap"),
        (None, "Micro Cap"),
    ],
)
def test_cap_band(spark, cap, band):
    assert one(spark, labels.cap_band(F.lit(cap).cast("bigint"))) == band


def test_headquarters(spark):
    def text(*parts):
        return one(spark, labels.joined_parts(*[F.lit(p).cast("string") for p in parts]))

    assert text("Cupertino", "CA", "US") == "Cupertino, CA, US"
    assert text(None, "", "US") == "US"
    assert text(None, "", None) is None


def test_ratios_guard_each_denominator(spark):
    row = spark.createDataFrame(
        [(Decimal(1000), Decimal(400), Decimal(200), Decimal(100), Decimal(-50), Decimal(2000), Decimal(500), Decimal(0), Decimal(300), 100)],
        "revenue decimal(20,2), gross_profit decimal(20,2), operating_income decimal(20,2), net_income decimal(20,2),"
        "total_equity decimal(20,2), total_assets decimal(20,2), current_assets decimal(20,2),"
        "current_liabilities decimal(20,2), total_debt decimal(20,2), shares_outstanding bigint",
    ).select(*[e.alias(n) for n, e in fundamental_ratios().items()]).first()
    assert row["gross_margin"] == 40.0 and row["profit_margin"] == 10.0 and row["roa"] == 5.0
    assert row["roe"] is None and row["debt_to_equity"] is None and row["book_value_per_share"] is None
    assert row["current_ratio"] is None and row["quick_ratio"] is None
    assert row["asset_turnover"] == 0.5 and row["revenue_per_share"] == 10.0


FILING = (
    "struct<period_type string, eps_diluted decimal(10,4), shares_outstanding bigint, total_debt decimal(20,2),"
    " cash_and_equivalents decimal(20,2), revenue_per_share double, book_value_per_share double>"
)
TTM = (
    "struct<ttm_revenue decimal(20,2), ttm_net_income decimal(20,2), ttm_eps_diluted decimal(10,4),"
    " ttm_operating_income decimal(20,2), ttm_dividends_paid decimal(20,2), latest_shares_outstanding bigint,"
    " latest_total_debt decimal(20,2), latest_cash_and_equivalents decimal(20,2)>"
)


def valued(spark, filing, ttm, close="100.00", places=2):
    df = spark.createDataFrame(
        [(Decimal(close), filing, ttm)], f"close_price decimal(10,2), filing {FILING}, ttm {TTM}"
    )
    return with_valuation(df, places).first()


def test_valuation_golden(spark):
    ttm = (
        Decimal(400_000_000), Decimal(100_000_000), Decimal("4.80"), Decimal(0), Decimal(-20_000_000), 20_000_000,
        Decimal(0), Decimal(0),
    )
    row = valued(spark, None, ttm)
    assert row["pe_ratio_ttm"] == Decimal("20.83")
    assert row["ps_ratio_ttm"] == Decimal("5.00")
    assert row["dividend_yield"] == Decimal("1.00")
    assert row["payout_ratio"] == Decimal("20.00")
    assert row["market_cap"] == Decimal("2000000000.00") and row["fiscal_period"] == "TTM"
    assert row["pe_ratio"] is None and row["ev_to_ebitda"] is None and row["ev_to_ebit"] is None


def test_valuation_falls_back_to_the_quarter(spark):
    filing = ("q3", Decimal("2.00"), 1_000, Decimal(500), Decimal(200), 50.0, 25.0)
    ttm = (Decimal(0), Decimal(0), Decimal(0), Decimal(0), Decimal(10), 0, Decimal(0), None)
    row = valued(spark, filing, ttm, places=None)
    assert row["market_cap"] == 100_000 and row["enterprise_value"] == 100_300
    assert row["pe_ratio"] == 50.0 and row["pb_ratio"] == 4.0 and row["ps_ratio"] == 2.0
    assert row["ev_to_revenue"] == 100_300 / 50_000.0
    # a positive payout is no dividend, and zero trailing figures give no multiples
    assert row["dividend_yield"] is None and row["payout_ratio"] is None and row["pe_ratio_ttm"] is None
    assert row["fiscal_period"] == "Q3"


def test_peg(spark):
    assert one(spark, peg(F.lit(25.0), F.lit(20.0))) == 1.25
    assert one(spark, peg(F.lit(25.0), F.lit(-1.0))) is None
