from datetime import date, datetime, timedelta
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import growth, trailing
from tickerloom.operators.trailing import FLOWS, STOCKS

ENDS = [date(y, m, d) for y in range(2018, 2024) for m, d in ((3, 31), (6, 30), (9, 30), (12, 31))]


def quarter(k, fiscal, accepted, **values):
    row = {c: Decimal(values.get(c, 0)) for c in (*FLOWS, *STOCKS)}
    return (k, fiscal, accepted, *row.values())


def frame(spark, rows):
    cols = ", ".join(f"{c} decimal(20,2)" for c in (*FLOWS, *STOCKS))
    return spark.createDataFrame(rows, f"k int, fiscal_date date, accepted_date timestamp_ntz, {cols}")


def accepted(fiscal, days=35):
    return datetime(fiscal.year, fiscal.month, fiscal.day, 16, 5) + timedelta(days=days)


def in_order(k=1, ends=ENDS, seed=0):
    rng = Random(seed)
    return [quarter(k, e, accepted(e), revenue=rng.randrange(1000), total_assets=rng.randrange(1000)) for e in ends]


def key(r):
    return (r.k, r.calculation_date, r.ttm_revenue, r.latest_total_assets, r.oldest_quarter_date, r.newest_quarter_date)


def test_golden(spark):
    ends = ENDS[:4]
    rows = [quarter(1, e, accepted(e), revenue=100_000_000, net_income=25_000_000, operating_cash_flow=30_000_000, total_assets=i) for i, e in enumerate(ends)]
    (r,) = trailing.ttm_in_order(frame(spark, rows), ["k"]).collect()
    assert (r.ttm_revenue, r.ttm_net_income, r.ttm_operating_cash_flow) == (400_000_000, 100_000_000, 120_000_000)
    assert r.latest_total_assets == 3 and r.quarters_included == 4


@pytest.mark.parametrize("seed", range(3))
def test_both_forms_agree_on_filings_in_order(spark, seed):
    rng = Random(seed)
    ends = [e for e in ENDS if rng.random() > 0.15]
    df = frame(spark, in_order(1, ends, seed) + in_order(2, ENDS, seed + 9))
    a = sorted(map(key, trailing.ttm_in_order(df, ["k"]).collect()))
    b = sorted(map(key, trailing.ttm_as_known(df, ["k"]).collect()))
    assert a == b


def brute(rows):
    """Four newest distinct quarters known at each filing day and younger than 15 months."""
    out = []
    days = {}
    for r in rows:
        day = r[2].date()
        days[day] = max(days.get(day, r[2]), r[2])
    for day, moment in days.items():
        m = day.year * 12 + day.month - 1 - 15
        last = [31, 29 if m // 12 % 4 == 0 else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m % 12]
        edge = date(m // 12, m % 12 + 1, min(day.day, last))
        known = {}
        for r in sorted(rows, key=lambda r: r[2]):
            if r[2] <= moment and r[1] > edge:
                known[r[1]] = r
        if len(known) >= 4:
            four = [known[f] for f in sorted(known)[-4:]]
            out.append((day, sum(r[3] for r in four), four[0][1], four[-1][1]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_as_known_equals_brute_force_for_any_order(spark, seed):
    rng = Random(seed)
    rows = [quarter(1, e, accepted(e, rng.randrange(0, 400)), revenue=rng.randrange(1000)) for e in ENDS]
    # restated quarters and two filings on one day
    rows += [quarter(1, e, accepted(e, rng.randrange(401, 450)), revenue=rng.randrange(1000)) for e in ENDS[::5]]
    rows += [quarter(1, ENDS[9], rows[8][2] - timedelta(hours=1), revenue=7)]
    got = trailing.ttm_as_known(frame(spark, rows), ["k"]).collect()
    assert sorted((r.calculation_date, r.ttm_revenue, r.oldest_quarter_date, r.newest_quarter_date) for r in got) == brute(rows)


def test_restatement_divides_the_two_forms(spark):
    rows = in_order(1, ENDS[:5])
    late = quarter(1, ENDS[1], accepted(ENDS[4], 60), revenue=5000)
    as_known = trailing.ttm_as_known(frame(spark, rows + [late]), ["k"]).collect()
    assert len(as_known) == 3 and max(as_known, key=lambda r: r.calculation_date).ttm_revenue > 5000


def test_opportunities_count_distinct_quarters(spark):
    rows = in_order(1, ENDS[:4]) + [quarter(1, ENDS[0], accepted(ENDS[0], 40), revenue=1)]
    (r,) = trailing.opportunities(frame(spark, rows), ["k"]).collect()
    assert r.quarters_available == 4 and r.oldest_quarter_date == ENDS[0]


def test_with_ttm_equals_in_order(spark):
    df = frame(spark, in_order(1, ENDS[:3] + ENDS[5:12]))
    a = trailing.with_ttm(df, ["k"]).where("ttm is not null").select("k", "ttm.*")
    assert sorted(map(key, a.collect())) == sorted(map(key, trailing.ttm_in_order(df, ["k"]).collect()))


def test_integrity_names_the_broken_rules(spark):
    ttm = trailing.ttm_in_order(frame(spark, in_order(1, ENDS[:4])), ["k"])
    assert trailing.ttm_integrity(ttm).count() == 0
    bad = ttm.withColumn("oldest_quarter_date", F.lit(date(2017, 1, 31))).withColumn("ttm_revenue", F.lit(None).cast("decimal(20,2)"))
    assert trailing.ttm_integrity(bad).first().broken_rules == ["quarter span", "no revenue"]


# ---- growth ------------------------------------------------------------------------------

def test_growth_forms(spark):
    df = spark.createDataFrame(
        [(1, date(2020, 3, 31), 100.0), (1, date(2021, 3, 31), 120.0), (1, date(2023, 3, 31), 800.0), (1, date(2024, 2, 29), 1.0), (1, date(2025, 2, 28), 3.0)],
        "k int, d date, v double",
    )
    yearly = growth.against_earlier(df, ["k"], "d", 12, ["v"])
    assert sorted((r.d, r.prior_v) for r in yearly.collect()) == [(date(2021, 3, 31), 100.0)]
    three = {r.d: r.v_cagr_3y for r in growth.with_cagr(df, ["k"], "d", "v", [3]).collect()}
    assert three[date(2023, 3, 31)] == 1.0 and three[date(2021, 3, 31)] is None
    nearest = growth.against_nearest(df, ["k"], "d", 12, ["v"])
    assert {r.d: r.prior_v for r in nearest.collect()}[date(2024, 2, 29)] == 120.0


def test_growth_needs_a_positive_prior(spark):
    df = spark.createDataFrame([(Decimal(5), Decimal(-1)), (Decimal(5), Decimal(4))], "v decimal(10,2), prior_v decimal(10,2)")
    assert [r[0] for r in df.select(growth.rates(["v"])["v_growth_rate"]).collect()] == [None, 25.0]
