"""The growth fact against plain lookups, and how it is planned."""

from datetime import date, datetime
from random import Random

import pytest
from pyspark.sql import functions as F

from tickerloom.operators.growth import GROWTH_MEASURES
from tickerloom.operators.trailing import FLOWS, STOCKS
from tickerloom.plans import growth_table

ENDS = ((3, 31), (6, 30), (9, 30), (12, 31))


@pytest.fixture(scope="module")
def statements(spark):
    """Two companies over seven years; some quarters and years lack, and one day sees two filings."""
    rng, rows = Random(4), []
    for key in (1, 2):
        for year in range(2017, 2024):
            for q, (m, d) in enumerate(ENDS, 1):
                for period in (f"Q{q}", "FY")[: 1 + (q == 4)]:
                    if rng.random() > 0.1:
                        accepted = datetime(year + (q == 4), (m + 1) % 12 or 12, 20)
                        rows.append((key, date(year, m, d), period, accepted, rng.choice([None, -5, 0, *range(1, 60)])))
    rows.append((3, date(2021, 3, 31), "Q1", datetime(2021, 5, 1), 10))
    rows += [(3, date(2022, 3, 31), "Q1", datetime(2022, 9, 1), 20), (3, date(2022, 6, 30), "Q2", datetime(2022, 9, 1), 30), (3, date(2021, 6, 30), "Q2", None, 15)]
    df = spark.createDataFrame(rows, "company_key int, fiscal_date date, period_type string, accepted_date timestamp, revenue int")
    others = {c: F.col("revenue") * (k + 2) for k, c in enumerate(dict.fromkeys([*FLOWS, *STOCKS, *GROWTH_MEASURES])) if c != "revenue"}
    return rows, df.withColumns(others)


def back(day, quarters):
    n = day.year * 4 + (day.month - 1) // 3 - quarters
    return date(n // 4, *ENDS[n % 4])


def test_equals_plain_lookups(spark, statements):
    rows, df = statements
    got = {(r.company_key, r.period_type, r.current_period_date, r.periods_back): r for r in growth_table.growth_fact(df).where("period_type <> 'TTM'").collect()}
    by_place = {(k, "ANNUAL" if p == "FY" else "QUARTERLY", d): (v, a) for k, d, p, a, v in rows}
    want = {}
    for (key, kind, day), (v, accepted) in by_place.items():
        for n, quarters in growth_table.PERIODS[kind].items():
            prior = by_place.get((key, kind, back(day, quarters)))
            if prior and accepted:
                rate = (v - prior[0]) / prior[0] * 100 if v is not None and prior[0] and prior[0] > 0 else None
                want[key, kind, day, n] = (v, prior[0], rate)
    # of two quarters that became known on one day the newer has the row
    del want[3, "QUARTERLY", date(2022, 3, 31), 4]
    assert set(got) == set(want)
    for place, (v, prior, rate) in want.items():
        r = got[place]
        assert (r.revenue_current, r.revenue_prior) == (v, prior)
        assert r.revenue_growth_rate == (None if rate is None else pytest.approx(rate))


def test_trailing_years(spark, statements):
    rows, df = statements
    got = growth_table.growth_fact(df).where("period_type = 'TTM' and periods_back = 1").collect()
    quarters = {(k, d): v for k, d, p, _, v in rows if p != "FY"}
    assert got
    for r in got:
        for end, total in ((r.current_period_date, r.revenue_current), (r.prior_period_date, r.revenue_prior)):
            # the last four quarters there are, which may span fifteen months
            values = [quarters[place] for place in sorted(p for p in quarters if p[0] == r.company_key and p[1] <= end)[-4:]]
            assert total == (sum(v for v in values if v is not None) if any(v is not None for v in values) else None)
        assert r.prior_period_date == back(r.current_period_date, 4)


def test_statements_are_shuffled_once(spark, statements):
    plan = growth_table.growth_fact(statements[1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_one_row_for_each_key(spark, statements):
    fact = growth_table.growth_fact(statements[1])
    keys = ["company_key", "calculation_date", "period_type", "periods_back"]
    assert fact.count() == fact.dropDuplicates(keys).count() and growth_table.growth_fact(statements[1].limit(0)).count() == 0


def test_more_statements_get_more_tasks(spark, statements, monkeypatch):
    rows, df = statements
    monkeypatch.setattr(growth_table, "EACH", 10)
    fact = growth_table.growth_fact(df)
    monkeypatch.undo()
    assert "hashpartitioning(company_key#" in (plan := fact._jdf.queryExecution().executedPlan().toString())
    assert f", {-(-len(rows) // 10)}), REPARTITION_BY_NUM" in plan
    assert sorted(map(repr, fact.collect())) == sorted(map(repr, growth_table.growth_fact(df).collect()))
