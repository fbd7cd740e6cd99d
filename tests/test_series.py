from datetime import date, datetime, timedelta
from decimal import Decimal
from random import Random
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import series


def bars(spark, n=120, seed=1):
    rng = Random(seed)
    rows, day = [], date(2023, 1, 2)
    for i in range(n):
        day += timedelta(days=rng.choice([1, 1, 1, 3, 5, 8]))
        rows.append(("A", day, Decimal(rng.randrange(100, 9999)) / 100, rng.randrange(1, 500)))
    rows += [("B", date(2023, 5, 1), Decimal("10.00"), 5)]
    return rows, spark.createDataFrame(rows, "symbol string, day date, close decimal(10,2), volume bigint")


@pytest.mark.parametrize("unit", ["month", "year", "week"])
def test_previous_by_slot_equals_plain(spark, unit):
    _, df = bars(spark)
    a = series.previous(df, ["symbol"], ["day"], {"p": "close", "pd": "day"})
    b = series.previous(df, ["symbol"], ["day"], {"p": "close", "pd": "day"}, slot=F.trunc("day", unit))
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_previous_by_slot_skips_empty_slots(spark):
    df = spark.createDataFrame([("A", date(2020, 1, 5), 1), ("A", date(2023, 7, 1), 2)], "s string, d date, v int")
    got = series.previous(df, ["s"], ["d"], {"p": "v"}, slot=F.trunc("d", "month")).orderBy("d").collect()
    assert [x.p for x in got] == [None, 1]


def test_balanced_slots_spread_one_busy_entity(spark, tmp_path):
    rows = [(1, i % 50, i) for i in range(3000)] + [(k, 0, k) for k in range(2, 40)]
    df = spark.createDataFrame(rows, "k int, t int, n int").repartition(6)
    cut = series.balanced_slots(df, ["k"], ["t", "n"], str(tmp_path / "cut"), 8)
    sizes = [r["count"] for r in cut.where("k = 1").groupBy("slot").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1500
    a = series.previous(cut, ["k"], ["t", "n"], {"p": "n"}, slot=F.col("slot")).select("k", "n", "p")
    b = series.previous(df, ["k"], ["t", "n"], {"p": "n"}).select("k", "n", "p")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_price_change(spark):
    df = spark.createDataFrame(
        [("A", date(2024, 1, 1), Decimal("10.00")), ("A", date(2024, 1, 2), Decimal("12.50")), ("A", date(2024, 1, 3), Decimal("0.00")), ("A", date(2024, 1, 4), Decimal("1.00"))],
        "symbol string, day date, close decimal(10,2)",
    )
    got = series.price_change(df, ["symbol"], ["day"], "close").orderBy("day").collect()
    assert [x.change_amount for x in got] == [None, Decimal("2.50"), Decimal("-12.50"), Decimal("1.00")]
    assert [x.change_percent for x in got] == [None, 25.0, -100.0, None]


def test_gaps(spark):
    days = [date(2024, 1, 1), date(2024, 1, 4), date(2024, 1, 8), date(2024, 1, 20)]
    df = spark.createDataFrame([("A", d) for d in days], "symbol string, day date")
    got = sorted(x.days_gap for x in series.gaps(df, ["symbol"], "day").collect())
    assert got == [4, 12]


def test_moving_averages_equal_plain_means(spark):
    rows, df = bars(spark)
    closes = [r[2] for r in rows if r[0] == "A"]
    got = series.moving_averages(df, ["symbol"], "day", "close", {"m3": 3, "m50": 50}).where("symbol = 'A'").orderBy("day").collect()
    for i, x in enumerate(got):
        for name, n in (("m3", 3), ("m50", 50)):
            part = closes[max(0, i - n + 1) : i + 1]
            assert x[name] == float(sum(part)) / len(part)


def test_rolling_sums_skip_missing_values(spark):
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate([1, None, 3, 4])], "s string, d int, v bigint")
    got = series.rolling_sums(df, ["s"], "d", "v", {"r": 2}).orderBy("d").collect()
    assert [(x.r_sum, x.r_rows) for x in got] == [(1, 1), (1, 1), (3, 1), (7, 2)]


def test_returns_and_volatility(spark):
    rows, df = bars(spark)
    closes = [float(r[2]) for r in rows if r[0] == "A"]
    r = series.returns(df, ["symbol"], "day", "close", {"r1": 1, "r5": 5})
    got = series.volatility(r, ["symbol"], "day", "r1", rows=20).where("symbol = 'A'").orderBy("day").collect()
    assert got[0].r1 is None and got[4].r5 is None
    assert got[30].r5 == closes[30] / closes[25] - 1
    last20 = [closes[i] / closes[i - 1] - 1 for i in range(81, 101)]
    assert got[100].volatility == pytest.approx(stdev(last20) * 252**0.5, abs=1e-6)
    with pytest.raises(ValueError):
        series.volatility(r, ["symbol"], "day", "r1")


def test_multiple_of_average(spark):
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate([10, 20, 60, 9])], "s string, d int, v bigint")
    got = series.multiple_of_average(df, ["s"], "d", "v", 2, "x").orderBy("d").collect()
    assert [x.x for x in got] == [None, 2.0, 60 / mean([10, 20]), 9 / mean([20, 60])]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("gap", [60, 1800, 9000])
def test_sessions_equal_brute_force(spark, seed, gap):
    rng = Random(seed)
    ticks = [(rng.randrange(3), datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(6000)), i) for i in range(300)]
    df = spark.createDataFrame(ticks, "u int, ts timestamp_ntz, id int")
    slots = [None, F.trunc("ts", "month"), F.date_trunc("hour", "ts")]
    got = [sorted((x.u, x.session_start, x.session_end, x.ticks) for x in series.sessions(df, ["u"], "ts", "id", gap, s).collect()) for s in slots]
    want = []
    for u in range(3):
        runs = []
        for t in sorted(t for k, t, _ in ticks if k == u):
            if runs and (t - runs[-1][-1]).total_seconds() < gap:
                runs[-1].append(t)
            else:
                runs.append([t])
        want += [(u, r[0], r[-1], len(r)) for r in runs]
    assert got == [sorted(want)] * 3
