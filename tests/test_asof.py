from datetime import date, datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from tickerloom.operators.asof import asof_join, carried_forward, intervals, known_at, one_timeline

DAY0 = date(2019, 11, 20)


def sample(spark, seed, right_rows=40, entities=4, days=900):
    rng = Random(seed)
    left = [(rng.randrange(entities), DAY0 + timedelta(rng.randrange(days)), i) for i in range(200)]
    left.append((entities + 5, DAY0, 999))
    left.append((0, None, 1000))
    right = [
        (
            rng.randrange(entities),
            datetime(2019, 9, 1) + timedelta(days=rng.randrange(days), hours=rng.choice([0, 0, 16])),
            i,
        )
        for i in range(right_rows)
    ]
    return (
        left,
        right,
        spark.createDataFrame(left, "k int, d date, n int"),
        spark.createDataFrame(right, "k int, at timestamp_ntz, v int"),
    )


def brute(left, right):
    out = []
    for k, d, n in left:
        hits = [] if d is None else [(at, v) for rk, at, v in right if rk == k and at <= datetime(d.year, d.month, d.day)]
        out.append((n, max(hits)[1] if hits else None))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("slot_months", [1, 12])
def test_equals_brute_force(spark, seed, slot_months):
    left, right, l, r = sample(spark, seed)
    got = asof_join(l, r, ["k"], "d", "at", ["v"], slot_months=slot_months).select("n", "v").collect()
    assert sorted((x.n, x.v) for x in got) == brute(left, right)


@pytest.mark.parametrize("horizon", [date(2019, 1, 1), date(2020, 6, 1), date(2040, 1, 1)])
def test_horizon_does_not_change_the_result(spark, horizon):
    left, right, l, r = sample(spark, 7)
    got = asof_join(l, r, ["k"], "d", "at", ["v"], horizon=horizon).select("n", "v").collect()
    assert sorted((x.n, x.v) for x in got) == brute(left, right)


def test_inner_drops_rows_without_event(spark):
    left, right, l, r = sample(spark, 3)
    got = asof_join(l, r, ["k"], "d", "at", ["v"], how="inner").select("n", "v").collect()
    assert sorted((x.n, x.v) for x in got) == [x for x in brute(left, right) if x[1] is not None]


def test_filing_of_the_afternoon_counts_from_the_next_day(spark):
    l = spark.createDataFrame([(1, date(2024, 5, 2)), (1, date(2024, 5, 3))], "k int, d date")
    r = spark.createDataFrame([(1, datetime(2024, 5, 2, 16, 5), "q")], "k int, at timestamp_ntz, v string")
    got = {x.d: x.v for x in asof_join(l, r, ["k"], "d", "at").collect()}
    assert got == {date(2024, 5, 2): None, date(2024, 5, 3): "q"}


def test_equal_left_rows_are_kept(spark):
    l = spark.createDataFrame([(1, date(2024, 5, 3))] * 3, "k int, d date")
    r = spark.createDataFrame([(1, datetime(2024, 5, 2), "q")], "k int, at timestamp_ntz, v string")
    assert asof_join(l, r, ["k"], "d", "at").count() == 3


def test_intervals_do_not_overlap(spark):
    _, _, _, r = sample(spark, 1)
    rows = intervals(r, ["k"], "at", ["v"]).orderBy("k", "at").collect()
    for a, b in zip(rows, rows[1:]):
        assert a.k != b.k or a.valid_until == b["at"]


def test_one_timeline_equals_two_joins(spark):
    left, right, l, r = sample(spark, 11)
    _, right2, _, r2 = sample(spark, 12)
    r2 = r2.withColumnRenamed("v", "w")
    events = one_timeline({"a": (r, "at", ["v"]), "b": (r2, "at", ["w"])}, ["k"], "known")
    state = carried_forward(events, ["k"], "known", ["a", "b"])
    got = asof_join(l, state, ["k"], "d", "known").select("n", "a.v", "b.w").collect()
    assert sorted((x.n, x.v) for x in got) == brute(left, right)
    assert sorted((x.n, x.w) for x in got) == brute(left, right2)


def test_known_at(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), 1), ("a", date(2024, 3, 1), 2), ("b", date(2024, 5, 1), 3)], "k string, at date, v int")
    got = known_at(df, ["k"], "at", F.lit(date(2024, 4, 1))).collect()
    assert [(x.k, x.v) for x in got] == [("a", 2)]
