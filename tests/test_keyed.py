from datetime import date
from random import Random

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import keyed
from tickerloom.operators.scd2 import apply_changes, change_counts, detect_changes, first_load
from tickerloom.plans.dims import company_versions


def table(spark, seed, n=60):
    rng = Random(seed)
    rows = {(rng.randrange(40), rng.randrange(3)): (rng.randrange(100), rng.choice(["x", None, "y"])) for _ in range(n)}
    return rows, spark.createDataFrame([(*k, *v) for k, v in rows.items()], "a int, b int, v int, w string")


@pytest.mark.parametrize("seed", range(3))
def test_upsert_equals_dict_update(spark, seed):
    old, target = table(spark, seed)
    new, source = table(spark, seed + 100)
    got = {(r.a, r.b): (r.v, r.w) for r in keyed.upsert(target, source, ["a", "b"]).collect()}
    assert got == {**old, **new}


def test_upsert_twice_changes_nothing(spark):
    _, target = table(spark, 1)
    _, source = table(spark, 2)
    once = keyed.upsert(target, source, ["a", "b"])
    counts = keyed.merge_counts(keyed.merged(once, source, ["a", "b"])).first()
    assert counts.inserted == 0 and counts.updated == 0 and counts.unchanged == once.count()


def test_upsert_columns_and_match_only(spark):
    old, target = table(spark, 1)
    new, source = table(spark, 2)
    got = {(r.a, r.b): (r.v, r.w) for r in keyed.upsert(target, source, ["a", "b"], update=["v"], insert=False).collect()}
    assert got == {k: (new[k][0] if k in new else v, w) for k, (v, w) in old.items()}


def test_upsert_takes_the_latest_of_repeated_keys(spark):
    target = spark.createDataFrame([(1, "old", 0)], "k int, v string, at int")
    source = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 1)], "k int, v string, at int")
    got = {r.k: r.v for r in keyed.upsert(target, source, ["k"], order=[F.desc("at")]).collect()}
    assert got == {1: "b", 2: "c"}


def test_latest_of_a_busy_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = keyed.latest(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [(r.k, r.row_count) for r in keyed.duplicates(df, ["k"]).collect()] == [(1, 2)]


def test_high_water_and_earliest(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 5)), ("a", date(2024, 1, 9)), ("b", None)], "s string, d date")
    got = {r.s: r.load_from for r in keyed.high_water(df, ["s"], "d", "2020-01-01").collect()}
    assert got == {"a": date(2024, 1, 10), "b": date(2020, 1, 1)}
    empty = df.where("1 = 0")
    assert keyed.earliest_of([(df, "d"), (empty, "d")], "2019-01-01").first().load_from == date(2024, 1, 5)
    assert keyed.earliest_of([(empty, "d")], "2019-01-01").first().load_from == date(2019, 1, 1)


def test_split_by_age_loses_nothing(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 6, 1)), (3, None)], "k int, d date")
    old, kept = keyed.split_by_age(df, "d", date(2024, 3, 1))
    assert [r.k for r in old.collect()] == [1] and sorted(r.k for r in kept.collect()) == [2, 3]


# ---- slowly changing dimension -----------------------------------------------------------

PROFILE = (
    "symbol string, company_name string, sector string, industry string, exchange string, market_cap bigint,"
    " headquarters_city string, headquarters_state string, headquarters_country string"
)


def profiles(spark, rows):
    return spark.createDataFrame([(s, n, sec, "Ind", "X", cap, None, None, None) for s, n, sec, cap in rows], PROFILE)


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_change_detection(spark):
    before = profiles(spark, [("A", "Apple", "Tech", 2_500), ("B", "Bee", "Tech", 100), ("C", "Cee", None, 0)])
    after = profiles(spark, [("A", "Apple", "Tech", 3_000), ("B", "Bee Inc", "Farm", 105), ("C", "Cee", None, 50), ("D", "New", "Tech", 1)])
    found = detect_changes(after, before)
    got = {r.symbol: (r.is_new, r.changed_fields, r.has_changes) for r in found.collect()}
    assert got == {
        "A": (False, ["market_cap"], True),
        "B": (False, ["name", "sector"], True),
        "C": (False, [], False),
        "D": (True, ["all"], True),
    }
    assert tuple(change_counts(found).first()) == (1, 2, 1)


def test_cap_is_not_watched_without_a_previous_cap(spark):
    before = profiles(spark, [("A", "Apple", "Tech", 2_500)]).drop("market_cap")
    assert detect_changes(profiles(spark, [("A", "Apple", "Tech", 9_999)]), before).first().changed_fields == []


def test_versions_stay_contiguous_over_many_loads(spark):
    rng = Random(5)
    state = {s: [s, "n0", "s0", 100] for s in "ABCDE"}
    previous = profiles(spark, [tuple(v) for v in state.values()])
    dim = first_load(company_versions(previous), at("2024-01-01 00:00:00"))
    for load in range(1, 4):
        for s in state:
            if rng.random() < 0.5:
                state[s][1] = f"n{load}"
        state[f"N{load}"] = [f"N{load}", "n", "s", 1]
        now = profiles(spark, [tuple(v) for v in state.values()])
        changed = detect_changes(now, previous).where("has_changes")
        dim = apply_changes(dim, company_versions(changed), at(f"2024-0{load + 1}-01 00:00:00"))
        previous = now
    rows = dim.orderBy("symbol", "valid_from").select(
        "symbol", "company_name", "is_current", "company_key", *[F.col(c).cast("string").alias(c) for c in ("valid_from", "valid_to")]
    ).collect()
    for s in state:
        mine = [r for r in rows if r.symbol == s]
        assert [r.is_current for r in mine] == [False] * (len(mine) - 1) + [True]
        assert all(a.valid_to == b.valid_from for a, b in zip(mine, mine[1:]))
        assert mine[-1].valid_to == "9999-12-31 00:00:00" and mine[-1].company_name == state[s][1]
        assert len({r.company_key for r in mine}) == 1


def test_one_new_and_one_changed_company(spark):
    before = profiles(spark, [("A", "a", "s", 1), ("B", "b", "s", 1)])
    dim = first_load(company_versions(before), at("2024-01-01 00:00:00"))
    after = profiles(spark, [("A", "a2", "s", 1), ("B", "b", "s", 1), ("C", "c", "s", 1)])
    out = apply_changes(dim, company_versions(detect_changes(after, before).where("has_changes")), at("2024-02-01 00:00:00"))
    assert out.count() == 4 and out.where("not is_current").count() == 1
    gone = apply_changes(dim, company_versions(after.limit(0)), at("2024-02-01 00:00:00"), present=after.where("symbol = 'A'"))
    assert [r.symbol for r in gone.where("not is_current").collect()] == ["B"]
