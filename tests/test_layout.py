"""Clustering, sketches, the backfill's ledger and membership on small tables."""

import re
from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickerloom.operators import membership
from tickerloom.sources import files, sinks, versions

DAY = date(2024, 1, 1)


def bars(spark, companies=64, days=128):
    rows = spark.range(companies * days).select((F.col("id") % companies).cast("int").alias("key"), F.date_add(F.lit(DAY), (F.col("id") / companies).cast("int")).alias("day"))
    return rows.select("key", "day", (F.col("key") * 2.5).alias("price"), F.lit(2024).alias("year"))


def opened(spark, path, test):
    """The share of a table's files whose smallest and largest values may hold what is read."""
    hit = total = 0
    for part, folder in versions.newest(spark, path).pairs():
        for name in files.children(spark, f"{path}/data/{folder}/{part}"):
            if name.startswith("part"):
                meta = pq.ParquetFile(f"{path}/data/{folder}/{part}/{name}").metadata.row_group(0)
                stats = {meta.column(i).path_in_schema: meta.column(i).statistics for i in range(meta.num_columns)}
                total += 1
                hit += test({c: (s.min, s.max) for c, s in stats.items() if s})
    return hit / total, total


def test_a_company_or_a_week_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = bars(spark)
    sinks.replace_partitions(df.orderBy(F.rand(1)), path, ["year"])
    versions.advance(spark, path, "c", versions.newest(spark, path).number)
    assert sinks.cluster_table(spark, path, ["year"], ["key", "day"], 64) == 1
    week = (DAY + timedelta(40), DAY + timedelta(46))
    company, total = opened(spark, path, lambda s: s["key"][0] <= 17 <= s["key"][1])
    days, _ = opened(spark, path, lambda s: s["day"][0] <= week[1] and s["day"][1] >= week[0])
    # 64 files cut both keys into about 8 ranges; a read may touch two of them, some ranges run over
    assert total >= 50 and company <= 0.3 and days <= 0.35, (total, company, days)
    assert sorted(map(tuple, sinks.read_table(spark, path).collect())) == sorted(map(tuple, df.collect()))
    assert versions.changes(spark, path, df.schema, "c")[0].count() == 0


def test_clustering_with_nulls_ties_and_chosen_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(None, None, None, 1)] * 3 + [(1, DAY, 2.0, 1)] * 5 + [(2, None, float("nan"), 2)]
    df = spark.createDataFrame(rows, "key int, day date, price double, year int")
    sinks.replace_partitions(df, path, ["year"])
    before = versions.newest(spark, path).folders
    assert sinks.cluster_table(spark, path, ["year"], ["key", "day", "price"], 4, ["year=1", "year=7"]) == 1
    after = versions.newest(spark, path).folders
    assert after["year=2"] == before["year=2"] and after["year=1"] != before["year=1"]
    assert sorted(map(repr, sinks.read_table(spark, path).collect())) == sorted(map(repr, df.collect()))
    assert sinks.cluster_table(spark, path, ["year"], ["key"], 4, []) == 0


def test_sketches_read_new_folders_only_and_merge(spark, tmp_path):
    path, side = str(tmp_path / "t"), str(tmp_path / "s")
    some = lambda low, high, year: spark.range(low, high).select("id", (F.col("id") % 7).alias("k"), F.lit(None).cast("string").alias("none"), F.lit(year).alias("part of year"))
    for year, (low, high) in enumerate(((0, 4000), (2000, 6000), (0, 10))):
        sinks.replace_partitions(some(low, high, year), path, ["part of year"])
    assert sinks.update_sketches(spark, path, side) == 3 and sinks.update_sketches(spark, path, side) == 0

    def profile():
        return {r.column_name: (r.row_count, r.present, r.approx_distinct) for r in sinks.profile_from_sketches(spark, path, side).collect()}

    got = profile()
    assert got["none"] == (8010, 0, 0) and got["k"] == (8010, 8010, 7) and got["part of year"][2] == 3
    assert got["id"][:2] == (8010, 8010) and abs(got["id"][2] - 6000) < 6000 * 0.06
    # one partition is written anew: one folder is read, and the old sketch counts no more
    sinks.replace_partitions(some(0, 100, 1), path, ["part of year"])
    assert sinks.update_sketches(spark, path, side) == 1
    assert profile()["id"][:2] == (4110, 4110) and abs(profile()["id"][2] - 4000) < 4000 * 0.06
    assert sinks.read_table(spark, side).count() == 3


def test_a_backfill_does_open_and_changed_slices(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    day = lambda n, v: spark.createDataFrame([(DAY + timedelta(n), v, n)], "day date, v int, n int")
    for n in range(6):
        sinks.replace_partitions(day(n, 1), source, ["n"])
    built = []

    def build(low, high):
        if stop and low >= stop:
            raise InterruptedError
        built.append(low)
        return sinks.read_table(spark, source).where(F.col("day").between(F.lit(low), F.lit(high))).drop("n").withColumn("d", F.col("day"))

    def position(low, high):
        return sinks.input_position(spark, source, lambda p: low <= DAY + timedelta(int(p[2:])) <= high)

    def fill():
        return sinks.backfill(build, DAY, DAY + timedelta(7), target, ["d"], 2, position)

    def state():
        return sorted((r.day, r.v) for r in sinks.read_table(spark, target).collect())

    stop = DAY + timedelta(4)
    with pytest.raises(InterruptedError):
        fill()
    stop = None
    assert len(state()) == 4 and fill() == 2 and fill() == 0 and len(state()) == 6
    sinks.replace_partitions(day(3, 9), source, ["n"])
    assert fill() == 2 and (DAY + timedelta(3), 9) in state() and fill() == 0
    # without a position every slice is written
    assert sinks.backfill(build, DAY, DAY + timedelta(7), target, ["d"], 2) == 6


def test_stays_with_gaps_repeats_and_odd_rows(spark):
    t = [DAY + timedelta(30 * k) for k in range(5)]
    lists = {0: "AB", 1: "ABB", 2: "A", 3: "", 4: "BA"}
    rows = [(s, t[k]) for k, names in lists.items() for s in names] + [(None, t[3]), ("A", None)]
    got = membership.intervals(spark.createDataFrame(rows, "symbol string, taken_at date"), ["symbol"])
    want = {("A", t[0], t[3], 3), ("A", t[4], None, 1), ("B", t[0], t[2], 2), ("B", t[4], None, 1)}
    assert {tuple(r[c] for c in ("symbol", "member_from", "member_to", "snapshots")) for r in got.collect()} == want
    days = spark.createDataFrame([("A", t[2]), ("A", t[3]), ("B", t[1] + timedelta(29)), ("B", t[2]), ("C", t[0]), ("A", t[4] + timedelta(900))], "symbol string, day date")
    met = membership.members_on(days, got, ["symbol"], "day", ["member_from", "member_to"]).collect()
    assert {(r.symbol, r.day, r.member_from) for r in met} == {("A", t[2], t[0]), ("B", t[1] + timedelta(29), t[0]), ("A", t[4] + timedelta(900), t[4])}
    assert membership.intervals(spark.createDataFrame([], "symbol string, taken_at date"), ["symbol"]).count() == 0


def test_a_place_takes_few_comparisons(spark):
    bounds = [float(k // 2 * 2 + 1) for k in range(0, 126, 2)]
    place = sinks._place(F.col("v"), bounds)
    values = [None, float("nan"), -5.0, 0.99, 1.0, 1.5, 61.0, 62.0, 125.0, 126.0, *bounds]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", place.alias("p"), sinks._place(F.col("v"), []).alias("none")).collect()
    for r in got:
        assert r.p == (0 if r.v is None else 63 if r.v != r.v else sum(r.v >= b for b in bounds)) and r.none == 0
    # each row is compared six times, not with all 63 bounds
    depth = deepest = 0
    for word in re.findall(r"\b(?:CASE|END)\b", str(place)):
        depth += 1 if word == "CASE" else -1
        deepest = max(deepest, depth)
    assert deepest == 6
