"""Streams fed in several batches must end where the batch query ends."""

from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.operators import quality
from tickerloom.sources import sinks
from tickerloom.streaming import ticks

SCHEMA = T.StructType(
    [T.StructField(n, t) for n, t in (("id", T.LongType()), ("ts", T.TimestampType()), ("user", T.LongType()), ("price", T.DoubleType()))]
)


@pytest.fixture
def feed(spark, tmp_path):
    """Three files of ticks, in time order up to small lateness, with repeats across files."""
    rng = Random(3)
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=7 * i + rng.randrange(5)), rng.randrange(4), float(rng.randrange(1, 100))) for i in range(600)]
    path = tmp_path / "feed"
    for n in range(3):
        part = rows[n * 200 : (n + 1) * 200] + (rows[n * 200 - 5 : n * 200] if n else [])
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))
    return rows, ticks.file_ticks(spark, str(path), SCHEMA, files_per_trigger=1)


def paths(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "check")


def test_bars(spark, feed, tmp_path):
    rows, stream = feed
    out, check = paths(tmp_path)
    once = ticks.without_repeats(stream, ["id", "ts"], "1 day")
    bars = ticks.bars(stream, ["user"], "price", F.lit(1), "id")
    ticks.run_batches(bars, ticks.batch_folders(out), check).awaitTermination()
    got = {(r.user, r.bar_start): (r.open_price, r.close_price, r.high_price) for r in ticks.newest_batches(spark, out, ["user", "bar_start"], bars.schema).collect()}
    want = {}
    for i, ts, user, p in sorted(rows, key=lambda r: (r[1], r[0])):
        key = (user, ts.replace(hour=0, minute=0))
        o, _, h = want.get(key, (p, p, p))
        want[key] = (o, p, max(h, p))
    assert got == want
    assert once.isStreaming


def test_repeats_across_batches_are_dropped(spark, feed, tmp_path):
    rows, stream = feed
    out, check = paths(tmp_path)
    once = ticks.without_repeats(stream, ["id", "ts"], "1 day")
    ticks.run_files(once, out, check).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [r[0] for r in rows]
    with pytest.raises(ValueError):
        ticks.without_repeats(stream, ["id"])


def test_upsert_keeps_the_newest_tick(spark, feed, tmp_path):
    rows, stream = feed
    out, check = paths(tmp_path)
    daily = stream.withColumn("day", F.to_date("ts"))
    sinks.create_table(spark, out, daily.schema)
    handle = ticks.upsert_batches(out, ["user", "day"], ["day"], [F.desc("ts"), F.desc("id")], daily.schema)
    ticks.run_batches(daily, handle, check, mode="append").awaitTermination()
    got = {(r.user, r.day): r.id for r in sinks.read_table(spark, out).collect()}
    want = {}
    for i, ts, user, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        want[(user, ts.date())] = i
    assert got == want


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), 1, 2.0)], SCHEMA).withColumn("day", F.to_date("ts"))
    out = str(tmp_path / "out")
    sinks.create_table(spark, out, df.schema)
    handle = ticks.upsert_batches(out, ["user", "day"], ["day"], [F.desc("ts")], df.schema)
    for _ in range(2):
        handle(df, 0)
    assert sinks.read_table(spark, out).count() == 1
    write = ticks.batch_folders(str(tmp_path / "b"))
    for _ in range(2):
        write(df, 5)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1


def test_rejects_touched_and_clean_rows_add_up(spark, feed, tmp_path):
    rows, stream = feed
    base, check = paths(tmp_path)
    rules = [quality.Rule("cheap", F.col("price") < 10, quality.say("too cheap"))]
    ticks.run_batches(
        stream, ticks.validated_batches(rules, ticks.batch_folders(f"{base}/good"), f"{base}/bad"), check, mode="append"
    ).awaitTermination()
    good, bad = spark.read.parquet(f"{base}/good"), spark.read.parquet(f"{base}/bad")
    assert good.count() + bad.count() == 610 and bad.where("price >= 10").count() == 0


def test_landed_files_load_once(spark, tmp_path):
    src, (out, check) = tmp_path / "in", paths(tmp_path)
    schema = T.StructType([T.StructField("a", T.LongType())])
    src.mkdir()
    (src / "1.json").write_text('[{"a": 1}, {"a": 2}]')
    ticks.landed_files(spark, str(src), schema, out, check).awaitTermination()
    (src / "2.json").write_text('[{"a": 3}]')
    ticks.landed_files(spark, str(src), schema, out, check).awaitTermination()
    assert sorted(r.a for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_parse_ticks_keeps_what_does_not_parse(spark):
    df = spark.createDataFrame([('{"id": 1, "price": 2.5}',), ("oops",)], "value string")
    got = ticks.parse_ticks(df, SCHEMA).collect()
    assert [(r.id, r.raw_value) for r in got] == [(1, '{"id": 1, "price": 2.5}'), (None, "oops")]


def test_late_rows_are_split_off(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), 1, 1.0), (2, datetime(2024, 1, 9), 1, 1.0)], SCHEMA)
    ok, late = ticks.split_late(df, F.lit(datetime(2024, 1, 10)), "2 days")
    assert [r.id for r in ok.collect()] == [2] and [r.id for r in late.collect()] == [1]
