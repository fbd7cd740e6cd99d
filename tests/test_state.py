"""Tables that streams keep: repeated batches, late rows, sizes, and metrics behind them."""

from datetime import date, datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from tickerloom.plans import daily, live
from tickerloom.sources import files, sinks, versions
from tickerloom.streaming import state

SCHEMA = "id long, ts timestamp, user long, price double"
START = datetime(2024, 1, 1)


def batches(n=5, size=60, seed=2):
    """Ticks in time order, some of them days late."""
    rng = Random(seed)
    out = [[] for _ in range(n)]
    for i in range(n * size):
        late = rng.choice([0, 0, 0, 1, 2])
        out[min(n - 1, i // size + late)].append((i, START + timedelta(minutes=30 * i), rng.randrange(3), float(rng.randrange(1, 90))))
    return out


def bars(rows):
    want = {}
    for i, ts, user, p in sorted(rows, key=lambda r: (r[1], r[0])):
        key = (user, ts.date())
        o, _, high, low, n = want.get(key, (p, p, p, p, 0))
        want[key] = (o, p, max(high, p), min(low, p), n + 1)
    return want


class Stop(Exception):
    pass


def stopped_once(monkeypatch, module, name, at):
    """The ``at``-th call of a function fails, the others run."""
    real, calls = getattr(module, name), [0]

    def call(*a, **b):
        calls[0] += 1
        if calls[0] == at:
            raise Stop
        return real(*a, **b)

    monkeypatch.setattr(module, name, call)


def given(spark, handle, rows, k):
    """A batch, repeated for as long as it stops."""
    df = spark.createDataFrame(rows, SCHEMA)
    for _ in range(3):
        try:
            return handle(df, k)
        except Stop:
            pass


def test_bars_merge_whatever_stops_or_repeats(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bars")
    handle = state.merged_batches(path, lambda df: state.partial_bars(df, ["user"], "price", F.lit(1), "id"), ["user", "bar_start"], state.BAR_STATES)
    feed = batches()
    stopped_once(monkeypatch, files, "write_new", 3)
    for k, rows in enumerate(feed):
        given(spark, handle, rows, k)
        given(spark, handle, rows, k)
    got = {(r.user, r.day): (r.open_price, r.close_price, r.high_price, r.low_price, r.ticks) for r in sinks.read_table(spark, path).collect()}
    assert got == bars([r for rows in feed for r in rows])


def test_the_table_of_bars_keeps_its_size(spark, tmp_path):
    path = str(tmp_path / "bars")
    handle = state.merged_batches(path, lambda df: state.partial_bars(df, ["user"], "price", F.lit(1), "id"), ["user", "bar_start"], state.BAR_STATES)
    sizes = []
    for k in range(6):
        handle(spark.createDataFrame([(k, START + timedelta(minutes=k), k % 2, 1.0)], SCHEMA), k)
        paths = [f"{path}/data/{folder}/{p}" for p, folder in versions.newest(spark, path).pairs()]
        sizes.append(sum(f.startswith("part") for p in paths for f in files.children(spark, p)))
    assert sizes == [1] * 6 and sinks.read_table(spark, path).agg(F.sum("ticks")).first()[0] == 6


def test_null_entities_and_empty_batches_are_merged(spark, tmp_path):
    path = str(tmp_path / "bars")
    handle = state.merged_batches(path, lambda df: state.partial_bars(df, ["user"], "price", F.lit(1), "id"), ["user", "bar_start"], state.BAR_STATES)
    handle(spark.createDataFrame([], SCHEMA), 0)
    for k in (1, 2):
        handle(spark.createDataFrame([(k, START, None, float(k)), (k, START, 1, None)], SCHEMA), k)
    got = {r.user: (r.ticks, r.high_price) for r in sinks.read_table(spark, path).collect()}
    assert got == {None: (2, 2.0), 1: (2, None)}


@pytest.mark.parametrize("at", [None, 4, 5, 6])
def test_late_rows_are_judged_by_earlier_batches(spark, tmp_path, monkeypatch, at):
    path, keys, part = str(tmp_path / "late"), ["id", "day"], ["day"]
    schema = spark.createDataFrame([], SCHEMA).withColumn("day", F.to_date("ts")).schema
    state.create_late(spark, path, schema, ["user"])
    judge = state.late_batches(path, ["user"], keys, part, ["ts"], "10 hours")
    feed = batches(4, 40)
    feed[2].append((9_000, START, None, 1.0))
    if at is not None:
        stopped_once(monkeypatch, files, "write_new", at)
    for k, rows in enumerate(feed):
        for _ in range(2):
            given(spark, lambda df, k: judge(df.withColumn("day", F.to_date("ts")), k), rows, k)
    newest, late = {}, set()
    for rows in feed:
        late |= {r[0] for r in rows if r[2] in newest and r[1] < newest[r[2]] - timedelta(hours=10)}
        for r in rows:
            if r[2] is not None:
                newest[r[2]] = max(newest.get(r[2], r[1]), r[1])
    ids = lambda name: sorted(r.id for r in sinks.read_table(spark, f"{path}/{name}").collect())
    everything = sorted(r[0] for rows in feed for r in rows)
    assert late and ids(state.LATE) == sorted(late) and ids(state.ON_TIME) == sorted(set(everything) - late)
    marks = {r.user: r.newest for r in sinks.read_table(spark, f"{path}/{state.MARKS}").collect()}
    assert marks == newest
    assert state.merge_late(spark, path, keys, part, ["ts"])["inserted"] == len(late)
    assert ids(state.ON_TIME) == everything
    assert state.merge_late(spark, path, keys, part, ["ts"]) == {"inserted": 0, "updated": 0, "unchanged": 0}


def test_live_metrics_touch_only_their_months(spark, tmp_path):
    root = str(tmp_path / "t")
    daily.create(spark, root)
    schema = "symbol string, ts timestamp, seq long, price decimal(12,2), volume long"
    handle = live.valued_batches(root)
    profile = spark.createDataFrame([(s, s) for s in ("AAA", "BBB")], "symbol string, company_name string")
    daily.store(spark, root, "profile", profile.withColumns({f.name: F.lit(None).cast(f.dataType) for f in daily.TABLES["profile"].schema.fields if f.name not in profile.columns}))
    daily.update_companies(spark, root, datetime(2024, 1, 1))

    def ticks(*rows):
        return spark.createDataFrame([(s, datetime(2024, m, d, h), h, p, 1) for s, m, d, h, p in rows], "symbol string, ts timestamp, seq int, price double, volume int").select(
            *[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])

    def closes():
        names = daily.read(spark, root, "dim_company").select("company_key", "symbol")
        return {(r.symbol, r.price_date): (float(r.open_price), float(r.close_price), r.change_amount and float(r.change_amount)) for r in daily.read(spark, root, "daily_prices").join(names, "company_key").collect()}

    handle(ticks(("AAA", 1, 10, 9, 10.0), ("AAA", 2, 1, 9, 12.0), ("BBB", 1, 10, 9, 5.0)), 0)
    first = dict(versions.newest(spark, f"{root}/{daily.TABLES['daily_prices'].folder}").folders)
    # a late tick of January is that day's first price, and a new one its last in February
    later = ticks(("AAA", 2, 1, 8, 11.0), ("AAA", 2, 1, 15, 14.0))
    for _ in range(2):
        handle(later, 1)
    second = versions.newest(spark, f"{root}/{daily.TABLES['daily_prices'].folder}").folders
    assert second["month=202401"] == first["month=202401"] and second["month=202402"] != first["month=202402"]
    assert closes() == {("AAA", date(2024, 1, 10)): (10, 10, None), ("BBB", date(2024, 1, 10)): (5, 5, None), ("AAA", date(2024, 2, 1)): (11, 14, 4)}
    # an earlier day's bar changes: the next day's change follows
    handle(ticks(("AAA", 1, 10, 12, 13.0)), 2)
    assert closes()["AAA", date(2024, 1, 10)] == (10, 13, None) and closes()["AAA", date(2024, 2, 1)] == (11, 14, 1)
