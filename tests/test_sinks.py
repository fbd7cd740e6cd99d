"""Table writes that stop half way leave the old version; the feed of changes loses none."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tickerloom.sources import files, sinks, versions

SCHEMA = "k long, v string, p int"


def rows(spark, df_or_path):
    return sorted(tuple(r) for r in df_or_path.select("k", "v", "p").collect())


def table(spark, path):
    old = spark.createDataFrame([(k, "old", k % 3) for k in range(12)], SCHEMA)
    sinks.create_table(spark, path, old.schema)
    sinks.replace_partitions(old, path, ["p"])
    return old.schema


def upsert(spark, path, schema, **more):
    source = spark.createDataFrame([(1, "new", 1), (4, "new", 1), (99, "new", 0)], SCHEMA)
    return sinks.upsert_table(spark, path, source, ["k"], ["p"], ["v"], schema=schema, **more)


WANT = sorted([(k, "new" if k in (1, 4) else "old", k % 3) for k in range(12)] + [(99, "new", 0)])


class Stop(Exception):
    pass


OLD = sorted((k, "old", k % 3) for k in range(12))
STEPS = ("delete", "exists", "children", "mark", "read_text", "write_new")


@pytest.mark.parametrize("step", range(11))
def test_stopped_at_any_step_and_run_again(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    schema = table(spark, path)
    versions.advance(spark, path, "reader", versions.newest(spark, path).number)
    count = [0]

    def stopping(real):
        def call(*a, **b):
            if count[0] == step:
                raise Stop
            count[0] += 1
            return real(*a, **b)

        return call

    for name in STEPS:
        monkeypatch.setattr(files, name, stopping(getattr(files, name)))
    try:
        upsert(spark, path, schema)
    except Stop:
        pass
    monkeypatch.undo()
    # old or new as a whole, and the feed tells which
    read = rows(spark, sinks.read_table(spark, path))
    listed = {r.k for r in versions.changes(spark, path, schema, "reader")[0].collect()}
    assert (read, listed) in ((OLD, set()), (WANT, {1, 4, 99}))
    upsert(spark, path, schema)
    assert rows(spark, sinks.read_table(spark, path)) == WANT
    feed, upto = versions.changes(spark, path, schema, "reader")
    assert {r.k for r in feed.collect()} == {1, 4, 99}
    versions.advance(spark, path, "reader", upto)
    assert versions.changes(spark, path, schema, "reader")[0].count() == 0


def test_readers_see_one_version_throughout_every_write(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = table(spark, path)
    before, seen = sinks.read_table(spark, path), []

    def looking(real):
        def call(*a, **b):
            monkeypatch.undo()
            seen.append(rows(spark, sinks.read_table(spark, path)))
            watch()
            return real(*a, **b)

        return call

    def watch():
        for name in STEPS:
            monkeypatch.setattr(files, name, looking(getattr(files, name)))

    watch()
    upsert(spark, path, schema)
    monkeypatch.undo()
    assert len(seen) >= 10 and all(state in (OLD, WANT) for state in seen)
    assert seen == sorted(seen, key=lambda state: state == WANT)
    # a frame made before the write still reads what was there then
    assert rows(spark, before) == OLD and rows(spark, sinks.read_table(spark, path)) == WANT


def test_folders_of_stopped_writes_are_removed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = table(spark, path)
    monkeypatch.setattr(files, "write_new", lambda *a: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        upsert(spark, path, schema)
    monkeypatch.undo()
    assert len(files.children(spark, f"{path}/data")) == 2
    upsert(spark, path, schema)
    assert len(files.children(spark, f"{path}/data")) == 2 and rows(spark, sinks.read_table(spark, path)) == WANT


def test_untouched_partitions_keep_their_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = table(spark, path)
    first = versions.newest(spark, path)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = files.children(spark, shared)
    assert upsert(spark, path, schema) == {"inserted": 1, "updated": 2, "unchanged": 6}
    assert files.children(spark, shared) == before
    second = versions.newest(spark, path)
    assert second.folders["p=2"] == first.folders["p=2"] and second.folders["p=1"] != first.folders["p=1"]
    # nothing differs now: no new version, no new folder
    kept = files.children(spark, f"{path}/data")
    assert upsert(spark, path, schema) == {"inserted": 0, "updated": 0, "unchanged": 9}
    assert versions.newest(spark, path) == second
    versions.tidy(spark, path)
    assert files.children(spark, f"{path}/data") == kept


def test_a_consumer_gets_each_change_until_it_moves_on(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = table(spark, path)

    def feed(consumer="c"):
        df, upto = versions.changes(spark, path, schema, consumer)
        return sorted(r.k for r in df.collect()), upto

    everything, upto = feed()
    assert everything == list(range(12))
    versions.advance(spark, path, "c", upto)
    assert feed() == ([], upto)
    for v in ("one", "two"):
        source = spark.createDataFrame([(1, v, 1), (2, "old", 2)], SCHEMA)
        sinks.upsert_table(spark, path, source, ["k"], ["p"], ["v"], schema=schema)
    assert feed()[0] == [1, 1] == feed()[0]
    versions.advance(spark, path, "c", feed()[1])
    # a replaced partition counts as changed, unless its rows say what was done
    sinks.replace_partitions(spark.createDataFrame([(1, "x", 1)], SCHEMA), path, ["p"])
    marked = spark.createDataFrame([(2, "old", 2, "N"), (5, "y", 2, "U")], SCHEMA + ", _action string")
    sinks.replace_partitions(marked, path, ["p"])
    assert feed()[0] == [1, 5] and sinks.read_table(spark, path).columns == ["k", "v", "p"]


def test_versions_a_consumer_needs_are_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "KEEP", 2)
    path = str(tmp_path / "t")
    schema = table(spark, path)
    versions.advance(spark, path, "slow", versions.newest(spark, path).number)

    def load(k):
        sinks.upsert_table(spark, path, spark.createDataFrame([(k, "v", 0)], SCHEMA), ["k"], ["p"], ["v"], schema=schema)

    for k in range(100, 106):
        load(k)
    assert sorted(r.k for r in versions.changes(spark, path, schema, "slow")[0].collect()) == list(range(100, 106))
    versions.forget(spark, path, "slow")
    load(106)
    load(107)
    assert len(versions.numbers(spark, path)) == 3 and len(files.children(spark, f"{path}/data")) <= 5
    # who comes back after its versions are gone gets the whole table
    versions.advance(spark, path, "late", 2)
    assert versions.changes(spark, path, schema, "late")[0].count() == sinks.read_table(spark, path).count() == 20


def test_a_batch_is_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = table(spark, path)
    assert upsert(spark, path, schema, batch=("stream", 4))["updated"] == 2
    other = spark.createDataFrame([(1, "again", 1)], SCHEMA)
    for batch, updated in ((("stream", 4), 0), (("stream", 3), 0), (("other", 1), 1), (("stream", 5), 0)):
        assert sinks.upsert_table(spark, path, other, ["k"], ["p"], ["v"], schema=schema, batch=batch)["updated"] == updated
    assert versions.newest(spark, path).batches == {"stream": 5, "other": 1}


def test_the_second_of_two_writers_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = table(spark, path)
    known = versions.newest(spark, path)
    upsert(spark, path, schema)
    with pytest.raises(FileExistsError):
        versions.publish(spark, path, known, schema, "_version=vx", ["p=1"])
    assert rows(spark, sinks.read_table(spark, path)) == WANT


def test_odd_partition_values_and_none(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, v string, p string, q date"
    some = [(1, "a", None, date(2024, 1, 1)), (2, "b", "x/y=z %", None), (3, "c", "ä:#", date(2024, 1, 2))]
    source = spark.createDataFrame(some, schema)
    sinks.create_table(spark, path, source.schema)
    for _ in range(2):
        sinks.upsert_table(spark, path, source, ["k"], ["p", "q"], ["v"])
    assert sorted(map(tuple, sinks.read_table(spark, path).collect()), key=repr) == sorted(some, key=repr)
    changed = sinks.upsert_table(spark, path, source.where("k = 2").withColumn("v", F.lit("new")), ["k"], ["p", "q"], ["v"])
    assert changed == {"inserted": 0, "updated": 1, "unchanged": 0}
    empty = str(tmp_path / "empty")
    sinks.create_table(spark, empty, source.schema)
    assert sinks.upsert_table(spark, empty, source.limit(0), ["k"], ["p", "q"], ["v"])["inserted"] == 0
    assert sinks.read_table(spark, empty).count() == 0


def test_contest_keeps_the_row_that_comes_first(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = table(spark, path)
    source = spark.createDataFrame([(1, "zzz", 1), (2, "aaa", 2), (50, "new", 2)], SCHEMA)
    sinks.upsert_table(spark, path, source, ["k"], ["p"], ["v"], schema=schema, contest=True)
    got = {k: v for k, v, _ in rows(spark, sinks.read_table(spark, path))}
    assert (got[1], got[2], got[50], got[0], len(got)) == ("old", "aaa", "new", "old", 13)


def test_few_files_for_each_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(0, 4000, 1, 64).selectExpr("id as k", "'x' as v", "cast(id % 7 as int) as p")
    sinks.create_table(spark, path, many.schema)
    sinks.replace_partitions(many, path, ["p"])
    folder = versions.newest(spark, path).folders["p=3"]
    assert all(len([f for f in files.children(spark, f"{path}/data/{folder}/p={p}") if f.startswith("part")]) == 1 for p in range(7))


def test_partitions_told_by_other_rows(spark, tmp_path, monkeypatch):
    """The source was kept and gone through twice to learn which partitions it touches."""
    path = str(tmp_path / "t")
    schema = table(spark, path)
    before = versions.newest(spark, path).folders
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *_: 1 / 0)
    # more partitions than the source has are read, and left as they are
    counts = upsert(spark, path, schema, near=spark.range(3).selectExpr("cast(id as int) as p"), unique=True)
    assert counts == {"inserted": 1, "updated": 2, "unchanged": 10} and rows(spark, sinks.read_table(spark, path)) == WANT
    after = versions.newest(spark, path).folders
    assert {p for p in after if after[p] != before[p]} == {"p=0", "p=1"}


def test_unique_rows_may_repeat(spark, tmp_path):
    path = str(tmp_path / "t")
    source = spark.createDataFrame([(1, "b", 1), (1, "a", 1), (2, "c", 0), (None, "d", 0), (None, "e", 0)], SCHEMA)
    sinks.create_table(spark, path, source.schema)
    sinks.upsert_table(spark, path, source, ["k"], ["p"], ["v"], unique=True)
    assert {tuple(r) for r in sinks.read_table(spark, path).select("k", "v", "p").collect()} == {(1, "a", 1), (2, "c", 0), (None, "d", 0)}


def test_states_told_by_other_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.create_table(spark, path, spark.createDataFrame([], "k long, n long, p int").schema)
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *_: 1 / 0)
    for n in (1, 2):
        some = spark.createDataFrame([(k, n, k % 2) for k in range(3 * n)], "k long, n long, p int")
        sinks.combine_into(spark, path, some, ["k", "p"], ["p"], {"n": F.sum("n")}, near=some)
    assert {(r.k, r.n) for r in sinks.read_table(spark, path).collect()} == {(k, 3 if k < 3 else 2) for k in range(6)}
