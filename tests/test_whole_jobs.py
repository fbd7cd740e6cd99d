"""Queries that do their whole job, each step once, on rows made here."""

import random
from datetime import datetime, timedelta

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks import layout, stored, streams
from tickerloom.llm import line_dedup
from tickerloom.sources import landing


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Trades of six companies over two and a half years, and 40 events in as many days."""
    at = str(tmp_path_factory.mktemp("trades"))
    rows = [
        (100 * k + m, k, 1, 10.0 + m % 7, 1000.0 + 10 * k + m, 0.05, 0.02, datetime(1995, 1, 10) + timedelta(days=30 * m))
        for k in range(6) for m in range(30)
    ]
    names = "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, names).write.parquet(f"{at}/lineitem.parquet")
    events = [(k, datetime(2024, 1, 1) + timedelta(days=k % 30), k % 3, "view", 1.0 + k, "") for k in range(40)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{at}/events.parquet")
    return at


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_histories_read_mapped_statements(spark, folder):
    """Four histories of fields that are still to be mapped made a plan that filled the driver."""
    df = entry.queries()["statement_versions"](spark, folder)
    text = optimized(df)
    assert "lineitem" not in text and "l_extendedprice" not in text and len(text) < 100_000
    assert df.count() > 0


def test_incremental_metrics_are_those_of_all_companies(spark, folder):
    got = {tuple(r) for r in entry.queries()["incremental_metrics"](spark, folder).collect()}
    want = entry.queries()["market_metrics"](spark, folder).select("company_key", "price_date", "market_cap", "pe_ratio_ttm").collect()
    assert got == {tuple(r) for r in want} and {r[0] for r in got} == set(range(6))


def test_snapshots_read_stored_lists(spark, folder, monkeypatch):
    plans, write = [], layout.sinks.write_snapshot
    monkeypatch.setattr(layout.sinks, "write_snapshot", lambda lists, *args: (plans.append(optimized(lists)), write(lists, *args)))
    assert entry.queries()["snapshot_files"](spark, folder).count() > 0
    assert plans and not any("Aggregate" in p for p in plans)


def test_arrivals_are_read_by_many_tasks(spark, folder, monkeypatch):
    """``coalesce(1)`` made one task read all events for each file."""
    plans, write = [], type(spark.range(1)).write
    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda df: (plans.append(optimized(df)), write.fget(df))[1]))
    stream = streams._arriving(spark, folder, streams._TEN, 10)
    assert stream.isStreaming and len(plans) == 10 and not any("Repartition 1, false" in p for p in plans)


def test_trades_are_read_by_many_tasks(spark, folder, tmp_path, monkeypatch):
    plans, write = [], type(spark.range(1)).write
    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda df: (plans.append(optimized(df)), write.fget(df))[1]))
    schema = stored.trades_in_files(spark, folder, str(tmp_path / "trades"))
    assert len(plans) == 3 and not any("Repartition 1, false" in p for p in plans)
    assert len([f for f in (tmp_path / "trades").iterdir() if f.suffix == ".parquet"]) == 3
    assert spark.read.schema(schema).parquet(str(tmp_path / "trades")).count() == 180


def test_landed_prices_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "work_dir", lambda _, purpose: str(tmp_path / purpose))
    rows = spark.range(300).selectExpr("concat('S', id) as symbol", "cast(id as string) as volume")
    path = stored.land(rows, spark, "price", "gzip")
    assert [f for f in (tmp_path / "landed-price").iterdir() if f.name.endswith(".txt.gz") and f.stat().st_size]
    back, _ = landing.read_feed(spark, path, "price")
    assert {(r.symbol, r.volume) for r in back.collect()} == {(f"S{k}", str(k)) for k in range(300)}


def test_pipeline_lines_by_simhash_and_what_it_leaves(spark, monkeypatch):
    rng, used, made = random.Random(3), [], line_dedup._occurrences
    monkeypatch.setattr(line_dedup, "_occurrences", lambda *a: (used.append(a), made(*a))[1])
    base = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(30)]
    rows = [(k, " ".join(base[:k] + ["other"] + base[k + 1 :])) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.distinct_lines(spark, docs, "").collect()] == [0] and used
