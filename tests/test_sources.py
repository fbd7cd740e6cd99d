import gzip
import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickerloom import schemas
from tickerloom.sources import landing, mapping, sinks, versions

AT = datetime(2024, 1, 1, 6)


def at():
    return F.lit(AT).cast("timestamp_ntz")


def mapped(spark, feed, payload):
    df = spark.createDataFrame([(json.dumps(payload),)], "p string")
    records, rejects = landing.parse_feed(df, "p", feed)
    raw, staged, unmapped = mapping.map_feed(records, feed, at())
    return raw.collect(), staged.collect(), rejects.collect() + unmapped.collect()


def test_profile(spark):
    payload = {
        "symbol": "AAPL", "companyName": "Apple Inc.", "sector": "Technology", "marketCap": 2_500_000_000_000,
        "fullTimeEmployees": "150000", "city": "Cupertino", "state": "CA", "country": "US", "unknown": [1],
    }
    (raw,), (row,), bad = mapped(spark, "profile", [payload])
    assert row.symbol == "AAPL" and row.employees == 150_000 and row.headquarters_state == "CA"
    assert row.market_cap == Decimal("2500000000000.00") and row.website is None and not bad
    body = json.loads(raw.raw_data)
    assert raw.api_source == "FMP" and body["company_name"] == "Apple Inc." and body["website"] is None
    assert raw.loaded_timestamp == AT


@pytest.mark.parametrize(("given", "expected"), [(150, 150), ("", None), (0, None), ("0", None), (None, None)])
def test_employees(spark, given, expected):
    _, (row,), _ = mapped(spark, "profile", {"symbol": "A", "fullTimeEmployees": given})
    assert row.employees == expected


def test_price_defaults(spark):
    df = spark.createDataFrame([("AAPL", json.dumps({"historical": [{"date": "2024-01-02", "close": 10.5, "open": 10}]}))], "s string, p string")
    records, _ = landing.parse_feed(df, "p", "price", symbol="s")
    _, staged, _ = mapping.map_feed(records, "price", at())
    row = staged.first()
    assert (row.symbol, row.price_date) == ("AAPL", date(2024, 1, 2))
    assert row.adj_close == Decimal("10.50") and row.high_price == 0 and row.volume == 0 and row.change_percent is None


def test_income(spark):
    payload = {
        "symbol": "AAPL", "date": "2024-03-31", "filingDate": "2024-05-02", "acceptedDate": "2024-05-02 16:05:11",
        "revenue": 90753000000, "epsDiluted": 1.53, "weightedAverageShsOut": 15405856000,
    }
    _, (row,), bad = mapped(spark, "income", payload)
    assert row.period == "FY" and row.accepted_date == datetime(2024, 5, 2, 16, 5, 11) and not bad
    assert row.eps_diluted == Decimal("1.5300") and row.shares_outstanding == 15405856000 and row.net_income is None


def test_unreadable_time_rejects_the_record(spark):
    _, staged, bad = mapped(spark, "income", {"symbol": "A", "date": "2024-03-31", "acceptedDate": "2024-05-02"})
    assert not staged and bad[0].reject_reason == "unreadable acceptedDate"
    assert json.loads(bad[0].detail)["acceptedDate"] == "2024-05-02"


def test_zero_falls_through(spark):
    _, (row,), _ = mapped(spark, "balance", {"symbol": "A", "date": "2024-03-31", "totalEquity": 0, "totalStockholdersEquity": 7})
    assert row.total_equity == 7
    _, (row,), _ = mapped(spark, "cashflow", {"symbol": "A", "date": "2024-03-31", "commonDividendsPaid": -3, "netDividendsPaid": -4, "dividendsPaid": -9})
    assert row.dividends_paid == -3


def test_missing_keys_are_rejected_and_counted(spark):
    payload = [{"symbol": "A", "date": "2024-03-31"}, {"date": "2024-03-31"}, {"symbol": "B"}]
    df = spark.createDataFrame([(json.dumps(payload),)], "p string")
    records, rejects = landing.parse_feed(df, "p", "cashflow")
    _, staged, unmapped = mapping.map_feed(records, "cashflow", at())
    assert rejects.count() == 0
    assert sorted(r.reject_reason for r in unmapped.collect()) == ["missing date", "missing symbol"]
    assert tuple(mapping.mapping_stats(staged, unmapped).first()) == (1, 2)


def test_unknown_feed(spark):
    with pytest.raises(ValueError):
        mapping.map_feed(spark.range(1), "other", at())


def test_landed_files_of_every_shape(spark, tmp_path):
    bar = {"date": "2024-01-02", "close": 1.5}
    (tmp_path / "AAPL.json").write_text(json.dumps([bar, {**bar, "date": "2024-01-03"}]))
    (tmp_path / "MSFT.json").write_text(json.dumps({"symbol": "MSFT", "historical": [bar]}))
    (tmp_path / "ONE.json").write_text(json.dumps(bar))
    (tmp_path / "ERR.json").write_text(json.dumps({"Error Message": "Limit Reach"}))
    (tmp_path / "BAD.json").write_text('[{"date": "2024-')
    with gzip.open(tmp_path / "GZ.json.gz", "wt") as f:
        json.dump([bar], f)
    records, rejects = landing.read_feed(spark, str(tmp_path), "price", symbol_from_file=r"([A-Z]+)\.json")
    assert sorted((r.symbol, r.date) for r in records.collect()) == [
        ("AAPL", "2024-01-02"), ("AAPL", "2024-01-03"), ("GZ", "2024-01-02"), ("MSFT", "2024-01-02"), ("ONE", "2024-01-02"),
    ]
    assert sorted(r.reject_reason for r in rejects.collect()) == ["error payload", "malformed payload"]


def test_many_profiles_skip_failures(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"symbol": "A"}]))
    (tmp_path / "b.json").write_text(json.dumps([{"companyName": "no symbol"}]))
    records, rejects = landing.read_feed(spark, str(tmp_path), "profile", symbol_required=True)
    assert [r.symbol for r in records.collect()] == ["A"] and [r.reject_reason for r in rejects.collect()] == ["missing symbol"]


def test_bulk_lines_go_on_after_a_bad_line(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"SYMBOL": "A", "date": "2024-01-01"}\nnot json\n{"symbol": "B", "date": "2024-01-01"}\n')
    records, rejects = landing.read_lines(spark, str(tmp_path), "price")
    assert sorted(r.symbol for r in records.collect()) == ["A", "B"]
    assert rejects.count() == 1


def test_statement_periods(spark):
    rows = [("A", f"202{y}-12-31", p) for y in range(4) for p in ("FY", "Q4")] + [("A", "2019-12-31", None)]
    df = spark.createDataFrame(rows, "symbol string, date string, period string")
    assert sorted(r.date for r in landing.statement_periods(df, "annual", 2).collect()) == ["2022-12-31", "2023-12-31"]
    assert landing.statement_periods(df, "annual").count() == 5
    assert {r.period for r in landing.statement_periods(df, "quarterly").collect()} == {"Q4"}


def test_vendor_metrics_take_any_field(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"symbol": "A", "currentRatioTTM": 0.92, "note": "x", "newFieldTTM": 3, "noneTTM": None}]))
    got = sorted((tuple(r) for r in landing.read_metrics(spark, str(tmp_path)).collect()), key=repr)
    assert got == [("A", "currentRatioTTM", 0.92, None), ("A", "newFieldTTM", 3.0, None), ("A", "noneTTM", None, None), ("A", "note", None, "x")]


def test_rates_long(spark):
    df = spark.createDataFrame([("2024-01-02", 5.5, None)], "date string, month1 double, year10 double")
    assert [tuple(r) for r in landing.rates_long(df).collect()] == [("2024-01-02", "month1", 5.5), ("2024-01-02", "year10", None)]


def test_payloads_are_kept_as_they_came(spark, tmp_path):
    texts = {"A": '[{"symbol": "A", "new": {"x": 1}}, {"price": 2.5}]', "B": '{"symbol": "", "new": "text"}', "C": '[{"symbol": ', "D": "[]"}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows = landing.read_payloads(spark, str(tmp_path), r"([A-Z])\.json")
    got = landing.fields(rows, "payload", {"x": ("$.new.x", "int"), "new": ("$.new", "string"), "price": ("$.price", "double")})
    found = sorted((tuple(r) for r in got.select("symbol", "x", "new", "price", "unparsed", "source_file").collect()), key=repr)
    assert found == sorted([
        ("A", 1, '{"x":1}', None, None, "A.json"), ("A", None, None, 2.5, None, "A.json"), ("B", None, "text", None, None, "B.json"),
        ("C", None, None, None, '[{"symbol": ', "C.json"),
    ], key=repr)


def test_conform(spark):
    df = spark.createDataFrame([("A", 1)], "symbol string, extra int")
    out = schemas.conform(df, schemas.STAGING["profile"])
    assert out.schema.names == schemas.STAGING["profile"].names and out.first().market_cap is None


# ---- sinks -------------------------------------------------------------------------------

def prices(spark, rows):
    return spark.createDataFrame(rows, "symbol string, day date, close int, at int").withColumn("year", F.year("day"))


def test_append_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, ("x",))], "k int, raw struct<a string>")
    assert sinks.append(df, path, json_columns=["raw"]) == 1 and sinks.append(df, path, json_columns=["raw"]) == 1
    assert [r.raw for r in spark.read.parquet(path).collect()] == ['{"a":"x"}'] * 2


def test_upsert_table_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    start = prices(spark, [("A", date(2022, 1, 1), 1, 0), ("A", date(2023, 1, 1), 2, 0), ("B", date(2023, 1, 1), 3, 0), ("A", date(2024, 1, 1), 4, 0)])
    sinks.replace_partitions(start, path, ["year"])
    untouched = [versions.newest(spark, path).folders[f"year={y}"] for y in (2022, 2024)]
    coming = prices(spark, [("A", date(2023, 1, 1), 20, 1), ("A", date(2023, 1, 1), 19, 0), ("C", date(2023, 5, 1), 30, 0), ("C", date(2025, 1, 1), 31, 0)])
    args = (spark, path, coming, ["symbol", "day"], ["year"], [F.desc("at")])
    assert sinks.upsert_table(*args) == {"inserted": 2, "updated": 1, "unchanged": 1}
    got = sorted((r.symbol, str(r.day), r.close) for r in sinks.read_table(spark, path).collect())
    assert got == [("A", "2022-01-01", 1), ("A", "2023-01-01", 20), ("A", "2024-01-01", 4), ("B", "2023-01-01", 3), ("C", "2023-05-01", 30), ("C", "2025-01-01", 31)]
    assert untouched == [versions.newest(spark, path).folders[f"year={y}"] for y in (2022, 2024)]
    assert sinks.upsert_table(*args)["unchanged"] == 4


def test_replace_partitions_and_backfill(spark, tmp_path):
    path = str(tmp_path / "t")

    def build(low, high):
        return spark.sql(f"select explode(sequence(date'{low}', date'{high}')) as day")

    slices = list(sinks.date_slices(date(2024, 1, 1), date(2024, 1, 10), 4))
    assert slices == [(date(2024, 1, 1), date(2024, 1, 4)), (date(2024, 1, 5), date(2024, 1, 8)), (date(2024, 1, 9), date(2024, 1, 10))]
    for _ in range(2):
        n = sinks.backfill(lambda a, b: build(a, b).withColumn("d", F.col("day")), date(2024, 1, 1), date(2024, 1, 10), path, ["day"], 4)
        assert n == 10
    assert sinks.read_table(spark, path).count() == 10


def test_archive(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 6, 1)), (3, None)], "k int, d date")
    for _ in range(2):
        counts = sinks.archive(df, "d", date(2024, 3, 1), str(tmp_path / "old"), str(tmp_path / "kept"))
        assert counts == {"archived": 1, "kept": 2}
    assert spark.read.parquet(str(tmp_path / "old")).count() == 1
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 2
    assert sinks.sample_rows(df, 2).count() == 2


def test_versions_keep_what_was_known_before_a_restatement(spark):
    def load(accepted, revenue, at):
        payload = {"symbol": "A", "date": "2024-03-31", "period": "Q1", "acceptedDate": accepted, "revenue": revenue}
        df = spark.createDataFrame([(json.dumps(payload),)], "p string")
        records, _ = landing.parse_feed(df, "p", "income")
        return mapping.map_feed(records, "income", F.lit(at).cast("timestamp_ntz"))[0]

    raw = load("2024-05-01 16:00:00", 10, datetime(2024, 5, 2)).unionByName(load("2024-05-01 16:00:00", 11, datetime(2024, 5, 3)))
    raw = raw.unionByName(load("2024-09-01 16:00:00", 20, datetime(2024, 9, 2)))
    got = sorted((r.accepted_date, r.revenue) for r in mapping.statement_versions(raw, "income").collect())
    assert got == [(datetime(2024, 5, 1, 16), 11), (datetime(2024, 9, 1, 16), 20)]


def test_layout_spreads_a_busy_key(spark, tmp_path):
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    for spread, enough in ((1, lambda n: n == 1), (8, lambda n: n > 2)):
        rows = sinks.laid_out(df, ["k"], ["id"], spread, partitions=8)
        assert enough(rows.select(F.spark_partition_id().alias("p")).distinct().count())


def test_snapshot_profile_and_copy(spark, tmp_path):
    df = spark.createDataFrame([("B",), ("A",), (None,), ("A",)], "symbol string")
    sinks.write_snapshot(df, str(tmp_path / "s"), "2024-01-01")
    got = spark.read.json(str(tmp_path / "s")).orderBy("symbol").collect()
    assert [(r.symbol, r.member_count) for r in got] == [("A", 2), ("B", 2)]
    df.write.parquet(str(tmp_path / "p"))
    sinks.copy_table(spark, str(tmp_path / "p"), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 4
    (r,) = sinks.table_profile(df).collect()
    assert (r.column_name, r.row_count, r.present, r.approx_distinct) == ("symbol", 4, 3, 2)
    assert [r.data_type for r in sinks.table_columns(spark, df).collect()] == ["string"]


def test_unreadable_or_too_large_measures_reject_the_record(spark):
    rows = [("AAA", "2024-01-02", "abc", "5"), ("BBB", "2024-01-02", "1", "123456789.5"), ("CCC", "2024-01-02", "1.5", "2"), ("DDD", "2024-01-02", None, "")]
    schema = landing.PAYLOADS["price"]
    names = [f.name for f in schema.fields]
    df = spark.createDataFrame([tuple({"symbol": s, "date": d, "open": o, "close": c}.get(n) for n in names) for s, d, o, c in rows], schema)
    _, staged, bad = mapping.map_feed(df, "price", F.lit(datetime(2024, 1, 3)).cast("timestamp_ntz"))
    assert sorted((r.symbol, r.reject_reason) for r in bad.collect()) == [("AAA", "unreadable open"), ("BBB", "unreadable close")]
    assert {r.symbol for r in staged.collect()} == {"CCC", "DDD"}
    whole = spark.createDataFrame([("AAA", "9" * 30), ("BBB", "12.0")], "symbol string, v string")
    assert [r[0] for r in whole.select(mapping.whole("v")).collect()] == [None, 12]


def test_market_caps_are_whole_without_a_limit(spark):
    df = spark.createDataFrame([("A", f"2020-{m:02d}-{d:02d}", 1) for m in range(1, 13) for d in range(1, 29)], "symbol string, date string, marketCap long")
    assert landing.historical_market_cap(df).count() == 336
    assert landing.historical_market_cap(df, limit=100).count() == 100


def test_payload_text_is_parsed_once_not_for_each_record(spark):
    """A parse above the generator runs again for every record of the text."""
    texts = spark.createDataFrame([('[{"symbol": "A", "x": 1}, {"x": 2}]', "f"), ("no json", "g")], "value string, source_file string")
    rows = landing.payload_records(texts)
    above = rows._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "parsejson" not in above.lower() and "parse_json" not in above.lower()
    got = sorted((r.source_file, r.symbol or "", r.payload is None, r.unparsed or "") for r in rows.collect())
    assert got == [("f", "", False, ""), ("f", "A", False, ""), ("g", "", True, "no json")]


def test_landed_files_follow_the_records_not_the_companies(spark, tmp_path, monkeypatch):
    from checks import stored

    monkeypatch.setattr(stored, "work_dir", lambda _, purpose: str(tmp_path / purpose))
    rows = spark.range(300).selectExpr("concat('S', id) as symbol", "id as volume")
    path = stored.land(rows, spark, "price")
    files = [f for f in (tmp_path / "landed-price").iterdir() if f.name.endswith(".txt") and f.stat().st_size]
    assert len(files) == 1
    back = landing.payload_records(spark.read.option("wholetext", True).text(path))
    assert {r.symbol for r in back.collect()} == {f"S{k}" for k in range(300)}
