"""Streaming jobs run to the end of the sample events, compared with the batch result.

Output and checkpoints go to the shared working folder; results are read back from the
files the sinks wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.operators import quality
from tickerloom.sources import samples, sinks
from tickerloom.streaming import state, ticks

from .registry import query

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _ticks(spark, d):
    stream = ticks.file_ticks(spark, d, SCHEMA, glob="events.parquet")
    return stream.withColumns({"ts": F.col("ts").cast("timestamp"), "price": F.col("value").cast("decimal(12,2)")})


def _finish(q):
    q.awaitTermination()


_BARS = """select user_id, cast(ts as date) as bar_date, cast(arg_min(value, {'a': ts, 'b': event_id}) as double) as open_price,
  cast(max(value) as double) as high_price, cast(min(value) as double) as low_price,
  cast(arg_max(value, {'a': ts, 'b': event_id}) as double) as close_price, cast(sum(event_id % 100) as bigint) as volume
  from events group by 1, 2"""


@query("stream_daily_bars", _BARS)
def stream_daily_bars(spark, d):
    """Every batch writes the bars it changed; the last batch of a bar is its final state."""
    bars = ticks.bars(_ticks(spark, d), ["user_id"], "value", F.col("event_id") % 100, "event_id")
    out, check = ticks.new_paths(spark, "bars")
    _finish(ticks.run_batches(bars, ticks.batch_folders(out), check))
    rows = ticks.newest_batches(spark, out, ["user_id", "bar_start"], bars.schema)
    return rows.select(
        "user_id", F.col("bar_start").cast("date").alias("bar_date"), "open_price", "high_price", "low_price", "close_price", "volume"
    )


@query("stream_without_repeats", "select event_id, user_id, ts from events")
def stream_without_repeats(spark, d):
    """Each tick arrives twice and is kept once."""
    twice = _ticks(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = ticks.without_repeats(twice, ["event_id", "ts"]).select("event_id", "user_id", "ts")
    out, check = ticks.new_paths(spark, "once")
    _finish(ticks.run_files(once, out, check))
    return spark.read.schema(once.schema).parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "stream_enriched",
    """select event_id, user_id, symbol, sector from events left join
      (select company_key as user_id, symbol, sector from v_company) using (user_id)""",
)
def stream_enriched(spark, d):
    """All ticks with the company of their user; users beyond the companies have none."""
    reference = samples.companies(spark, d).select(
        F.col("company_key").alias("user_id"), "symbol", "sector"
    )
    rows = ticks.enriched(_ticks(spark, d), reference, "user_id").select("event_id", "user_id", "symbol", "sector")
    out, check = ticks.new_paths(spark, "enriched")
    _finish(ticks.run_files(rows, out, check))
    return spark.read.schema(rows.schema).parquet(out)


@query(
    "stream_sliding_average",
    """select event_type, window_start, cast(sum(cast(value as decimal(12,2))) as double) / count(*) as average, count(*) as ticks
      from (select event_type, value, unnest(generate_series(time_bucket(interval 6 hour, ts) - interval 18 hour, time_bucket(interval 6 hour, ts), interval 6 hour)) as window_start from events)
      group by 1, 2""",
)
def stream_sliding_average(spark, d):
    rows = ticks.sliding_average(_ticks(spark, d), ["event_type"], "price", "1 day", "6 hours")
    out, check = ticks.new_paths(spark, "sliding")
    _finish(ticks.run_batches(rows, ticks.batch_folders(out), check))
    last = ticks.newest_batches(spark, out, ["event_type", "window_start"], rows.schema)
    return last.select(
        "event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        (F.col("price_sum").cast("double") / F.col("ticks")).alias("average"), "ticks",
    )


@query(
    "stream_sessions",
    """with marked as (select user_id, ts, case when prev is null or date_diff('microsecond', prev, ts) >= 21600000000 then 1 else 0 end as starts
        from (select *, lag(ts) over (partition by user_id order by ts, event_id) as prev from events)),
      runs as (select user_id, ts, sum(starts) over (partition by user_id order by ts rows unbounded preceding) as no from marked)
      select user_id, min(ts) as session_start, max(ts) + interval 6 hour as session_end, count(*) as ticks from runs group by user_id, no
      having max(ts) + interval 6 hour <= (select max(ts) from events) - interval 1 day""",
)
def stream_sessions(spark, d):
    """Sessions the watermark has closed; the open ones stay in the state."""
    rows = ticks.tick_sessions(_ticks(spark, d), ["user_id"], "6 hours")
    out, check = ticks.new_paths(spark, "sessions")
    _finish(ticks.run_files(rows, out, check))
    return spark.read.schema(rows.schema).parquet(out).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    )


def _rules():
    return [
        quality.Rule("price_positive", F.col("value") <= 1, quality.say("Price too low")),
        quality.Rule("kind", F.col("event_type") == "error", quality.say("Not a tick")),
    ]


def _checked(spark, d):
    """Clean ticks to one folder, rejects to another, touched entities to a third."""
    base, check = ticks.new_paths(spark, "checked")
    keep, touch = ticks.batch_folders(f"{base}/good"), ticks.touched_keys(f"{base}/keys", "user_id")

    def accept(df, batch_id):
        keep(df, batch_id)
        touch(df, batch_id)

    rows = _ticks(spark, d).select("event_id", "user_id", "event_type", "value")
    _finish(ticks.run_batches(rows, ticks.validated_batches(_rules(), accept, f"{base}/bad"), check, mode="append"))
    return base


@query(
    "stream_rejects",
    """select event_id, concat_ws(',', case when value <= 1 then 'price_positive' end, case when event_type = 'error' then 'kind' end) as rules
      from events where value <= 1 or event_type = 'error'""",
)
def stream_rejects(spark, d):
    bad = spark.read.parquet(f"{_checked(spark, d)}/bad")
    return bad.select("event_id", F.array_join(F.transform("issues", lambda i: i["rule"]), ",").alias("rules"))


@query("stream_touched_entities", "select distinct user_id from events where value > 1 and event_type <> 'error'")
def stream_touched_entities(spark, d):
    return spark.read.parquet(f"{_checked(spark, d)}/keys").select("user_id").distinct()


@query(
    "stream_upsert",
    """select user_id, event_type, cast(ts as date) as day, arg_max(value, {'a': ts, 'b': event_id}) as value, max(ts) as ts from events group by 1, 2, 3""",
)
def stream_upsert(spark, d):
    """Latest tick per entity, kind and day; a batch rewrites the days it touches."""
    path, check = ticks.new_paths(spark, "upsert")
    rows = _ticks(spark, d).select("user_id", "event_type", "value", "event_id", "ts", F.to_date("ts").alias("day"))
    keys, order = ["user_id", "event_type", "day"], [F.desc("ts"), F.desc("event_id")]
    sinks.create_table(spark, path, rows.schema)
    handle = ticks.upsert_batches(path, keys, ["day"], order, rows.schema)
    _finish(ticks.run_batches(rows, handle, check, mode="append"))
    stored = sinks.read_table(spark, path)
    return stored.select(*keys, "value", F.col("ts").cast("timestamp_ntz").alias("ts"))


#: Bytes of a landed file that one task reads at least.
ROW_GROUP = 8 << 20


def _arriving(spark, d, arrival, n):
    """The events as a stream of ``n`` files that arrive one after the other."""
    path, _ = ticks.new_paths(spark, "arrivals")
    events = samples.table(spark, d, "events").select(*SCHEMA.names)
    for k in range(n):
        # read by many tasks, and written as one file that many tasks can read again
        files = events.where(F.expr(arrival) == k).repartition(1)
        files.write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(path)
    stream = ticks.file_ticks(spark, path, SCHEMA, files_per_trigger=1)
    return stream.withColumns({"ts": F.col("ts").cast("timestamp"), "price": F.col("value").cast("decimal(12,2)")})


# ten files of three days each; a seventh of the ticks comes nine days late
_TEN = "least(9, (day(ts) - 1) div 3 + case when event_id % 7 = 0 then 3 else 0 end)"


def _user_bars(df):
    return state.partial_bars(df, ["user_id"], "value", F.col("event_id") % 100, "event_id")


def _as_bars(rows):
    return rows.select("user_id", F.col("bar_start").cast("date").alias("bar_date"), "open_price", "high_price", "low_price", "close_price", "volume")


@query("stream_bars_merged", _BARS)
def stream_bars_merged(spark, d):
    """Ten batches, late ticks among them, merged into one row per bar."""
    out, check = ticks.new_paths(spark, "merged")
    handle = state.merged_batches(out, _user_bars, ["user_id", "bar_start"], state.BAR_STATES)
    _finish(ticks.run_batches(_arriving(spark, d, _TEN, 10), handle, check, mode="append"))
    return _as_bars(sinks.read_table(spark, out))


@query("stream_bars_restarted", _BARS)
def stream_bars_restarted(spark, d):
    """Two files a batch by the clock, stopped after the second batch and started again."""
    out, check = ticks.new_paths(spark, "restarted")
    stream = _arriving(spark, d, _TEN, 10)
    handle = state.merged_batches(out, _user_bars, ["user_id", "bar_start"], state.BAR_STATES)
    running = ticks.run_batches(stream, handle, check, mode="append", every="100 milliseconds")
    ticks.after_batches(running, 2).stop()
    _finish(ticks.run_batches(stream, handle, check, mode="append"))
    return _as_bars(sinks.read_table(spark, out))


@query(
    "stream_averages_merged",
    """select event_type, window_start, cast(sum(cast(value as decimal(12,2))) as double) / count(*) as average, count(*) as ticks
      from (select event_type, value, unnest(generate_series(time_bucket(interval 6 hour, ts) - interval 18 hour, time_bucket(interval 6 hour, ts), interval 6 hour)) as window_start from events)
      group by 1, 2""",
)
def stream_averages_merged(spark, d):
    """Sliding averages over ten batches, late ticks among them."""
    out, check = ticks.new_paths(spark, "averages")
    partial = lambda df: state.partial_averages(df, ["event_type"], "price", "1 day", "6 hours")
    handle = state.merged_batches(out, partial, ["event_type", "window_start", "window_end"], state.AVERAGE_STATES)
    _finish(ticks.run_batches(_arriving(spark, d, _TEN, 10), handle, check, mode="append"))
    return sinks.read_table(spark, out).select(
        "event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        (F.col("price_sum").cast("double") / F.col("ticks")).alias("average"), "ticks",
    )


# six files of five days each; a tenth of the ticks comes ten days late
_SIX = "least(5, (day(ts) - 1) {div} 5 + case when event_id % 10 = 3 then 2 else 0 end)"


@query(
    "stream_late_rows",
    f"""select event_id, user_id, ts, coalesce(ts < newest - interval 5 day, false) as late
      from (select *, max(ts) over (partition by user_id order by arrival range between unbounded preceding and 1 preceding) as newest
        from (select *, {_SIX.format(div="//")} as arrival from events))""",
)
def stream_late_rows(spark, d):
    """All ticks after the late ones, set aside by each user's newest time, are merged by a batch."""
    out, check = ticks.new_paths(spark, "late")
    stream = _arriving(spark, d, _SIX.format(div="div"), 6).select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    keys, part = ["event_id", "day"], ["day"]
    state.create_late(spark, out, stream.schema, ["user_id"])
    _finish(ticks.run_batches(stream, state.late_batches(out, ["user_id"], keys, part, ["ts"], "5 days"), check, mode="append"))
    late = sinks.read_table(spark, f"{out}/{state.LATE}").select("event_id", F.lit(True).alias("late"))
    state.merge_late(spark, out, keys, part, ["ts"])
    rows = sinks.read_table(spark, f"{out}/{state.ON_TIME}").join(late, "event_id", "left")
    return rows.select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.coalesce("late", F.lit(False)).alias("late"))


@query(
    "late_ticks",
    "select event_id, user_id from events where ts < (select max(ts) from events) - interval 10 day",
)
def late_ticks(spark, d):
    """Ticks older than the lateness bound, which go to the batch upsert."""
    e = samples.table(spark, d, "events")
    newest = e.agg(F.max("ts")).scalar()
    _, late = ticks.split_late(e.select("event_id", "user_id", "ts"), newest, "10 days")
    return late.drop("ts")


@query("landed_files", "select event_id, user_id, event_type from events")
def landed_files(spark, d):
    """Files are loaded once: the second run of the same job finds nothing new."""
    out, check = ticks.new_paths(spark, "landed")
    for _ in range(2):
        _finish(ticks.landed_files(spark, d, SCHEMA, out, check, fmt="parquet", glob="events.parquet"))
    return spark.read.schema(SCHEMA).parquet(out).select("event_id", "user_id", "event_type")
