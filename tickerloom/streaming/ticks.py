"""Tick streams: bars, averages, sessions, deduplication, enrichment, upsert.

Every job takes and returns a streaming DataFrame; ``run_batches`` and ``run_files``
attach the sink. Event time is ``ts`` as ``timestamp``, which watermarks require.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import latest
from ..operators.quality import Rule, split_valid, validate
from ..session import work_dir
from ..sources.sinks import upsert_table


def file_ticks(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
    fmt: str = "parquet", files_per_trigger: int | None = None,
) -> DataFrame:
    """Landed files as a stream; each file is taken once per checkpoint."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def topic_ticks(spark: SparkSession, servers: str, topic: str, schema: T.StructType, group: str | None = None, per_batch: int = 1_000_000) -> DataFrame:
    """JSON ticks from a Kafka topic, from the latest offsets on. Needs the Kafka connector.

    A batch takes at most ``per_batch`` records, so that one after a pause has a bounded size.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("maxOffsetsPerTrigger", per_batch)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return parse_ticks(reader.load().select(F.col("value").cast("string").alias("value")), schema)


def parse_ticks(text: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON text to tick columns; text that does not parse keeps NULLs and ``raw_value``."""
    return text.select(F.from_json(column, schema).alias("_t"), F.col(column).alias("raw_value")).select(
        "_t.*", "raw_value"
    )


def bars(
    ticks: DataFrame, by: Sequence[str], price: str, volume: Column, tie: str,
    width: str = "1 day", lateness: str = "1 day",
) -> DataFrame:
    """Open, high, low, close and volume per entity and window.

    Ticks are combined per task before the shuffle, so a busy entity costs one partial
    bar per task and window.
    """
    at = F.struct("ts", tie)
    return (
        ticks.withWatermark("ts", lateness)
        .groupBy(F.window("ts", width).alias("w"), *by)
        .agg(
            F.min_by(price, at).alias("open_price"),
            F.max(price).alias("high_price"),
            F.min(price).alias("low_price"),
            F.max_by(price, at).alias("close_price"),
            F.sum(volume).alias("volume"),
        )
        .select(*by, F.col("w.start").alias("bar_start"), "open_price", "high_price", "low_price", "close_price", "volume")
    )


def sliding_average(
    ticks: DataFrame, by: Sequence[str], price: str, width: str = "20 minutes", slide: str = "1 minute",
    lateness: str = "20 minutes",
) -> DataFrame:
    """Sum and count of ticks per entity in overlapping windows; divide at read time."""
    return (
        ticks.withWatermark("ts", lateness)
        .groupBy(F.window("ts", width, slide).alias("w"), *by)
        .agg(F.sum(price).alias("price_sum"), F.count(price).alias("ticks"))
        .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "price_sum", "ticks")
    )


def tick_sessions(ticks: DataFrame, by: Sequence[str], gap: str, lateness: str = "1 day") -> DataFrame:
    """Runs of ticks without a pause of ``gap``, per entity.

    A task merges its own ticks into sessions before the shuffle, so a busy entity arrives
    as a few sessions; the setting for that is made on the session here.
    """
    ticks.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        ticks.withWatermark("ts", lateness)
        .groupBy(F.session_window("ts", gap).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("ticks"))
        .select(*by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "ticks")
    )


def without_repeats(ticks: DataFrame, keys: Sequence[str], lateness: str = "1 hour") -> DataFrame:
    """First arrival of each key; ``keys`` must hold the event time.

    Two ticks of a key have equal event times, so a key can be forgotten once the
    watermark passes it and no batch layout changes what counts as a repeat.
    """
    if "ts" not in keys:
        raise ValueError("keys must contain ts")
    return ticks.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(list(keys))


def enriched(ticks: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Ticks with the reference row of their entity; unknown entities keep NULLs."""
    return ticks.join(reference, key, "left")


def run_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all that is available to Parquet files, exactly once, then stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update",
    every: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``handle``; without ``every`` take what is available and stop."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def after_batches(running: StreamingQuery, n: int, seconds: float = 600) -> StreamingQuery:
    """Wait until a query has completed ``n`` batches since it started, or fail as it does."""
    ends = time.monotonic() + seconds
    while sum(p["numInputRows"] > 0 for p in running.recentProgress) < n:
        if running.exception() is not None:
            raise running.exception()
        if not running.isActive or time.monotonic() > ends:
            raise TimeoutError(f"fewer than {n} batches")
        time.sleep(0.05)
    return running


def batch_folders(path: str) -> Callable[[DataFrame, int], None]:
    """Handler that writes a batch to its own folder; a repeated batch replaces it."""

    def handle(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def newest_batches(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """What ``batch_folders`` wrote, the last batch winning per key."""
    stored = spark.read.schema(T.StructType(list(schema.fields)).add("batch_id", T.LongType())).parquet(path)
    return latest(stored, keys, [F.desc("batch_id")]).drop("batch_id")


def validated_batches(
    rules: Sequence[Rule], accept: Callable[[DataFrame, int], None], reject_path: str
) -> Callable[[DataFrame, int], None]:
    """Handler that sends clean rows to ``accept`` and writes rejects with their issues.

    The batch is cached for its two writes; a lost block is computed again from the source.
    """
    refuse = batch_folders(reject_path)

    def handle(df: DataFrame, batch_id: int) -> None:
        checked = validate(df, rules).persist()
        try:
            good, bad = split_valid(checked)
            accept(good, batch_id)
            refuse(bad, batch_id)
        finally:
            checked.unpersist()

    return handle


def upsert_batches(
    path: str, keys: Sequence[str], partition_by: Sequence[str], order: Sequence, schema: T.StructType
) -> Callable[[DataFrame, int], None]:
    """Handler that upserts a batch into a partitioned table; a repeated batch changes nothing.

    A stored row wins over a later batch only if it sorts first by ``order``.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        upsert_table(df.sparkSession, path, df, keys, partition_by, order, schema=schema, contest=True)

    return handle


def touched_keys(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """Handler that records which entities a batch touched, for later recomputation."""

    def handle(df: DataFrame, batch_id: int) -> None:
        df.select(key).distinct().write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def split_late(rows: DataFrame, newest_seen: Column, lateness: str) -> tuple[DataFrame, DataFrame]:
    """Rows in time, and rows older than the bound, which go to a side table for the batch upsert."""
    edge = newest_seen - F.expr(f"interval {lateness}")
    return rows.where(F.col("ts") >= edge), rows.where(F.col("ts") < edge)


def landed_files(
    spark: SparkSession, path: str, schema: T.StructType, target: str, checkpoint: str, fmt: str = "json",
    glob: str | None = None,
) -> StreamingQuery:
    """Load files that were not loaded before; the checkpoint remembers which were."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("multiLine", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return run_files(reader.load(path), target, checkpoint)


def new_paths(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """Fresh output and checkpoint folders in the shared working folder."""
    base = work_dir(spark, purpose)
    return f"{base}/out", f"{base}/checkpoint"
