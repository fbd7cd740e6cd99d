"""Job audit tables derived from job events, and the reports over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arith import dbl
from ..operators.keyed import newest_n, top_n

SUCCESS, FAILED, PARTIAL = "SUCCESS", "FAILED", "PARTIAL"
# Longest text the audit tables keep.
MESSAGE_LENGTH = 5000
DESCRIPTION_LENGTH = 1000


def _seconds(microseconds: Column) -> Column:
    """Seconds to two places, rounded in decimal."""
    return F.round(microseconds * F.lit("0.000001").cast("decimal(7,6)"), 2)


def job_history(events: DataFrame) -> DataFrame:
    """One row per job run from its phase events.

    ``events``: job_id, job_name, phase (EXTRACT, TRANSFORM, LOAD), started_at, ended_at,
    records, error (NULL if none), fatal (did the error end the run).
    """
    failed = F.count_if(F.coalesce("fatal", F.lit(False))) > 0
    errors = F.count("error")

    def records(phase: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("phase") == phase, F.col("records"))), F.lit(0))

    def seconds(phase: str) -> Column:
        took = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at"))
        return _seconds(F.sum(F.when(F.col("phase") == phase, took)))

    runs = events.groupBy("job_id", "job_name").agg(
        F.min("started_at").alias("start_time"),
        F.max("ended_at").alias("end_time"),
        records("EXTRACT").alias("records_extracted"),
        records("TRANSFORM").alias("records_transformed"),
        records("LOAD").alias("records_loaded"),
        errors.alias("error_count"),
        failed.alias("_failed"),
        seconds("EXTRACT").alias("extract_duration"),
        seconds("TRANSFORM").alias("transform_duration"),
        seconds("LOAD").alias("load_duration"),
    )
    some_errors = F.col("error_count") > 0
    status = (
        F.when(F.col("_failed") | (some_errors & (F.col("records_loaded") == 0)), FAILED)
        .when(some_errors, PARTIAL)
        .otherwise(SUCCESS)
    )
    took = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time"))
    return runs.withColumns(
        {"status": status, "duration_seconds": _seconds(took)}
    ).drop("_failed")


def job_errors(events: DataFrame) -> DataFrame:
    """One row per error; a long message is cut and its full text kept as JSON."""
    text = F.col("error")
    long = F.length(text) > MESSAGE_LENGTH
    return events.where(text.isNotNull()).select(
        "job_id",
        F.col("ended_at").alias("error_timestamp"),
        F.lit("ETL_ERROR").alias("error_type"),
        F.substring(text, 1, MESSAGE_LENGTH).alias("error_message"),
        F.when(long, F.to_json(F.struct(text.alias("full_error")))).otherwise("{}").alias("error_details"),
    )


def job_metrics(reported: DataFrame, metrics: str = "metrics") -> DataFrame:
    """One row per metric of a map from name to (value, unit, phase); unit and phase may be missing."""
    return reported.select("job_id", "recorded_at", F.explode(metrics).alias("metric_name", "_m")).select(
        "job_id",
        "metric_name",
        F.col("_m.value").cast("decimal(20,4)").alias("metric_value"),
        F.coalesce("_m.unit", F.lit("")).alias("metric_unit"),
        F.coalesce("_m.phase", F.lit("")).alias("phase"),
        "recorded_at",
    )


def quality_issues(issues: DataFrame, job_id: Column, table: str, record: Column, at: Column) -> DataFrame:
    """Validator issues (``operators.quality.issue_rows``) in the shape of the audit table; a long
    message is cut and its full text kept as JSON."""
    return issues.select(
        job_id.alias("job_id"),
        F.lit(table).alias("table_name"),
        record.cast("string").alias("record_identifier"),
        F.col("rule").alias("issue_type"),
        F.substring("message", 1, DESCRIPTION_LENGTH).alias("issue_description"),
        F.when(F.length("message") > DESCRIPTION_LENGTH, F.to_json(F.struct(F.col("message").alias("full_message")))).otherwise("{}").alias("issue_details"),
        "severity",
        at.alias("detected_at"),
    )


def job_status(jobs: DataFrame) -> DataFrame:
    """Per job the last run and the totals; equal start times go to the larger job id."""
    at = F.struct("start_time", "job_id")
    total = F.sum("duration_seconds")
    return jobs.groupBy("job_name").agg(
        F.max("start_time").alias("last_run_time"),
        F.max_by("status", at).alias("last_status"),
        F.max_by("duration_seconds", at).alias("last_duration_seconds"),
        F.max_by("records_loaded", at).alias("last_records_loaded"),
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == SUCCESS).alias("successful_runs"),
        F.count_if(F.col("status") == FAILED).alias("failed_runs"),
        (dbl(total) / F.count("duration_seconds")).alias("avg_duration_seconds"),
    )


def job_daily(jobs: DataFrame, since: Column) -> DataFrame:
    return (
        jobs.where(F.col("start_time") >= since)
        .groupBy("job_name", F.to_date("start_time").alias("run_date"))
        .agg(
            F.count(F.lit(1)).alias("run_count"),
            F.count_if(F.col("status") == SUCCESS).alias("success_count"),
            (dbl(F.sum("duration_seconds")) / F.count("duration_seconds")).alias("avg_duration_seconds"),
            F.max("duration_seconds").alias("max_duration_seconds"),
            F.sum("records_loaded").alias("total_records_loaded"),
            F.max("end_time").alias("last_run_time"),
        )
    )


def run_health(jobs: DataFrame, now: Column) -> DataFrame:
    """Success rate of the last seven days and run counts of the last day, in one pass."""
    day_old = F.col("start_time") >= now - F.expr("interval 24 hours")
    runs = F.count(F.lit(1))
    return jobs.where(F.col("start_time") >= now - F.expr("interval 7 days")).agg(
        F.when(runs > 0, dbl(F.count_if(F.col("status") == SUCCESS)) * F.lit(100.0) / dbl(runs)).alias(
            "success_rate_7d"
        ),
        *[
            F.count_if(day_old & (F.col("status") == s)).alias(f"{s.lower()}_24h")
            for s in (SUCCESS, PARTIAL, FAILED)
        ],
    )


def recent_errors(errors: DataFrame, jobs: DataFrame, since: Column) -> DataFrame:
    """Errors since a time with the job and start time of their run."""
    return (
        errors.where(F.col("error_timestamp") >= since)
        .join(jobs.select("job_id", "job_name", "start_time"), "job_id")
        .select("job_name", "start_time", "error_timestamp", "error_type", "error_message")
    )


def error_frequency(errors: DataFrame, since: Column) -> DataFrame:
    return (
        errors.where(F.col("error_timestamp") >= since)
        .groupBy("job_name", "error_message")
        .agg(F.count(F.lit(1)).alias("error_count"))
    )


def error_count(errors: DataFrame, since: Column) -> DataFrame:
    return errors.agg(F.count_if(F.col("error_timestamp") >= since).alias("recent_errors"))


def job_performance(jobs: DataFrame) -> DataFrame:
    """Elapsed seconds and records of successful runs per job."""
    took = F.timestamp_diff(
        "SECOND", F.date_trunc("second", "start_time"), F.date_trunc("second", "end_time")
    )
    return (
        jobs.where(F.col("status") == SUCCESS)
        .withColumn("_s", took)
        .groupBy("job_name")
        .agg(
            (dbl(F.sum("_s")) / F.count("_s")).alias("avg_duration_seconds"),
            F.max("_s").alias("max_duration_seconds"),
            (dbl(F.sum("records_loaded")) / F.count("records_loaded")).alias("avg_records"),
        )
    )


def throughput(jobs: DataFrame, since: Column) -> DataFrame:
    """Mean duration, entities handled, share of clean runs and records per second."""
    runs, seconds = F.count(F.lit(1)), F.sum("duration_seconds")
    return jobs.where(F.col("start_time") >= since).agg(
        F.when(runs > 0, dbl(seconds) / dbl(runs)).alias("avg_duration"),
        F.sum("symbols_processed").alias("total_symbols"),
        F.when(runs > 0, dbl(F.count_if(F.col("error_count") == 0)) / dbl(runs)).alias("success_rate"),
        F.when(seconds > 0, dbl(F.sum("records_loaded")) / dbl(seconds)).alias("throughput"),
    )


def recent_jobs(
    jobs: DataFrame, name: str | None = None, status: str | None = None, limit: int = 100
) -> DataFrame:
    """The newest runs, filtered by job and status; a report, so the limit is its feature."""
    if name is not None:
        jobs = jobs.where(F.col("job_name") == name)
    if status is not None:
        jobs = jobs.where(F.col("status") == status)
    return top_n(jobs, [F.desc("start_time"), F.desc("job_id")], limit)


def slowest_job(jobs: DataFrame) -> DataFrame:
    """The longest run per job, as one row each."""
    at = F.struct("duration_seconds", "job_id")
    return jobs.groupBy("job_name").agg(
        F.max("duration_seconds").alias("duration_seconds"), F.max_by("job_id", at).alias("job_id")
    )


def first_errors(errors: DataFrame, by: Sequence[str] = ("job_name",), n: int = 3) -> DataFrame:
    return newest_n(errors, by, ["error_timestamp", "error_id"], n, "error_no")
