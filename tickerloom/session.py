"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "tickerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects; ``conf`` overrides them.

    ANSI mode stays on, so an unguarded division fails instead of hiding.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        # call sites are not recorded for every column expression built
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    The setting is required: a folder of one machine would be out of reach for the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Whether files of a shuffle are deleted when the query that made them ends.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, a shuffle's files go with its query; else they stay until the driver collects garbage,
    and a run of many steps holds those of all. For steps that each run their frames once: a frame
    that runs again makes its shuffles again."""
    before = spark.conf.get(SHUFFLES_END, "false")
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_END, before)


def ready(spark: SparkSession) -> SparkSession:
    """For entry points: on one machine, a session without a shared folder gets one of its own."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tickerloom-"))
    return spark
