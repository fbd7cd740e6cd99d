"""Folders and small files of whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if it isn't there."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, made in one step."""
    fs, where = _at(spark, path)
    fs.create(where, True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, in order; none if it isn't there."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole or not at all, and never takes the place of another."""
    fs, where = _at(spark, path)
    _, draft = _at(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(where) or not fs.rename(draft, where):
        fs.delete(draft, False)
        raise FileExistsError(path)
