"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sqlviews

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the views of ``sqlviews``, which are put in front."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql if sql in ORACLE.values() else with_views(sql)
        return fn

    return add


def with_views(sql: str) -> str:
    """``sql`` with the definitions of the views it uses, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in sqlviews.VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(sqlviews.VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    heads = ",\n".join(f"{n} as ({sqlviews.VIEWS[n]})" for n in needed)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {heads},\n{body[5:]}"
    return f"with {heads}\n{body}"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison across engines."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def dbl(*names: str, prefix: str = "") -> str:
    """SQL select items that give the named columns as doubles."""
    return ", ".join(f"cast({prefix}{n} as double) as {n}" for n in names)
