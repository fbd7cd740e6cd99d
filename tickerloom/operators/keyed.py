"""Operators on keyed rows: latest, newest n, duplicates, membership, upsert.

Rank filters of the form ``row_number() <= n`` are cut to n rows per key before the
shuffle (window group limit), and aggregates combine on the map side, so a key that
holds a large share of the rows still reaches its reducer as a few rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import as_column


def newest_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows per key in ``order``; ``rank`` keeps the position as a column."""
    name = rank or "_rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``; give a total order for a stable result."""
    return newest_n(df, keys, order, 1)


def first_of_few(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``latest`` for rows whose keys hardly ever repeat: rows aren't sorted before the shuffle too,
    which would cut none of them."""
    again = F.lag(F.lit(True)).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_again", again).where(F.col("_again").isNull()).drop("_again")


def duplicates(df: DataFrame, keys: Sequence[str], count: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of the whole table, found per task first and then merged."""
    return df.orderBy(*order).limit(n)


def only_in(df: DataFrame, allowed: DataFrame | Sequence, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in a short Python list or in another table."""
    if isinstance(allowed, DataFrame):
        return df.join(allowed, on, "left_semi")
    return df.where(F.col(on).isin(list(allowed)))


def not_in(df: DataFrame, existing: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``existing``; NULL keys are kept."""
    return df.join(existing, on, "left_anti")


def between(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Inclusive range on ``column``; an open end is not filtered."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: bool = True,
    action: str = "_action",
) -> DataFrame:
    """Target rows after an upsert, with what happened to each one in ``action``.

    ``I`` inserted, ``U`` updated, ``N`` left as it was (also when the source repeats the
    stored values). Both sides must be unique by key: pass the source through ``latest``
    first. ``update`` limits the columns a match overwrites; the others keep the stored
    value. With ``insert=False`` only matches are written.
    """
    update = list(update) if update is not None else [c for c in target.columns if c not in keys]
    stored = target.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_t"))
    coming = source.select(*keys, F.struct(*[c for c in source.columns if c not in keys]).alias("_s"))
    both = stored.join(coming, list(keys), "full_outer" if insert else "left_outer")

    in_t, in_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"_t.{c}").eqNullSafe(F.col(f"_s.{c}")) for c in update],
        F.lit(False),
    )
    out = {}
    for c in target.columns:
        if c in keys:
            continue
        given = F.col(f"_s.{c}") if c in source.columns else F.lit(None)
        if c in update:
            out[c] = F.when(in_s, given).otherwise(F.col(f"_t.{c}"))
        else:
            out[c] = F.when(in_t, F.col(f"_t.{c}")).otherwise(given)
    what = F.when(~in_t, "I").when(in_s & differs, "U").otherwise("N")
    return both.select(
        *[out.get(c, F.col(c)).alias(c) for c in target.columns], what.alias(action)
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] | None = None,
    update: Sequence[str] | None = None,
    insert: bool = True,
) -> DataFrame:
    """Target after the upsert; ``order`` picks one source row where a key repeats."""
    if order is not None:
        source = latest(source, keys, order)
    return merged(target, source, keys, update, insert).drop("_action")


def merge_counts(merged_rows: DataFrame, action: str = "_action") -> DataFrame:
    """How many rows were inserted, updated and left unchanged."""
    a = F.col(action)
    return merged_rows.agg(
        F.count_if(a == "I").alias("inserted"),
        F.count_if(a == "U").alias("updated"),
        F.count_if(a == "N").alias("unchanged"),
    )


def high_water(
    df: DataFrame, by: Sequence[str], column: str, default, step_days: int = 1
) -> DataFrame:
    """Next date to load per entity: newest stored date plus ``step_days``, or ``default``."""
    newest = F.date_add(F.max(column), step_days)
    return df.groupBy(*by).agg(F.coalesce(newest, F.lit(default).cast("date")).alias("load_from"))


def earliest_of(tables: Sequence[tuple[DataFrame, str]], default, name: str = "load_from") -> DataFrame:
    """The smallest date over several tables, each reduced first; ``default`` if all are empty."""
    lows = [df.agg(F.min(column).alias("low")) for df, column in tables]
    return reduce(DataFrame.unionByName, lows).agg(
        F.coalesce(F.min("low"), F.lit(default).cast("date")).alias(name)
    )


def split_by_age(df: DataFrame, column: str, before) -> tuple[DataFrame, DataFrame]:
    """Rows to archive and rows to keep; a missing date is kept."""
    old = as_column(column) < F.lit(before)
    return df.where(old), df.where(~F.coalesce(old, F.lit(False)))
