"""Point-in-time joins: which event was the latest one known at a moment.

The event side becomes validity intervals, cut at calendar slots. The observation side
then needs one equi-join on (entity, slot) with a range check inside the slot: it is
never ranked, never multiplied, and if the intervals fit a broadcast it is not even
shuffled. Beyond that size the join is a sort-merge join whose busy (entity, slot)
partitions the adaptive planner can split, because one interval at most matches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_slot
from .keyed import latest


def intervals(
    events: DataFrame,
    by: Sequence[str],
    at: str,
    tie: Sequence[Column | str] = (),
    until: str = "valid_until",
) -> DataFrame:
    """Each event with the exclusive end of its validity; of equal times the last by ``tie`` wins.

    Ranks one entity's events in one task, so events must be few per entity, such as
    filings (a handful a year).
    """
    w = Window.partitionBy(*by).orderBy(at, *tie)
    return (
        events.where(F.col(at).isNotNull())
        .withColumn(until, F.lead(at).over(w))
        .where(F.col(until).isNull() | (F.col(until) > F.col(at)))
    )


def asof_join(
    left: DataFrame,
    events: DataFrame,
    by: Sequence[str],
    left_at: str,
    at: str,
    tie: Sequence[Column | str] = (),
    how: str = "left",
    slot_months: int = 12,
    horizon: date | None = None,
) -> DataFrame:
    """``left`` with the columns of the latest event at or before ``left_at``.

    Column names of ``events`` other than ``by`` must not occur in ``left``. A slot spans
    ``slot_months``; times after ``horizon`` (default today) share the last slot, which
    bounds how far an open interval is repeated and does not change the result.
    """
    last = F.lit(horizon or date.today())
    edge = month_slot(last, slot_months)

    def slot(c: str) -> Column:
        return F.least(month_slot(c, slot_months), edge)

    spans = intervals(events, by, at, tie, "_until").withColumns(
        {"_from": F.col(at)}
    )
    spans = spans.withColumn(
        "_slot", F.explode(F.sequence(slot("_from"), F.coalesce(slot("_until"), edge)))
    )
    r = spans.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        *[c for c in spans.columns if c not in by],
    )
    l = left.withColumn("_left_slot", slot(left_at))
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_by_{c}") for c in by])
    on = (
        on
        & (F.col("_left_slot") == F.col("_slot"))
        & (F.col("_from") <= F.col(left_at))
        & (F.col("_until").isNull() | (F.col(left_at) < F.col("_until")))
    )
    return l.join(r, on, how).drop(
        "_left_slot", "_slot", "_from", "_until", *[f"_by_{c}" for c in by]
    )


def one_timeline(
    streams: Mapping[str, tuple[DataFrame, str, Sequence[str]]], by: Sequence[str], at: str
) -> DataFrame:
    """Several event streams as one: per event time a struct column per stream, NULL where
    that stream has no event then.

    ``streams`` maps an output struct name to (events, time column, tie-break columns).
    """
    parts = []
    for name, (events, time, tie) in streams.items():
        own = [c for c in events.columns if c not in by]
        once = intervals(events, by, time, tie, "_end").drop("_end")
        parts.append(once.select(*by, F.col(time).alias(at), F.struct(*own).alias(name)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.groupBy(*by, at).agg(*[F.any_value(n, ignoreNulls=True).alias(n) for n in streams])


def carried_forward(events: DataFrame, by: Sequence[str], at: str, names: Sequence[str]) -> DataFrame:
    """Each column of ``names`` with its last value so far; joining the result once as-of
    replaces one as-of join per column."""
    so_far = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumns({n: F.last(n, ignorenulls=True).over(so_far) for n in names})


def known_at(
    df: DataFrame, by: Sequence[str], at: str, moment, order: Sequence[Column | str] = ()
) -> DataFrame:
    """The newest row per entity among those with ``at`` not after ``moment``."""
    return latest(df.where(F.col(at) <= moment), by, [F.desc(at), *order])
