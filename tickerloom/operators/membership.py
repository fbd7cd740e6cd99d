"""Membership over time: snapshots of member lists as intervals, and who was a member when."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(snapshots: DataFrame, member: Sequence[str], taken: str = "taken_at") -> DataFrame:
    """(member, ``member_from``, ``member_to``, ``snapshots``): each unbroken stay of a member.

    ``snapshots`` has one row per member and snapshot, in any order; repeated rows count once. A
    stay lasts from its first snapshot to the first one that lacks the member, exclusive; its end
    is NULL while the member is in the last snapshot. A member that comes back starts a new stay.
    An empty snapshot can't be told from none: pass it as a row without member. Rows without
    member start no stay.

    Snapshots are numbered once (as many rows as there are snapshots, not members); a member's
    consecutive numbers differ from its own count by a constant for each stay.
    """
    times = snapshots.select(taken).where(F.col(taken).isNotNull()).distinct()
    order = Window.orderBy(taken)
    numbered = times.select(taken, F.row_number().over(order).alias("_no"), F.lead(taken).over(order).alias("_next"))
    rows = snapshots.select(*member, taken).where(" and ".join(f"`{c}` is not null" for c in member)).distinct()
    stays = rows.join(numbered, taken).withColumn("_stay", F.col("_no") - F.row_number().over(Window.partitionBy(*member).orderBy("_no")))
    return stays.groupBy(*member, "_stay").agg(
        F.min(taken).alias("member_from"), F.max_by("_next", "_no").alias("member_to"), F.count(F.lit(1)).alias("snapshots")
    ).drop("_stay")


def was_member(day: Column) -> Column:
    """Whether a day lies in a stay."""
    return (F.col("member_from") <= day) & (F.col("member_to").isNull() | (day < F.col("member_to")))


def members_on(rows: DataFrame, stays: DataFrame, member: Sequence[str], day: str, keep: Sequence[str] = ("member_from",)) -> DataFrame:
    """Those of the rows whose member was one on the row's day; a day lies in one stay at most."""
    ends = stays.select(*member, *dict.fromkeys([*keep, "member_from", "member_to"]))
    met = rows.join(ends, list(member)).where(was_member(F.col(day)))
    return met.select(*rows.columns, *keep)
