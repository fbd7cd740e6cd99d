"""Date keys and elapsed-time measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arith import as_column

QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def date_key(d: Column | str) -> Column:
    """Integer yyyymmdd."""
    d = as_column(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def hour_boundaries(start: Column | str, end: Column | str) -> Column:
    """How many full-hour marks lie between two timestamps."""
    start, end = as_column(start), as_column(end)
    return F.timestamp_diff("HOUR", F.date_trunc("hour", start), F.date_trunc("hour", end))


def is_quarter(period: Column | str) -> Column:
    return as_column(period).isin(*QUARTERS)


def period_rank(period: Column | str) -> Column:
    """Full year first, then Q4 down to Q1; anything else has no rank."""
    period = as_column(period)
    rank = F.when(period == "FY", 1)
    for place, name in enumerate(("Q4", "Q3", "Q2", "Q1"), start=2):
        rank = rank.when(period == name, place)
    return rank


def month_slot(d: Column | str, months: int) -> Column:
    """Number of the ``months``-long calendar slot that holds ``d``."""
    d = as_column(d)
    return F.floor((F.year(d) * 12 + F.month(d) - 1) / F.lit(months)).cast("int")
