"""Guarded arithmetic.

A ratio is one division of two doubles, so its result does not depend on how an
engine scales decimal quotients. Sums stay decimal until that division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dbl(x: Column | str) -> Column:
    return as_column(x).cast("double")


def nz(x: Column | str) -> Column:
    """The value, or zero where it is missing."""
    return F.coalesce(as_column(x), F.lit(0))


def first_nonzero(*xs: Column | str) -> Column:
    """The first value that is neither missing nor zero; zero if there is none."""
    return F.coalesce(*[F.nullif(as_column(x), F.lit(0)) for x in xs], F.lit(0))


def ratio(num: Column | str, den: Column | str, *guards: Column) -> Column:
    """``num / den`` in double where ``den > 0`` and every guard holds, else NULL."""
    den = as_column(den)
    ok = den > 0
    for guard in guards:
        ok = ok & guard
    return F.when(ok, dbl(num) / dbl(den))


def percent(num: Column | str, den: Column | str, *guards: Column) -> Column:
    return ratio(num, den, *guards) * F.lit(100.0)


def growth_pct(current: Column | str, prior: Column | str) -> Column:
    """Change against a positive prior value, in percent."""
    return percent(as_column(current) - as_column(prior), prior)


def exact_mean(x: Column | str, places: int = 6) -> Column:
    """Mean whose sum is taken in decimal, so the order of the rows cannot change it."""
    x = as_column(x).cast(f"decimal(28,{places})")
    return F.when(F.count(x) > 0, dbl(F.sum(x)) / F.count(x))


def cagr(current: Column | str, prior: Column | str, years: int) -> Column:
    """Compound yearly growth between two positive values, rounded to 6 places."""
    current, prior = as_column(current), as_column(prior)
    raw = F.pow(dbl(current) / dbl(prior), F.lit(1.0).cast("double") / F.lit(float(years)))
    return F.when((current > 0) & (prior > 0), F.round(raw - F.lit(1.0), 6))


def half_even(x: Column, places: int | None) -> Column:
    """Round half to even on a decimal; ``None`` leaves the value as it is."""
    if places is None:
        return x
    return F.bround(x.cast("decimal(38,12)"), places)


def blank(x: Column | str) -> Column:
    """Text or date that is NULL or empty."""
    x = as_column(x)
    return x.isNull() | (x.cast("string") == "")


def unset(x: Column | str) -> Column:
    """Number that is NULL or zero."""
    return F.coalesce(as_column(x), F.lit(0)) == 0
