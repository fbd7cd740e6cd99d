"""Windows over entity time series.

``previous`` without ``slot`` and the rolling operators sort one entity's rows in one
task. They are meant for series with one row per entity and calendar day (about 250 a
year), which the keyed upsert guarantees for stored prices. For ticks, where an entity
has no such bound, pass ``slot``: the series is cut into time slots, each its own group,
and the last row before a slot is carried in from a one-row-per-slot summary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import dbl, percent


def previous(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    slot: Column | None = None,
) -> DataFrame:
    """Add the preceding row's values: ``columns`` maps output name to input column.

    ``order`` must be total per entity; ``slot`` must not decrease along it.
    """
    if slot is None:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumns({out: F.lag(c).over(w) for out, c in columns.items()})

    kept = F.struct(*[F.col(c).alias(out) for out, c in columns.items()])
    rows = df.withColumns({"_slot": slot, "_kept": kept, "_carried": F.lit(False)})
    tails = rows.groupBy(*by, "_slot").agg(F.max_by("_kept", F.struct(*order)).alias("_tail"))
    before = F.lag("_tail").over(Window.partitionBy(*by).orderBy("_slot"))
    # the last row before a slot joins the slot as an extra row in front of its own
    carried = tails.select(*by, "_slot", before.alias("_kept"), F.lit(True).alias("_carried")).where(
        F.col("_kept").isNotNull()
    )
    inside = Window.partitionBy(*by, "_slot").orderBy(F.desc("_carried"), *order)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn("_prev", F.lag("_kept").over(inside))
        .where(~F.col("_carried"))
        .withColumns({out: F.col("_prev")[out] for out in columns})
        .drop("_slot", "_kept", "_carried", "_prev")
    )


def balanced_slots(
    df: DataFrame, by: Sequence[str], order: Sequence[str], path: str, slots: int, name: str = "slot"
) -> DataFrame:
    """``df`` cut into ``slots`` runs of about equal size along (``by``, ``order``).

    For series that bunch in time as well, where no calendar slot is small: an entity with
    a third of all rows is spread over a third of the slots. The cut is drawn from a sample
    and must not move, so the rows are written to ``path`` (a fresh shared folder) and read
    back with their slot in ``name``, ready to pass to ``previous``.
    """
    cut = df.repartitionByRange(slots, *by, *order).withColumn(name, F.spark_partition_id())
    cut.write.parquet(path)
    return df.sparkSession.read.schema(cut.schema).parquet(path)


def price_change(
    df: DataFrame, by: Sequence[str], order: Sequence[str], price: str, slot: Column | None = None
) -> DataFrame:
    """``change_amount`` and ``change_percent`` against the row before, over the whole series.

    Filter a load window after this, not before: the first row of a slice has a
    predecessor too.
    """
    df = previous(df, by, order, {"_previous": price}, slot)
    change = F.col(price) - F.col("_previous")
    return df.withColumns(
        {"change_amount": change, "change_percent": percent(change, "_previous")}
    ).drop("_previous")


def gaps(
    df: DataFrame, by: Sequence[str], day: str, longer_than: int = 3, slot: Column | None = None
) -> DataFrame:
    """Pairs of neighbouring dates that lie more than ``longer_than`` days apart."""
    seen = previous(df.select(*by, day), by, [day], {"gap_start": day}, slot)
    days = F.date_diff(F.col(day), F.col("gap_start"))
    return (
        seen.withColumn("days_gap", days)
        .where(F.col("days_gap") > longer_than)
        .select(*by, "gap_start", F.col(day).alias("gap_end"), "days_gap")
    )


def returns(
    df: DataFrame, by: Sequence[str], day: str, price: str, offsets: Mapping[str, int]
) -> DataFrame:
    """Relative change against the row ``n`` places earlier, one column per offset."""
    w = Window.partitionBy(*by).orderBy(day)

    def one(n: int) -> Column:
        before = F.nullif(F.lag(price, n).over(w), F.lit(0))
        return dbl(price) / dbl(before) - F.lit(1.0)

    return df.withColumns({name: one(n) for name, n in offsets.items()})


def rolling_sums(
    df: DataFrame, by: Sequence[str], day: str, value: str, spans: Mapping[str, int], skip: int = 0
) -> DataFrame:
    """Sum and count of ``value`` over ``n`` rows, as ``{name}_sum`` and ``{name}_rows``.

    The ``n`` rows end ``skip`` rows before the current one. Each is the difference of two
    running totals, so the cost per row does not grow with ``n``; ``value`` must be exact
    (integer or decimal), or the differences would drift.
    """
    w = Window.partitionBy(*by).orderBy(day)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns(
        {
            "_total": F.coalesce(F.sum(value).over(so_far), F.lit(0)),
            "_rows": F.count(value).over(so_far),
        }
    )

    def before(c: str, n: int) -> Column:
        return F.col(c) if n == 0 else F.coalesce(F.lag(c, n).over(w), F.lit(0))

    cells = {}
    for name, n in spans.items():
        cells[f"{name}_sum"] = before("_total", skip) - before("_total", skip + n)
        cells[f"{name}_rows"] = before("_rows", skip) - before("_rows", skip + n)
    return df.withColumns(cells).drop("_total", "_rows")


def moving_averages(
    df: DataFrame, by: Sequence[str], day: str, price: str, spans: Mapping[str, int]
) -> DataFrame:
    """Mean of the last ``n`` rows, summed exactly in the price's own decimal type."""
    df = rolling_sums(df, by, day, price, {f"_{name}": n for name, n in spans.items()})
    means = {
        name: F.when(F.col(f"_{name}_rows") > 0, dbl(f"_{name}_sum") / F.col(f"_{name}_rows"))
        for name in spans
    }
    return df.withColumns(means).drop(*[f"_{n}_{part}" for n in spans for part in ("sum", "rows")])


def volatility(
    df: DataFrame,
    by: Sequence[str],
    day: str,
    change: str,
    rows: int | None = None,
    days: int | None = None,
    per_year: int = 252,
    name: str = "volatility",
) -> DataFrame:
    """Annualised sample deviation of ``change`` over the last ``rows`` rows or ``days`` days."""
    if (rows is None) == (days is None):
        raise ValueError("give either rows or days")
    if rows is not None:
        frame = Window.partitionBy(*by).orderBy(day).rowsBetween(1 - rows, 0)
    else:
        number = F.unix_date(F.col(day))
        frame = Window.partitionBy(*by).orderBy(number).rangeBetween(1 - days, 0)
    value = F.stddev_samp(change).over(frame) * F.sqrt(F.lit(float(per_year)))
    return df.withColumn(name, F.round(value, 6))


def multiple_of_average(
    df: DataFrame, by: Sequence[str], day: str, value: str, span: int, name: str
) -> DataFrame:
    """A row's value over the mean of the ``span`` rows before it."""
    df = rolling_sums(df, by, day, value, {"_before": span}, skip=1)
    mean = F.when(F.col("_before_rows") > 0, dbl("_before_sum") / F.col("_before_rows"))
    return df.withColumn(name, F.when(mean > 0, dbl(value) / mean)).drop("_before_sum", "_before_rows")


def sessions(
    df: DataFrame, by: Sequence[str], at: str, tie: str, gap_seconds: int, slot: Column | None = None
) -> DataFrame:
    """Runs of ticks with no pause of ``gap_seconds`` or more, one row per run.

    Ticks are first joined to runs within their time slot (a month, unless ``slot`` says
    otherwise; a slot should hold many ticks of a common entity). Only a slot's first run can belong to an earlier session; a summary with one
    row per entity and slot tells which, so no step needs one entity in one group.
    """

    def apart(before: Column, after: Column) -> Column:
        return F.timestamp_diff("MICROSECOND", before, after) >= gap_seconds * 1_000_000

    inside = Window.partitionBy(*by, "_slot").orderBy(at, tie)
    ticks = df.select(*by, at, tie, (F.date_trunc("month", at) if slot is None else slot).alias("_slot"))
    pause = apart(F.lag(at).over(inside), F.col(at))
    run_no = F.count_if(F.col("_breaks")).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    runs = (
        ticks.withColumn("_breaks", pause)
        .withColumn("_run", run_no)
        .groupBy(*by, "_slot", "_run")
        .agg(F.min(at).alias("_start"), F.max(at).alias("_end"), F.count(F.lit(1)).alias("_ticks"))
    )

    chain = Window.partitionBy(*by).orderBy("_slot")
    slots = runs.groupBy(*by, "_slot").agg(
        F.min("_start").alias("_first"),
        F.max("_start").alias("_last"),
        F.max("_end").alias("_until"),
        F.count(F.lit(1)).alias("_n"),
    )
    slots = slots.withColumn("_goes_on", ~apart(F.lag("_until").over(chain), F.col("_first")))
    # where the session of a slot's last run began; open where the slot is one run that goes on
    anchor = F.when((F.col("_n") > 1) | ~F.coalesce("_goes_on", F.lit(False)), F.col("_last"))
    slots = slots.withColumn("_anchor", F.last(anchor, ignorenulls=True).over(chain)).select(
        *by,
        "_slot",
        F.when(F.col("_goes_on"), F.lag("_anchor").over(chain)).otherwise(F.col("_first")).alias("_began"),
    )
    began = F.when(F.col("_run") == 0, F.col("_began")).otherwise(F.col("_start"))
    return (
        runs.join(slots, [*by, "_slot"])
        .groupBy(*by, began.alias("session_start"))
        .agg(F.max("_end").alias("session_end"), F.sum("_ticks").alias("ticks"))
    )
