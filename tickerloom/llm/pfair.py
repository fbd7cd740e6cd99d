"""Mixing sources to target weights with Pfair scheduling.

Every source's documents, in a fixed random order, are laid end to end and cut into blocks of
equal size. Block ``j`` (from 0) of a source of weight ``w`` may run from slot ``floor(j / w)``
and must have run by slot ``ceil((j + 1) / w)``; in every slot the released block with the
earliest deadline runs. With weights that sum to 1 no deadline is missed, so after ``t`` slots
every source has run more than ``w t - 1`` and fewer than ``w t + 1`` blocks.

Weights are taken as they are, in whole numbers of any size, so windows never drift from the
target weights however long the corpus is and however many sources it has. Blocks, about a
million at most, are scheduled on the driver, which holds one of each source; every ``period`` slots, or more
if there are more sources, are written to the shared folder, and documents are joined to the
blocks. Block numbers come from running sums within buckets of documents and over buckets, so
no source, however large, is in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import batched, islice
from math import lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import unused, work_dir

HELPERS = {"__source", "__size", "__order", "__tie", "__bucket", "__sum", "__before", "__at", "__slot"}
#: Documents in a bucket on average.
BUCKET = 5000
#: Blocks of a corpus for the driver to schedule: longer corpora have longer blocks.
BLOCKS = 1 << 20
#: Blocks that are written at once at least.
WRITTEN = 50_000


def shares(weights: dict, period: int) -> dict:
    """Whole numbers that sum to ``period``, in proportion to the weights, each at least 1.

    Largest remainders are rounded up first, ties in order of the names. They are for schedules
    that must repeat after a period; ``mixed_order`` doesn't round.
    """
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be above 0")
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources need a period of as many slots at least")
    whole, free, out = exact(weights), period, {}
    # sources of less than a slot get one, the others share what is left in proportion
    left = sum(whole.values())
    for s in sorted(whole, key=lambda s: whole[s]):
        if whole[s] * free >= left:
            break
        out[s], free, left = 1, free - 1, left - whole[s]
    rest = {s: Fraction(n * free, left) for s, n in whole.items() if s not in out}
    out |= {s: int(x) for s, x in rest.items()}
    for s in sorted(rest, key=lambda s: (out[s] - rest[s], str(s)))[: period - sum(out.values())]:
        out[s] += 1
    return {s: out[s] for s in weights}


def exact(weights: dict) -> dict:
    """Whole numbers in exactly the proportion of the weights; a float counts as it is written."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be above 0")
    parts = {s: w if isinstance(w, Fraction) else Fraction(str(w)) for s, w in weights.items()}
    unit = lcm(*(x.denominator for x in parts.values()))
    return {s: int(x * unit) for s, x in parts.items()}


def slots(whole: dict, blocks: dict | None = None) -> Iterator[tuple]:
    """(slot, source, block, release, deadline), earliest deadline first, ties by name.

    ``whole`` are weights in whole numbers. A source has no end, or as many blocks as ``blocks``
    says; the first that any source lacks is in the list too, and from there on only blocks that
    are there.
    """
    total = sum(whole.values())
    window = lambda s, j: (j * total // whole[s], -(-(j + 1) * total // whole[s]))
    waiting = [(*window(s, 0), str(s), k, s, 0) for k, s in enumerate(whole)]
    heapq.heapify(waiting)
    ready, slot, full = [], 0, True
    while waiting or ready:
        if not ready and waiting[0][0] > slot:
            slot = waiting[0][0]
        while waiting and waiting[0][0] <= slot:
            release, *job = heapq.heappop(waiting)
            heapq.heappush(ready, (*job, release))
        deadline, name, k, s, j, release = heapq.heappop(ready)
        there = blocks is None or j < blocks[s]
        if not there and not full:
            continue
        if deadline <= slot:
            raise AssertionError("a block missed its deadline")
        yield slot, s, j, release, deadline
        full = full and there
        if there:
            heapq.heappush(waiting, (*window(s, j + 1), name, k, s, j + 1))
        slot += 1


def schedule(share: dict) -> list:
    """The source that runs in each slot of a period of as many slots as the shares sum to."""
    return [s for _, s, *_ in islice(slots(share), sum(share.values()))]


def mixed_order(
    documents: DataFrame, weights: dict | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    block: int | None = None, period: int = 1000, power: float = 0.7, seed: int = 0,
) -> DataFrame:
    """``documents`` with ``block``, ``slot``, ``place``, ``release``, ``deadline`` and ``in_mix``.

    Read in order of ``slot``, then ``place``, the corpus is mixed to the weights. A block is
    ``block`` characters of a source, by default 100,000 or so many that the corpus has about a
    million blocks; a document belongs to the block in which it starts, and
    one without text counts one character. ``weights`` maps sources to target weights; sources
    it doesn't name come after all others, each in its own order, with null ``slot``, ``release``
    and ``deadline``. By default every source has its number of characters to ``power``.

    The mix holds as long as no source has run out: ``in_mix`` is true in slots before the
    first block that a source lacks. Later slots keep their order, with gaps where a source
    is used up; no row is dropped or repeated. A null source is a source of its own (a null
    key in ``weights`` names it). Repeated rows and rows with null ids are placed like others.
    An empty table gives no rows. Columns of the input that bear the name of a new one are replaced.
    """
    spark = documents.sparkSession
    clash = {"block", "slot", "place", "release", "deadline", "in_mix"} & set(documents.columns)
    if clash:
        documents = documents.drop(*clash)
    # the caller's columns make room for those used here
    own = {c: unused(documents, f"{c}_")[0] for c in documents.columns if c.lower() in HELPERS}
    documents = documents.withColumnsRenamed(own)
    id_col, text_col, source_col = (own.get(c, c) for c in (id_col, text_col, source_col))
    size = F.greatest(F.coalesce(F.length(text_col), F.lit(0)), F.lit(1)).cast("long")
    known = F.to_json(F.struct(F.col(source_col).cast("string").alias("s")))
    # the order of a source: random by id, the same in every run
    docs = documents.withColumns({"__source": known, "__size": size, "__order": F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string")), 1), "__tie": F.xxhash64(text_col)})
    totals = {r["__source"]: (r["size"], r["n"], r["name"]) for r in docs.groupBy("__source").agg(F.sum("__size").alias("size"), F.count(F.lit(1)).alias("n"), F.first(F.col(source_col).cast("string")).alias("name")).collect()}
    block = block or max(100_000, -(-sum(v[0] for v in totals.values()) // BLOCKS))
    if weights is None:
        named = {s: float(v[0]) ** power for s, v in totals.items()}
    else:
        named = {s: weights[v[2]] for s, v in totals.items() if v[2] in weights}
    lacks = {s: -(-totals[s][0] // block) for s in named}
    path, end = work_dir(spark, "blocks"), None
    kind = "__slot long, __source string, block long, release long, deadline long"
    spark.createDataFrame([], kind).write.parquet(path)
    for rows in batched(slots(exact(named), lacks) if named else [], max(period, len(named), WRITTEN)):
        if end is None:
            # the slot of the first block that a source lacks
            end = next((slot for slot, s, j, *_ in rows if j == lacks[s]), None)
        spark.createDataFrame(list(rows), kind).write.mode("append").parquet(path)
    end = end or 0

    buckets = max(1, sum(v[1] for v in totals.values()) // BUCKET)
    # a bucket is a range of the order, so running sums over buckets and within them make one order
    docs = docs.withColumn("__bucket", F.expr(f"floor(shiftright(__order, 31) / 4294967296D * {buckets})"))
    before = docs.groupBy("__source", "__bucket").agg(F.sum("__size").alias("__sum"))
    before = before.withColumn("__before", F.sum("__sum").over(Window.partitionBy("__source").orderBy("__bucket")) - F.col("__sum")).drop("__sum")
    within = Window.partitionBy("__source", "__bucket").orderBy("__order", F.col(id_col), "__size", "__tie")
    docs = docs.withColumn("__at", F.sum("__size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size"))
    docs = docs.join(before, ["__source", "__bucket"]).withColumn("__at", F.col("__at") + F.col("__before"))
    docs = docs.withColumns({"block": F.floor(F.col("__at") / block), "place": F.col("__at") % block})

    table = spark.read.schema(kind).parquet(path)
    docs = docs.join(table, ["__source", "block"], "left").withColumn("slot", F.col("__slot"))
    docs = docs.withColumn("in_mix", F.coalesce(F.col("slot") < end, F.lit(False)))
    out = docs.select(*documents.columns, "block", "slot", "place", "release", "deadline", "in_mix")
    return out.withColumnsRenamed({new: c for c, new in own.items()})
