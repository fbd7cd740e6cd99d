"""Connected components of a graph given by its edges, with alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored


def _done(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has this one neighbour only."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("v", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or down = 1 and up = 1").limit(1).count()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with an edge; a component bears its smallest node.

    ``a`` and ``b`` are long columns; loops, repeated edges and nulls are allowed and add
    nothing. Large-star links each node's larger neighbours to its smallest neighbour,
    small-star links the smaller ones, until every component is a star about its smallest
    node, so edges that are such stars take no round; the number of rounds grows with the logarithm of the size. Each round is written to
    the shared folder, in place of the one before, so a lost executor costs one round at most, and
    smallest neighbours are combined before the shuffle, so a node with very many edges is no hot spot.
    """
    now = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
            F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
        ).distinct(),
        "edges",
    )
    while not _done(now):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        before, now = now, stored(small.select("e.u", "e.v").where("u != v").distinct(), "edges")
        dropped(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct()
    )
