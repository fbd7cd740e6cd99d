"""Embedding near-dedup with randomised-rotation binary codes.

A unit vector, padded with zeros, is turned by a random rotation; the signs of the result are
its binary code, and the inner product of vector and code is stored beside it as correction
factor. The inner product of the code with another rotated vector, divided by the factor, is an
unbiased estimate of the cosine, with an error of about ``sqrt((1 - f * f) / f / f / (bits - 1))``.
Pairs whose estimate lies more than ``spread`` errors below the threshold are settled; the
cosines of all others are computed again from the vectors, in double precision.

Which pairs are estimated: bits of the code, which agree between near vectors with a known
probability, make keys of ``tables`` hash tables. Keys get a bit longer with every doubling of
the vectors, and there are as many tables as find a pair at the threshold with probability
``recall``. A pair that meets in several tables is counted in the first. Large buckets are cut
into cells, and a task compares two cells as matrices: it returns numbers of links and a star
for each connected set, not pairs. Equal vectors are one node with a weight.
"""

from __future__ import annotations

from collections.abc import Callable
from math import acos, ceil, log, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components

#: Vectors in a bucket on average, and in a cell of a large bucket.
ROOM, CELL = 256, 1024
_OUT = "node long, links long, star long"


def code_bits(size: int, bits: int) -> int:
    """Bits of the code of a vector: one for each dimension at least, in whole bytes."""
    return max(bits, -(-size // 8) * 8)


def rotation(size: int, bits: int, seed: int) -> np.ndarray:
    """``size`` orthonormal rows in ``code_bits`` dimensions: a random rotation of padded vectors."""
    bits = code_bits(size, bits)
    square = np.random.default_rng([seed, size]).normal(size=(bits, bits))
    turned, upper = np.linalg.qr(square)
    return (turned * np.sign(np.diag(upper)))[:size]


def plan(vectors: int, least: float, recall: float, bits: int, seed: int) -> np.ndarray:
    """The bits of the code that make the key of each table."""
    agree = 1 - acos(least) / pi
    width = int(min(max(2, ceil(log(max(vectors, 1) / ROOM + 1, 2))), 40))
    tables = ceil(log(1 - recall) / log(1 - agree**width))
    rng = np.random.default_rng([seed, width])
    return np.stack([rng.choice(bits, width, replace=False) for _ in range(tables)])


def units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, signs as 0 and 1, and correction factors."""
    turned = unit @ turn
    return turned, turned > 0, np.abs(turned).sum(1) / np.sqrt(turn.shape[1])


def _keys(picks: np.ndarray, bits: int, seed: int) -> Callable:
    def run(batches):
        for batch in batches:
            column = batch.column("vec")
            sizes = np.diff(column.offsets.to_numpy())
            values = column.flatten().to_numpy().astype(float)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for size in np.unique(sizes):
                turn = rotation(int(size), bits, seed)
                for some in np.array_split(np.flatnonzero(sizes == size), max(1, int((sizes == size).sum() // 4096))):
                    vec = values[starts[some][:, None] + np.arange(size)]
                    _, signs, factor = encode(units(vec), turn)
                    keys = (signs[:, picks].astype(np.int64) << np.arange(picks.shape[1])).sum(2)
                    yield pa.RecordBatch.from_pydict({
                        "node": batch.column("node").take(pa.array(some)), "weight": batch.column("weight").take(pa.array(some)), "size": pa.array(np.full(len(some), size), pa.int32()),
                        "vec": pa.array([v.tobytes() for v in vec], pa.binary()), "code": pa.array([c.tobytes() for c in np.packbits(signs, axis=1)], pa.binary()),
                        "factor": factor, "keys": pa.array(list(keys), pa.list_(pa.int64())),
                    })

    return run


def _stars(linked: np.ndarray) -> np.ndarray:
    """For each row the smallest row of its connected set; ``linked`` is symmetric."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None, :], len(linked)).min(1)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(least: float, bits: int, seed: int, spread: float) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        side, pair = table.column("cell").to_numpy(), table.column("pair")[0].as_py()
        nodes, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        unit = units(np.stack([np.frombuffer(v) for v in table.column("vec").to_pylist()]))
        signs = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in table.column("code").to_pylist()]), axis=1)
        factor = table.column("factor").to_numpy()
        keys = np.stack(table.column("keys").to_numpy())
        at = int(table.column("tab")[0].as_py())
        rows, cols = np.flatnonzero(side == pair["low"]), np.flatnonzero(side == pair["high"])
        # the estimate: a code's inner product with the other vector, over the code's factor
        turned = unit[cols] @ rotation(unit.shape[1], bits, seed)
        estimate = ((2.0 * signs[rows] - 1) @ turned.T) / (np.sqrt(signs.shape[1]) * factor[rows, None])
        error = spread * np.sqrt((1 - factor[rows] ** 2) / factor[rows] ** 2 / (signs.shape[1] - 1))
        a, b = np.nonzero(estimate >= least - error[:, None])
        a, b = rows[a], cols[b]
        if pair["low"] == pair["high"]:
            a, b = a[a != b], b[a != b]
        first = ~(keys[a, :at] == keys[b, :at]).any(1) if at else np.ones(len(a), bool)
        a, b = a[first], b[first]
        real = np.concatenate([np.einsum("ij,ij->i", unit[x], unit[y]) >= least for x, y in zip(np.array_split(a, len(a) // 65536 + 1), np.array_split(b, len(b) // 65536 + 1))])
        a, b = a[real], b[real]
        linked = np.zeros((len(nodes), len(nodes)), bool)
        # an estimate may settle one direction only; a link holds for both
        linked[a, b] = linked[b, a] = True
        links = linked @ weight.astype(float)
        some = np.flatnonzero(links > 0)
        return pa.table({"node": nodes[some], "links": links[some].astype(np.int64), "star": nodes[_stars(linked)[some]]})

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95, recall: float = 0.998,
    bits: int = 256, spread: float = 4.0, seed: int = 7,
) -> DataFrame:
    """(id, ``n_links``, ``component_id``, ``kept``) of every row.

    Two vectors are linked if their cosine in double precision is at least ``least``. Links
    below it are never reported; of those at it, a share of ``recall`` or more is found, and
    of nearer ones more. ``component_id`` is the smallest id reachable by links.

    Null and zero vectors and those with null or non-finite components have no links. Vectors
    of different lengths aren't compared; their codes have ``bits`` bits, or as many as they have
    dimensions. Equal vectors in several rows, also of one id, are linked with each other. Rows
    with a null id have links like others but give no component its name; if they reach no id,
    their component is null and they are kept. An empty table gives no rows.
    """
    if bits % 8 or bits < 64:
        raise ValueError("bits must be a multiple of 8, at least 64")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    fine = "vec is not null and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vec, x -> x != 0)"
    fine = F.coalesce(F.expr(fine), F.lit(False))
    good = rows.where(fine)
    classes = stored(good.groupBy("vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight")), "vectors")
    named = classes.select("vec", "weight", F.xxhash64("node", "vec").alias("node"), F.col("node").alias("least"))
    picks = plan(named.count(), least, recall, bits, seed)
    coded = named.select("node", "weight", "vec").mapInArrow(_keys(picks, bits, seed), "node long, weight long, size int, vec binary, code binary, factor double, keys array<long>")
    coded = coded.select("*", F.posexplode("keys").alias("tab", "key"))
    sizes = coded.groupBy("size", "tab", "key").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("cells"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    placed = coded.join(sizes, ["size", "tab", "key"]).withColumn("cell", F.pmod(F.xxhash64("node"), "cells"))
    # every two cells of a bucket meet once: a cell is sent to each pair that it is part of
    pair = F.explode(F.expr("transform(sequence(0L, cells - 1L), c -> struct(least(c, cell) as low, greatest(c, cell) as high))"))
    placed = placed.withColumn("pair", pair)
    found = placed.groupBy("size", "tab", "key", "pair").applyInArrow(_compare(least, bits, seed, spread), _OUT)
    found = stored(found, "vector-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(found.where("node != star"), "node", "star").withColumnRenamed("component", "group")
    known = named.join(links, "node", "left").join(group, "node", "left").withColumn("group", F.coalesce("group", "node"))
    heads = known.groupBy("group").agg(F.min("least").alias("component_id"))
    known = known.join(heads, "group").select("vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = good.join(known, "vec").select("id", "n_links", "component_id").union(rows.where(~fine).select("id", F.lit(0).cast("long"), "id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
