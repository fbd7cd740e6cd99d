"""Embedding whitening, with the leading eigenvectors found by spectrum slicing.

Components c of the vectors become whole numbers ``x = floor(1024 c) + 100000``, so the sums S
over all n vectors are exact, and so is every ``n x - S``. The covariance is the mean product of
``(n x - S) / n``, centred before it is multiplied. Tasks add up their own products; the driver
gets one matrix of dims by dims, however many vectors there are.

The number of positive pivots of an LDL' factorisation of ``V - s I`` is the number of
eigenvalues of V above s (Sylvester's law of inertia). Bisection with such counts slices the
spectrum until an interval holds one of the leading eigenvalues; Rayleigh quotient iteration
from there converges cubically; and two more counts, just below and just above the result,
certify that it is the eigenvalue of that number. Eigenvalues that can't be told apart in double
precision share an interval; each new vector is kept orthogonal to those before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

EPS = np.finfo(float).eps
#: Components of this magnitude have no x of 64 bits and count as not finite.
LARGEST = float(1 << 52)
_ALPHA = (1 + 17**0.5) / 8


def positive_pivots(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are positive, from its LDL' factorisation.

    The largest entry left is brought to the front, as a pivot of its own or, off the diagonal, as
    part of a block of two with one eigenvalue of each sign (Bunch and Parlett), so that rounding
    stays as small as the matrix allows. A remainder that is zero counts as not positive.
    """
    a, positive = a.copy(), 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        k = int(diagonal.argmax())
        i, j = np.unravel_index(int(np.abs(a).argmax()), a.shape)
        largest = abs(a[i, j])
        if largest == 0:
            break
        if diagonal[k] >= _ALPHA * largest:
            pivot, first = a[k, k], [k]
            positive += bool(pivot > 0)
        else:
            first = [int(i), int(j)]
            positive += 1
        rest = np.delete(np.arange(len(a)), first)
        column = a[np.ix_(rest, first)]
        step = np.linalg.solve(a[np.ix_(first, first)], column.T)
        a = a[np.ix_(rest, rest)] - column @ step
        a = (a + a.T) / 2
    return positive


@dataclass
class Pair:
    """An eigenvalue with its unit eigenvector, and the counts above its lower and upper edge."""

    value: float
    vector: np.ndarray
    above_low: int
    above_high: int


def leading(v: np.ndarray, most: int) -> list[Pair]:
    """The largest eigenvalues of a covariance matrix, falling, at most ``most``.

    Eigenvalues that are zero within rounding are left out: there is nothing to scale.
    """
    dims = len(v)
    scale = float(np.abs(v).sum(1).max()) if dims else 0.0
    if scale == 0:
        return []
    v = v / scale
    edge = 8 * dims * EPS
    counts = {}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = positive_pivots(v - s * np.eye(dims))
        return counts[s]

    def orthogonal(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for p in found:
                x = x - (p.vector @ x) * p.vector
        return x / np.linalg.norm(x)

    def solved(s: float, x: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(v - s * np.eye(dims), x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(v - (s + edge) * np.eye(dims), x)
        return orthogonal(y)

    def iterated(low: float, high: float) -> tuple[float, np.ndarray]:
        """Inverse iteration until the quotient lies in the interval, then with the quotient itself."""
        mid = (low + high) / 2
        x = orthogonal(np.random.default_rng(dims).normal(size=dims))
        for _ in range(50):
            x = solved(mid, x)
            value = float(x @ v @ x)
            if low <= value <= high and np.linalg.norm(v @ x - value * x) <= (high - low) / 2:
                break
        best = (np.inf, value, x)
        for _ in range(12):
            error = float(np.linalg.norm(v @ x - value * x))
            if error < best[0]:
                best = (error, value, x)
            if error <= EPS:
                break
            x = solved(value, x)
            value = float(x @ v @ x)
        return best[1:]

    found: list[Pair] = []
    for number in range(1, min(most, dims) + 1):
        low, high = -edge, 1 + edge
        while True:
            # halve until the interval holds this number's eigenvalue alone or is as narrow as rounding allows
            while high - low > edge and (above(low) != number or above(high) != number - 1):
                mid = (low + high) / 2
                low, high = (mid, high) if above(mid) >= number else (low, mid)
            value, vector = iterated(low, high)
            pair = Pair(value * scale, vector, above(value - edge), above(value + edge))
            if pair.above_low >= number > pair.above_high:
                break
            if high - low <= edge:
                raise ArithmeticError(f"eigenvalue {number} could not be certified")
            for _ in range(4):
                mid = (low + high) / 2
                low, high = (mid, high) if above(mid) >= number else (low, mid)
        if value <= edge:
            break
        found.append(pair)
    return found


@dataclass
class Whitening:
    """What is known of all vectors: their number, sums and covariance's leading eigenvectors."""

    dims: int
    n: int
    sums: list[int]
    pairs: list[Pair]
    trace: float

    @property
    def explained(self) -> list[float]:
        return [p.value / self.trace for p in self.pairs]

    def axes(self) -> np.ndarray:
        """Rows that turn centred vectors into whitened ones."""
        return np.array([p.vector / np.sqrt(p.value) for p in self.pairs]).reshape(len(self.pairs), self.dims)


def whole(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of exact whole numbers, from vectors of ``dims`` finite components each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    vectors = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
    return np.floor(vectors * 1024).astype(np.int64) + 100_000


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S`` exactly: in 64 bits where they hold it, else in whole numbers of any size."""
    if len(x) and int(np.abs(x).max()) * n < 1 << 61 and max(map(abs, sums), default=0) < 1 << 61:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(d: np.ndarray) -> list[int]:
    """For each row the exact sum of its squares."""
    if d.dtype != object and (not d.size or d.shape[1] * int(np.abs(d).max()) ** 2 < 1 << 63):
        return (d * d).sum(1).tolist()
    d = d.astype(object)
    return (d * d).sum(1).tolist()


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector can be used, as doubles in ``vector_col``."""
    out = vectors.withColumn(vector_col, F.col(vector_col).cast("array<double>"))
    fine = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return out.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.coalesce(fine, F.lit(False)))


def _summed(parts: DataFrame, keys: list[str], value: str) -> dict:
    """Sums by key, which are at most dims by dims, on the driver."""
    return {tuple(r[:-1]): r[-1] for r in parts.groupBy(*keys).agg(F.sum(value)).collect()}


def _gram(vectors: DataFrame, run, dims: int, size: int) -> np.ndarray:
    """The summed products of the rows that ``run`` makes of batches; each task sends one triangle."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                rows = run(whole(batch.column(0), dims))
                total += rows.T @ rows
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": total[i, j]})

    out = np.zeros((size, size))
    for (i, j), v in _summed(vectors.mapInArrow(products, "i int, j int, v double"), ["i", "j"], "v").items():
        out[i, j] = out[j, i] = v
    return out


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = 8) -> Whitening:
    """Mean, covariance and leading components over all usable vectors of the table.

    Vectors that are null or empty, or hold null, non-finite or huge (2**52 and up) components,
    are left out. Where lengths differ, the most frequent one counts (of equally frequent ones the
    longest). Without usable vectors, or if all are equal, there are no components.
    """
    small_batches(vectors.sparkSession)
    fine = usable(vectors.select(vector_col), vector_col)
    sizes = fine.groupBy(F.size(vector_col).alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("dims")).first()
    if first is None:
        return Whitening(0, 0, [], [], 0.0)
    dims, n = first
    fine = fine.where(F.size(vector_col) == dims)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, object)
        for batch in batches:
            total += whole(batch.column(0), dims).astype(object).sum(0) if batch.num_rows else 0
        yield pa.RecordBatch.from_pydict({"j": pa.array(range(dims), pa.int32()), "s": pa.array(map(str, total), pa.string())})

    added = _summed(fine.mapInArrow(sums, "j int, s string").select("j", F.col("s").cast("decimal(38,0)").alias("s")), ["j"], "s")
    exact = [int(added[(j,)]) for j in range(dims)]
    v = _gram(fine, lambda x: deviations(x, n, exact).astype(float) / n, dims, dims) / n
    return Whitening(dims, n, exact, leading(v, components), float(np.trace(v)))


def identity_error(vectors: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity.

    Whitened vectors are centred by construction, as their deviations from the mean are exact.
    """
    if not model.pairs:
        return 0.0
    n, sums, axes = model.n, model.sums, model.axes()
    fine = usable(vectors.select(vector_col), vector_col).where(F.size(vector_col) == model.dims)
    got = _gram(fine, lambda x: (deviations(x, n, sums).astype(float) / n) @ axes.T, model.dims, len(axes)) / n
    return float(np.abs(got - np.eye(len(axes))).max())


def whitened(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, ``deviation``, ``whitened``) of every row that the model's ``fit`` counts.

    ``whitened`` holds one value for each component, with variance 1 over all rows; the sign of a
    component is any, but the same for all rows. ``deviation`` is the exact sum over the
    dimensions of ``(n x - S)**2``, as a decimal; null if it has over 38 digits. Rows with a null id
    and repeated rows are returned each. Other columns are left out. An empty table gives no rows.
    """
    small_batches(vectors.sparkSession)
    kind = vectors.schema[id_col].dataType.simpleString()
    n, sums, axes, dims = model.n, model.sums, model.axes(), model.dims
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec"))
    rows = usable(rows, "vec").where(F.size("vec") == dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = deviations(whole(batch.column("vec"), dims), n, sums)
            values = (d.astype(float) / n) @ axes.T
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "deviation": pa.array(map(str, squares(d)), pa.string()),
                "whitened": pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1, dtype=np.int32) * len(axes)), pa.array(values.ravel())),
            })

    out = rows.mapInArrow(run, f"id {kind}, deviation string, whitened array<double>")
    return out.select(F.col("id").alias(id_col), F.expr("try_cast(deviation as decimal(38,0))").alias("deviation"), "whitened")
