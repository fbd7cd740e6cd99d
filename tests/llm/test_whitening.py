import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import whitening
from tickerloom.llm.queries import QUERIES
from tickerloom.llm.whitening import leading, positive_pivots


def reference(rows, components=8):
    """n, exact deviations and whitened rows by plain Python integers and a library eigensolver."""
    x = {k: [math.floor(1024 * c) + 100_000 for c in v] for k, v in rows}
    n, dims = len(x), len(next(iter(x.values())))
    sums = [sum(r[j] for r in x.values()) for j in range(dims)]
    d = {k: [n * a - s for a, s in zip(r, sums)] for k, r in x.items()}
    centred = np.array([[a / n for a in r] for r in d.values()])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, {k: sum(a * a for a in r) for k, r in d.items()}, dict(zip(d, centred @ vectors / np.sqrt(values))), values / np.trace(v)


def matches(rows, out, model, error, components=8):
    n, deviation, white, explained = reference(rows, components)
    assert model.n == n and error < 1e-9
    assert np.allclose(model.explained, explained, rtol=1e-9)
    assert {r[0]: int(r[1]) for r in out} == deviation
    got = np.array([r[2] for r in out])
    want = np.array([white[r[0]] for r in out])
    signs = np.sign((got * want).sum(0))
    assert np.allclose(got * signs, want, atol=1e-7)


def run(df, **how):
    model = whitening.fit(df, **how)
    return whitening.whitened(df, model).collect(), model, whitening.identity_error(df, model)


def some_vectors(n=300, dims=12, seed=1):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dims, dims)) * np.linspace(0.1, 2, dims)
    return [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(n, dims)) @ mix + 5)]


def test_equals_a_library_solver(spark):
    rows = some_vectors()
    out, model, error = run(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6))
    matches(rows, out, model, error)


def test_query_keeps_its_contract(spark):
    folder = "/root/testdata/sf0.001"
    out = QUERIES["op12_embedding_whitening"](spark, folder)
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r["vec_id"], list(map(float, r["embedding"]))) for r in table.collect()]
    n, deviation, white, explained = reference(rows)
    got = out.collect()
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(out.dtypes)["component"] == "int" and dict(out.dtypes)["n"] == dict(out.dtypes)["deviation"] == "bigint"
    assert len(got) == 8 * len(rows) and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    for c in range(1, 9):
        some = [r for r in got if r["component"] == c]
        assert all(r["deviation"] == deviation[r["vec_id"]] and r["n"] == n for r in some)
        sign = np.sign(sum(r["whitened"] * white[r["vec_id"]][c - 1] for r in some))
        assert all(abs(sign * r["whitened"] - white[r["vec_id"]][c - 1]) < 1e-7 for r in some)
        assert [r["explained"] for r in some] == pytest.approx([explained[c - 1]] * len(some), rel=1e-9)


def test_odd_rows(spark):
    rows = some_vectors(60, 5)
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [1.0, math.nan, 0.0, 0.0, 0.0]), (903, [math.inf] + [0.0] * 4), (904, []), (905, [1.0, 2.0]), (906, [1e300] + [0.0] * 4)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "vec", "n", "at", "deviation", "whitened")})
    out, model, error = run(df, components=5)
    assert sorted(r[0] for r in out) == [k for k, _ in rows]
    matches(rows, out, model, error, 5)
    # repeated rows and null ids count like any other
    again = spark.createDataFrame([(None, v) for _, v in rows] + rows, "vec_id long, embedding array<double>")
    assert whitening.fit(again).n == 120 and whitening.whitened(again, whitening.fit(again)).where("vec_id is null").count() == 60


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])]):
        out, model, error = run(spark.createDataFrame(rows, schema))
        assert out == [] and model.n == 0 and error == 0
    out, model, _ = run(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema))
    assert model.pairs == [] and [r[2] for r in out] == [[], []]
    # three points span a plane: two components, the others have no variance
    out, model, error = run(spark.createDataFrame([(k, v) for k, v in enumerate(np.eye(6)[:3].tolist())], schema))
    assert len(model.pairs) == 2 and error < 1e-9


def test_sums_beyond_64_bits(spark):
    def table(big):
        rows = [(k, [big * (1 if k % 2 else -1), float(k), 1.0 / (k + 1)]) for k in range(9)]
        return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    rows, df = table(float(1 << 49))
    n, deviation, _, explained = reference(rows, 1)
    out, model, _ = run(df, components=1)
    assert {r[0]: int(r[1]) for r in out} == deviation and max(deviation.values()) > 1 << 63
    assert model.explained == pytest.approx(explained, rel=1e-9)
    # beyond 38 digits there is no deviation, the rest stays
    out, _, _ = run(table(float(1 << 51))[1], components=1)
    assert [r[1] for r in out] == [None] * 9 and all(abs(r[2][0]) < 2 for r in out)


def test_common_offset_costs_no_digits(spark):
    rng = np.random.default_rng(4)
    rows = [(k, (1e6 + rng.normal(size=4) * [1, 2, 3, 4] / 64).tolist()) for k in range(200)]
    out, model, error = run(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=4)
    matches(rows, out, model, error, 4)


def random_symmetric(rng, dims):
    m = rng.normal(size=(dims, dims))
    return m + m.T


def test_pivots_count_eigenvalues():
    rng = np.random.default_rng(2)
    for dims in (1, 2, 3, 8, 20):
        for k in range(40):
            m = random_symmetric(rng, dims)
            if k % 3 == 0:
                m[np.diag_indices(dims)] = 0
            assert positive_pivots(m) == (np.linalg.eigvalsh(m) > 0).sum()


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1, 0.5], [3, 3, 3, 2, 2, 1], [1, 1, 1, 1, 1, 1], [5, 5 - 1e-13, 4, 4 - 1e-9, 1e-6, 0], [1, 0, 0, 0, 0, 0]])
def test_spectrum_slices(values):
    turn, _ = np.linalg.qr(np.random.default_rng(6).normal(size=(6, 6)))
    v = turn @ np.diag(values) @ turn.T
    v = (v + v.T) / 2
    pairs = leading(v, 6)
    assert len(pairs) == sum(x > 0 for x in values)
    assert np.allclose([p.value for p in pairs], [x for x in values if x], rtol=0, atol=1e-14 * 6 * values[0])
    q = np.array([p.vector for p in pairs])
    assert np.allclose(q @ q.T, np.eye(len(q)), atol=1e-13)
    for number, p in enumerate(pairs, 1):
        assert np.linalg.norm(v @ p.vector - p.value * p.vector) < 1e-13 * values[0]
        assert p.above_low >= number > p.above_high
