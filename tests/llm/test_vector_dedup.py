import numpy as np
import pytest
from helpers import Union

from tickerloom.llm import vector_dedup as v


def usable(x):
    return bool(x) and None not in x and np.isfinite(x).all() and any(x)


def brute(rows, least=0.95):
    """Components of rows, named by their smallest id; a row without id may be in one."""
    good = [(k, np.array(x, float) / max(map(abs, x))) for k, (_, x) in enumerate(rows) if usable(x)]
    n, u = dict.fromkeys(range(len(rows)), 0), Union()
    for a, (i, x) in enumerate(good):
        for j, y in good[:a]:
            if len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                n[i] += 1
                n[j] += 1
                u.join(i, j)
    names = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            names[u.find(k)] = min(names.get(u.find(k), i), i)
    out = [(i, n[k], names.get(u.find(k))) for k, (i, _) in enumerate(rows)]
    return sorted(((i, k, c, c is None or i == c) for i, k, c in out), key=repr)


def corpus(seed, n=250, size=32):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=size) for _ in range(n)]
    for k in range(n):
        near = rows[rng.integers(n // 10)] + rng.normal(size=size) * rng.choice([0, 0.1, 0.2, 0.3])
        rows.append(near * rng.choice([1, 1, 5.0]))
    out = [(int(i), x.tolist()) for i, x in zip(rng.permutation(2 * n), rows)]
    one = out[0][1]
    return out + [(1000, None), (1001, [0.0] * size), (1002, [None] + one[1:]), (1003, [float("nan")] + one[1:]), (1004, [float("inf")] + one[1:]), (1005, []), (None, one), (1006, one), (1006, one), (1007, one[:5]), (1008, one[:5]), (1009, [x * 1e200 for x in one])]


@pytest.mark.parametrize("seed", [1, 2])
def test_links_and_recall(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "0 as node", "0 as key")
    got = sorted((tuple(r) for r in v.near_vectors(df).collect()), key=repr)
    want = brute(rows)
    assert len(got) == len(want)
    found, all_ = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all_ > 500 and found >= 0.99 * all_ and all(g[1] <= w[1] for g, w in zip(got, want))
    assert [r[0] for r in got] == [r[0] for r in want]
    assert np.mean([g == w for g, w in zip(got, want)]) > 0.98


@pytest.mark.parametrize("size", [5, 250, 384, 768])
def test_any_number_of_dimensions(spark, size):
    rows = corpus(3, 60, size)
    got = sorted((tuple(r) for r in v.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=repr)
    want = brute(rows)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want) > 0 and len(got) == len(want)
    assert np.mean([g == w for g, w in zip(got, want)]) > 0.98


def test_rows_without_id_link(spark):
    near, other, lone = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(7, near), (None, [1.0, 0.1, 0.0]), (9, [1.0, 0.2, 0.0]), (None, other), (None, [0.1, 1.0, 0.0]), (None, lone), (None, None)]
    got = sorted((tuple(r) for r in v.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=repr)
    assert got == brute(rows) == sorted([(7, 2, 7, True), (9, 2, 7, False), (None, 2, 7, False), (None, 1, None, True), (None, 1, None, True), (None, 0, None, True), (None, 0, None, True)], key=repr)


def test_cells_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(v, "CELL", 16)
    rng = np.random.default_rng(4)
    base = rng.normal(size=64)
    rows = [(k, (base + 0.02 * rng.normal(size=64)).tolist()) for k in range(120)]
    got = sorted(tuple(r) for r in v.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(k, 119, 0, k == 0) for k in range(120)]


def test_estimates_are_unbiased_and_within_bounds():
    rng = np.random.default_rng(5)
    turn = v.rotation(64, 256, 3)
    assert np.allclose(turn @ turn.T, np.eye(64))
    x = v.units(rng.normal(size=(400, 64)))
    y = v.units(0.7 * x + 0.7 * v.units(rng.normal(size=(400, 64))))
    _, signs, factor = v.encode(x, turn)
    estimate = ((2.0 * signs - 1) * (y @ turn)).sum(1) / (16 * factor)
    off = estimate - (x * y).sum(1)
    bound = np.sqrt((1 - factor**2) / factor**2 / 255)
    assert abs(off.mean()) < 4 * bound.mean() / 20 and (np.abs(off) < 4 * bound).all()


def test_tables_follow_the_vectors():
    few, many = v.plan(1000, 0.95, 0.998, 256, 7), v.plan(10**9, 0.95, 0.998, 256, 7)
    assert few.shape[1] < many.shape[1] and len(few) < len(many)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert v.near_vectors(df).collect() == []
