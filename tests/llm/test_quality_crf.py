import itertools
import random
import zlib

import numpy as np
import pyarrow as pa

from tickerloom.llm import quality_crf as q
from tickerloom.llm.common import text_pieces


def test_marginals_and_totals_equal_enumeration():
    rng = np.random.default_rng(1)
    chain = q.Chain(3)
    chain.emit, chain.start, chain.move = rng.normal(size=3), rng.normal(size=2), rng.normal(size=(2, 2))
    sizes = np.array([1, 4, 2, 6])
    x = rng.normal(size=(sizes.sum(), 3))
    got = chain.marginals(x, sizes)
    at = 0
    for n in sizes:
        weight = {}
        for path in itertools.product((0, 1), repeat=int(n)):
            s = chain.start[path[0]] + sum(chain.emit @ x[at + k] * y for k, y in enumerate(path)) + sum(chain.move[a, b] for a, b in zip(path, path[1:]))
            weight[path] = np.exp(s)
        for k in range(n):
            assert np.isclose(got[at + k], sum(w for p, w in weight.items() if p[k]) / sum(weight.values()))
        at += n


def test_fit_separates_and_uses_neighbours():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 9, 300)
    labels = rng.integers(0, 2, 300)
    x = rng.normal(size=(sizes.sum(), 2)) + np.repeat(labels, sizes)[:, None] * [1.5, 0.0]
    x[:, 1] = 1
    chain = q.Chain(2).fit(x, sizes, labels, np.ones(300), 150)
    p = chain.marginals(x, sizes)
    mean = np.array([v.mean() for v in np.split(p, np.cumsum(sizes)[:-1])])
    assert ((mean > 0.5) == labels).mean() > 0.85
    assert chain.move[0, 0] + chain.move[1, 1] > chain.move[0, 1] + chain.move[1, 0] + 1


def test_features_do_not_depend_on_the_batch():
    texts = ["One line.\nTwo!! LINES!!", "", "a\n\n\nb", None, "| x | y |\n" * 30, "é"]
    whole = [x for *_, d, o in text_pieces(pa.array(texts)) for x in [q.line_features(d, o)]]
    lone = [q.line_features(d, o)[0] for t in texts for *_, d, o in text_pieces(pa.array([t], pa.string()))]
    assert np.allclose(whole[0][0], np.concatenate(lone))
    assert whole[0][1].tolist() == [0, 0, 2, 2, *[4] * 30, 5]


def corpus(n=300):
    rng = random.Random(3)
    words = lambda k: " ".join(rng.choice(["stone", "river", "and", "the", "light", "goes"]) for _ in range(k))
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        lines = [(words(9).upper().replace(" ", "!! ") if bad else words(12) + ".") for _ in range(rng.randrange(1, 9))]
        rows.append((k, "\n".join(lines)))
        labels.append((k, int(not bad)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus()
    odd = [(900, None), (901, ""), (902, "\n \n"), (None, "the river goes."), (3, "STONE!! STONE!!"), (903, "x" * 300_000)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").selectExpr("*", "0 as label", "0 as score")
    table = spark.createDataFrame([x for x in labels if zlib.crc32(str(x[0]).encode()) % 5] + [(None, 1), (5, None), (7, 1), (7, 0)], "doc_id long, quality int")
    chain = q.train(docs, table)
    got = {}
    for r in q.scored(docs, chain).collect():
        got.setdefault(r.doc_id, []).append((r.score, r.predicted))
    assert sum(map(len, got.values())) == len(rows) + len(odd)
    held = [(k, y) for k, y in labels if zlib.crc32(str(k).encode()) % 5 == 0 and k != 3]
    assert np.mean([got[k][0][1] == y for k, y in held]) > 0.95
    assert [got[k] for k in (900, 901, 902)] == [[(0.0, 0)]] * 3
    assert len(got[3]) == 2 and all(0 <= s <= 1 and p == int(s >= 0.3) for v in got.values() for s, p in v)
    kept = q.without_rejected(docs, chain)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(k) for k, v in got.items() for _, p in v if p)


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert q.train(docs, none) is None
    assert sorted(tuple(r) for r in q.scored(docs, None).collect()) == [(1, 0.5, 1), (2, 0.0, 0)]
    assert q.scored(docs.limit(0), None).collect() == []
