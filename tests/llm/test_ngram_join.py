import random
from itertools import combinations

import numpy as np
import pytest
from helpers import Union, corpus, shingle_set, words

from tickerloom.llm import ngram_join
from tickerloom.llm.components import components
from tickerloom.llm.ngram_join import _blocks, jaccard_groups


def brute(rows, percent=80):
    sets = [(i, shingle_set(t)) for i, t in rows]
    u = Union()
    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            u.join(a, b)
    return sorted((i, len(s), u.find(i)) for i, s in sets)


def ours(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in jaccard_groups(df, **more).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert ours(spark, rows) == brute(rows)


def test_chain_of_near_copies_and_borderline_sizes(spark):
    rng = random.Random(5)
    text, rows = words(rng, 60), []
    for k in range(40):
        rows.append((k * 3 % 101, " ".join(text)))
        text[rng.randrange(len(text))] = f"x{k}"
    rows += [(500, "a b c d e f g h i"), (501, "a b c d e f g h"), (502, "a b c d e f g h i j k"), (503, "a b c d")]
    assert ours(spark, rows) == brute(rows)


def test_many_documents_share_a_passage(spark):
    rng = random.Random(6)
    hot = words(rng, 30)
    rows = [(k, " ".join(words(rng, 6) + hot + words(rng, k % 3))) for k in range(80)]
    assert ours(spark, rows) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "q r s t u v"), (2, "a b c d e f"), (3, "q r s t u v"), (None, "a b c d e f"), (None, "alone in here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard_groups(df).collect())
    assert got == [(0, 1, 0), (0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1)]


def test_shingles_that_the_cut_makes_equal_count_each():
    """Two shingles of one document with equal low bits: one is sent, both count as shared."""
    low, blocks = 77, 4
    # block 1 twice, block 2 once; a second document has other shingles
    grams = np.array([(1 << 32) | low, (5 << 32) | low, (2 << 32) | low, (9 << 32) | 5], np.uint64)
    rows, owner, often = _blocks(np.array([10, 11], np.uint64), grams, np.array([3, 1]), blocks, False)
    assert owner.tolist() == [0, 0, 0, 1] and sorted(often[:2].tolist()) == [False, True] and not often[2:].any()
    sent = {r["block"]: len(r["grams"]) // 4 for r in rows}
    assert sent == {1: 2, 2: 1}


def test_many_blocks(spark, monkeypatch):
    """Blocks follow the bytes of the texts and the shingles of open documents."""
    rows = corpus(4)
    monkeypatch.setattr(ngram_join, "BYTES", 500)
    monkeypatch.setattr(ngram_join, "CELLS", 200)
    assert ours(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, node long, size int")
    assert jaccard_groups(df).collect() == []
    df = spark.createDataFrame([(1, "a b", 5, 6, 7)], "doc_id long, text string, node long, id int, label int")
    assert [tuple(r) for r in jaccard_groups(df).collect()] == [(1, 1, 1)]


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(200, 260)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(50)] + [(7, 7), (None, 4)]
    u = Union()
    for a, b in edges:
        if a is not None and a != b:
            u.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {x: u.find(x) for x in list(u.up)}


def test_stars_take_no_round(spark, monkeypatch):
    """Two more rounds only showed that nothing changes any more."""
    from tickerloom.llm import components as module

    rounds, was = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: (rounds.append(name), was(df, name))[1])
    links = [(1, 7), (1, 8), (9, 1), (4, 5), (3, 3), (None, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    assert got == {1: 1, 7: 1, 8: 1, 9: 1, 4: 4, 5: 4} and len(rounds) == 1
