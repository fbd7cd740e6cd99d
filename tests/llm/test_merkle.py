import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tickerloom.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, arity):
    """The root over the nodes, and for each the siblings (before, after) on its way."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + arity] for k in range(0, len(nodes), arity)]
        for k, place in enumerate(at):
            run, slot = runs[place // arity], place % arity
            paths[k].append((run[:slot], run[slot + 1 :]))
            at[k] = place // arity
        nodes = [h("".join(run)) for run in runs]
    return nodes[0], paths


def fold(now, path):
    for before, after in path:
        now = h("".join([*before, now, *after]))
    return now


def reference(rows, arity=3, tamper=lambda row: row):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found, subroots = [], []
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subroot, paths = climb([leaf(r) for r in ordered], arity)
        subroots.append(subroot)
        found.append((ordered, paths))
    root, tops = climb(subroots, arity)
    out = []
    for (ordered, paths), subroot, top in zip(found, subroots, tops):
        for row, path in zip(ordered, paths):
            whole = path + top
            proof = h("".join(x for before, after in whole for x in [*before, *after]))
            again = fold(leaf(tamper(row)), whole)
            out.append((row[0], row[1], leaf(row), subroot, root, proof, again, again == root))
    return sorted(out, key=repr)


def result(df, arity=3, **how):
    out = merkle.manifest(df, arity=arity, **how)
    proof = F.sha2(merkle.as_text(merkle.siblings(F.col("path"))), 256)
    rows = out.select("doc_id", "source", "leaf", "subroot", "root", proof, "folded_root", "verified").collect()
    return sorted(map(tuple, rows), key=repr)


def some_rows(seed=3, n=150):
    rng = random.Random(seed)
    sources = ["a", "a", "a", "b", "é", "z" * 5, None, ""]
    rows = [
        (k, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, k]), rng.choice(["x\ny", "", None, "é ü", "1:2-", "line\n" * 50]))
        for k in rng.sample(range(10_000), n)
    ]
    # a lone row, repeated rows, one id with two texts, and rows without id
    return [*rows, (7, "lone", None, 0, "x"), *[(20_001, "a", "en", 1, "same")] * 5, (20_002, "b", "en", 1, "one"), (20_002, "b", "en", 1, "two"), (None, "b", None, None, None), (None, None, None, None, "t")]


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_equals_plain_trees(spark, arity):
    rows = some_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert result(df, arity) == reference(rows, arity)
    assert all(row[-1] for row in result(df, arity))


def test_changed_rows_fail_and_others_pass(spark):
    rows = some_rows(5)
    df = spark.createDataFrame(rows, SCHEMA)
    seen = {"text": F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))}

    def tamper(row):
        if row[0] is None or row[0] % 2 or row[4] is None:
            return row
        return (*row[:4], row[4].replace("\n", ""))

    expected = reference(rows, 3, tamper)
    assert result(df, found=seen) == expected
    assert {row[-1] for row in expected} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28])
def test_small_groups(spark, n):
    rows = [(k, "s", "en", 1, f"t{k}") for k in range(n)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == (reference(rows) if rows else [])


def test_many_groups_of_one(spark):
    rows = [(k, f"s{k}", None, None, None) for k in range(40)]
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5)) == reference(rows)


def test_extra_columns_long_texts_and_other_roles(spark):
    rows = [(k, "s" if k % 3 else "t", "en", k, "word \n" * 200_000 if k == 4 else f"t{k}") for k in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = df.withColumns({c: F.lit(9) for c in ("h", "tree", "i", "n", "path", "root", "order", "group_", "part", "at", "before", "leaf")})
    assert result(clashing) == reference(rows)
    renamed = df.withColumnsRenamed({"doc_id": "tree", "source": "path_"})
    out = merkle.manifest(renamed, ["tree", "path_", "lang", "n_chars", "text"], "path_", "tree")
    assert out.columns[:2] == ["tree", "path_"]
    assert sorted(r["leaf"] for r in out.collect()) == sorted(leaf(r) for r in rows)


def test_fields_cannot_be_read_two_ways(spark):
    rows = [(1, "a", "b", None, "-"), (2, "a", "b", None, None)]
    leaves = {r[2] for r in result(spark.createDataFrame(rows, SCHEMA))}
    assert len(leaves) == 2
    with pytest.raises(ValueError):
        merkle.manifest(spark.createDataFrame(rows, SCHEMA), arity=1)
