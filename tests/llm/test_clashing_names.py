"""Functions that return the caller's rows keep them whatever their columns are called."""

import pytest
from helpers import words
from pyspark.sql import functions as F
from test_decontaminate import items

from tickerloom.llm import decontaminate, line_dedup, ngram_join, pfair, span_dedup

NAMES = ("__id", "__hash", "__cut", "__cuts", "__leak", "__source", "__size", "__order", "__tie", "__bucket", "__before", "__at", "__slot", "__sum", "__SIZE_", "__id_")


def rows():
    import random

    rng = random.Random(2)
    bench = items(rng, 6)
    texts = [" ".join(words(rng, 60)) + ".\n" + " ".join(words(rng, 30)) + "." for _ in range(12)]
    texts += [texts[0], texts[1] + " more", bench[0][1] + " " + texts[2], texts[3].split("\n")[0] + "\n" + texts[4]]
    return [(k, t, "ab"[k % 2]) for k, t in enumerate(texts)], bench


@pytest.mark.parametrize("act", ["lines", "copies", "leaks", "spans", "mix"])
def test_same_rows_with_clashing_names(spark, act):
    data, bench = rows()
    plain = spark.createDataFrame(data, "doc_id long, text string, source string")
    clashing = plain.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in NAMES})
    table = spark.createDataFrame(bench, "item_id long, text string")
    run = {
        "lines": lambda df: line_dedup.without_repeats(df, radius=None), "copies": ngram_join.without_copies,
        "leaks": lambda df: decontaminate.without_leaks(df, table), "spans": span_dedup.without_repeats, "mix": lambda df: pfair.mixed_order(df, block=500),
    }[act]
    want, got = run(plain), run(clashing)
    added = [c for c in want.columns if c not in plain.columns]
    assert got.columns == clashing.columns + added
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    assert all(r[c] == f"{c}{r['doc_id']}" for r in got.collect() for c in NAMES)


def test_a_long_corpus_has_longer_blocks(spark, monkeypatch):
    monkeypatch.setattr(pfair, "BLOCKS", 4)
    docs = spark.createDataFrame([(k, "x" * 60_000, "ab"[k % 3 == 0]) for k in range(30)], "doc_id long, text string, source string")
    out = pfair.mixed_order(docs).collect()
    assert len(out) == 30 and len({(r.source, r.block) for r in out}) <= 6
    assert all(r.release <= r.slot < r.deadline for r in out if r.in_mix)
