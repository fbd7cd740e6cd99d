import random
from collections import Counter
from fractions import Fraction

import pytest

from pyspark.sql import functions as F
from tickerloom.llm import pfair


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 3, "b": 1}, {"a": 0.61, "b": 0.3, "c": 0.08, "d": 0.01}, {str(k): k + 1 for k in range(20)}])
def test_every_prefix_is_within_a_block(weights):
    share = pfair.shares(weights, 1000)
    assert sum(share.values()) == 1000 and min(share.values()) >= 1
    order = pfair.schedule(share)
    done = Counter()
    for t, s in enumerate(order * 2, 1):
        done[s] += 1
        assert all(abs(done[x] - Fraction(n * t, 1000)) < 1 for x, n in share.items())


def rows():
    rng = random.Random(1)
    out = [(k, rng.choice(["web"] * 5 + ["books", "code", None]), "x" * rng.choice([0, 5, 50, 90, 400])) for k in range(600)]
    return out + [(7, "web", "x" * 30), (7, "web", "x" * 30), (None, "code", None), (600, "books", "y" * 5000)]


def test_blocks_slots_and_windows(spark):
    df = spark.createDataFrame(rows(), "doc_id long, source string, text string").withColumn("slot", F.lit(9)).withColumn("extra", F.lit(1))
    weights = {"web": 0.5, "books": 0.2, "code": 0.2, None: 0.1}
    got = pfair.mixed_order(df, weights, block=300, period=50)
    assert set(df.columns) <= set(got.columns)
    got = got.collect()
    assert sorted(Counter((r.doc_id, r.text) for r in got).items(), key=repr) == sorted(Counter((i, t) for i, _, t in rows()).items(), key=repr)
    share = {s: int(w * 50) for s, w in weights.items()}
    share = pfair.shares(weights, 50)
    per = {}
    for r in got:
        assert r.release <= r.slot < r.deadline
        assert r.release == r.block * 50 // share[r.source] and r.deadline == -(-(r.block + 1) * 50 // share[r.source])
        per.setdefault(r.source, []).append(r)
    for rs in per.values():
        rs.sort(key=lambda r: (r.slot, r.place))
        at = 0
        for r in rs:
            assert (r.block, r.place) == (at // 300, at % 300)
            at += max(1, len(r.text or ""))
    slots = {}
    for r in got:
        assert slots.setdefault(r.slot, r.source) == r.source
    end = max(r.slot for r in got if r.in_mix) + 1
    assert end > 20 and all(r.in_mix == (r.slot < end) for r in got if r.slot != end)
    # in the mix, every prefix of slots holds each source's blocks to within one
    blocks = {s: sum(max(1, len(r.text or "")) for r in rs) // 300 for s, rs in per.items()}
    order = pfair.schedule(share)
    done = Counter()
    for t in range(1, end + 1):
        done[order[(t - 1) % 50]] += 1
        assert all(abs(done[s] - Fraction(n * t, 50)) < 1 for s, n in share.items())
        assert all(done[s] <= blocks[s] + 1 for s in share)


def test_default_weights_unnamed_sources_and_empty_table(spark):
    df = spark.createDataFrame(rows(), "doc_id long, source string, text string")
    got = pfair.mixed_order(df, {"web": 1}, block=300).collect()
    assert all((r.slot is None) == (r.source != "web") for r in got) and len(got) == len(rows())
    assert pfair.mixed_order(df, block=300, period=20).where("slot is null").count() == 0
    assert pfair.mixed_order(df.limit(0)).collect() == []


def test_many_buckets_give_the_same_order(spark, monkeypatch):
    df = spark.createDataFrame(rows(), "doc_id long, source string, text string")
    one = sorted(map(repr, pfair.mixed_order(df, block=300).collect()))
    monkeypatch.setattr(pfair, "BUCKET", 20)
    assert sorted(map(repr, pfair.mixed_order(df, block=300).collect())) == one


def test_weights_must_fit():
    with pytest.raises(ValueError):
        pfair.shares({"a": 0}, 10)
    with pytest.raises(ValueError):
        pfair.shares({str(k): 1 for k in range(11)}, 10)


@pytest.mark.parametrize("weights", [{str(k): 0.5 if k == 0 else 0.5 / 19 for k in range(20)}, {"a": 0.2029, "b": 0.7, "c": 0.0971}])
def test_given_weights_hold_over_many_periods(spark, weights):
    docs = spark.createDataFrame([(k, s, "x" * 10) for s, w in weights.items() for k in range(int(w * 6000) + 1)], "doc_id long, source string, text string")
    got = pfair.mixed_order(docs, weights, block=10).where("in_mix").select("slot", "source").distinct().orderBy("slot").collect()
    done, total = Counter(), sum(Fraction(str(w)) for w in weights.values())
    for t, r in enumerate(got, 1):
        assert r.slot == t - 1
        done[r.source] += 1
        if t % 97 == 0 or t > len(got) - 50:
            assert all(abs(done[s] - Fraction(str(w)) / total * t) < 1 for s, w in weights.items())
    assert len(got) > 5000


def test_more_sources_than_a_period(spark):
    df = spark.range(6000).selectExpr("id as doc_id", "concat('host', id % 1500) as source", "repeat('x', 100) as text")
    got = pfair.mixed_order(df, block=100).collect()
    assert len({r.slot for r in got}) == len(got) == 6000 and all(r.release <= r.slot < r.deadline for r in got)
    assert sum(r.in_mix for r in got) == 6000


def test_shares_follow_weights():
    assert pfair.shares({"a": 0.5, "b": 0.2, "c": 0.2, "d": 0.1}, 50) == {"a": 25, "b": 10, "c": 10, "d": 5}
    assert pfair.shares({"a": 0.5} | {str(k): Fraction(1, 38) for k in range(19)}, 1000)["a"] == 500
    assert pfair.shares({"a": 998, "b": 1, "c": 0.001}, 10) == {"a": 8, "b": 1, "c": 1}
