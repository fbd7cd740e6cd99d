import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import words

from tickerloom.llm import decontaminate as d
from tickerloom.llm.common import MARKS, text_pieces, word_hashes


def items(rng, n=30):
    common = words(rng, 12)
    return [(k, " ".join(w if rng.random() < 0.6 else rng.choice(common) for w in words(rng, rng.randrange(4, 40))) + ". Answer " + " ".join(words(rng, 3)) + ".") for k in range(n)]


def tokens(text):
    return re.findall("[a-z0-9]+", text.lower())


def scores(passage, bench, k1=1.2, b=0.75):
    """Share of each item's BM25 weight that the passage has, term by term."""
    docs = [Counter(tokens(t)) for _, t in bench]
    mean = sum(sum(x.values()) for x in docs) / len(docs)
    df = Counter(w for x in docs for w in x)
    out = []
    for x in docs:
        weight = {w: math.log1p((len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * n * (k1 + 1) / (n + k1 * (1 - b + b * sum(x.values()) / mean)) for w, n in x.items()}
        out.append(sum(v for w, v in weight.items() if w in passage) / sum(weight.values()))
    return out


def test_wand_finds_all_items_above_the_threshold():
    rng = random.Random(2)
    bench = items(rng)
    pool = [w for _, t in bench for w in tokens(t)]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.choice([0, 5, 60, 300]))) for _ in range(25)] + [t for _, t in bench[:5]]
    for threshold in (0.2, 0.35, 0.5):
        split = [d.split_item(t) for _, t in bench]
        known = list(zip([i for i, _ in bench], d.hashed([t for _, t in bench]), d.hashed([q for q, _ in split]), d.hashed([a for _, a in split])))
        index = d.Index(known, 64, threshold, 1.2, 0.75)
        got = {}
        for first, _, data, offsets in text_pieces(pa.array(texts)):
            for k, at, item, score in index.search(*word_hashes(data, offsets, MARKS)):
                got[first + k, at, item] = score
        want = {}
        for k, text in enumerate(texts):
            w = tokens(text)
            for at in range(0, len(w), index.window):
                for item, score in enumerate(scores(set(w[at : at + 2 * index.window]), bench)):
                    if score >= threshold:
                        want[k, at, item] = score
        assert set(got) == set(want) and len(want) > 5
        assert np.allclose([got[x] for x in want], [want[x] for x in want])


def test_leaks_are_found_and_clean_documents_left(spark):
    rng = random.Random(3)
    bench = items(rng)
    rows = [(k, " ".join(words(rng, rng.choice([3, 200, 700])))) for k in range(40)]
    want = set()
    for k in range(0, 40, 4):
        item, text = bench[rng.randrange(len(bench))]
        body = rows[k][1].split()
        body.insert(rng.randrange(len(body) + 1), rng.choice([text, text.upper().replace(" ", "\n")]))
        rows[k] = (k, " ".join(body))
        want.add((k, item))
    question = d.split_item(bench[0][1])[0]
    rows += [(50, question), (51, None), (52, ""), (None, bench[1][1]), (53, bench[2][1]), (53, bench[2][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as item", "2 as score")
    table = spark.createDataFrame(bench + [(99, None), (98, "..."), (97, "")], "item_id long, text string")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.item_id) for r in d.contaminated(docs, table).collect())
    assert got == sorted([*want, (-1, 1), (53, 2), (53, 2)])
    kept = d.without_leaks(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in want} - {53}


def test_scores_do_not_depend_on_the_parts(spark, monkeypatch):
    """The same hits and scores, equal to the whole benchmark's weights, however it is cut."""
    rng = random.Random(8)
    bench = [*items(rng, 40), (90, " ".join(words(rng, 90)) + ". Answer " + " ".join(words(rng, 4)) + "."), (3, "A repeated item. Twice.")]
    damaged = lambda t: " ".join(w for w in t.split() if rng.random() < 0.75)
    rows = [(k, " ".join(words(rng, 20)) + " " + damaged(bench[k % 42][1])) for k in range(84)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(bench, "item_id long, text string")

    def hits():
        return {(r.doc_id, r.item_id): r.score for r in d.contaminated(docs, table, threshold=0.4).collect()}

    whole = hits()
    assert len(whole) > 25
    for size in (1000, 4000):
        monkeypatch.setattr(d, "PART", size)
        cut = hits()
        assert set(cut) == set(whole) and all(abs(cut[x] - whole[x]) < 1e-9 for x in whole)
    plain = {(k, i): s for k, t in rows for (i, _), s in zip(bench, scores(set(tokens(t)), bench))}
    near = [x for x in whole if x[1] != 3 and len(dict(rows)[x[0]].split()) < 60]
    assert near and all(abs(whole[x] - plain[x]) < 1e-9 for x in near)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contaminated(docs, none).collect() == []
    assert d.contaminated(docs.limit(0), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).collect() == []


def test_split():
    assert d.split_item("What is it? A thing.") == ("What is it?", "A thing.")
    assert d.split_item("one two three") == ("one two", "three")
    assert d.split_item("one") == ("one", "")
