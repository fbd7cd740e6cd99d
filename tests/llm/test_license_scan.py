import random

import pytest
from pyspark.sql import functions as F

from tickerloom.llm import license_scan
from tickerloom.llm.license_scan import TEMPLATES, AnyWords, Automaton, Template, Word, license_places, parsed, words_of
from tickerloom.llm.queries import QUERIES


def ends(regions, words, at):
    """All places where the regions can end that begin at a word: plain search."""
    if not regions:
        return {at}
    region, rest = regions[0], regions[1:]
    if isinstance(region, Word):
        return ends(rest, words, at + 1) if at < len(words) and words[at] == region.text else set()
    if isinstance(region, AnyWords):
        return set().union(*(ends(rest, words, at + k) for k in range(region.least, region.most + 1) if at + k <= len(words)))
    return set().union(*(ends((*way, *rest), words, at) for way in region.ways))


def reference(text, templates):
    words = words_of(text or "")
    found = []
    for t in templates:
        regions = parsed(t.text)
        for at in range(len(words)):
            stops = ends(regions, words, at)
            if stops:
                found.append((t.name, t.label, t.weight, t.base, at, max(stops) - at))
    return len(words), sorted(found)


def scanned(spark, rows, templates):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(((r[0], r[1], sorted(map(tuple, r[2]))) for r in license_places(df, templates).collect()), key=repr)


def check(spark, texts, templates):
    rows = list(enumerate(texts))
    assert scanned(spark, rows, templates) == sorted(((k, *reference(t, templates)) for k, t in rows), key=repr)


SMALL = [
    Template("plain", "p", "a b c", 0.5, True),
    Template("optional", "o", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>> d<<endOptional>> e"),
    Template("holder", "h", 'a <<var;name="x";original="b";match=".{1,4}">> c d', 0.7),
    Template("ways", "w", 'b <<var;match="c d|d||c c c">> a <<var;match=".?">> e'),
    Template("loose end", "l", "d e<<beginOptional>> a b<<endOptional>>"),
    Template("one", "s", 'c <<var;match=".">> c'),
]


def test_equals_plain_search_on_random_words(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("aabbccdde") for _ in range(rng.choice([0, 1, 3, 10, 60]))) for _ in range(150)]
    texts += [rng.choice([" ", ", ", "\n\n", "-"]).join(t.split()).upper() for t in texts]
    check(spark, texts, SMALL)


MIT = next(t.text for t in TEMPLATES if t.name == "mit text")


def variants():
    """License texts as they are found in the wild, and texts that miss a mandatory word."""
    import re

    plain = re.sub(r"<<(begin|end)Optional>>", "", re.sub(r'<<var;.*?original="(.*?)".*?>>', r"\1", MIT))
    short = re.sub(r"<<beginOptional>>.*?<<endOptional>>", "", re.sub(r'<<var;.*?original="(.*?)".*?>>', "ACME Inc.", MIT))
    yield from (plain, short, plain.upper(), plain.replace(" ", "\n * "), f"x {short} y {plain}")
    yield from (plain.replace("sublicense", ""), plain.replace("hereby", "thereby"), plain[:-12])


def test_license_texts(spark):
    texts = [
        *variants(),
        "Released under the MIT License", "It is released under the terms of the MIT license.", "under the MITlicense", "under the mit  licenses", "Under The MIT, License!",
        "licensed under the Apache License, Version 2.0 and CC BY-NC 4.0, or CC-BY-NC-SA", "apache license version 2 apache license version 2",
        "This work is licensed under the GNU General Public License, version 3", "licensed under the GNU General Public License as published by the Free Software Foundation; either version 2",
        "SPDX-License-Identifier: Apache-2.0", "spdx license identifier gpl 2", "licensed under a CC BY-NC-ND 3.0 license", "\u00e9under the mit license", "under the mit\u00a0license",
    ]
    check(spark, texts, TEMPLATES)
    found = {k: {p[1] for p in places} for k, _, places in scanned(spark, list(enumerate(texts[:8])), TEMPLATES)}
    assert [found[k] for k in range(8)] == [{"mit"}] * 5 + [set()] * 3


def test_odd_rows(spark):
    long = "word " * 400_000 + "under the MIT License " + "word " * 100
    rows = [(1, None), (2, ""), (3, " .,- "), (None, "cc by nc"), (4, "cc by nc"), (4, "cc by nc"), (5, long), (6, "cc by"), (7, "nc cc by nc cc by nc")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "n_words", "places", "label")})
    out = sorted(map(tuple, license_places(df, TEMPLATES).select("doc_id", "n_words", F.transform("places", lambda p: p["first"])).collect()), key=repr)
    assert out == sorted([(1, 0, []), (2, 0, []), (3, 0, []), (None, 3, [0]), (4, 3, [0]), (4, 3, [0]), (5, 400_104, [400_000]), (6, 2, []), (7, 7, [1, 4])], key=repr)
    assert license_places(df.limit(0), TEMPLATES).collect() == []


def test_many_places_in_one_text(spark):
    n = 30_000
    rows = [(1, "under the mit license " * n)]
    out = query_rows(spark, rows)
    assert out == [(1, 4 * n, n, 0, 4 * (n - 1), "mit", "mit", 0.5)]


def query_rows(spark, rows):
    folder = spark.conf.get("spark.checkpoint.dir") + f"/license-{random.random()}"
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return sorted(map(tuple, QUERIES["op13_license_scan"](spark, folder).collect()))


def test_query_columns(spark):
    rows = [
        (1, None), (2, "CC BY-NC, released under the MIT license; Apache License Version 2"), (3, "licensed under the GNU General Public License, version 3"),
        (4, "SPDX-License-Identifier: MIT"),
    ]
    assert query_rows(spark, rows) == [
        (1, 0, 0, None, None, "", "", 0.0), (2, 12, 3, 0, 8, "apache-2,cc-by-nc,mit", "apache-2,cc-by-nc,mit", 0.8),
        (3, 9, 0, None, None, "", "gpl-3", 0.8), (4, 4, 0, None, None, "", "mit", 1.0),
    ]


@pytest.mark.parametrize("text", ["", "<<beginOptional>>a", "a<<endOptional>>", "<<beginOptional>>a<<endOptional>>", '<<var;match=".{3,2}">> a', "<<var;name=x>> a", "<<what>> a"])
def test_bad_templates(text):
    with pytest.raises(ValueError):
        Automaton([Template("x", "x", text)])


def test_too_wide_regions(monkeypatch):
    monkeypatch.setattr(license_scan, "STATES", 1000)
    with pytest.raises(ValueError):
        Automaton([Template("x", "x", 'a <<var;match=".{1,40}">> a <<var;match=".{1,40}">> a b')])
