import random
import re

import numpy as np

from tickerloom.llm import url_filter as u

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def brute(url, rules, listed):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x.group().lower(), m[1]), m[2]) if m else ("", "")

    def fits(entry):
        h, slash, p = entry.partition("/")
        return (host == h or host.endswith("." + h)) and path.startswith(slash + p)

    best = max((r for r in rules if fits(r[0])), key=lambda r: len(r[0]), default=None)
    on = max((x for x in listed if fits(x)), key=len, default=None)
    return host, path, best and best[0], best[1] if best else "block" if on else "allow", on


def filtered(spark, rules=RULES, listed=("bad.net", "worse.com/x", "deep.bad.net")):
    rows = [(r, v, True) for r, v in rules] + [(x, "block", False) for x in listed]
    return u.UrlFilter(spark.createDataFrame(rows, "entry string, verdict string, rule boolean"))


def test_equals_trying_every_entry(spark, monkeypatch):
    rng = random.Random(1)
    urls = [None, "", "no scheme/es/", "x://", "://example.org/es/", "http://EXAMPLE.org", "http://example.org?q", "HTTP://A.example.ORG/es/1#x", "a://b://c.org/es/", "http://exämple.org/es/", "http://org/\n/x", "http://notexample.org/es/a", "http://bad.net", "http://a.deep.bad.net/", "http://bad.net.org/", "http://worse.com/xyz", "http://worse.com/"]
    for _ in range(300):
        host = ".".join(rng.choice([["www"], ["a", "b"], []]) + rng.choice([["example"], ["bad"], ["worse"], ["x", "example"]]) + [rng.choice(["org", "com", "net", "de"])])
        urls.append(f"http://{host}" + rng.choice(["", "/", "/es", "/es/", "/en/1", "/en/12?x", "/fr/a#b", "/de/", "/x/y", "?q=/de/"]))
    rows = list(enumerate(urls)) + [(None, "http://example.org/es/"), (3, "http://bad.net")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as id", "2 as host", "3 as rule")
    want = sorted(((i, *brute(x, RULES, ["bad.net", "worse.com/x", "deep.bad.net"])) for i, x in rows), key=repr)
    assert sorted((tuple(r) for r in filtered(spark).judge(pages).collect()), key=repr) == want
    monkeypatch.setattr(u, "SHARD", 3)
    several = filtered(spark)
    assert len(several.names) > 1
    assert sorted((tuple(r) for r in several.judge(pages).collect()), key=repr) == want


def test_digests_are_sparks(spark):
    texts = ["", "a", "org/", "exämple.org/" + "x" * 100]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("xxhash64(t)").collect()]
    assert u.digests([t.encode() for t in texts]).tolist() == got


def test_equal_digests_are_told_apart_by_text():
    shard = u.Shard.__new__(u.Shard)
    texts = [b"aa", b"b", b"ccc"]
    shard.digests, shard.edges = np.array([5, 5, 9]), np.cumsum([0, *map(len, texts)])
    shard.kinds, shard.texts = np.array([0, 1, 3], np.uint8), np.frombuffer(b"".join(texts), np.uint8)
    probes = np.array([5, 5, 5, 9, 9, 1, 99])
    assert shard.find(probes, [b"b", b"aa", b"zz", b"ccc", b"b", b"aa", b"ccc"]).tolist() == [1, 0, -1, 3, -1, -1, -1]


def test_labelled_domains_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://m.spam.example.org/x"), (2, "https://ok.net"), (3, None), (4, "http://SPAM.net"), (5, "http://spam.x.spam.de")], "page_id long, url string")
    entries = u.labelled_domains(pages, ["spam"])
    assert {r.entry for r in entries.collect()} == {"spam.example.org", "spam.net", "spam.x.spam.de", "spam.de"}
    got = {r.page_id: r.verdict for r in u.UrlFilter(entries).judge(pages).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "block"}
    none = u.UrlFilter(entries.limit(0))
    assert {r.verdict for r in none.judge(pages).collect()} == {"allow"}
    assert u.UrlFilter(entries).judge(pages.limit(0)).collect() == []
