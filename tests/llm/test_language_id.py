import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tickerloom.llm import language_id as li

STEMS = {"aa": ["the", "ing", "wh", "th"], "bb": ["sch", "ung", "ich", "ü"], "cc": ["eau", "é", "oi", "que"], "dd": ["ción", "ñ", "ar", "os"], "ee": ["ij", "oe", "aan", "ge"]}


def texts(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        lang = rng.choice(list(STEMS))
        make = lambda: "".join(rng.choice(STEMS[lang]) for _ in range(rng.randrange(1, 4)))
        out.append((k, " ".join(make() for _ in range(rng.choice([3, 20, 100]))), lang))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 40])
def test_codewords_are_apart(n):
    code = li.codebook(n)
    assert len(code) == n and set(np.unique(code)) <= {-1.0, 1.0}
    if n > 1:
        assert (np.abs(code.sum(0)) < n).all()
        assert li.distance(code) >= (1 if n == 2 else 2 if n == 3 else 4)
    if 2 < n <= 7:
        assert len({tuple(c * c[0]) for c in code.T}) == code.shape[1]


def test_decoding_corrects_wrong_bits_and_flags_ambiguity():
    code = li.codebook(5)
    model = li.Model(list("abcde"), code, np.zeros((li.SLOTS, code.shape[1])), np.zeros(code.shape[1]), np.ones(code.shape[1]))
    assert model.correct == 3
    for k in range(5):
        margins = 4 * code[k]
        margins[:3] *= -0.2
        name, score, second, odd = model.decode(margins)
        assert name == "abcde"[k] and score > 0.9 and second != name and not odd
    name, score, _, odd = model.decode(np.zeros(code.shape[1]))
    assert (name, odd) == ("a", True) and np.isclose(score, 0.2)
    assert model.decode(2 * (code[1] + code[3]))[3]


def test_slots_ignore_what_is_not_a_letter():
    assert li.gram_slots("Ab, c").tolist() == li.gram_slots("ab 12 C!").tolist()
    assert len(li.gram_slots("")) == 0
    whole = li.gram_slots("é" * 10)
    assert len(whole) == 10 + 11 + 10


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 50])
def test_cuts_change_nothing(monkeypatch, piece):
    texts_ = ["", "a", "Ab, c", " x", "...", "ab 12 C! é\U00030000z " * 9, "a" * 20, "\ud800 b"]
    whole = [sorted(li.gram_slots(t).tolist()) for t in texts_]
    monkeypatch.setattr(li, "PIECE", piece)
    assert [sorted(li.gram_slots(t).tolist()) for t in texts_] == whole
    assert li.gram_slots("\U00030000").size == 4


def plain_grams(text):
    """N-grams of a whole text with their numbers, character by character."""
    chars = [" "]
    for c in text.lower():
        if c.isalpha():
            chars.append(c)
        elif chars[-1] != " ":
            chars.append(" ")
    if chars[-1] != " ":
        chars.append(" ")
    out = Counter("".join(chars[k : k + n]) for n in (1, 2, 3) for k in range(len(chars) - n + 1))
    del out[" "]
    return out


def test_decoding_equals_plain_loss_sums(spark):
    """Every prediction against loops over grams, classifiers and codewords of the whole text."""
    rows = [(k, t * (500_000 // len(t)) if k % 40 == 0 else t, lang) for k, t, lang in texts(160, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.train(docs.where("doc_id % 2 = 0"), sample=30)
    got = {r.doc_id: r for r in li.predicted(docs, model).collect()}
    assert max(len(t) for _, t, _ in rows) > li.PIECE
    slot = {}
    for k, text, _ in rows:
        grams = plain_grams(text)
        for g in grams:
            if g not in slot:
                # the slot of one gram: what a text has that shows it beside its own shorter grams
                points = sum(ord(c) * m for c, m in zip(g, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))) + (len(g) << 40) if len(g) > 1 else ord(g)
                h = (points ^ (points >> 15)) * 0xD6E8FEB86659FD93 % (1 << 64)
                slot[g] = h >> 50
        n = sum(grams.values())
        margins = []
        for c in range(model.code.shape[1]):
            total = sum(times * float(model.weights[slot[g], c]) for g, times in grams.items())
            margins.append(total / n**0.5 * min(1.0, n**0.5 / 20) + float(model.bias[c]))
        losses = {name: sum(float(model.trust[c]) * np.logaddexp(0, -model.code[i, c] * m) for c, m in enumerate(margins)) for i, name in enumerate(model.names)}
        best = min(losses, key=losses.get)
        share = 1 / sum(np.exp(losses[best] - x) for x in losses.values())
        assert got[k].lang_pred == best and abs(got[k].score - share) < 1e-4


def test_held_out_accuracy_and_odd_rows(spark):
    rows = texts()
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "12 !?", "cc"), (903, "the whing thing", None), (None, "ción ñar os", "dd"), (3, "eau que éoi", "cc"), (904, "schung " * 200_000, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "2 as id")
    model = li.train(docs.where("crc32(cast(doc_id as string)) % 4 != 2"), sample=60)
    got = {}
    for r in li.predicted(docs, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) + len(odd)
    held = [(k, lang) for k, _, lang in rows if zlib.crc32(str(k).encode()) % 4 == 2 and k != 3]
    assert np.mean([got[k][0].lang_pred == lang for k, lang in held]) > 0.95
    assert [(got[k][0].lang_pred, got[k][0].score) for k in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[903][0].lang_pred == "aa" and got[None][0].lang_pred == "dd" and got[904][0].lang_pred == "bb" and len(got[3]) == 2
    assert all(0 <= r.score <= 1 for v in got.values() for r in v)


def test_one_language_none_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abc", "x"), (2, "def", "x")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in li.predicted(docs, li.train(docs)).collect()} == {"x"}
    none = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert li.train(none) is None
    assert {(r.lang_pred, r.score) for r in li.predicted(none, None).collect()} == {("und", 0.0)}
    assert li.predicted(docs.limit(0), None).collect() == []
