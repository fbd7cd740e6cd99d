import random

import duckdb
import pytest
from tokenizers import Tokenizer, models, normalizers

from tickerloom.llm.token_count import PENALTY, SPACE, Counter, read_vocabulary, token_counts

PATH = "/opt/tokenizers/piece_bpe_32k.model"


def brute(text, pieces, fallback):
    """Best (score, then earliest starts from the end) by trying every start for every end."""
    score = dict(reversed(pieces))
    low = min(score.values()) - PENALTY
    best = [(0.0, [])]
    for end in range(1, len(text) + 1):
        top = None
        for start in range(end):
            piece = text[start:end]
            if piece in score:
                now = best[start][0] + score[piece], best[start][1] + [piece]
            elif end - start == 1:
                now = best[start][0] + low, best[start][1] + [None if not fallback else (piece,)]
            else:
                continue
            if top is None or now[0] > top[0]:
                top = now
        best.append(top)
    n = 0
    for k, p in enumerate(path := best[-1][1]):
        n += len(p[0].encode()) if isinstance(p, tuple) else not (p is None and k and path[k - 1] is None)
    return n, best[-1][0]


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("step", [1, 0.1])
def test_equals_trying_everything(fallback, step):
    rng = random.Random(1)
    for _ in range(60):
        pieces = {"".join(rng.choice("abc" + SPACE if k == 0 else "abcd") for k in range(rng.randrange(1, 5))): -float(rng.randrange(1, 9)) * step for _ in range(25)}
        counter = Counter(list(pieces.items()), fallback, prefix=False)
        for _ in range(12):
            text = "".join(rng.choice("abcde é\n") for _ in range(rng.randrange(0, 25)))
            want = brute(text.replace(" ", SPACE), list(pieces.items()), fallback) if text else (0, 0.0)
            got = counter.count(text)
            assert got[0] == want[0] and got[1] == pytest.approx(want[1])


def test_equals_the_library_on_whole_documents():
    pieces, fallback = read_vocabulary(PATH)
    assert fallback and len(pieces) > 30_000
    byte = [(f"<0x{k:02X}>", -1e6) for k in range(256)]
    low = min(s for _, s in pieces)
    vocabulary = [("<unk>", 0.0), *pieces, *((b, low) for b, _ in byte)]
    library = Tokenizer(models.Unigram(vocabulary, 0, True))
    library.normalizer = normalizers.Sequence([normalizers.Prepend(SPACE), normalizers.Replace(" ", SPACE)])
    counter = Counter(pieces, fallback)
    texts = [t for (t,) in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall() if t]
    texts += ["a  b   c", "   ", "x\n\n  y ", "日本語 😀 ok", "\ttab", "naïve café…", "a" * 300, " lead", "trail "]
    for text in texts:
        assert counter.count(text)[0] == len(library.encode(text, add_special_tokens=False).ids), text[:80]


def test_odd_rows(spark):
    pieces, fallback = read_vocabulary(PATH)
    rows = [(1, "hello world"), (1, "hello world"), (2, None), (3, ""), (None, "hello"), (4, "word " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as score")
    got = sorted(((r.doc_id, r.n_tokens) for r in token_counts(df, pieces, fallback).collect()), key=repr)
    counter = Counter(pieces, fallback)
    assert got == sorted([(i, counter.count(t)[0]) for i, t in rows], key=repr)
    assert dict(got)[2] == 0 and dict(got)[3] == 0
    assert token_counts(df.limit(0), pieces, fallback).collect() == []
