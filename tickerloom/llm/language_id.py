"""Language ID with error-correcting output codes.

Every language has a codeword of bits; one binary classifier over character n-grams predicts
each bit. Decoding sums, over the bits, a loss of the classifier's margin against the codeword's
bit, weighted by how well that classifier did in training; the codeword with the least loss
names the language. A text is ambiguous if a second codeword is nearly as near, or if more bits
are wrong than the code can correct.

The classifiers are logistic over hashed n-grams of one to three letters, trained in the
driver on at most ``sample`` texts of each language, whose n-grams are counted in Spark tasks.
Texts are scored whole, in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few_of_each, small_batches

#: Hashed n-grams, characters that are handled at once, and most classifiers of a code.
SLOTS, PIECE, WIDEST = 1 << 14, 400_000, 63


@cache
def _letters() -> np.ndarray:
    return np.array([chr(k).isalpha() for k in range(0x110000)])


def slot_pieces(text: str) -> Iterator[np.ndarray]:
    """Hash slots of all n-grams of one to three characters that hold a letter, a piece of the text at a time.

    Letters are lower-cased; a run of anything else is one space, and so are both ends. A piece
    has the grams that end in it: two characters are carried over, so it doesn't matter where
    a text is cut.
    """
    text = f" {text.lower()} "
    carried, after_letter = np.zeros(0, np.uint64), True
    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[points]
        keep = letter | np.concatenate([[after_letter], letter[:-1]])
        after_letter = bool(letter[-1])
        p = np.concatenate([carried, np.where(letter, points, 32)[keep].astype(np.uint64)])
        new = len(carried)
        some = [p[new:][p[new:] != 32]]
        for width in (2, 3):
            q = p[max(0, new - width + 1) :]
            if len(q) >= width:
                g = sum(q[k : len(q) - width + 1 + k] * np.uint64((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)[k]) for k in range(width))
                some.append(g + np.uint64(width << 40))
        h = np.concatenate(some)
        h = (h ^ (h >> np.uint64(15))) * np.uint64(0xD6E8FEB86659FD93)
        yield (h >> np.uint64(50)).astype(np.int64)
        carried = p[-2:]


def gram_slots(text: str) -> np.ndarray:
    """The slots of a whole text."""
    return np.concatenate(list(slot_pieces(text)))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def codebook(n: int, seed: int = 11) -> np.ndarray:
    """``n`` codewords of -1 and 1, far from each other; no bit is constant, none repeats another.

    Up to seven languages get the exhaustive code (every way to split them in two); more get the
    random code with the largest least distance of a fixed number of draws.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        return np.array([[1 if k == 0 or not (m >> (k - 1)) & 1 else -1 for m in range(1, 1 << (n - 1))] for k in range(n)], float)
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(300):
        code = rng.choice([-1.0, 1.0], (n, min(WIDEST, 10 * int(np.ceil(np.log2(n))))))
        code = code[:, np.abs(code.sum(0)) < n]
        least = ((code.shape[1] - code @ code.T) / 2 + 1e9 * np.eye(n)).min()
        if least > far:
            best, far = code, least
    return best


def distance(code: np.ndarray) -> int:
    """Least number of bits between two codewords."""
    return int(min((np.sum(a != b) for a, b in combinations(code, 2)), default=0))


class Model:
    """Codewords, classifiers and their weights in decoding."""

    def __init__(self, names: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray) -> None:
        self.names, self.code, self.weights, self.bias, self.trust = names, code, weights, bias, trust
        self.correct = max(0, (distance(code) - 1) // 2)

    def margins(self, text: str) -> np.ndarray:
        """Of each classifier, from the whole text, a piece at a time."""
        total, n = np.zeros(len(self.bias)), 0
        for slots in slot_pieces(text):
            total += np.bincount(slots, minlength=SLOTS) @ self.weights
            n += len(slots)
        # the share of each slot, damped for short texts, whose shares are coarse
        return total / np.sqrt(max(n, 1)) * min(1.0, np.sqrt(max(n, 1)) / 20) + self.bias

    def decode(self, margins: np.ndarray) -> tuple[str, float, str, bool]:
        """Language, confidence, runner-up, and whether the choice is ambiguous."""
        loss = np.logaddexp(0, -self.code * margins) @ self.trust
        order = np.argsort(loss, kind="stable")
        p = np.exp(-(loss - loss[order[0]]))
        p = p / p.sum()
        wrong = int((np.where(margins >= 0, 1, -1) != self.code[order[0]]).sum())
        second = self.names[order[1]] if len(order) > 1 else self.names[order[0]]
        return self.names[order[0]], float(p[order[0]]), second, bool(p[order[0]] < 0.6 or wrong > self.correct)


def fit(names: list[str], counts: np.ndarray, language: np.ndarray, rounds: int = 120, rate: float = 0.3, ridge: float = 1e-4) -> Model:
    """One logistic classifier for each bit of the code, by gradient steps (Adam).

    ``counts`` has a row of n-gram counts for each text. A language's texts weigh one together.
    """
    code = codebook(len(names))
    n = counts.sum(1, keepdims=True)
    x = (counts / np.sqrt(np.maximum(n, 1)) * np.minimum(1.0, np.sqrt(np.maximum(n, 1)) / 20)).astype(np.float32)
    sign = code[language].astype(np.float32)
    weight = (1 / np.bincount(language, minlength=len(names))[language] / len(names)).astype(np.float32)[:, None]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    speed, spread = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        push = weight * sign / (1 + np.exp(np.clip(sign * (x @ w + b), -60, 60)))
        up = x.T @ push - ridge * w
        b += rate * push.sum(0)
        speed = 0.9 * speed + 0.1 * up
        spread = 0.99 * spread + 0.01 * up * up
        w += rate * 0.1 * (speed / (1 - 0.9**k)) / (np.sqrt(spread / (1 - 0.99**k)) + 1e-8)
    right = (weight * (sign * (x @ w + b) > 0)).sum(0)
    trust = np.clip(2 * right - 1, 0.05, 1)
    return Model(names, code, w, b, trust / trust.sum() * len(trust))


def train(documents: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = 400) -> Model | None:
    """The model of the languages in ``documents``, or None if there are none.

    Of each language the ``sample`` different texts with the smallest hashes are taken.
    Rows with a null text or language, and texts without a letter, teach nothing.
    """
    rows = documents.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("at"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    ranked = few_of_each(rows, "lang", "at", sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                total = np.zeros(SLOTS, np.int32)
                for slots in slot_pieces(text):
                    total += np.bincount(slots, minlength=SLOTS).astype(np.int32)
                some = np.flatnonzero(total)
                out.append(np.stack([some, total[some]]).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "at": batch.column("at"), "grams": pa.array(out, pa.binary())})

    found = ranked.select("lang", "text", "at").mapInArrow(count, "lang string, at long, grams binary").toArrow().sort_by([("lang", "ascending"), ("at", "ascending")])
    if not len(found):
        return None
    lang = np.array(found.column("lang").to_pylist())
    names, language = np.unique(lang, return_inverse=True)
    counts = np.zeros((len(lang), SLOTS), np.float32)
    for k, packed in enumerate(found.column("grams").to_pylist()):
        slots, times = np.frombuffer(packed, np.int32).reshape(2, -1)
        counts[k, slots] = times
    return fit(names.tolist(), counts, language)


def predicted(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, runner_up, ambiguous) of every row.

    A null text or one without a letter is ``und`` with score 0 and not ambiguous; without a
    model all texts are. ``score`` is the share of the chosen language in the losses, 0 to 1.
    Rows that repeat an id are each predicted.
    """
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    small_batches(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            out = [
                model.decode(model.margins(text)) if model is not None and has_letter(text) else ("und", 0.0, None, False)
                for text in (x.as_py() for x in batch.column("text"))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([r[c] for r in out], t) for c, t in enumerate([pa.string(), pa.float64(), pa.string(), pa.bool_()]))],
                names=["id", "lang_pred", "score", "runner_up", "ambiguous"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, lang_pred string, score double, runner_up string, ambiguous boolean").withColumnRenamed("id", id_col)
