"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of its bytes by kind, its length, and how
often its words repeat, along with those of the lines before and after it; the chain's
transitions tie neighbouring labels. Forward and backward passes give the marginal of each
line, and a document's score is the mean of its lines' marginals, weighted by their lengths.

The labels are given for whole documents, so training takes each line to bear the label of
its document, in a sample of at most ``sample`` labelled documents (half of each label, weighted
back to the labels' shares of all training rows). Scoring reads whole texts, in one pass, with
arrays over the lines of many documents at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few_of_each, mixed, small_batches, text_pieces, word_hashes, word_spans

_FEED = np.arange(256) == 10
_KINDS = np.array([
    [chr(k).isascii() and chr(k).isalpha() or k >= 128 for k in range(256)],
    [65 <= k <= 90 for k in range(256)],
    [48 <= k <= 57 for k in range(256)],
    [k < 128 and chr(k).isprintable() and not chr(k).isalnum() and chr(k) not in " .,;:?'\"()-" for k in range(256)],
    [chr(k) in ".,;:?" for k in range(256)],
    [chr(k) in " \t" for k in range(256)],
])
#: Features of a line by itself, and longest training documents in lines.
OWN, LONGEST = 16, 400


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, text, bytes) of every line that isn't empty; a blank line has no bytes."""
    starts, ends = word_spans(data, offsets, _FEED)
    n = len(starts)
    if not n:
        return np.zeros((0, 3 * OWN + 3), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = ends - starts
    count = []
    for kind in _KINDS:
        sums = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int32)])
        count.append(sums[ends] - sums[starts])
    letters, upper, digits, marks, stops, blanks = (c / size for c in count)
    hashes, _ = word_hashes(data, offsets)
    at, _ = word_spans(data, offsets)
    line = np.searchsorted(starts, at, "right") - 1
    words = np.bincount(line, minlength=n)
    seen = np.unique(mixed(hashes + line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    fresh = np.bincount(line[seen], minlength=n) / np.maximum(words, 1)
    shout = np.divide(count[1], np.maximum(count[0], 1))
    long = count[0] / np.maximum(words, 1)
    own = np.stack([
        shout, shout > 0.3, digits * 3, digits > 0.2, np.minimum(marks * 5, 2), marks > 0.02, marks > 0.08, np.minimum(stops * 10, 2),
        blanks * 3, np.minimum(long / 5, 3), np.log1p(size) / 5, words < 3, (1 - fresh) * np.minimum(words / 20, 1) * 2,
        (fresh < 0.6) & (words > 8), np.isin(data[ends - 1], list(b".!?")), letters,
    ], 1).astype(np.float32)
    text = np.searchsorted(offsets, starts, "right") - 1
    edge = np.concatenate([[True], text[1:] != text[:-1], [True]])
    before = np.where(edge[:-1, None], 0, np.concatenate([own[:1], own[:-1]]))
    after = np.where(edge[1:, None], 0, np.concatenate([own[1:], own[-1:]]))
    return np.concatenate([own, before, after, edge[:-1, None], edge[1:, None], np.ones((n, 1))], 1).astype(np.float32), text, np.where(words > 0, size, 0)


class Chain:
    """Weights of the features for a good line, and of (bad, good) starts and transitions."""

    def __init__(self, width: int) -> None:
        self.emit, self.start, self.move = np.zeros(width), np.zeros(2), np.zeros((2, 2))

    def passes(self, x: np.ndarray, sizes: np.ndarray):
        """Log sums over the labels of each chain of lines, forwards and backwards.

        ``sizes`` are the lines of the chains, none empty. All chains go ahead together, one
        line a step, those with most lines first so that the others drop off at the end.
        """
        score = np.zeros((len(x), 2))
        score[:, 1] = x @ self.emit
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        order = np.argsort(-sizes, kind="stable")
        first, sizes = first[order], sizes[order]
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[first] = score[first] + self.start
        live = len(sizes)
        steps = int(sizes[0]) if live else 0
        active = np.searchsorted(-sizes, -np.arange(steps), "left")
        for t in range(1, steps):
            at = first[: active[t]] + t
            old = ahead[at - 1]
            ahead[at, 0] = np.logaddexp(old[:, 0] + self.move[0, 0], old[:, 1] + self.move[1, 0])
            ahead[at, 1] = np.logaddexp(old[:, 0] + self.move[0, 1], old[:, 1] + self.move[1, 1])
            ahead[at] += score[at]
        for t in range(steps - 1, 0, -1):
            at = first[: active[t]] + t
            new = back[at] + score[at]
            back[at - 1, 0] = np.logaddexp(self.move[0, 0] + new[:, 0], self.move[0, 1] + new[:, 1])
            back[at - 1, 1] = np.logaddexp(self.move[1, 0] + new[:, 0], self.move[1, 1] + new[:, 1])
        return score, ahead, back

    def marginals(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probability that each line is good."""
        _, ahead, back = self.passes(x, sizes)
        both = ahead + back
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))

    def fit(self, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 250, rate: float = 0.1, ridge: float = 1e-4) -> Chain:
        """Maximises the weighted likelihood of the labelled chains by gradient steps (Adam)."""
        truth = np.repeat(labels, sizes).astype(int)
        weight = weights / weights.sum()
        by_line = np.repeat(weight, sizes)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        inner = np.ones(len(x), bool)
        inner[first] = False
        inner = np.flatnonzero(inner)
        flat = np.zeros(len(self.emit) + 6)
        speed, spread = np.zeros_like(flat), np.zeros_like(flat)
        for k in range(1, rounds + 1):
            score, ahead, back = self.passes(x, sizes)
            total = np.repeat(np.logaddexp(*(ahead + back)[first].T), sizes)
            p = np.exp(ahead + back - total[:, None])
            emit = (by_line * (truth - p[:, 1])) @ x
            start = np.array([(weight * ((labels == s) - p[first, s])).sum() for s in (0, 1)])
            move = np.zeros((2, 2))
            for a in (0, 1):
                for b in (0, 1):
                    q = np.exp(ahead[inner - 1, a] + self.move[a, b] + score[inner, b] + back[inner, b] - total[inner])
                    move[a, b] = (by_line[inner] * ((truth[inner - 1] == a) * (truth[inner] == b) - q)).sum()
            up = np.concatenate([emit, start, move.ravel()]) - ridge * flat
            speed = 0.9 * speed + 0.1 * up
            spread = 0.99 * spread + 0.01 * up * up
            flat = flat + rate * (speed / (1 - 0.9**k)) / (np.sqrt(spread / (1 - 0.99**k)) + 1e-8)
            self.emit, self.start, self.move = flat[:-6], flat[-6:-4], flat[-4:].reshape(2, 2)
        return self


def _scores(chain: Chain, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    x, text, size = line_features(data, offsets)
    n = len(offsets) - 1
    if not len(x):
        return np.zeros(n)
    lines = np.bincount(text, minlength=n)
    good = chain.marginals(x, lines[lines > 0])
    return np.bincount(text, good * size, minlength=n) / np.maximum(np.bincount(text, size, minlength=n), 1)


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 4000) -> Chain | None:
    """The chain fitted to a sample of the labelled documents, or None if there are none.

    Of each label the ``sample // 2`` documents with the smallest hashed ids are taken, if they
    have at most ``LONGEST`` lines. Rows with a null id, text or label teach nothing; of
    several labels of one id the larger counts.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    counts = dict(known.groupBy("label").count().collect())
    if not counts:
        return None
    chosen = few_of_each(known.withColumn("at", F.xxhash64("id")), "label", "at", sample // 2).drop("at")
    chosen = documents.sparkSession.createDataFrame(chosen.toArrow())  # at most ``sample`` rows
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_pieces(batch.column("text")):
                x, text, _ = line_features(data, offsets)
                lines = np.bincount(text, minlength=end - first)
                some = (lines > 0) & (lines <= LONGEST)
                edges = np.searchsorted(text, np.arange(end - first + 1))
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("id").slice(first, end - first).filter(pa.array(some)), "label": batch.column("label").slice(first, end - first).filter(pa.array(some)),
                    "x": pa.array([x[edges[k] : edges[k + 1]].tobytes() for k in np.flatnonzero(some)], pa.binary()),
                })

    rows = docs.join(F.broadcast(chosen), "id").select("id", "label", "text").mapInArrow(features, "id long, label int, x binary").toArrow().sort_by([("id", "ascending")])
    if not len(rows):
        return None
    width = 3 * OWN + 3
    found = [np.frombuffer(v, np.float32).reshape(-1, width) for v in rows.column("x").to_pylist()]
    label = rows.column("label").to_numpy()
    there = np.bincount(label, minlength=2)
    weight = np.array([counts.get(k, 0) / max(there[k], 1) for k in (0, 1)])[label]
    return Chain(width).fit(np.concatenate(found).astype(float), np.array([len(f) for f in found]), label, weight)


def scored(documents: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text", least: float = 0.3) -> DataFrame:
    """(id, score, predicted) of every row; ``predicted`` is 1 if the score is at least ``least``.

    Null, empty and blank-line texts score 0; without a chain all others score 0.5. Rows
    that repeat an id are each scored.
    """

    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_pieces(batch.column("text")):
                if chain is None:
                    score = np.where(np.diff(offsets) > 0, 0.5, 0.0)
                else:
                    score = _scores(chain, data, offsets)
                yield pa.RecordBatch.from_pydict({"id": batch.column("id").slice(first, end - first), "score": score, "predicted": (score >= least).astype(np.int32)})

    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)


def without_rejected(documents: DataFrame, chain: Chain | None, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``documents`` whose score is at least ``least``, in one pass and with all columns."""

    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for _, end, data, offsets in text_pieces(batch.column(text_col)):
                keep.append(np.diff(offsets) * 0.5 if chain is None else _scores(chain, data, offsets))
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep) >= least))

    return documents.mapInArrow(run, documents.schema)
