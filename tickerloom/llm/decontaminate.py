"""Benchmark decontamination: a BM25 index of test items, asked with every training passage.

The index holds the items; a passage is a query of its distinct words. An item's impacts are
divided by the score that its own text gets, so a score is the weighted share of the item that
the passage has, and one threshold serves all items. Retrieval is block-max WAND over items in
order: first, for a whole batch of passages at once, the sums of the largest impacts in each
range of items say which ranges can hold an item above the threshold; in those ranges, cursors
move from pivot to pivot and skip blocks whose maxima cannot reach it. All items above the
threshold are found. A hit counts when question and answer overlap with the passage.

Passages are overlapping windows of whole texts, twice as long as the longest item of their
class of lengths, so that every item lies wholly in one window. Documents are read once and
never shuffled. The items are broadcast in parts of a checked size, one pass for each part; the
statistics that weigh their words are counted over the whole benchmark before.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MARKS, mixed, small_batches, stored, text_pieces, unused, word_hashes

#: Bytes of items that one broadcast index may hold, ranges of its items, postings in a block.
PART, RANGES, POSTINGS = 8 << 20, 64, 16
#: Longest items, in words, of the classes of lengths.
CLASSES = (64, 512, 4096, 1 << 60)
GRAM = 3


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item: its last sentence is the answer; of one sentence, the last third."""
    parts = re.split(r"(?<=[.?!])\s+", text.strip())
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = max(1, len(words) * 2 // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def hashed(texts: list[str]) -> list[np.ndarray]:
    out = []
    for _, _, data, offsets in text_pieces(pa.array(texts, pa.string())):
        words, places = word_hashes(data, offsets, MARKS)
        out += [words[a:b] for a, b in zip(places[:-1], places[1:])]
    return out


def grams(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of three words; of all words, if there are fewer."""
    n = min(GRAM, len(words))
    if not n:
        return words
    return mixed(sum(words[k : len(words) - n + 1 + k] * np.uint64(2 * k + 3) for k in range(n)))


def share(part: np.ndarray, whole: np.ndarray) -> float:
    """Share of the distinct values of ``part`` that ``whole`` has; of nothing, all."""
    part = np.unique(part)
    return float(np.isin(part, whole).mean()) if len(part) else 1.0


@dataclass
class Statistics:
    """Of a whole benchmark: items with words, their mean length, and in how many items terms are
    found; ``terms`` are in order and hold at least those of the items indexed with them."""

    items: int
    mean: float
    terms: np.ndarray
    found: np.ndarray


def statistics(words: list[np.ndarray]) -> Statistics:
    terms, found = np.unique(np.concatenate([np.unique(w) for w in words]), return_counts=True)
    return Statistics(len(words), float(np.mean([len(w) for w in words])), terms, found)


class Index:
    """Impacts of one class of items, in order of the items."""

    def __init__(self, items: list[tuple], reach: int, threshold: float, k1: float, b: float, known: Statistics | None = None) -> None:
        self.items, self.threshold = items, threshold
        words = [item[1] for item in items]
        lengths = np.array([len(w) for w in words])
        self.window = int(min(reach, lengths.max()))
        pairs = [np.unique(w, return_counts=True) for w in words]
        term = np.concatenate([t for t, _ in pairs])
        owner = np.repeat(np.arange(len(items)), [len(t) for t, _ in pairs])
        times = np.concatenate([n for _, n in pairs]).astype(float)
        self.terms, term = np.unique(term, return_inverse=True)
        known = known or statistics(words)
        found = known.found[np.searchsorted(known.terms, self.terms)]
        idf = np.log1p((known.items - found + 0.5) / (found + 0.5))
        impact = idf[term] * times * (k1 + 1) / (times + k1 * (1 - b + b * lengths[owner] / known.mean))
        impact /= np.bincount(owner, impact)[owner]
        order = np.lexsort((owner, term))
        self.owner, self.impact = owner[order], impact[order]
        self.step = -(-len(items) // RANGES)
        self.best = np.zeros((len(self.terms) + 1, -(-len(items) // self.step)), np.float32)
        np.maximum.at(self.best, (term, owner // self.step), (impact * (1 + 1e-4)).astype(np.float32))
        self.block = np.maximum.reduceat(self.impact, np.arange(0, len(self.impact), POSTINGS)).tolist()
        # where the postings of a term in a range begin
        inside = np.bincount(term * self.best.shape[1] + owner // self.step, minlength=len(self.terms) * self.best.shape[1])
        self.cut = np.concatenate([[0], np.cumsum(inside)])

    def above(self, terms: np.ndarray, at: int) -> Iterator[tuple[int, float]]:
        """(item, score) of the range's items that reach the threshold: block-max WAND."""
        high = (at + 1) * self.step
        cells = terms * self.best.shape[1] + at
        start, end = self.cut[cells], self.cut[cells + 1]
        some = start < end
        start = start[some]
        cursors = [list(c) for c in zip(self.owner[start].tolist(), start.tolist(), end[some].tolist(), self.best[terms[some], at].tolist())]
        owner = self.owner

        def move(c: list, to: int) -> None:
            while c[1] < c[2] and owner[c[1]] < to:
                c[1] += 1
            c[0] = int(owner[c[1]]) if c[1] < c[2] else high

        while True:
            cursors = sorted(c for c in cursors if c[0] < high)
            reached, pivot = 0.0, None
            for k, c in enumerate(cursors):
                reached += c[3]
                if reached >= self.threshold:
                    pivot = c[0]
                    break
            if pivot is None:
                return
            while k + 1 < len(cursors) and cursors[k + 1][0] == pivot:
                k += 1
            ahead = cursors[: k + 1]
            # the pivot's blocks; a cursor behind it may skip to the block that holds it
            blocks = [bisect_left(owner, pivot, c[1], c[2]) // POSTINGS for c in ahead]
            bound = sum(self.block[min(x, len(self.block) - 1)] for x in blocks)
            if bound < self.threshold:
                # nothing up to the nearest end of these blocks can reach the threshold
                ends = [self.owner[min((x + 1) * POSTINGS, c[2]) - 1] + 1 if (x + 1) * POSTINGS <= c[2] else high for x, c in zip(blocks, ahead)]
                rest = cursors[k + 1][0] if k + 1 < len(cursors) else high
                to = max(pivot + 1, min(int(min(ends)), rest))
                for c in ahead:
                    move(c, to)
            elif ahead[0][0] == pivot:
                score = float(sum(self.impact[c[1]] for c in ahead))
                if score >= self.threshold:
                    yield pivot, score
                for c in ahead:
                    move(c, pivot + 1)
            else:
                for c in ahead:
                    if c[0] < pivot:
                        move(c, pivot)

    def search(self, words: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(text, first word of the passage, item, score) over the windows of all texts."""
        size = self.window
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[at] == words)
        text = np.searchsorted(places, known, "right") - 1
        parts = -(-np.diff(places) // size)
        base = np.concatenate([[0], np.cumsum(parts)])
        part = base[text] + (known - places[text]) // size
        keys = np.unique(part * len(self.terms) + at[known])
        if not len(keys):
            return
        part, term = np.divmod(keys, len(self.terms))
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        edges = np.full(base[-1] + 2, len(keys))
        bounds = np.zeros((base[-1] + 1, self.best.shape[1]), np.float32)
        bounds[part[first]] = np.add.reduceat(self.best[term], first)
        edges[: base[-1] + 1] = np.searchsorted(part, np.arange(base[-1] + 1))
        last = np.zeros(base[-1] + 1, bool)
        last[base[1:] - 1] = True
        last[-1] = True
        bounds[:-1] += np.where(last[:-1, None], 0, bounds[1:])
        for p, r in zip(*np.nonzero(bounds[: base[-1]] >= self.threshold)):
            here = np.unique(term[edges[p] : edges[p + 1 if last[p] else p + 2]])
            k = int(np.searchsorted(base, p, "right")) - 1
            for item, score in self.above(here, int(r)):
                yield k, int(p - base[k]) * size, item, score


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = hashed(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), pa.array([np.unique(w).view(np.int64) for w in words], pa.list_(pa.int64())), pa.array([len(w) for w in words], pa.int64())],
            names=["part", "terms", "length"],
        )


_FOUND = "id long, item long, score double, question double, answer double, word long"


def _scan(indexes, least_question: float, least_answer: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_pieces(batch.column("text")):
                ids = batch.column("id").slice(first, end - first).to_pylist()
                words, places = word_hashes(data, offsets, MARKS)
                best: dict[tuple[int, int], tuple] = {}
                for index in indexes.value:
                    for k, at, item, score in index.search(words, places):
                        passage = words[places[k] + at : min(places[k] + at + 2 * index.window, places[k + 1])]
                        name, _, question, answer = index.items[item]
                        q, a = share(grams(question), grams(passage)), share(answer, passage)
                        if q >= least_question and a >= least_answer:
                            best[k, name] = max(best.get((k, name), ()), (score, q, a, -at))
                rows = [(ids[k], name, s, q, a, -at) for (k, name), (s, q, a, at) in best.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], t) for c, t in enumerate([pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()])],
                    names=["id", "item", "score", "question", "answer", "word"],
                )

    return run


def contaminated(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", threshold: float = 0.5, least_question: float = 0.5, least_answer: float = 0.5, k1: float = 1.2, b: float = 0.75,
) -> DataFrame:
    """(document, item, score, question_overlap, answer_overlap, first_word) of every leak.

    A row stands for a document one of whose passages has at least ``threshold`` of an item's
    BM25 weight, at least ``least_question`` of the question's word trigrams and at least
    ``least_answer`` of the answer's words; of several such passages it shows the one with the
    highest score, then overlaps, then the first. Words are runs of letters, digits and bytes
    beyond ASCII, A-Z lower-cased.

    Null and empty texts and items without words match nothing. Rows that repeat an id or an
    item are searched and reported each for itself. Empty tables give no rows.
    """
    spark = documents.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // PART)
    found = []
    # what an item scores doesn't depend on the part it is in: the statistics are the whole benchmark's
    items = items.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(max(parts, 1))).cast("int"))
    worded = stored(items.select("part", "text").mapInArrow(_terms, "part int, terms array<long>, length long").where("length > 0"), "benchmark")
    n, mean = worded.agg(F.count(F.lit(1)), F.avg("length")).first()
    each = worded.select("part", F.explode("terms").alias("term"))
    often = stored(each.groupBy("term").agg(F.count(F.lit(1)).alias("found")), "benchmark-terms")
    for part in range(parts if n else 0):
        rows = items.where(F.col("part") == part).orderBy("item", "text").collect()
        of = each.where(F.col("part") == part).select("term").distinct().join(often, "term").toArrow()
        terms, counts = of.column("term").to_numpy().view(np.uint64), of.column("found").to_numpy()
        order = np.argsort(terms)
        whole = Statistics(n, mean, terms[order], counts[order])
        split = [split_item(r.text) for r in rows]
        known = list(zip([r.item for r in rows], hashed([r.text for r in rows]), hashed([q for q, _ in split]), hashed([a for _, a in split])))
        indexes, below = [], 0
        for reach in CLASSES:
            some = [x for x in known if below < len(x[1]) <= reach]
            below = reach
            if some:
                indexes.append(Index(some, reach, threshold, k1, b, whole))
        found.append(docs.mapInArrow(_scan(spark.sparkContext.broadcast(indexes), least_question, least_answer), _FOUND))
    if not found:
        found.append(spark.createDataFrame([], _FOUND))
    names = {"id": id_col, "item": item_col, "score": "score", "question": "question_overlap", "answer": "answer_overlap", "word": "first_word"}
    return reduce(DataFrame.union, found).select(*[F.col(a).alias(c) for a, c in names.items()])


def without_leaks(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **more) -> DataFrame:
    """The rows of ``documents`` whose id has no leak; rows with a null id are kept."""
    (leak,) = unused(documents, "__leak")
    leaks = contaminated(documents, benchmark, id_col, **more).select(F.col(id_col).alias(leak)).distinct()
    return documents.join(leaks, documents[id_col] == F.col(leak), "left_anti")
