"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character. One pass
over the characters keeps, for each end, the best score of a segmentation and its number of
pieces; no pieces are stored and nothing is traced back. Of equal scores the segmentation whose
last piece starts first wins, as in the tokenizer's own search, which goes through the starts
in order and replaces only by strictly better ones.

A character that no one-character piece covers may stand alone at ten below the lowest score.
With byte fallback it then counts one piece for each of its UTF-8 bytes; otherwise a run of
such characters is one unknown piece.

No piece reaches over a word's start, so words are counted by themselves and the counts of
frequent words are kept, as long as scores are whole numbers, whose sums are exact in any order.
With other scores, texts are searched in one piece.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from itertools import chain, pairwise
from math import inf

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: The character that stands for a space, and most words whose counts a task keeps.
SPACE, KEPT = "▁", 300_000
PENALTY = 10.0


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Pieces with scores of a sentencepiece model file, and whether it falls back to bytes.

    Unknown, control, unused and byte pieces match no text and are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    odd = (model.is_unknown, model.is_control, model.is_unused, model.is_byte)
    return [(model.id_to_piece(k), model.get_score(k)) for k in ids if not any(f(k) for f in odd)], sum(map(model.is_byte, ids)) == 256


class _Kept(dict):
    """Results of words by word. When it is full it starts anew, and takes what is used again from before."""

    def __init__(self, search: Callable[[str], tuple]) -> None:
        super().__init__()
        self.search, self.before = search, {}

    def __missing__(self, word: str) -> tuple:
        found = self.before.get(word) or self.search(word)
        if len(word) < 64:
            if len(self) >= KEPT:
                self.before = dict(self)
                self.clear()
            self[word] = found
        return found


class Counter:
    """Counts the pieces of texts; keeps the counts of words it has seen."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool, prefix: bool = True) -> None:
        self.fallback, self.prefix = byte_fallback, prefix
        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(reversed(pieces)).items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - PENALTY
        texts = [p for p, _ in pieces]
        whole = all(float(s).is_integer() for _, s in pieces) and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in texts)
        feed = "" if any("\n" in p for p in texts) else r"\n"
        # what a word is: the spaces before it and the characters up to the next space or line
        self.words = re.compile(f"{feed}|{SPACE}+[^{SPACE}{feed}]*|[^{SPACE}{feed}]+" if feed else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall if whole else lambda text: [text] if text else []
        self.kept = _Kept(self.search)

    def search(self, text: str) -> tuple[int, float, bool, bool]:
        """Pieces, score, and whether the first and the last piece are unknown."""
        n, lone_score, fallback = len(text), self.unknown, self.fallback
        score, count, first, last = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1), [False] * (n + 1)
        at, best, start, lone = 1, -inf, 0, False
        # matches come by end and, for one end, the longest first, so the first start comes first;
        # one more end behind the text settles the last one
        for end, (length, s) in chain(self.automaton.iter(text), [(n, (1, 0.0))]):
            while at <= end:
                if not lone and (now := score[at - 1] + lone_score) > best:
                    start = at - 1
                    score[at], last[at] = now, True
                    count[at] = count[start] + (len(text[start].encode("utf-8", "replace")) if fallback else not last[start])
                    first[at] = first[start] if start else True
                else:
                    score[at], count[at], first[at] = best, count[start] + 1, first[start]
                at += 1
                best, lone = -inf, False
            if length == 1:
                lone = True
            if (now := score[end + 1 - length] + s) > best:
                best, start = now, end + 1 - length
        return count[n], score[n], first[n], last[n]

    def count(self, text: str | None) -> tuple[int, float]:
        """Pieces of the text and their summed score."""
        if not text:
            return 0, 0.0
        text = text.replace(" ", SPACE)
        found = list(map(self.kept.__getitem__, self.words(SPACE + text if self.prefix else text)))
        pieces, score = sum([f[0] for f in found]), sum([f[1] for f in found])
        if not self.fallback:
            # an unknown piece that goes on in the next word is one piece
            pieces -= sum([a[3] and b[2] for a, b in pairwise(found)])
        return pieces, float(score)


_COUNTERS: dict[str, Counter] = {}


def _counter(name: str, vocabulary) -> Counter:
    """The worker's counter for a vocabulary; it keeps the last one."""
    if name not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[name] = Counter(*vocabulary.value)
    return _COUNTERS[name]


def token_counts(documents: DataFrame, pieces: list[tuple[str, float]], byte_fallback: bool, id_col: str = "doc_id", text_col: str = "text", prefix: bool = True) -> DataFrame:
    """(id, n_tokens, score) of every row, over the whole text.

    Every space is written as the space character, and ``prefix`` puts one before the text; the
    text is taken as it is otherwise. A null or empty text has no tokens and score 0. Rows that
    repeat an id are each counted; a null id is kept.
    """
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    small_batches(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast((pieces, byte_fallback, prefix))  # as large as the vocabulary
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(name, held)
        for batch in batches:
            found = [counter.count(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "n_tokens": pa.array([n for n, _ in found], pa.int64()), "score": pa.array([s for _, s in found], pa.float64())})

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_tokens long, score double").withColumnRenamed("id", id_col)
