"""License scans by template-markup matching.

A template is a license's wording with markup: optional regions, which may be missing, and
replaceable regions, which stand for one of several wordings or for some words of any kind, such
as a holder's name. All other words are mandatory and must follow one another exactly; case and
punctuation don't count. Templates are parsed into regions, regions become states of one
automaton over words, and the automaton is made deterministic, with the words that templates
name as its alphabet and one more letter for all others.

A task looks up all words of a batch of texts at once and then moves all places where a
template can start through the automaton together, one word a step, until each is either in no
state or at its text's end. A place costs as many steps as its words fit a template, so work
grows with the text and with what is found in it. What is accepted is compared with the
templates' words letter by letter once more, as words are looked up by 64-bit hashes.

Markup: ``<<beginOptional>>`` and ``<<endOptional>>`` enclose a region that may be missing, and
``<<var;name="...";original="...";match="...">>`` is replaceable: ``match`` gives wordings
between bars, or ``.{1,12}`` for that many words of any kind (``.?`` and ``.`` for short).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MARKS, small_batches, text_pieces, word_hashes, word_spans

#: States that the templates together may need; more mean replaceable regions that are too wide.
STATES = 200_000

_MARKUP = re.compile(r"<<(.*?)>>", re.S)
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_MATCH = re.compile(r'match="(.*?)"', re.S)
_ANY = re.compile(r"\.(?:\{(\d+),(\d+)\}|(\?))?$")


@dataclass(frozen=True)
class Template:
    """Wording with markup; ``weight`` is how strong evidence a place is, from 0 to 1."""

    name: str
    label: str
    text: str
    weight: float = 1.0
    base: bool = False


@dataclass(frozen=True)
class Word:
    text: str


@dataclass(frozen=True)
class AnyWords:
    least: int
    most: int


@dataclass(frozen=True)
class Choice:
    """One of several wordings; an empty one may be skipped."""

    ways: tuple[tuple, ...]


def words_of(text: str) -> list[str]:
    """Words in the sense of the scan: letters and digits, A-Z lower-cased, and all beyond ASCII."""
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in _WORD.findall(text)]


def _replaceable(markup: str) -> Choice | AnyWords:
    found = _MATCH.search(markup)
    if not found:
        raise ValueError(f"a replaceable region without match: {markup}")
    if any_ := _ANY.match(found[1]):
        least, most = (0, 1) if any_[3] else (int(any_[1] or 1), int(any_[2] or 1))
        if most < max(least, 1):
            raise ValueError(f"a region of no words: {markup}")
        return AnyWords(least, most)
    return Choice(tuple(tuple(map(Word, words_of(way))) for way in found[1].split("|")))


def parsed(text: str) -> tuple:
    """The regions of a template."""
    open_: list[list] = [[]]
    for k, piece in enumerate(_MARKUP.split(text)):
        if k % 2 == 0:
            open_[-1] += map(Word, words_of(piece))
        elif piece == "beginOptional":
            open_.append([])
        elif piece == "endOptional":
            if len(open_) == 1:
                raise ValueError("an optional region ends that has not begun")
            inner = tuple(open_.pop())
            open_[-1].append(Choice((inner, ())))
        elif piece.startswith("var;"):
            open_[-1].append(_replaceable(piece))
        else:
            raise ValueError(f"unknown markup: {piece}")
    if len(open_) > 1:
        raise ValueError("an optional region does not end")
    return tuple(open_[0])


class _States:
    """States of the automaton before it is deterministic: steps by word, by any word, for free."""

    def __init__(self) -> None:
        self.steps: list[dict] = []
        self.free: list[set[int]] = []

    def new(self) -> int:
        self.steps.append({})
        self.free.append(set())
        return len(self.steps) - 1

    def step(self, at: int, word: str | None) -> int:
        to = self.new()
        self.steps[at].setdefault(word, set()).add(to)
        return to

    def regions(self, at: int, regions: Sequence) -> int:
        """The state after all regions, read one after the other from ``at`` on."""
        for region in regions:
            if isinstance(region, Word):
                at = self.step(at, region.text)
            elif isinstance(region, AnyWords):
                end = self.new()
                for k in range(region.most):
                    if k >= region.least:
                        self.free[at].add(end)
                    at = self.step(at, None)
                self.free[at].add(end)
                at = end
            else:
                end = self.new()
                for way in region.ways:
                    self.free[self.regions(at, way)].add(end)
                at = end
        return at

    def reached(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for to in self.free[todo.pop()] - seen:
                seen.add(to)
                todo.append(to)
        return frozenset(seen)


class Automaton:
    """All templates as one deterministic automaton.

    ``table[state, letter]`` is the next state, 0 for none; state 1 is the start. Letter 0 stands
    for words that no template names. ``ends`` tells which templates a state accepts.
    """

    def __init__(self, templates: Sequence[Template]) -> None:
        states = _States()
        start = states.new()
        accepts: dict[int, int] = {}
        for k, template in enumerate(templates):
            begin = states.new()
            states.free[start].add(begin)
            accepts[states.regions(begin, parsed(template.text))] = k
        self.words = sorted({w for s in states.steps for w in s if w is not None})
        letters = {w: k for k, w in enumerate(self.words, 1)}
        first = states.reached({start})
        if any(s in accepts for s in first):
            raise ValueError("a template needs a mandatory word")
        known, todo, rows, ends = {first: 1}, [first], [{}, {}], [set(), set()]
        while todo:
            now = todo.pop()
            moves: dict[str | None, set[int]] = {}
            for s in now:
                for word, to in states.steps[s].items():
                    moves.setdefault(word, set()).update(to)
            other = moves.pop(None, set())
            row = {}
            for word, to in [*moves.items(), (None, set())]:
                if not (to := to | other):
                    continue
                after = states.reached(to)
                if after not in known:
                    if len(rows) >= STATES:
                        raise ValueError("the templates' replaceable regions are too wide")
                    known[after] = len(rows)
                    rows.append({})
                    ends.append({accepts[s] for s in after if s in accepts})
                    todo.append(after)
                row[letters[word] if word else 0] = known[after]
            rows[known[now]] = (row, known[states.reached(other)] if other else 0)
        self.table = np.zeros((len(rows), len(self.words) + 1), np.int32)
        for k, made in enumerate(rows[1:], 1):
            row, rest = made
            self.table[k] = rest
            for letter, to in row.items():
                self.table[k, letter] = to
        self.ends = ends
        self.accepting = np.array([bool(e) for e in ends])
        data = "".join(w + " " for w in self.words).encode()
        hashes, _ = word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]), MARKS)
        order = np.argsort(hashes)
        self.hashes, self.letters = hashes[order], (order + 1).astype(np.int32)
        self.bytes = [w.encode() for w in self.words]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The letter of every word, from its hash."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.letters[at], 0)

    def places(self, letters: np.ndarray, edges: np.ndarray) -> list[tuple[int, int, int]]:
        """(first word, words, template) of every place; the longest, where a template fits in several.

        ``edges`` are the texts' first words; no place reaches over one.
        """
        ends = np.repeat(edges[1:], np.diff(edges))
        at = np.flatnonzero(self.table[1, letters] > 0)
        state, taken = np.ones(len(at), np.int32), 0
        found: dict[tuple[int, int], int] = {}
        while len(at):
            state = self.table[state, letters[at + taken]]
            taken += 1
            for k in np.flatnonzero(self.accepting[state]):
                for template in self.ends[state[k]]:
                    found[int(at[k]), template] = taken
            go_on = (state > 0) & (at + taken < ends[at])
            at, state = at[go_on], state[go_on]
        return [(first, n, template) for (first, template), n in found.items()]


def license_places(
    documents: DataFrame, templates: Sequence[Template], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ``n_words``, ``places``) of every row, over the whole text.

    ``places`` holds (``template``, ``label``, ``weight``, ``base``, ``first``, ``words``) of each
    place where a template is accepted, by first word (from 0) and template. A template that fits
    from one word on in several lengths gives its longest place; places may overlap.

    A null or empty text has no words and no places. Repeated rows and null ids are returned
    each. Other columns are left out. An empty table gives no rows.
    """
    small_batches(documents.sparkSession)
    kind = documents.schema[id_col].dataType.simpleString()
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    templates = list(templates)
    automaton = Automaton(templates)
    place = pa.struct([("template", pa.string()), ("label", pa.string()), ("weight", pa.float64()), ("base", pa.bool_()), ("first", pa.int64()), ("words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_pieces(batch.column("text")):
                hashes, edges = word_hashes(data, offsets, MARKS)
                letters = automaton.lookup(hashes)
                rows: list[list[dict]] = [[] for _ in range(end - first)]
                found = automaton.places(letters, edges)
                if found:
                    starts, stops = word_spans(data, offsets, MARKS)
                    raw = data.tobytes()
                for at, n, k in sorted(found):
                    # equal hashes are not yet equal words
                    spelled = (automaton.bytes[letters[w] - 1] == raw[starts[w] : stops[w]].lower() for w in range(at, at + n) if letters[w])
                    if all(spelled):
                        row, t = int(np.searchsorted(edges, at, "right")) - 1, templates[k]
                        rows[row].append({"template": t.name, "label": t.label, "weight": t.weight, "base": t.base, "first": at - int(edges[row]), "words": n})
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, end - first), pa.array(np.diff(edges), pa.int64()), pa.array(rows, pa.list_(place))],
                    names=["id", "n_words", "places"],
                )

    shape = "array<struct<template: string, label: string, weight: double, base: boolean, first: bigint, words: bigint>>"
    return docs.mapInArrow(run, f"id {kind}, n_words long, places {shape}").withColumnRenamed("id", id_col)


# The base phrases with their labels, and public license wordings.
_ACT = '<<var;name="act";match="licensed|released|distributed|published|available|provided">>'
_TERMS = '<<beginOptional>>the <<var;match="terms|terms and conditions">> of <<endOptional>>'
_TAG = "SPDX-License-Identifier: "
_BULLET = '<<var;name="bullet";match=".?">>'
_BSD = (
    f"Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    f" {_BULLET} Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    f" {_BULLET} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer"
    " in the documentation and/or other materials provided with the distribution."
)
TEMPLATES = (
    Template("mit phrase", "mit", "under the mit license", 0.5, True),
    Template("apache-2 phrase", "apache-2", "apache license version 2", 0.5, True),
    Template("cc-by-nc phrase", "cc-by-nc", "cc by nc", 0.5, True),
    Template("mit notice", "mit", f"{_ACT} under {_TERMS}the MIT License", 0.8),
    Template("apache-2 notice", "apache-2", f"{_ACT} under {_TERMS}the Apache License, Version 2", 0.8),
    Template("gpl-2 notice", "gpl-2", f"{_ACT} under {_TERMS}the GNU General Public License<<beginOptional>> as published by the Free Software Foundation; either<<endOptional>>, version 2", 0.8),
    Template("gpl-3 notice", "gpl-3", f"{_ACT} under {_TERMS}the GNU General Public License<<beginOptional>> as published by the Free Software Foundation; either<<endOptional>>, version 3", 0.8),
    Template("cc-by-nc notice", "cc-by-nc", f'{_ACT} under <<beginOptional>>{_TERMS}<<var;match="a|the">> <<endOptional>>CC BY-NC<<var;match="|-SA|-ND">><<var;match="| 4.0| 3.0">>', 0.8),
    Template("cc-by-nc name", "cc-by-nc", "Creative Commons Attribution-NonCommercial", 0.8),
    Template("mit tag", "mit", f"{_TAG}MIT"),
    Template("apache-2 tag", "apache-2", f"{_TAG}Apache-2.0"),
    Template("gpl-2 tag", "gpl-2", f"{_TAG}GPL-2.0"),
    Template("gpl-3 tag", "gpl-3", f"{_TAG}GPL-3.0"),
    Template("cc-by-nc tag", "cc-by-nc", f"{_TAG}CC-BY-NC"),
    Template(
        "mit text", "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"),"
        " to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
        " The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph) <<endOptional>>shall be included in all copies"
        " or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO"
        " THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL"
        ' <<var;name="holder";original="THE AUTHORS OR COPYRIGHT HOLDERS";match=".{1,12}">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF'
        " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    Template(
        "apache-2 header", "apache-2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
        "<<beginOptional>> You may obtain a copy of the License at <<var;name=\"url\";original=\"http://www.apache.org/licenses/LICENSE-2.0\";match=\".{1,10}\">><<endOptional>>"
        " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    Template("bsd-2 text", "bsd-2", f'{_BSD} THIS SOFTWARE IS PROVIDED BY <<var;name="holder";match=".{{1,12}}">> "AS IS"'),
    Template(
        "bsd-3 text", "bsd-3",
        f'{_BSD} {_BULLET} Neither the name of <<var;name="organisation";match=".{{1,12}}">> nor the names of its contributors may be used to endorse or promote'
        " products derived from this software without specific prior written permission.",
    ),
)


def as_pattern(text: str) -> str:
    """The template as a regular expression over words with a space before each."""

    def written(regions: Sequence) -> str:
        out = ""
        for region in regions:
            if isinstance(region, Word):
                out += " " + region.text
            elif isinstance(region, AnyWords):
                out += f"(?: [^ ]+){{{region.least},{region.most}}}"
            else:
                out += "(?:" + "|".join(map(written, region.ways)) + ")"
        return out

    return written(parsed(text))
