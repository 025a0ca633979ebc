"""Licence scan: normalised text against licence templates by Dice coefficient.

Text is cut to its ASCII letter and digit runs, lower-cased, so that line
breaks, comment signs and punctuation do not count. The units compared with a
template of n word bigrams are the windows of a text that start at one of its
bigrams and are 2/3, 5/6, 1, 5/4 and 3/2 times n bigrams long (to the end of
the text where that comes first): a full licence inside a longer document, a
header wrapped over lines and a notice inside a sentence are units like any
other. With A and B the sets of bigrams, ``2 |A n B| / (|A| + |B|)`` reaches the
threshold t only where ``|A n B| >= |B| t / (2 - t)``: a text that holds fewer of
a template's bigrams is not compared with it, which leaves most texts no
template at all, and no window outside the lengths above can qualify unless
its bigrams repeat.

Of the windows that reach the threshold, those are returned that overlap no
better one: first within a template by Dice coefficient, then among templates
by bigrams shared, so that a notice quoted by a full licence belongs to the
licence, and version 3 is not also reported as version 2.

Templates are a parameter: the files of ``licenses/`` (full texts and standard
headers) and notices made of licence names; they travel with the tasks. The
scan is one pass over the rows without a shuffle; a task holds one text's words
as numbers.

Defined cases: null, empty and blank texts, and texts of one word, match
nothing; ties go to the template listed first, then to the earlier and the
shorter window; repeated rows repeat their result; a text of any length is
scanned whole; an empty table gives an empty result; columns beside doc_id and
text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from importlib import resources
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from dovetail.llm.common import documents_core

THRESHOLD = 0.8
#: Lengths of windows, as parts of a template's number of bigrams.
LENGTHS = ((2, 3), (5, 6), (1, 1), (5, 4), (3, 2))
SCHEMA = ("doc_id bigint, license string, template string, start_word bigint, end_word bigint, "
          "shared bigint, dice double")
# Licence names as commonly written in notices.
NAMES = (
    ("MIT", "the MIT License"),
    ("Apache-2.0", "the Apache License, Version 2.0"),
    ("Apache-2.0", "the Apache 2.0 License"),
    ("GPL", "the GNU General Public License"),
    ("GPL-2.0", "the GNU General Public License, version 2"),
    ("GPL-3.0", "the GNU General Public License, version 3"),
    ("LGPL-2.1", "the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0"),
    ("BSD", "the BSD License"),
    ("BSD-2-Clause", "the 2-clause BSD License"),
    ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-3-Clause", "the 3-clause BSD License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("ISC", "the ISC License"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
    ("CC-BY-4.0", "a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-ND-4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-NC-ND-4.0", "a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
)
# How notices begin.
OPENINGS = ("licensed under", "under the terms of")


class Template(NamedTuple):
    license: str
    name: str
    text: str


def _words(text: str) -> Iterator[bytes]:
    """Runs of ASCII letters and digits, lower-cased; the text is cut between
    words every megabyte, so that a long one is never a list of all its words."""
    raw, at = text.encode("utf-8", "replace").lower(), 0
    while at < len(raw):
        gap = re.compile(b"[^a-z0-9]").search(raw, at + (1 << 20))
        end = gap.start() if gap else len(raw)
        yield from re.findall(b"[a-z0-9]+", raw[at:end])
        at = end


def normal_words(text: str) -> list[str]:
    return [w.decode() for w in _words(text)]


def lengths(n: int) -> list[int]:
    """Window lengths for a template of ``n`` bigrams."""
    return sorted({max(1, (2 * n * p + q) // (2 * q)) for p, q in LENGTHS})


@lru_cache(1)
def templates() -> tuple[Template, ...]:
    """The licence files, full texts and headers, then a notice for every opening and name."""
    files = sorted((f for f in resources.files("dovetail.llm").joinpath("licenses").iterdir() if f.name.endswith(".txt")),
                   key=lambda f: f.name)
    made = [Template(f.name.removesuffix(".txt").removesuffix(".header"), f.name.removesuffix(".txt"), f.read_text(encoding="utf-8"))
            for f in files]
    return (*made, *(Template(spdx, f"{opening} {name}", f"{opening} {name}") for spdx, name in NAMES for opening in OPENINGS))


class _Index:
    """Bigrams of all templates: their keys in order, and which template has which."""

    def __init__(self, made: tuple[Template, ...], threshold: float):
        texts = [list(_words(t.text)) for t in made]
        self.word = {w: i for i, w in enumerate(sorted({w for ws in texts for w in ws}), 1)}
        self.base = len(self.word) + 1
        each = [self.keys(np.array([self.word[w] for w in ws], np.int64)) for ws in texts]
        self.grams = np.unique(np.concatenate(each))
        self.has = np.zeros((len(self.grams), len(made)), bool)
        for t, k in enumerate(each):
            self.has[np.searchsorted(self.grams, k), t] = True
        self.size = self.has.sum(axis=0)
        self.lengths = [lengths(len(k)) for k in each]
        self.least = np.ceil(self.size * threshold / (2 - threshold) - 1e-9)

    def keys(self, words: np.ndarray) -> np.ndarray:
        """One number for each bigram; 0 and multiples of the base stand for words of no template."""
        return words[:-1] * self.base + words[1:]


@lru_cache(4)
def _index(made: tuple[Template, ...], threshold: float) -> _Index:
    return _Index(made, threshold)


def _distinct(at: np.ndarray, before: np.ndarray, length: int, starts: int) -> np.ndarray:
    """For each start s, how many different bigrams stand at the places ``at``
    within [s, s + length): a place counts in the windows that hold it and not
    its bigram's place ``before``."""
    step = np.zeros(starts + 1, np.int64)
    first = np.maximum(np.maximum(before + 1, at - length + 1), 0)
    some = first < starts
    np.add.at(step, first[some], 1)
    np.add.at(step, np.minimum(at[some] + 1, starts), -1)
    return np.cumsum(step[:-1])


def _before(keys: np.ndarray) -> np.ndarray:
    """For each place, the last earlier place of the same key (-1: none)."""
    order = np.argsort(keys, kind="stable")
    out = np.full(len(keys), -1, np.int64)
    same = keys[order[1:]] == keys[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def _apart(order: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> list[int]:
    """In the order given, the windows [start, end] that overlap none taken before."""
    taken, out = np.zeros(n, bool), []
    for i in order:
        if not taken[start[i]:end[i] + 1].any():
            taken[start[i]:end[i] + 1] = True
            out.append(i)
    return out


def match(text: str, ix: _Index, threshold: float) -> list[tuple[int, int, int, int, float]]:
    """(template, first word, last word, bigrams shared, Dice coefficient) of the best windows of a text."""
    get = ix.word.get
    keys = ix.keys(np.fromiter((get(w, 0) for w in _words(text)), np.int64))
    n = len(keys)
    if n < 1:
        return []
    row = np.minimum(np.searchsorted(ix.grams, keys), len(ix.grams) - 1)
    known = np.flatnonzero(ix.grams[row] == keys)
    able = np.flatnonzero(ix.has[np.unique(row[known])].sum(axis=0) >= ix.least)
    if not len(able):
        return []
    # now words of no template need names too, for the size of a window's set
    names: dict[bytes, int] = {}
    other = np.fromiter((names.setdefault(w, len(names)) for w in _words(text)), np.int64)
    before = _before(other[:-1] * len(names) + other[1:])
    every = np.arange(n)
    found = []
    for t in able:
        hits = known[ix.has[row[known], t]]
        last_hit = np.zeros(n, np.int64)
        last_hit[hits] = hits
        last_hit = np.maximum.accumulate(last_hit)
        got = []
        for length in ix.lengths[t]:
            in_both = _distinct(hits, before[hits], length, n)[hits]
            size = _distinct(every, before, length, n)[hits]
            dice = 2.0 * in_both / (size + ix.size[t])
            ok = dice >= threshold
            start = hits[ok]
            got.append((dice[ok], in_both[ok], start, np.full(len(start), length), last_hit[np.minimum(start + length, n) - 1]))
        dice, shared, start, length, end = (np.concatenate(c) for c in zip(*got))
        best = np.lexsort((length, start, -shared, -dice))
        found += [(int(t), int(start[i]), int(end[i]), int(shared[i]), float(dice[i])) for i in _apart(best, start, end, n)]
    if len(found) < 2:
        return [(t, s, e + 1, k, d) for t, s, e, k, d in found]
    found.sort(key=lambda f: (-f[3], -f[4], f[0], f[1]))
    kept = _apart(np.arange(len(found)), np.array([f[1] for f in found]), np.array([f[2] for f in found]), n)
    return [(t, s, e + 1, k, d) for t, s, e, k, d in (found[i] for i in kept)]


def scan(docs: DataFrame, made: tuple[Template, ...] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per passage that matches: doc_id, license, template, start_word
    and end_word (first and last word of the passage, from 0), shared (bigrams
    it has of the template's), dice."""
    made = tuple(Template(*t) for t in (templates() if made is None else made))
    made = tuple(t for t in made if len(normal_words(t.text)) > 1)
    if not made:
        return docs.sparkSession.createDataFrame([], SCHEMA)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        ix = _index(made, threshold)
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, text in zip(batch.column(0), batch.column(1)):
                for t, start, end, shared, dice in match(text.as_py(), ix, threshold):
                    for c, v in zip(cols, (doc.as_py(), made[t].license, made[t].name, start, end, shared, dice)):
                        c.append(v)
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            names = ("doc_id", "license", "template", "start_word", "end_word", "shared", "dice")
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(cols, types)], names=list(names))

    return documents_core(docs).where("text is not null").mapInArrow(run, SCHEMA)
