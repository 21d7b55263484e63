"""License scans.

Templates are cut into words; the hashes of their runs of ``GRAM`` words are winnowed (of every
``WINDOW`` neighbouring hashes the least is kept) into an inverted index from fingerprint to template
and place.  Every run of words of a document is looked up, so a passage is found wherever a window of
the template stands in it unchanged.  Hits of a template that lie near each other on neighbouring
diagonals are candidates, each of which is aligned with the template in a band around the diagonals:
equal words score 2, a changed, left out or put in word costs 1.  An alignment is reported with its
span in the text, the template's words that it matches and their part of the template (coverage), if
that is at least ``COVERAGE``.  Where no single alignment has that, those of the template that follow each
other in the text and in the template are chained, with up to as many words between two of them as the
template has; the chain of most words is reported if it has the coverage, with its parts.  So a licence with a
passage put in, left out or exchanged is found, whatever its length.  No alignment is made where the
template's words that have an equal one in the bands are too few for the coverage.  Of templates that align with the same span (each span for the most
part inside the other), such as notices of sibling licences, the one with the highest coverage counts, and
of equal ones that with the most words.

Templates are the short notices of ``TEMPLATES``, some of them the beginning of a text (coverage is that
of the template), and the whole texts and notices in ``license_texts``.

A scan is one pass without a shuffle: the index is as large as the templates, which are a parameter
(checked to be under ``MOST_WORDS`` words).  Of a document only the words around hits are aligned; where
a document repeats a notice, every occurrence is reported.

Defined cases: null and empty texts have no rows; rows with equal doc_id are scanned one by one; rows
without doc_id are reported with a null doc_id; templates without words match nothing; extra columns
are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from adherence.llm.base import table
from adherence.llm.words import ALNUM, Words, slices

GRAM = 3
WINDOW = 4
COVERAGE = 0.8
#: Words that an alignment may be off the diagonal of a hit (a quarter of a shorter template).
BAND = 8
#: Words that a part of a chain matches at least; fingerprints that it has, with at most so many words between
#: two; and the share of a template's fingerprints that a text with a chain of it has.
PART, HITS, GAP, SEEN = 6, 3, 32, 0.3
MOST_WORDS = 1_000_000

# Short notices and grants as they stand in files, by licence.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "All rights reserved": "All rights reserved.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "BSD conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."),
}


def shipped() -> dict[str, str]:
    """``TEMPLATES`` and the files of ``license_texts`` by name: "X whole text" or "X notice"."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    whole = {f.stem if f.stem.endswith(" notice") else f"{f.stem} whole text": f.read_text("utf-8") for f in files}
    return TEMPLATES | whole


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the least hash (the last, if equal) of every window; all places of a
    text that has one window at most."""
    n = len(hashes)
    if n <= WINDOW:
        return np.arange(n)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)
    return np.unique(np.arange(n - WINDOW + 1) + WINDOW - 1 - np.argmin(windows[:, ::-1], axis=1))


class Index:
    """Templates by name, their words, and the inverted index of their fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        w = Words(pa.array([templates[n] for n in self.names], pa.string()), ALNUM)
        if len(w.starts) > MOST_WORDS:
            raise ValueError(f"templates have over {MOST_WORDS} words")
        self.words = [w.hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        rows = []
        for t, own in enumerate(self.words):
            size = min(GRAM, len(own))  # a template of fewer words has them all as its only run
            if size:
                rows += [(size, h, t, at) for h, at in _runs(own, size)]
        self.prints = np.bincount([r[2] for r in rows], minlength=len(self.names)).tolist() if rows else [0] * len(self.names)
        self.by_size = {}
        for size in sorted({r[0] for r in rows}):
            own = sorted((int(h), t, at) for s, h, t, at in rows if s == size)
            self.by_size[size] = (np.array([r[0] for r in own], np.uint64), np.array([r[1] for r in own]), np.array([r[2] for r in own]))

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word place, template, template's place) of every fingerprint in the texts."""
        out = []
        for size, (keys, templates, places) in self.by_size.items():
            pos, hashes = w.grams(list(range(size)))
            slot = np.searchsorted(keys, hashes)
            found = np.flatnonzero(keys[np.minimum(slot, len(keys) - 1)] == hashes)
            slot = slot[found]
            n = np.searchsorted(keys, hashes[found], "right") - slot
            which = np.repeat(slot, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append((np.repeat(pos[found], n), templates[which], places[which]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _runs(own: np.ndarray, size: int) -> list[tuple[int, int]]:
    w = Words.__new__(Words)  # the run hashes of one text
    w.hashes, w.first = own, np.array([0, len(own)])
    _, h = w.grams(list(range(size)))
    return [(int(h[i]), int(i)) for i in winnowed(h)]


def align(doc: np.ndarray, template: np.ndarray, lo: int, hi: int) -> tuple[int, int, int, int, int, int]:
    """(score, words matched, first, end word of ``doc``, first, end word of the template) of the best local
    alignment whose place minus template's place lies in lo..hi."""
    m, width = len(template), hi - lo + 1
    score, start, match, since = (np.zeros(width + 2, np.int64) for _ in range(4))  # by diagonal, with a border
    best = (0,) * 6
    score[0] = score[-1] = -(1 << 40)
    step = np.arange(width)
    for i in range(m):
        at = np.arange(lo, hi + 1) + i
        inside = (at >= 0) & (at < len(doc))
        equal = inside & (doc[np.clip(at, 0, len(doc) - 1)] == template[i])
        s, b, k, t = score[1:-1] + np.where(equal, 2, -1), start[1:-1].copy(), match[1:-1] + equal, since[1:-1].copy()
        skip = score[2:] - 1  # a template's word that the text leaves out
        take = skip > s
        s, b, k, t = (np.where(take, x, y) for x, y in ((skip, s), (start[2:], b), (match[2:], k), (since[2:], t)))
        fresh = (s <= 0) | ~inside
        s, k = np.where(fresh, 0, s), np.where(fresh, 0, k)
        b, t = np.where(fresh, at + 1, b), np.where(fresh, i + 1, t)
        first = equal & (k == 1) & (s == 2)
        b, t = np.where(first, at, b), np.where(first, i, t)
        reach = np.maximum.accumulate(s + step)  # words that the text puts in: each costs one
        of = np.maximum.accumulate(np.where(s + step == reach, step, 0))
        score[1:-1], start[1:-1], match[1:-1], since[1:-1] = reach - step, b[of], k[of], t[of]
        d = int(score[1:-1].argmax())
        if score[d + 1] > best[0]:
            best = (int(score[d + 1]), int(match[d + 1]), int(start[d + 1]), int(at[d]) + 1, int(since[d + 1]), i + 1)
    return best


def chained(parts: list[tuple], gap: int) -> list[tuple]:
    """Of parts (matched, first, end, template's first, end) the chain of most words matched in which each
    follows the one before, in the text (by ``gap`` words at most) and in the template.  Where a part begins
    up to ``GAP`` words before the other ends, as chance has it at a cut, it is shortened by them."""
    parts = sorted(parts, key=lambda p: (p[2], p[4], p[1]))
    best, before = [p[0] for p in parts], [-1] * len(parts)
    over = lambda q, p: max(0, q[2] - p[1], q[4] - p[3])
    for j, p in enumerate(parts):
        for i, q in enumerate(parts[:j]):
            less = over(q, p)
            if less <= min(GAP, p[0] - 1) and p[1] <= q[2] + gap and p[2] > q[2] and p[4] > q[4] and best[i] + p[0] - less > best[j]:
                best[j], before[j] = best[i] + p[0] - less, i
    out, at = [], max(range(len(parts)), key=best.__getitem__, default=-1)
    while at >= 0:
        p, less = parts[at], over(parts[before[at]], parts[at]) if before[at] >= 0 else 0
        out.append((p[0] - less, p[1] + less, p[2], p[3] + less, p[4]))
        at = before[at]
    return out[::-1]


def _most(doc: np.ndarray, template: np.ndarray, lo: int, hi: int) -> int:
    """Words that an alignment as in ``align`` matches at most: those with an equal one in the band."""
    hit = np.zeros(len(template), bool)
    for d in range(lo, hi + 1):
        a, b = max(0, -d), min(len(template), len(doc) - d)
        if a < b:
            hit[a:b] |= doc[a + d:b + d] == template[a:b]
    return int(hit.sum())


def _best(rows: list[tuple]) -> list[tuple]:
    """Of the rows of one text, as in ``scan``, those beside which no better one has the same span."""
    out = []
    for x in rows:
        for y in rows:
            both = min(x[5], y[5]) - max(x[4], y[4])
            if y[0] == x[0] and y[1] != x[1] and (y[3], y[2]) > (x[3], x[2]) and both >= COVERAGE * max(x[5] - x[4], y[5] - y[4]):
                break
        else:
            out.append(x)
    return out


def _groups(row, which, diagonal, words) -> list[tuple[int, int]]:
    """(first, end) of hits that one alignment covers: of one row and template, on diagonals that are no
    further apart than the band, or half the template's words if it is short."""
    out, x = [], 0
    for y in range(1, len(row) + 1):
        if y == len(row) or row[y] != row[x] or which[y] != which[x] or diagonal[y] - diagonal[x] > min(BAND, len(words[which[x]]) // 2):
            out.append((x, y))
            x = y
    return out


def _rows_of(own: np.ndarray, t: np.ndarray, prints: int, groups: list[tuple], coverage: float) -> list[tuple]:
    """(matched, first, end, parts) of a template (of so many fingerprints) in the words of a text, from groups
    of hits (lowest and highest diagonal with the band, places in the template in order): each group that
    covers enough by itself, or else the best chain of what lies around rows of hits."""
    whole = []
    for lo, hi, _ in groups:
        left = max(0, lo)  # of the text only the words that the band reaches
        near = own[left:hi + len(t) + 1]
        if len(near) >= coverage * len(t) and _most(near, t, lo - left, hi - left) >= coverage * len(t):
            _, matched, s, end, u, v = align(near, t, lo - left, hi - left)
            if matched >= coverage * len(t):
                whole.append((matched, s + left, end + left, [(matched, s + left, end + left, u, v)]))
    if whole:
        return whole
    if len(np.unique(np.concatenate([at for *_, at in groups]))) < SEEN * prints:
        return []
    around, ranges, reached = 2 * WINDOW + BAND, [], np.zeros(len(t), bool)
    for lo, hi, at in groups:
        for run in np.split(at, np.flatnonzero(np.diff(at) > GAP) + 1):
            if len(run) >= HITS:
                u, v = max(0, int(run[0]) - around), min(len(t), int(run[-1]) + GRAM + around)
                ranges.append((lo, hi, u, v))
                reached[u:v] = True
    if len(ranges) < 2 or reached.sum() < coverage * len(t):
        return []
    parts = []
    for lo, hi, u, v in ranges:
        left = max(0, lo + u)
        _, matched, s, end, x, y = align(own[left:hi + v + 1], t[u:v], lo + u - left, hi + u - left)
        if matched >= PART:
            parts.append((matched, s + left, end + left, x + u, y + u))
    chain = chained(parts, len(t))
    matched = sum(p[0] for p in chain)
    return [(matched, chain[0][1], chain[-1][2], chain)] if matched >= coverage * len(t) else []


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, matched, coverage, start_word, end_word, start_byte, end_byte, parts) of every match;
    bytes of the UTF-8 text, the end being past the last.  ``parts``: first and end word in the text and in
    the template of each alignment that the match consists of."""
    sent = docs.sparkSession.sparkContext.broadcast(templates or shipped())
    names = ["doc_id", "license", "matched", "coverage", "start_word", "end_word", "start_byte", "end_byte", "parts"]
    part_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start_word", "end_word", "template_start", "template_end")]))

    def run(batches):
        index = Index(sent.value)
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                w = Words(part.column("text"), ALNUM)
                rows = []
                place, which, at = index.hits(w)
                row = np.searchsorted(w.first, place, "right") - 1
                order = np.lexsort((place - at, which, row))
                place, which, at, row = place[order], which[order], at[order], row[order]
                diagonal = place - at
                for (r, n), groups in groupby(_groups(row, which, diagonal, index.words), key=lambda g: (int(row[g[0]]), int(which[g[0]]))):
                    t, f, e = index.words[n], int(w.first[r]), int(w.first[r + 1])
                    band = min(BAND, len(t) // 4)
                    found = [(int(diagonal[x]) - f - band, int(diagonal[y - 1]) - f + band, np.sort(at[x:y])) for x, y in groups]
                    for matched, s, end, parts in _rows_of(w.hashes[f:e], t, index.prints[n], found, coverage):
                        rows.append((r, index.names[n], matched, matched / len(t), s, end, int(w.starts[f + s] - w.offsets[r]),
                                     int(w.ends[f + end - 1] - w.offsets[r]), tuple(p[1:] for p in parts)))
                rows = [x for _, own in groupby(sorted(set(rows)), key=lambda x: x[0]) for x in _best(list(own))]
                ids = part.column("doc_id").take(pa.array([x[0] for x in rows], pa.int64()))
                kinds = [pa.string(), pa.int64(), pa.float64(), *[pa.int64()] * 4]
                spans = pa.array([[dict(zip(("start_word", "end_word", "template_start", "template_end"), p, strict=True)) for p in x[8]] for x in rows], part_type)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array([x[i + 1] for x in rows], k) for i, k in enumerate(kinds)], spans], names)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, license string, matched long, coverage double, start_word long, end_word long, start_byte long, end_byte long, "
             "parts array<struct<start_word: long, end_word: long, template_start: long, template_end: long>>")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))
