"""License scans: an exact set-similarity join of text blocks with license templates.

A template is a short text with a label; a text block is any run of as many words as the
template has.  They are linked when the block holds at least ``percent`` of the template's
different words (containment).  Templates that are phrases ask for all words, in order and without a gap.

1. One pass counts in how many documents each word of the templates occurs (partial counts
   per task, a few hundred rows); that is the global order, rare words first.
2. The templates' words, in that order, are indexed by prefix: a block that holds ``need`` of n
   words holds one of the n - need + 1 rarest.  The index is a few kB and its size is checked.
3. A second pass looks every word of every text up in the index.  Around a prefix word, the length filter asks
   for ``need`` different indexed words within reach, the positional filter for enough of them on
   either side of that word in the global order; what passes is verified exactly by
   sliding the block word by word with incremental counts.

Texts are never shuffled; a document is one task's work, in memory that grows with that text.

Defined results: null text is empty; a text without words has no links and score 0; shorter texts
than a template are one block; a very long text is read whole; repeated rows give repeated
rows; equal document counts are ordered by word; an empty table gives no rows (all counts are 0 then); a null id
stays null; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warnindex.llm.common import arrow_rows

# Word characters: 0-9, a-z and everything beyond ASCII; A-Z are lower-cased.
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False  # all words, in order and without a gap


# Fixed by the contract.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)

# Notices as their licenses publish them (fixed texts).
NOTICES = (
    Template("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
             "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
             'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
             "See the License for the specific language governing permissions and limitations under the License."),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
             '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
             "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    Template("mit", "Released under the MIT License"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
             "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    Template("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
             "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
)

PERCENT = 80  # of a notice's different words
MAX_TEMPLATE_WORDS = 1_000_000

LINKS = "doc_id long, n_words long, links array<struct<label:string,phrase:boolean,first:long,last:long,containment:double>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Entry:
    """A template in the index: its different words, rare ones first."""

    label: str
    phrase: bool
    words: tuple[bytes, ...]  # as written
    need: int
    span: int  # words in a block
    place: dict[bytes, int]  # word -> place in the global order of this template's words


@dataclass(frozen=True)
class Index:
    entries: tuple[Entry, ...]
    rank: dict[bytes, int]  # every template word -> its place in the global order
    prefix: dict[bytes, tuple[int, ...]]  # prefix word -> templates


def build_index(templates: Iterable[Template], docs_with: dict[bytes, int], percent: int = PERCENT) -> Index:
    order = {w: (docs_with.get(w, 0), w) for t in templates for w in words_of(t.text.encode())}
    rank = {w: i for i, w in enumerate(sorted(order, key=order.get))}
    entries, prefix = [], {}
    for t in templates:
        words = words_of(t.text.encode())
        if not words:
            raise ValueError(f"the template of {t.label!r} has no words")
        own = sorted(set(words), key=rank.get)
        need = len(own) if t.phrase else -(-len(own) * percent // 100)
        for w in own[: len(own) - need + 1]:
            prefix.setdefault(w, []).append(len(entries))
        entries.append(Entry(t.label, t.phrase, tuple(words), need, len(words), {w: i for i, w in enumerate(own)}))
    return Index(tuple(entries), rank, {w: tuple(e) for w, e in prefix.items()})


def _phrase_places(words: list[bytes], at: list[int], e: Entry) -> list[tuple[int, int, float]]:
    """Places of a phrase around the positions of its rarest word."""
    rare = min(e.place, key=e.place.get)
    offsets = [i for i, w in enumerate(e.words) if w == rare]
    starts = {p - o for p in at for o in offsets if p >= o and tuple(words[p - o:p - o + e.span]) == e.words}
    return [(s, s + e.span, 1.0) for s in sorted(starts)]


def _filtered(hits: list[tuple[int, int]], positions: np.ndarray, at: int, e: Entry, place: int, rank: int) -> bool:
    """Length and positional filters for all blocks that hold the prefix word at ``at``."""
    i, j = np.searchsorted(positions, (at - e.span + 1, at + e.span))
    near = {r for _, r in hits[i:j]}
    if len(near) < e.need:
        return False
    rarer = sum(r < rank for r in near)
    return min(place, rarer) + 1 + min(len(e.place) - place - 1, len(near) - rarer - 1) >= e.need


def _blocks(words: list[bytes], hits: list[tuple[int, int]], positions: np.ndarray, at: list[int], e: Entry) -> list[tuple[int, int, float]]:
    """Exact verification: every block that reaches a position in ``at``; overlapping
    linked blocks are merged and give their best containment."""
    out: list[list] = []
    done = -1  # blocks starting before were looked at
    k = 0
    while k < len(at):
        low, high = max(done, at[k] - e.span + 1, 0), at[k]
        while k + 1 < len(at) and at[k + 1] - e.span + 1 <= high + 1:
            k += 1
            high = at[k]
        k += 1
        done = high + 1
        i, j = np.searchsorted(positions, (low, high + e.span))
        own = [(p, e.place[words[p]]) for p, _ in hits[i:j] if words[p] in e.place]
        count = [0] * len(e.place)
        different = b = 0
        for a, (p, w) in enumerate(own):  # a best block starts at a word of the template
            if p > high:
                break
            while b < len(own) and own[b][0] < p + e.span:
                different += count[own[b][1]] == 0
                count[own[b][1]] += 1
                b += 1
            if different >= e.need:
                c = different / len(e.place)
                if out and p < out[-1][1]:
                    out[-1][1:] = [own[b - 1][0] + 1, max(out[-1][2], c)]
                else:
                    out.append([p, own[b - 1][0] + 1, c])
            count[w] -= 1
            different -= count[w] == 0
    return [tuple(x) for x in out]


def links_of(words: list[bytes], index: Index) -> list[tuple[str, bool, int, int, float]]:
    """Links of one text: (label, phrase, first word, end of the last word, containment)."""
    if index.prefix.keys().isdisjoint(words):
        return []
    rank = index.rank
    hits = [(i, rank[w]) for i, w in enumerate(words) if w in rank]
    positions = np.fromiter((p for p, _ in hits), np.int64, len(hits))
    found: dict[int, list[int]] = {}
    for p, r in hits:
        for t in index.prefix.get(words[p], ()):
            e = index.entries[t]
            if e.phrase or _filtered(hits, positions, p, e, e.place[words[p]], r):
                found.setdefault(t, []).append(p)
    out = []
    for t, at in sorted(found.items()):
        e = index.entries[t]
        places = _phrase_places(words, at, e) if e.phrase else _blocks(words, hits, positions, at, e)
        out += [(e.label, e.phrase, a, b, c) for a, b, c in places]
    return out


def _text(docs: DataFrame, text_col: str):
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")


def documents_with(docs: DataFrame, templates: Iterable[Template], text_col: str = "text") -> dict[bytes, int]:
    """For every word of the templates, in how many documents it occurs."""
    vocab = frozenset(w for t in templates for w in words_of(t.text.encode()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in arrow_rows(batches):
            for text in b.column(0).to_pylist():
                n.update(vocab.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    counts = docs.select(_text(docs, text_col)).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counts.collect()}  # a row for each word of the templates


def license_links(docs: DataFrame, templates: Iterable[Template] = PHRASES + NOTICES, percent: int = PERCENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words and all its links with the templates."""
    templates = tuple(templates)
    if not 0 < percent <= 100:
        raise ValueError("the threshold is a share")
    if sum(len(words_of(t.text.encode())) for t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"more than {MAX_TEMPLATE_WORDS} words of templates: scan for them in groups, links do not depend on each other")
    index = build_index(templates, documents_with(docs, templates, text_col), percent)
    kind = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            n, links = [], []
            for text in b.column(1).to_pylist():
                words = words_of(text)
                n.append(len(words))
                links.append([{"label": x[0], "phrase": x[1], "first": x[2], "last": x[3] - 1, "containment": x[4]} for x in links_of(words, index)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(links, kind)], names=["doc_id", "n_words", "links"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), _text(docs, text_col)).mapInArrow(run, LINKS)
