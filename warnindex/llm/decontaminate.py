"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

A benchmark item of n words leaks into a document when some run of the
document's words is within floor((1 - similarity) * n) word edits of it (words:
letters and digits, lower-cased).

CGK random walk: a pointer starts at the window's first word; step j emits the
word under the pointer and moves on by a random bit that depends on (j, word).
Windows at small edit distance re-synchronise, so edit distance turns into
Hamming distance.  A table samples a few steps of one walk; equal samples make a
candidate.  Windows are as long as the items of a length class (n in [m, 2m)):
steps are sampled over the part of the walk that stays inside them.

Document windows start at every (m/4)-th word only; each item is indexed from
each of its first m/4 words, so every occurrence has an aligned window, and from
m/4 words more whose windows end with the item (n < 2m), so that all of it is
sampled wherever the edits crowd.

Recall: per length class the number of tables is raised until mutated copies of
the class's own items, at the full edit budget and at random phases, are found
at ``target_recall`` for each place of the edits: spread, or all in the first, the
middle or the last half (copies with fewer edits are found more often).  A class
that misses the target with ``max_tables``, and items too short for a walk (below ``walk_words``),
are searched exactly instead: of an item cut into one piece more than its edits, one piece
stands unedited in every copy, so the items' pieces are looked up at every word.  Candidates
are verified exactly with bit-parallel edit distance over the whole item and all
alignments around the window.

Benchmark items are a stated query set: they are cut into blocks of at most
about ``block_chars`` characters, each block is broadcast and every document is
searched whole, in one map pass a block, without a shuffle.

Defined results: null and empty texts hold nothing; items without a word (null and empty ones too) are
in no text; an item of fewer than five words leaks where it stands word by word (its budget is no edit); equal items
match each; repeated rows and null ids are kept as they are; extra columns stay,
and the added column gives way to a clashing name by prefixing ``_``.
"""

from __future__ import annotations

import logging
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warnindex.llm.common import arrow_rows, fresh_name

log = logging.getLogger(__name__)
_WORD = re.compile(r"[^\W_]+")
PLACES = (None, 0.0, 0.5, 1.0)  # of a copy's edits: spread, or all in the first, middle or last half
_MUL, _FIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

HITS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("start_word", T.IntegerType()),
    T.StructField("n_words", T.IntegerType()), T.StructField("distance", T.IntegerType())]))
_ARROW_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("distance", pa.int32())]))


@dataclass(frozen=True)
class LeakParams:
    similarity: float = 0.8
    target_recall: float = 0.98
    walk_words: int = 5  # items below are looked up whole
    samples: int = 4
    max_tables: int = 64
    trials: int = 600
    block_chars: int = 2 << 20
    seed: int = 5


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    h = (x.astype(np.uint64) + np.uint64(salt * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * _MUL
    h = (h ^ (h >> np.uint64(29))) * _FIN
    return h ^ (h >> np.uint64(32))


def best_alignment(item: list[int], text: list[int]) -> tuple[int, int, int]:
    """(distance, start, end) of the run of ``text`` closest to ``item`` in word edits:
    smallest distance, then earliest end, then the longest run."""

    def search(pat, txt, anchored):
        m = len(pat)
        peq = defaultdict(int)
        for i, c in enumerate(pat):
            peq[c] |= 1 << i
        ones, high = (1 << m) - 1, 1 << (m - 1)
        pv, mv, score = ones, 0, m
        best, at = m, 0
        for j, c in enumerate(txt, 1):
            eq = peq.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = (mv | ~(xh | pv)) & ones, pv & xh
            score += 1 if ph & high else -1 if mh & high else 0
            ph = (ph << 1 | anchored) & ones
            mh = (mh << 1) & ones
            pv, mv = (mh | ~(xv | ph)) & ones, ph & xv
            if score < best or anchored and score == best:
                best, at = score, j
        return best, at

    dist, end = search(item, text, 0)
    _, back = search(item[::-1], text[:end][::-1], 1)
    return dist, end - back, end


@dataclass
class _Class:
    """Items of one length class and their tables."""

    low: int
    stride: int
    steps: int
    items: list[int] = field(default_factory=list)
    samples: int = 4
    tables: list = field(default_factory=list)  # (positions, sorted keys, owner of key, filters)
    recall: float = 0.0  # the worst over the places of the edits


class LeakIndex:
    """LSH tables over one block of items ``[(item_id, text)]``."""

    def __init__(self, items: list[tuple[int | None, str | None]], p: LeakParams = LeakParams()):
        self.p = p
        self.ids, self.words, vocab = [], [], {}
        for item_id, text in items:
            w = words_of(text)
            if w:
                self.ids.append(item_id)
                self.words.append([vocab.setdefault(x, len(vocab) + 1) for x in w])
        self.vocab = vocab
        self.stop = len(vocab) + 1  # separates documents; matches nothing
        self.budget = [int((1 - p.similarity) * len(w) + 1e-9) for w in self.words]
        self.sets = [frozenset(w) for w in self.words]
        self.classes: dict[int, _Class] = {}
        exact = []
        for i, w in enumerate(self.words):
            if len(w) < p.walk_words:
                exact.append(i)
                continue
            low = 1 << (len(w).bit_length() - 1)
            if low not in self.classes:
                stride = max(1, low // 4)
                self.classes[low] = _Class(low, stride, max(4, int(1.6 * (low - stride + 1))))
            self.classes[low].items.append(i)
        self._bits: dict[tuple[int, int], np.ndarray] = {}
        for low, c in list(self.classes.items()):
            if not self._fit(c):
                exact += c.items
                del self.classes[low]
        self.pieces = self._pieces(exact)

    def _grams(self, x: np.ndarray, n: int) -> np.ndarray:
        """A hash of the ``n`` symbols from every place on."""
        acc = np.zeros(max(0, len(x) - n + 1), dtype=np.uint64)
        for k in range(n):
            acc = acc * _MUL + x[k:k + len(acc)].astype(np.uint64) + np.uint64(1)
        return acc

    def _pieces(self, items: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """length -> (sorted hashes, (item, offset) of each) of the items' pieces, one more than their edits."""
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for i in items:
            w, cuts = np.array(self.words[i], dtype=np.int32), self.budget[i] + 1
            for k in range(cuts):
                a, b = k * len(w) // cuts, (k + 1) * len(w) // cuts
                found[b - a].append((int(self._grams(w[a:b], b - a)[0]), i, a))
        out = {}
        for n, rows in found.items():
            keys = np.array([r[0] for r in rows], dtype=np.uint64)
            order = np.argsort(keys, kind="stable")
            out[n] = keys[order], np.array([r[1:] for r in rows], dtype=np.int64)[order]
        return out

    def _exact(self, x: np.ndarray):
        """(place, item, offset) of every piece that stands in ``x``."""
        for n, (keys, owner) in self.pieces.items():
            acc = self._grams(x, n)
            lo, hi = np.searchsorted(keys, acc, "left"), np.searchsorted(keys, acc, "right")
            for at in np.flatnonzero(hi > lo):
                for item, off in owner[lo[at]:hi[at]].tolist():
                    yield int(at), item, off

    def bits(self, table: int, word: int) -> np.ndarray:
        """64 random bits for every symbol: those of steps 64*word ... of the table's walk."""
        key = (table, word)
        if key not in self._bits:
            self._bits[key] = _mix(np.arange(self.stop + 1), self.p.seed * 1_000_003 + table * 131 + word)
        return self._bits[key]

    def _variants(self, c: _Class) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All items of the class in one padded array; start of each (item, offset)."""
        pad, flat, starts, owner = [self.stop] * (c.steps + 1), [], [], []
        for i in c.items:
            last = max(0, len(self.words[i]) - c.low)
            for o in sorted({*range(c.stride), *range(last, last + c.stride)}):
                starts.append(len(flat) + o)
                owner.append((i, o))
            flat += self.words[i] + pad
        return np.array(flat + pad, dtype=np.int32), np.array(starts, dtype=np.int64), np.array(owner, dtype=np.int32)

    def _walk(self, x: np.ndarray, starts: np.ndarray, table: int, positions, filters=None):
        """(which starts are left, their keys): the sampled words of the walk, hashed.
        With filters, starts whose samples no item shares are dropped as they show."""
        p, left = starts.astype(np.int32), None
        acc = np.uint64(0)
        j, word, bits = 0, -1, None
        for k, pos in enumerate(positions):
            while j < pos:
                if j >> 6 != word:
                    word = j >> 6
                    bits = self.bits(table, word)[x]
                p += ((bits[p] >> np.uint64(j & 63)) & np.uint64(1)).astype(np.int32)
                j += 1
            here = x[p]
            if k == 0:  # most starts end here: their word is in no item's sample
                left = np.arange(len(p)) if filters is None else np.flatnonzero(filters[0][here])
                p, here = p[left], here[left]
                acc = here.astype(np.uint64) + np.uint64(1)
                continue
            acc = acc * _MUL + here.astype(np.uint64) + np.uint64(1)
            if filters is not None:
                size, hit = filters[k]
                ok = np.flatnonzero(hit[((acc * _FIN) >> size).astype(np.int64)])
                p, left, acc = p[ok], left[ok], acc[ok]
                if not len(p):
                    break
        return left, acc

    def _table(self, c: _Class, t: int, flat, starts) -> tuple:
        rng = np.random.default_rng((self.p.seed, c.low, t))
        positions = np.sort(rng.choice(c.steps, size=min(c.samples, c.steps), replace=False)).tolist()
        filters, bits = [], max(10, (8 * len(starts)).bit_length())
        first = np.zeros(self.stop + 1, dtype=bool)
        _, acc = self._walk(flat, starts, t, positions[:1])
        first[(acc - np.uint64(1)).astype(np.int64)] = True
        filters.append(first)
        for k in range(2, len(positions) + 1):
            _, acc = self._walk(flat, starts, t, positions[:k])
            hit = np.zeros(1 << bits, dtype=bool)
            hit[((acc * _FIN) >> np.uint64(64 - bits)).astype(np.int64)] = True
            filters.append((np.uint64(64 - bits), hit))
        order = np.argsort(acc, kind="stable")
        return positions, acc[order], order, filters

    def _mutated(self, i: int, place: float | None, rng) -> list[int]:
        """Item ``i`` after its full budget of edits, spread or all in the half at ``place`` (0 head, 1 tail)."""
        w = list(self.words[i])
        run = len(w) if place is None else max(self.budget[i], len(w) // 2)
        low = int((place or 0) * (len(w) - run))
        for at in sorted((low + rng.choice(run, self.budget[i], replace=False)).tolist(), reverse=True):
            kind = rng.integers(3)
            if kind == 0:
                del w[at]
            else:
                w[at:at + (kind == 1)] = [int(rng.integers(0, self.stop))]
        return w

    def _fit(self, c: _Class) -> bool:
        """Add tables until mutated copies of the class's items are found at the target; whether they are."""
        p, rng = self.p, np.random.default_rng((self.p.seed, c.low))
        flat, starts, owner = self._variants(c)
        c.owner = owner
        copies, place = [], []
        for n in range(len(PLACES) * p.trials):
            i = c.items[rng.integers(len(c.items))]
            phase = int(rng.integers(c.stride))
            place.append(n % len(PLACES))
            copies.append((i, rng.integers(0, self.stop, phase).tolist() + self._mutated(i, PLACES[place[-1]], rng)))
        place = np.array(place)
        for c.samples in range(p.samples, 0, -1):
            c.tables, found = [], np.zeros(len(copies), dtype=bool)
            x, at = [], []
            for i, w in copies:
                room = -len(x) % c.stride
                x += [self.stop] * room
                at.append(len(x))
                x += w + [self.stop] * (c.steps + 1)
            x = np.array(x + [self.stop] * (c.steps + c.stride), dtype=np.int32)
            grid = np.arange(0, len(x) - c.steps - 1, c.stride)
            whose = np.searchsorted(np.array(at), grid, side="right") - 1
            for t in range(p.max_tables):
                c.tables.append(self._table(c, t, flat, starts))
                for s, item, _ in self._candidates(c, t, x, grid):
                    found[whose[s // c.stride]] |= copies[whose[s // c.stride]][0] == item
                c.recall = min(float(found[place == k].mean()) for k in range(len(PLACES)))
                if c.recall >= p.target_recall:
                    return True
        log.warning("items of %d to %d words: mutated copies are found at %.3f, the target is %.3f; they are searched exactly",
                    c.low, 2 * c.low - 1, c.recall, p.target_recall)
        return False

    def _candidates(self, c: _Class, t: int, x: np.ndarray, grid: np.ndarray):
        positions, keys, order, filters = c.tables[t]
        left, acc = self._walk(x, grid, t, positions, filters)
        lo, hi = np.searchsorted(keys, acc, "left"), np.searchsorted(keys, acc, "right")
        for n in np.flatnonzero(hi > lo):
            for k in order[lo[n]:hi[n]]:
                yield int(grid[left[n]]), int(c.owner[k, 0]), int(c.owner[k, 1])

    def search(self, texts: list[str | None], chunk_words: int = 1 << 16) -> list[list[tuple]]:
        """Per text its leaks ``(item_id, start_word, n_words, distance)``: the best
        alignment of each item found, by item order."""
        out: list[list[tuple]] = [[] for _ in texts]
        if not self.ids:
            return out
        get, pad = self.vocab.get, max((c.steps for c in self.classes.values()), default=0) + 1
        group, size = [], 0
        for n, text in enumerate(texts):
            w = words_of(text)
            group.append((n, np.fromiter(map(get, w, repeat(0)), dtype=np.int32, count=len(w))))
            size += len(w)
            if size >= chunk_words:
                self._search_group(group, pad, out)
                group, size = [], 0
        if group:
            self._search_group(group, pad, out)
        return out

    def _search_group(self, group, pad, out) -> None:
        stop = np.full(pad, self.stop, dtype=np.int32)
        x = np.concatenate([p for _, w in group for p in (w, stop)] + [stop])
        begin = np.cumsum([0] + [len(w) + pad for _, w in group])
        seen: dict[tuple[int, int], set[int]] = defaultdict(set)
        for c in self.classes.values():
            grid = np.arange(0, len(x) - pad - 1, c.stride)
            grid = grid[x[grid] != self.stop]
            for t in range(len(c.tables)):
                for s, item, off in self._candidates(c, t, x, grid):
                    d = int(np.searchsorted(begin, s, side="right")) - 1
                    seen[d, item].add(s - off - int(begin[d]))
        for s, item, off in self._exact(x):
            d = int(np.searchsorted(begin, s, side="right")) - 1
            seen[d, item].add(s - off - int(begin[d]))
        for (d, item), starts in sorted(seen.items()):
            n, w = group[d]
            k, size, best = self.budget[item], len(self.words[item]), None
            done = -1
            for a in sorted(starts):
                # windows whose true start lies within k of an earlier one are covered by its region
                lo, hi = max(0, a - 2 * k), min(len(w), a + size + 2 * k)
                if hi <= done:
                    continue
                done = hi
                region = w[lo:hi].tolist()
                if sum(map(self.sets[item].__contains__, region)) < size - k:
                    continue  # too few of the item's words for k edits
                dist, s, e = best_alignment(self.words[item], region)
                if dist <= k and (best is None or dist < best[3]):
                    best = (self.ids[item], lo + s, e - s, dist)
                    if dist == 0:
                        break
            if best:
                out[n].append(best)


def add_leaks(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams(), text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", name: str = "leaks") -> tuple[DataFrame, str]:
    """``docs`` with an array column of leaks, and that column's name."""
    name = fresh_name(docs, name)
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).alias("t")).filter("length(t) > 0")
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-chars // p.block_chars))
    at = docs.columns.index(text_col)
    out = docs.withColumn(name, F.lit(None).cast(HITS))
    sc = docs.sparkSession.sparkContext
    for b in range(blocks):
        # one block of the query set: bounded by block_chars, not by the table
        block = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b) if blocks > 1 else items
        index = LeakIndex(sorted(((r.i, r.t) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])), p)
        shipped = sc.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for rb in arrow_rows(batches):
                found = shipped.value.search(rb.column(at).to_pylist())
                before = rb.column(rb.num_columns - 1).to_pylist()
                hits = [(x or []) + [dict(zip(("item_id", "start_word", "n_words", "distance"), h)) for h in y] for x, y in zip(before, found)]
                yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(hits, _ARROW_HITS)], names=rb.schema.names)

        out = out.mapInArrow(run, out.schema)
    return out, name


def find_leaks(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per (document row, leaked item): doc_id, item_id, start_word, n_words, distance."""
    out, name = add_leaks(docs.select(id_col, text_col), benchmark, p, text_col)
    return out.select(F.col(id_col).alias("doc_id"), F.explode(name).alias("h")).select("doc_id", "h.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams(), text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without any leaked item; the columns of ``docs``."""
    out, name = add_leaks(docs, benchmark, p, text_col)
    return out.filter(F.size(name) == 0).drop(name)
