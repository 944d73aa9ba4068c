"""Phrase collocations by multikey three-way quicksort of suffix pointers.

A suffix pointer stands for the words from one word of a piece on, at most ``max_words``
of them.  Sorting pointers word by word with a three-way partition puts all that share their
first d words into one equal partition at depth d, whose size is the count of that phrase.

1. In tasks, texts are cut into pieces and words, and the pointers of a bounded chunk are
   sorted to full depth; equal partitions become one entry with a count (pre-aggregated).
2. Entries are routed by their leading word (a row holds the entries of one chunk and route).  There the
   weighted pointers of all chunks are sorted again; partitions lighter than ``min_count`` are
   abandoned, the sizes of the others are the counts.
3. A route with too many entries for one task (a frequent leading word) is split by the leading two words,
   and what is still too large by one more.  Counts of phrases shorter than a route's words
   are then partial sums, which are added up; all others are whole.
4. Cuts, scores and the filter by longer phrases are joins over the counted phrases.

Defined results: null text is empty; null lang is ``und``; texts, pieces and langs without words give
nothing; repeated rows count as often as they occur; a text of any length is read whole, in parts
cut between pieces; an empty table gives no rows; ties are broken by phrase in UTF-8 order; other
columns are not read.  All arithmetic is exact (38 digits; counts up to 10**13).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warnindex.llm.common import arrow_rows, run_bounds, written
from warnindex.session import broadcast_if_small

# Fixed by the contract: bytes between pieces, and those between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_END = b"."
_FOLD = bytes(ord(_END) if c in PIECE_ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
NO_LANG = "und"

ROUTED = "lang string, route long, n long, m long, vocab binary, entries binary, counts binary"
COUNTS = "lang string, phrase string, words int, f long"


@dataclass(frozen=True)
class CollocationParams:
    max_words: int = 3
    min_count: int = 10
    longer_percent: int = 50  # a longer phrase with this share of the occurrences displaces
    top: int = 2000
    chunk_words: int = 1_500_000  # pointers sorted at once where texts are read
    part_bytes: int = 1 << 20  # of text tokenised at once
    routes: int | None = None  # by leading word; None: four for each shuffle partition
    group_entries: int = 1 << 19  # of one route in one task, at most; fewer where there are more tasks than that fills
    least_group: int = 1 << 14

    def __post_init__(self):
        if self.max_words < 2 or self.min_count < 1:
            raise ValueError("phrases have two words or more, and occur")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# ---- the sort -------------------------------------------------------------------

LEAF = 4096


def _leaf(keys: list[np.ndarray], weights: np.ndarray, ptr: np.ndarray, d: int, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A small partition, finished by one sort of its remaining keys."""
    sub = [k[ptr] for k in keys[d:]]
    order = np.lexsort(sub[::-1])
    ptr, w = ptr[order], weights[ptr[order]]
    new = np.zeros(len(ptr), dtype=bool)
    new[0] = True
    for depth, k in enumerate(sub, d):
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
        start = np.flatnonzero(new)
        size = np.add.reduceat(w, start)
        ok = size >= least
        yield depth, ptr[start[ok]], size[ok]


def equal_partitions(keys: list[np.ndarray], weights: np.ndarray, least: int = 1, leaf: int = LEAF) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of the pointers 0..n-1, whose key at depth d is ``keys[d]``.

    Yields (depth, pointers, sizes): for equal partitions of total weight ``least`` or more one pointer into
    each and that weight, those of one depth in ascending order.  Lighter partitions are
    abandoned as a whole."""
    pick = np.random.default_rng(len(weights))
    stack = [(np.arange(len(weights), dtype=np.int32), 0, False)]
    while stack:
        ptr, d, equal = stack.pop()
        if not len(ptr):
            continue
        size = int(weights[ptr].sum())
        if size < least:
            continue
        if equal:
            yield d, ptr[:1], np.array([size])
            if d + 1 < len(keys):
                stack.append((ptr, d + 1, False))
        elif len(ptr) <= leaf:
            yield from _leaf(keys, weights, ptr, d, least)
        else:
            key = keys[d][ptr]
            pivot = np.sort(key[pick.integers(0, len(key), 3)])[1]
            less, more = key < pivot, key > pivot
            stack += [(ptr[more], d, False), (ptr[~(less | more)], d, True), (ptr[less], d, False)]


# ---- where texts are read -------------------------------------------------------

def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """A folded text in parts of about ``size`` bytes, cut between pieces."""
    i = 0
    while len(text) - i > size:
        cut = text.rfind(_END, i, i + size)
        if cut < 0:
            cut = text.find(_END, i + size)
            if cut < 0:
                break
        yield text[i:cut]
        i = cut + 1
    yield text[i:]


def folded_words(text: bytes) -> list[bytes]:
    """Words of a folded text (A-Z lower-cased), with ``.`` between pieces."""
    return text.replace(_END, b" . ").split()


def _word_hash(words: list[bytes]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.fromiter(map(h, words), np.uint64, len(words))


def _pack(a: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest one needs."""
    return a.astype(np.min_scalar_type(int(a.max()))).tobytes()


def _unpacked(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, f"<u{len(blob) // n}")


def _routed(lang: str, words: list[bytes], keys: np.ndarray, counts: np.ndarray, route: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries (rows of word numbers) and their counts -> a row for each route: the words that occur
    there, the entries as numbers of these, and the counts."""
    order = np.argsort(route, kind="stable")
    route = route[order]
    cut = run_bounds(route).tolist()
    out, held = [], 0
    for i, j in zip(cut[:-1], cut[1:]):
        if i == j:
            continue
        at = order[i:j]
        used, ids = np.unique(keys[at], return_inverse=True)
        c = counts[at]
        out.append((int(route[i]), int(c.sum()), j - i, b"\n".join(map(words.__getitem__, used.tolist())), _pack(ids), _pack(c)))
        held += 16 * (j - i)
        if held >= 8 << 20:
            yield _batch(lang, out)
            out, held = [], 0
    if out:
        yield _batch(lang, out)


def _batch(lang: str, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = [pa.int64()] * 3 + [pa.binary()] * 3
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                                      names=["lang", "route", "n", "m", "vocab", "entries", "counts"])


def _collect(p: CollocationParams, routes: int):
    def rows(vocab: dict, by_lang: dict) -> Iterator[pa.RecordBatch]:
        words = [b"", *list(vocab)[1:]]
        to = (_word_hash(words) % np.uint64(routes)).astype(np.int64)
        for lang in list(by_lang):
            a = np.concatenate([*by_lang.pop(lang), np.zeros(p.max_words, np.int32)])
            at = np.flatnonzero(a[: len(a) - p.max_words]).astype(np.int32)
            keys = [a[at]]
            for d in range(1, p.max_words):
                keys.append(np.where(keys[-1] == 0, np.int32(0), a[at + d]))
            del a, at
            last = [(q, s) for d, q, s in equal_partitions(keys, np.ones(len(keys[0]), np.int32)) if d == p.max_words - 1]
            if last:
                q, counts = np.concatenate([x[0] for x in last]), np.concatenate([x[1] for x in last])
                del last
                entries = np.stack([k[q] for k in keys], axis=1)
                del keys, q
                yield from _routed(lang, words, entries, counts, to[entries[:, 0]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, by_lang, held = None, None, 0
        for b in arrow_rows(batches, p.part_bytes):
            texts = defaultdict(list)
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                texts[lang].append(text)
            for lang, some in texts.items():
                for part in _parts(_END.join(some).translate(_FOLD), p.part_bytes):
                    if vocab is None:
                        vocab, by_lang, held = defaultdict(count().__next__), defaultdict(list), 0
                        vocab[_END]  # number 0 is the end of a piece
                    found = folded_words(part)
                    found.append(_END)
                    by_lang[lang].append(np.fromiter(map(vocab.__getitem__, found), np.int32, len(found)))
                    held += len(found)
                    if held >= p.chunk_words:
                        yield from rows(vocab, by_lang)
                        vocab = None
        if vocab is not None:
            yield from rows(vocab, by_lang)

    return run


def routed_entries(docs: DataFrame, p: CollocationParams, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (lang, route by the leading word, occurrences n, different entries m, entries, counts) of bounded chunks."""
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return slim.mapInArrow(_collect(p, p.routes or 4 * shuffle_partitions(docs)), ROUTED)


# ---- where rows are routed to ---------------------------------------------------

def _unpack(rows: list[tuple], k: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, entries as numbers of these (0 is no word) and counts of rows (m, vocab, entries, counts)."""
    vocab: dict = defaultdict(count().__next__)
    vocab[b""]
    entries, counts = [], []
    for m, names, e, c in rows:
        names = names.split(b"\n")
        entries.append(np.fromiter(map(vocab.__getitem__, names), np.int32, len(names))[_unpacked(e, m * k)])
        counts.append(_unpacked(c, m).astype(np.int64))
    return list(vocab), np.concatenate(entries).reshape(-1, k), np.concatenate(counts)


def _count_routes(p: CollocationParams, prefix: int):
    """Rows in order of their route (by ``prefix`` leading words) -> phrases and their counts; those
    of phrases shorter than ``prefix`` words are partial."""

    def counted(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        langs = {}
        for r in held:
            langs.setdefault(r[0], []).append(r[1:])
        for lang, rows in langs.items():
            words, entries, weights = _unpack(rows, p.max_words)
            keys = list(np.ascontiguousarray(entries.T))
            found = [x for x in equal_partitions(keys, weights, p.min_count) if x[0] >= prefix - 1]
            if prefix > 1:
                found += equal_partitions(keys[: prefix - 1], weights)
            for d in range(p.max_words):
                some = [(q, f) for x, q, f in found if x == d]
                if not some:
                    continue
                q, f = np.concatenate([x[0] for x in some]), np.concatenate([x[1] for x in some])
                whole = keys[d][q] != 0
                q, f = q[whole], f[whole]
                phrase = [b" ".join(map(words.__getitem__, e)) for e in entries[q, : d + 1].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(q), pa.string()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(np.full(len(q), d + 1, np.int32)), pa.array(f)],
                    names=["lang", "phrase", "words", "f"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries, last = [], 0, None
        for b in arrow_rows(batches):
            for key, lang, m, *blobs in zip(*[c.to_pylist() for c in b.columns]):
                if held and key != last and entries + m > p.group_entries:
                    yield from counted(held)
                    held, entries = [], 0
                held.append((lang, m, *blobs))
                entries += m
                last = key
        if held:
            yield from counted(held)

    return run


def _split_routes(p: CollocationParams, prefix: int):
    """Rows with their number of parts -> rows routed by ``prefix`` leading words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            for lang, route, parts, *row in zip(*[c.to_pylist() for c in b.columns]):
                words, entries, weights = _unpack([tuple(row)], p.max_words)
                hashes = _word_hash(words)
                h = np.zeros(len(entries), np.uint64)
                for d in range(prefix):
                    h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[entries[:, d]]
                h ^= h >> np.uint64(32)
                to = (h % np.uint64(parts)).astype(np.int64)
                yield from _routed(lang, words, entries, weights, route * parts + to)

    return run


def phrase_counts(docs: DataFrame, p: CollocationParams | None = None, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(phrases, sizes): every phrase of 1 to ``max_words`` words with f >= min_count
    (lang, phrase, words, f), and n, the number of words, per lang."""
    p = p or CollocationParams()
    rows = written(routed_entries(docs, p, text_col, lang_col), "suffix-entries", "zstd")
    sizes = rows.groupBy("lang").agg(F.sum("n").alias("n"))
    most = min(p.group_entries, max(p.least_group, (rows.agg(F.sum("m")).first()[0] or 0) // (2 * shuffle_partitions(docs))))
    found = []
    for prefix in range(1, p.max_words + 1):
        key = F.xxhash64("lang", "route").alias("key")
        large = rows.groupBy("lang", "route").agg(F.sum("m").alias("m")).filter(F.col("m") > most)
        large = written(large.select("lang", "route", F.ceil(F.col("m") / most).cast("long").alias("parts")), "suffix-large")
        split = prefix < p.max_words and not large.isEmpty()
        large = broadcast_if_small(large)
        small = rows.join(large, ["lang", "route"], "left_anti") if split else rows
        small = small.select(key, "lang", "m", "vocab", "entries", "counts").repartition(4 * shuffle_partitions(docs), "key").sortWithinPartitions("key")
        found.append(small.mapInArrow(_count_routes(p, prefix), COUNTS))
        if not split:
            break
        rows = rows.join(large, ["lang", "route"]).select("lang", "route", "parts", "m", "vocab", "entries", "counts")
        rows = written(rows.mapInArrow(_split_routes(p, prefix + 1), ROUTED), "suffix-split", "zstd")
    f = reduce(DataFrame.unionByName, found).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return written(f.filter(F.col("f") >= p.min_count), "phrases"), sizes


# ---- scores ---------------------------------------------------------------------

def collocations(docs: DataFrame, p: CollocationParams | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each lang's best phrases of 2 to ``max_words`` words: lang, rank, phrase, a, l, r, n, score."""
    p = p or CollocationParams()
    f, sizes = phrase_counts(docs, p, text_col, lang_col)
    part = lambda n, key, name: f.filter(F.col("words") == n).select("lang", F.col("phrase").alias(key), F.col("f").alias(name))
    cut = lambda start, n: F.concat_ws(" ", F.slice("w", start, n))
    scored, longer = [], None
    for m in range(2, p.max_words + 1):
        c = f.filter(F.col("words") == m).select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
        best = None
        for k in range(1, m):
            c = c.withColumns({"_left": cut(1, k), "_right": cut(k + 1, m - k)})
            c = c.join(part(k, "_left", "l"), ["lang", "_left"]).join(part(m - k, "_right", "r"), ["lang", "_right"])
            score = F.expr("CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(14,0)) * CAST(a AS DECIMAL(14,0)) div (CAST(l AS DECIMAL(14,0)) * CAST(r AS DECIMAL(14,0)))")
            one = F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), "l", "r")
            best = one if best is None else F.least(F.col("_best"), one)
            c = c.withColumn("_best", best).drop("l", "r", "_left", "_right")
        scored.append(c.select("lang", "phrase", "a", F.lit(m).alias("words"), "_best.score", "_best.l", "_best.r"))
        if m > 2:  # a phrase in a longer one is in one that is a word longer, which occurs at least as often
            inner = c.select("lang", F.explode(F.array(cut(1, m - 1), cut(2, m - 1))).alias("phrase"), F.col("a").alias("outer"))
            longer = inner if longer is None else longer.unionByName(inner)
    s = reduce(DataFrame.unionByName, scored)
    if longer is not None:
        s = s.join(longer.groupBy("lang", "phrase").agg(F.max("outer").alias("outer")), ["lang", "phrase"], "left")
        s = s.filter("outer is null or CAST(100 AS DECIMAL(3,0)) * outer < CAST(%d AS DECIMAL(3,0)) * a" % p.longer_percent)
    w = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    s = s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= p.top)
    return s.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n").cast("long").alias("n"), "score")
