"""SimHash near-duplicates with pigeonring candidate filtering.

Fingerprint: 64 bits over the XXH64 (seed 42) of word shingles, repeats
included; a bit is set when more than half of the shingle hashes set it.

Search: the fingerprint is a ring of ``segments`` equal boxes.  If two
fingerprints differ in at most T bits, some start box exists from which every
chain of l consecutive boxes differs in at most floor(l * T / segments) bits
(the pigeonring principle).  With 8 boxes and T = 4 the budgets are
0 1 1 2 2 3 3 4: the start box is equal, and at least ``zeros`` boxes of a
short chain are equal in one of a few patterns.  Every fingerprint is keyed by
those boxes for every start; equal keys meet in one sorted run, where the
growing chains prune pairs before the full Hamming count.  No link is missed.

Groups: identical fingerprints are one node.  A run emits only a spanning
forest of its links (each reached node once), never all pairs.  Runs longer
than ``max_run`` are marked, cut into blocks of about ``max_run`` fingerprints and
compared block pair by block pair in separate tasks.  Components come from the
forest edges (components.py).

Defined results: null text counts as empty; texts without words have
fingerprint zero and link like any other; a null doc_id joins its group but
never names it (component_id is null only where every doc_id of the group is null);
repeated rows stay; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warnindex.llm.common import arrow_rows, fresh_name, run_bounds, written
from warnindex.llm.components import connected_components
from warnindex.session import fits

BITS = 64
SEED = 42


def simhash(text: str | None, shingle: int = 4) -> int:
    """Fingerprint of one text (unsigned).  Words are split on ASCII white space
    after lower-casing A-Z; shorter texts are one shingle of all their words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    a = starts[:n].tolist()
    b = ends[min(shingle, len(words)) - 1:].tolist()
    f = xxhash.xxh64_intdigest
    count = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        h = np.fromiter((f(joined[s:e], SEED) for s, e in zip(a[i:i + (1 << 16)], b[i:i + (1 << 16)])), dtype=np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << k for k in range(BITS) if 2 * int(count[k]) > n))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` per row; fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            fps = np.array([simhash(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, fp long")


def chain_budgets(segments: int, max_bits: int) -> list[int]:
    """Bits by which a viable chain of 1, 2, ... boxes may differ."""
    return [(k * max_bits) // segments for k in range(1, segments + 1)]


def zero_patterns(segments: int, max_bits: int, zeros: int) -> list[tuple[int, ...]]:
    """Offsets of ``zeros`` equal boxes, one of which every viable chain has.

    Enumerates which boxes of the shortest sufficient chain may differ under
    the budgets and keeps the first ``zeros`` equal ones of each.
    """
    budget = chain_budgets(segments, max_bits)
    if budget[0] != 0:
        raise ValueError("needs more segments than differing bits")
    length = next((n for n in range(zeros, segments + 1) if n - budget[n - 1] >= zeros), None)
    if length is None:
        raise ValueError("too many equal boxes asked for")
    found = set()
    for k in range(budget[length - 1] + 1):
        for off in combinations(range(length), k):
            if all(sum(o < n for o in off) <= budget[n - 1] for n in range(1, length + 1)):
                found.add(tuple(x for x in range(length) if x not in off)[:zeros])
    return sorted(found)


def _keys(fp, segments: int, max_bits: int, zeros: int) -> list:
    """One long per start box and pattern: its number and the equal boxes' bits."""
    w = BITS // segments
    box = lambda i: F.shiftrightunsigned(fp, (i % segments) * w).bitwiseAND(F.lit((1 << w) - 1))
    out = []
    pats = zero_patterns(segments, max_bits, zeros)
    for start in range(segments):
        for p, pat in enumerate(pats):
            key = F.lit(start * len(pats) + p).cast("long")
            for o in pat:
                key = F.shiftleft(key, w).bitwiseOR(box(start + o))
            out.append(key)
    return out


def _linked(x: np.ndarray, start: int, segments: int, max_bits: int) -> np.ndarray:
    """Which XORs pass: growing chains from ``start`` first, then the full count."""
    w = BITS // segments
    left, right = np.uint64(start * w), np.uint64((BITS - start * w) % BITS)
    ring = (x >> left) | (x << right) if start else x
    alive = np.arange(len(x))
    for n, most in enumerate(chain_budgets(segments, max_bits)[:-1], 1):
        mask = np.uint64((1 << (n * w)) - 1)
        ok = np.bitwise_count(ring[alive] & mask) <= most
        alive = alive[ok]
        if not len(alive):
            break
    alive = alive[np.bitwise_count(x[alive]) <= max_bits]
    return alive


def _forest(fp: np.ndarray, start: int, segments: int, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest (node, parent) of one run: every node is compared with
    those not yet reached, so a dense group costs about one pass."""
    fp = np.unique(fp)
    left = fp.copy()
    out = []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            p = front.pop()
            hit = _linked(left ^ p, start, segments, max_bits)
            if len(hit):
                front.extend(left[hit])
                out.extend((n, p) for n in left[hit])
                left = np.delete(left, hit)
    return out


def _run_links(segments: int, max_bits: int, patterns: int, max_run: int, width: int, mark: bool):
    """mapInArrow over rows (run, key, fp) sorted by run: forest edges of each run;
    runs longer than ``max_run`` give one marker row instead when ``mark``."""

    def solve(run, key, fp, out):
        at = run_bounds(run)
        size = np.diff(at)
        two = at[:-1][size == 2]
        if len(two):  # most runs: a single pair each, all at once by start box
            x = fp[two] ^ fp[two + 1]
            starts = (key[two] >> width) // patterns
            for s in np.unique(starts):
                sel = np.flatnonzero(starts == s)
                hit = two[sel[_linked(x[sel], int(s), segments, max_bits)]]
                out.extend(zip(fp[hit + 1], fp[hit]))
        for i in np.flatnonzero(size > 2):
            a, b = at[i], at[i + 1]
            out.extend(_forest(fp[a:b], int((key[a] >> width) // patterns), segments, max_bits))

    def go(batches):
        rest = None  # the last, maybe unfinished run, in pieces
        over = None  # a run already marked as too long
        empty = lambda: (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        rest = empty()

        def emit(edges, marks):
            if edges or marks:
                a = np.array([e[0] for e in edges], dtype=np.uint64).view(np.int64)
                b = np.array([e[1] for e in edges], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((a, np.zeros(len(marks), np.int64)))),
                     pa.array(np.concatenate((b, np.zeros(len(marks), np.int64)))),
                     pa.array([None] * len(edges) + marks, pa.int64())], names=["a", "b", "hot"])

        for batch in batches:
            new = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            run, key, fp = (np.concatenate(p) for p in zip(rest, (new[0], new[1], new[2].view(np.uint64))))
            edges, marks = [], []
            if over is not None:
                keep = run != over
                if keep.any():
                    over = None
                run, key, fp = run[keep], key[keep], fp[keep]
            at = run_bounds(run)
            last = at[-2] if len(at) > 1 else 0
            if mark:
                size = np.diff(at)
                for i in np.flatnonzero(size > max_run):
                    marks.append(int(key[at[i]]))
                if marks:
                    if size[-1] > max_run:
                        over = run[-1]
                    keep = np.repeat(size <= max_run, size)
                    run, key, fp = run[keep], key[keep], fp[keep]
                    last = run_bounds(run)[-2] if len(run) and over is None else len(run)
            solve(run[:last], key[:last], fp[:last], edges)
            rest = (run[last:], key[last:], fp[last:])
            yield from emit(edges, marks)
        edges = []
        solve(*rest, edges)
        yield from emit(edges, [])

    return go


def links(nodes: DataFrame, max_bits: int = 4, segments: int = 8, zeros: int = 3, max_run: int = 20_000) -> DataFrame:
    """Forest edges ``(a, b)`` that connect what the links within ``max_bits`` connect.

    ``nodes``: distinct ``fp`` (long).  Exact for any ``segments`` > max_bits.
    """
    spark = nodes.sparkSession
    width = zeros * (BITS // segments)
    n_pat = len(zero_patterns(segments, max_bits, zeros))
    if width + (segments * n_pat).bit_length() > 63:
        raise ValueError("key too wide")
    keyed = nodes.select(F.explode(F.array(*_keys(F.col("fp"), segments, max_bits, zeros))).alias("key"), "fp")
    first = keyed.select(F.col("key").alias("run"), "key", "fp").repartition("run").sortWithinPartitions("run", "fp")
    found = written(
        first.mapInArrow(_run_links(segments, max_bits, n_pat, max_run, width, True), "a long, b long, hot long"),
        "simhash-links")
    edges = found.filter("hot is null").select("a", "b")
    hot = found.filter("hot is not null").select(F.col("hot").alias("key"))
    if hot.isEmpty():
        return edges
    count = keyed.join(F.broadcast(hot) if fits(hot, 10_000) else hot, "key")
    sizes = count.groupBy("key").agg(F.ceil(F.count("*") / max_run).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = (
        count.join(sizes, "key").select("key", "fp", block.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("run"), "key", "fp")
        .repartition("run").sortWithinPartitions("run", "key", "fp")
    )
    more = pairs.mapInArrow(_run_links(segments, max_bits, n_pat, max_run, width, False), "a long, b long, hot long")
    return edges.unionByName(written(more.select("a", "b"), "simhash-hot-links"))


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int = 8, zeros: int = 3,
                       max_run: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``."""
    fps = written(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    nodes = written(nodes, "simhash-nodes")
    comp = connected_components(links(nodes.select("fp"), max_bits, segments, zeros, max_run))
    named = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(least, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


IDS_TO_BROADCAST = 500_000  # about 30 MB


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group: the smallest doc_id; of rows that repeat that id, the one
    with the smallest hash of its text.  Groups whose doc_ids are all null keep one row as well.
    Returns the columns of ``docs``.

    The texts are not shuffled where the ids to drop fit a broadcast; rows of repeated
    ids, and those without an id, are dealt with apart.
    """
    comp = written(simhash_components(docs, shingle, max_bits, id_col=id_col, text_col=text_col), "simhash-components")
    cols = docs.columns
    ids = comp.filter("doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.bool_or(F.col("doc_id") == F.col("component_id")).alias("head"))
    special = written(ids.filter("not head or n > 1"), "simhash-special")
    repeated = special.filter("head").select("doc_id")
    aside = special.select("doc_id")
    if fits(aside, IDS_TO_BROADCAST):
        aside, repeated = F.broadcast(aside), F.broadcast(repeated)
    mine = docs[id_col].cast("long")
    parts = [docs.filter(docs[id_col].isNotNull()).join(aside, mine == aside["doc_id"], "left_anti").select(cols)]
    if not special.filter("head").isEmpty():
        same = docs.join(repeated, mine == repeated["doc_id"], "left_semi").select(cols)
        rank = F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(text_col)))
        name = fresh_name(docs, "_rank")
        parts.append(same.withColumn(name, rank).filter(F.col(name) == 1).select(cols))
    null_heads = comp.filter("component_id is null").select("fp").distinct()
    if not null_heads.isEmpty():
        parts.append(_one_of_nameless(docs.filter(docs[id_col].isNull()), null_heads, shingle, max_bits, text_col).select(cols))
    return reduce(DataFrame.unionByName, parts)


def _one_of_nameless(nulls: DataFrame, null_heads: DataFrame, shingle: int, max_bits: int, text_col: str) -> DataFrame:
    """One row of each group that has no doc_id: hashes of the texts stand for ids."""
    rest = fingerprints(nulls.select(F.xxhash64(text_col).alias("h"), text_col), shingle, "h", text_col)
    nodes = written(rest.join(null_heads, "fp", "left_semi").groupBy("fp").agg(F.min("doc_id").alias("h")), "simhash-nameless")
    cc = connected_components(links(nodes.select("fp"), max_bits))
    root = nodes.join(cc, nodes["fp"] == cc["node"], "left").select("h", F.coalesce("component", "fp").alias("root"))
    pick = root.groupBy("root").agg(F.min("h").alias("_pick")).select("_pick")
    hashed = fresh_name(nulls, "_h")
    extra = nulls.withColumn(hashed, F.xxhash64(text_col))
    return extra.join(pick, F.col(hashed) == F.col("_pick"), "left_semi").dropDuplicates([hashed]).drop(hashed)
