"""Hard-negative mining: cover trees over norm-augmented candidates.

For every anchor and each of its nearest rows of the same label (positives) the best rows of other
labels are wanted whose inner product with the anchor lies in a window below the positive's.

Augmentation: with M the largest norm, a candidate x gets the component sqrt(M^2 - |x|^2)
and an anchor q the component 0.  All candidates then lie on a sphere of radius M,
inner products with q are unchanged, and <q, x> = |q| M cos(angle).

Index: candidates are dealt to cells around pivots (farthest-first on a bounded sample; it shapes the
trees only, every row is indexed), cells to shards of bounded size.  A task builds each shard's cover
tree: the children of a vertex are farthest-first centres more than half its covering
radius apart, every point goes to the nearest one, and each vertex keeps the covering radius
(an angle) of what lies below it.  The tree is written, a row per vertex.

Search: a bounded block of anchors at a time meets all shards.  A vertex whose children are scored
exactly is expanded best bound first; by the triangle inequality on the sphere, <q, x> of anything
below a child at angle t with covering radius r lies between |q| M cos(t + r) and |q| M cos(t - r).  Children
outside all that a window still admits (its limits, or the k-th best found) are skipped.

Crowds: rows of equal label and vector are one candidate with its smallest ids, as many as could
ever be asked for, so copies cost nothing.  Labels with many rows have shards of their own; all
others share shards, and every row's label is compared.

Defined results: rows with a null id, label, vector or component take no part, neither do those
whose norm is 2**31 or more (their scores would not fit a long); repeated rows
(equal id, label and vector) count once; rows of equal id that differ are different rows;
vectors of different length never meet; ties go to the smaller id; an anchor without
positives, or a window without rows, gives no rows; an empty table gives none; other
columns are not read.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warnindex.llm.common import arrow_rows, written
from warnindex.session import broadcast_if_small


@dataclass(frozen=True)
class NegativeParams:
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50  # of the positive's score
    high_percent: int = 95
    shard_rows: int = 4096
    sample: int = 4096  # rows that pivots are chosen from
    leaf: int = 16
    block: int = 4096  # anchors searched for at once

    @property
    def keep(self) -> int:
        """Ids of equal rows that can be asked for, and the anchor's own."""
        return max(self.positives, self.negatives) + 1


SLACK = 1e-6  # rounding of angles
LARGEST = 1 << 31


# ---- cover tree -----------------------------------------------------------------

def _augmented(x: np.ndarray, most: float) -> np.ndarray:
    """Unit vectors of the augmented candidates."""
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(most * most - (x * x).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1) / (most or 1.0)


def _angles(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(u @ v, -1.0, 1.0))


@dataclass
class Tree:
    """Vertices in breadth-first order; the children of i are [first[i], last[i]).  Vertex 0 is the root.
    ``again`` marks a child that is its parent's own point."""

    point: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray
    again: np.ndarray


def build_tree(x: np.ndarray, most: float, leaf: int = 16) -> Tree:
    u = _augmented(x, most)
    root_angle = _angles(u, u[0])
    point, radius, first, last, again = [0], [float(root_angle.max())], [0], [0], [False]
    queue = [(0, np.arange(1, len(x)), root_angle[1:])]  # vertex, points below it, their angles to it
    for v, below, angle in queue:
        first[v] = len(point)
        if len(below) <= leaf or angle.max() <= SLACK:
            groups = [(int(b), below[:0], angle[:0], False) for b in below]
        else:
            half = radius[v] / 2
            centres, nearest, owner = [point[v]], angle.copy(), np.zeros(len(below), np.int64)
            while True:
                far = int(nearest.argmax())
                if nearest[far] <= half:
                    break
                centres.append(int(below[far]))
                a = _angles(u[below], u[centres[-1]])
                a[far] = -1.0  # the centre is its own
                closer = a < nearest
                nearest[closer], owner[closer] = a[closer], len(centres) - 1
            groups = []
            for c, centre in enumerate(centres):
                own = owner == c
                if c:
                    own &= below != centre
                if c or own.any():
                    groups.append((centre, below[own], nearest[own], c == 0))
        for centre, pts, a, same in groups:
            point.append(centre)
            again.append(same)
            radius.append(float(a.max()) if len(pts) else 0.0)
            first.append(0)
            last.append(0)
            if len(pts):
                queue.append((len(point) - 1, pts, a))
        last[v] = len(point)
    return Tree(np.array(point), np.array(radius), np.array(first), np.array(last), np.array(again))


# ---- index ----------------------------------------------------------------------

def _vectors(col: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, "<i8") for v in col.to_pylist()]


def candidates(rows: DataFrame, p: NegativeParams) -> tuple[DataFrame, DataFrame]:
    """(rows that take part, each once; candidates: label, x, their smallest ids) of rows (vec_id, label, x, anchor).

    ``x`` becomes binary (64-bit integers); ``norm2`` is the squared norm."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [np.asarray(v.values, dtype=np.int64) for v in b.column(2)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array([v.tobytes() for v in x], pa.binary()), pa.array([len(v) for v in x], pa.int32()),
                                              pa.array([int((v * v).sum()) for v in x], pa.int64()), b.column(3)], names=["vec_id", "label", "x", "dim", "norm2", "anchor"])

    fits = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < LARGEST)) & (F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v) < float(LARGEST) ** 2)
    ok = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fits, F.lit(False)))
    ok = ok.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "x", F.coalesce("anchor", F.lit(False)).alias("anchor"))
    packed = ok.mapInArrow(pack, "vec_id long, label long, x binary, dim int, norm2 long, anchor boolean")
    packed = written(packed.groupBy("vec_id", "label", "x", "dim", "norm2").agg(F.bool_or("anchor").alias("anchor")), "hn-rows")
    smallest = F.row_number().over(Window.partitionBy("label", "x").orderBy("vec_id"))
    few = packed.select("vec_id", "label", "x", "dim", "norm2", smallest.alias("_n")).filter(F.col("_n") <= p.keep)
    return packed, written(few.groupBy("label", "x", "dim", "norm2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "hn-candidates")


def _pivots(nodes: DataFrame, n: int, most: float, p: NegativeParams) -> dict[int, np.ndarray]:
    """Up to ``n`` pivots for each length among a bounded sample of candidates, farthest first."""
    sample = nodes.select("x", "dim").orderBy(F.xxhash64("x", "label"), "x").limit(p.sample).collect()
    out = {}
    for dim in {r["dim"] for r in sample}:
        u = _augmented(np.stack([np.frombuffer(r["x"], "<i8") for r in sample if r["dim"] == dim]), most)
        chosen, nearest = [0], _angles(u, u[0])
        while len(chosen) < min(n, len(u)) and nearest.max() > SLACK:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _angles(u, u[chosen[-1]]))
        out[dim] = u[chosen]
    return out


def build_index(nodes: DataFrame, most: float, p: NegativeParams) -> tuple[DataFrame, int]:
    """(vertices of all shards' trees in order, how many shards there should be): shard, seq, label, ids, x, radius, first, last, again."""
    n = nodes.count()
    large = nodes.groupBy("dim", "label").agg(F.count("*").alias("n")).filter(F.col("n") > p.shard_rows // 4).select("dim", "label", F.lit(True).alias("own"))
    pivots = _pivots(nodes, -(-n // p.shard_rows), most, p)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = np.zeros(b.num_rows, np.int32)
            dims = b.column(b.schema.get_field_index("dim")).to_numpy()
            x = _vectors(b.column(b.schema.get_field_index("x")))
            for dim, u in pivots.items():
                at = np.flatnonzero(dims == dim)
                if len(at):
                    cell[at] = (_augmented(np.stack([x[i] for i in at]), most) @ u.T).argmax(axis=1)
            yield b.append_column("cell", pa.array(cell))

    grouped = nodes.join(broadcast_if_small(large), ["dim", "label"], "left").select(
        "label", "x", "dim", "ids", F.when(F.col("own"), F.xxhash64("dim", "label")).otherwise(F.xxhash64("dim")).alias("grp"))
    placed = written(grouped.mapInArrow(cells, "label long, x binary, dim int, ids array<long>, grp long, cell int"), "hn-cells")
    sizes = placed.groupBy("grp", "cell").agg(F.ceil(F.count("*") / p.shard_rows).cast("long").alias("parts"))
    dealt = placed.join(broadcast_if_small(sizes), ["grp", "cell"]).select(
        F.xxhash64("grp", "cell", F.pmod(F.xxhash64("x", "label"), "parts")).alias("shard"), "dim", "label", "ids", "x")

    schema = pa.schema([("shard", pa.int64()), ("seq", pa.int32()), ("dim", pa.int32()), ("label", pa.int64()), ("ids", pa.list_(pa.int64())), ("x", pa.binary()),
                        ("radius", pa.float64()), ("first", pa.int32()), ("last", pa.int32()), ("again", pa.bool_())])

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, dim), rows in _by_shard(batches):
            t = build_tree(np.stack([np.frombuffer(r["x"], "<i8") for r in rows]), most, p.leaf)
            at = [rows[i] for i in t.point.tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([shard] * len(at)), pa.array(range(len(at)), pa.int32()), pa.array([dim] * len(at), pa.int32()), pa.array([r["label"] for r in at], pa.int64()),
                pa.array([r["ids"] for r in at], pa.list_(pa.int64())), pa.array([r["x"] for r in at], pa.binary()), pa.array(t.radius),
                pa.array(t.first.astype(np.int32)), pa.array(t.last.astype(np.int32)), pa.array(t.again)], schema=schema)

    built = dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        trees, "shard long, seq int, dim int, label long, ids array<long>, x binary, radius double, first int, last int, again boolean")
    return written(built, "hn-trees")


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[dict]]]:
    """Rows of each (shard, dim), which follow each other; a shard is of bounded size."""
    key, rows = None, []
    for b in arrow_rows(batches):
        for r in b.to_pylist():
            k = (r["shard"], r["dim"])
            if k != key:
                if rows:
                    yield key, rows
                key, rows = k, []
            rows.append(r)
    if rows:
        yield key, rows


# ---- search ---------------------------------------------------------------------

@dataclass
class Wanted:
    """The best ``k`` with scores from ``low`` to ``high``: (-score, id), best first."""

    k: int
    low: int
    high: int
    best: list

    def floor(self) -> int:
        return self.low if len(self.best) < self.k else max(self.low, -self.best[-1][0])

    def offer(self, score: int, ids: list[int]) -> None:
        for i in ids[: self.k]:
            if len(self.best) >= self.k and (-score, i) > self.best[-1]:
                return
            insort(self.best, (-score, i))
            del self.best[self.k:]


@dataclass
class Anchor:
    qid: int
    vec_id: int
    label: int
    x: np.ndarray
    wanted: list[Wanted]


@dataclass
class Shard:
    x: np.ndarray
    labels: np.ndarray
    ids: list[list[int]]
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray
    again: np.ndarray

    @classmethod
    def of(cls, rows: list[dict], exact_floats: bool) -> Shard:
        rows.sort(key=lambda r: r["seq"])
        x = np.stack([np.frombuffer(r["x"], "<i8") for r in rows])
        col = lambda name: np.array([r[name] for r in rows])
        return cls(x.astype(np.float64) if exact_floats else x, col("label"), [r["ids"] for r in rows], col("radius") + SLACK, col("first"), col("last"), col("again"))


@dataclass
class Expanded:
    """A vertex's children as an anchor sees them: those that may be results by falling score, and
    bounds for what lies below the others."""

    minus_scores: np.ndarray
    at: np.ndarray
    deep: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


def expand(shard: Shard, a: Anchor, same: bool, reach: float, v: int, s: np.ndarray | None = None) -> Expanded:
    c0, c1 = (0, 1) if v < 0 else (int(shard.first[v]), int(shard.last[v]))
    if s is None:
        s = (shard.x[c0:c1] @ a.x).astype(np.int64)  # integers, also where they are held as doubles
    low, high = min(w.low for w in a.wanted), max(w.high for w in a.wanted)
    at = np.flatnonzero(((shard.labels[c0:c1] == a.label) == same) & ~shard.again[c0:c1] & (s >= low) & (s <= high))
    at = at[np.argsort(-s[at], kind="stable")]
    deep = np.flatnonzero(shard.last[c0:c1] > shard.first[c0:c1])
    if reach:
        t, r = np.arccos(np.clip(s[deep] / reach, -1.0, 1.0)), shard.radius[c0:c1][deep]
        spare = 1.0 + SLACK * reach
        upper, lower = reach * np.cos(np.maximum(t - r, 0.0)) + spare, reach * np.cos(np.minimum(t + r, math.pi)) - spare
    else:
        upper = lower = np.zeros(len(deep))
    return Expanded(-s[at], at + c0, deep + c0, upper, lower)


def search(shard: Shard, a: Anchor, same: bool, most: float, seen: dict[int, Expanded]) -> None:
    """Best-first descent for all that is wanted of one anchor.  ``seen`` keeps expanded vertices,
    which several windows share."""
    reach = math.sqrt(float((a.x.astype(np.float64) ** 2).sum())) * most
    for w in a.wanted:
        if w.low > w.high:
            continue
        heap = [(-math.inf, -1)]  # upper bound (negated), vertex (-1: above the root)
        while heap:
            upper, v = heapq.heappop(heap)
            if -upper < w.floor():
                break  # and so is all the rest
            e = seen.get(v)
            if e is None:
                e = seen[v] = expand(shard, a, same, reach, v)
            for i in range(int(np.searchsorted(e.minus_scores, -w.high)), len(e.at)):
                score = -int(e.minus_scores[i])
                if score < w.floor():
                    break
                ids = shard.ids[e.at[i]]
                if same and a.vec_id in ids and np.array_equal(shard.x[e.at[i]], a.x):
                    ids = [k for k in ids if k != a.vec_id]
                w.offer(score, ids)
            if len(e.deep):
                for i in np.flatnonzero((e.upper >= w.floor()) & (e.lower <= w.high)).tolist():
                    heapq.heappush(heap, (-float(e.upper[i]), int(e.deep[i])))


def _search_block(anchors: list[tuple], same: bool, most: float, k: int):
    """Shards' vertices, in order -> (qid, slot, score, vec_id) found by this task for a block of anchors
    (qid, vec_id, label, dim, x, windows)."""
    exact_floats = most * most < 2.0**53

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo: dict[int, list[Anchor]] = {}
        for qid, vec_id, label, dim, x, windows in anchors:
            x = np.frombuffer(x, "<i8")
            todo.setdefault(dim, []).append(Anchor(qid, vec_id, label, x.astype(np.float64) if exact_floats else x, [Wanted(k, lo, hi, []) for lo, hi in windows]))
        for (_, dim), rows in _by_shard(batches):
            asked = todo.get(dim, ())
            if not asked:
                continue
            shard = Shard.of(rows, exact_floats)
            pure = shard.labels[0] if (shard.labels == shard.labels[0]).all() else None
            asked = [a for a in asked if pure is None or (pure == a.label) == same]
            if not asked:
                continue
            c0, c1 = int(shard.first[0]), int(shard.last[0])
            for i in range(0, len(asked), 256):  # the root's children are scored for many anchors at once
                some = asked[i:i + 256]
                top = (np.stack([a.x for a in some]) @ shard.x[c0:c1].T).astype(np.int64)
                for a, s in zip(some, top):
                    reach = math.sqrt(float((a.x.astype(np.float64) ** 2).sum())) * most
                    search(shard, a, same, most, {0: expand(shard, a, same, reach, 0, s)} if c1 > c0 else {})
        out = [(a.qid, slot, -s, i) for some in todo.values() for a in some for slot, w in enumerate(a.wanted) for s, i in w.best]
        if out:
            c = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.int64())], names=["qid", "slot", "score", "found"])

    return run


def _search_all(index: DataFrame, asked: DataFrame, blocks: int, same: bool, most: float, k: int) -> DataFrame:
    """The best ``k`` for each (qid, slot): one pass over the index for each block of anchors."""
    spark = index.sparkSession
    dealt = index.repartition("shard").sortWithinPartitions("shard", "seq")
    found = []
    for b in range(blocks):
        rows = asked.filter(F.col("block") == b).select("qid", "vec_id", "label", "dim", "x", "windows").collect()  # a bounded block
        some = spark.sparkContext.broadcast([(r["qid"], r["vec_id"], r["label"], r["dim"], bytes(r["x"]), [tuple(w) for w in r["windows"]]) for r in rows])
        if rows:
            found.append(written(dealt.mapInArrow(lambda it, some=some: _search_block(some.value, same, most, k)(it), "qid long, slot int, score long, found long"), "hn-found"))
    if not found:
        return spark.createDataFrame([], "qid long, slot int, score long, found long, rank int")
    w = Window.partitionBy("qid", "slot").orderBy(F.col("score").desc(), "found")
    return reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, p: NegativeParams | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows (vec_id,
    label, x: integer components, anchor: whether it is one)."""
    p = p or NegativeParams()
    packed, nodes = candidates(rows.select("vec_id", "label", "x", "anchor"), p)
    most = math.sqrt(packed.agg(F.max("norm2")).first()[0] or 0)
    index = build_index(nodes, most, p)
    anchors = packed.filter("anchor")
    blocks = -(-anchors.count() // p.block)
    order = Window.partitionBy("block").orderBy("vec_id", "label", "x")
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(max(blocks, 1))).cast("int"))
    anchors = written(anchors.withColumn("qid", F.col("block").cast("long") * (1 << 32) + F.row_number().over(order)).select("qid", "block", "vec_id", "label", "dim", "x"), "hn-anchors")
    limit = 1 << 62
    everything = anchors.withColumn("windows", F.array(F.struct(F.lit(-limit).alias("lo"), F.lit(limit).alias("hi"))))
    pos = _search_all(index, everything, blocks, True, most, p.positives)
    pos = written(pos.select("qid", F.col("found").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("nth")), "hn-positives")
    window = lambda s: F.struct(  # noqa: E731  integers s with low * score <= 100 * s <= high * score
        (-F.floor(-s.cast("decimal(20,0)") * p.low_percent / 100)).cast("long").alias("lo"), F.floor(s.cast("decimal(20,0)") * p.high_percent / 100).cast("long").alias("hi"))
    listed = pos.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("nth", "positive_id", "positive_score"))).alias("pos"))
    asked = written(anchors.join(listed, "qid").withColumn("windows", F.transform("pos", lambda x: window(x["positive_score"]))), "hn-asked")
    neg = _search_all(index, asked.drop("pos"), blocks, False, most, p.negatives)
    named = asked.select("qid", F.col("vec_id").alias("anchor_id"), F.posexplode("pos").alias("slot", "p"))
    return neg.join(named, ["qid", "slot"]).select("anchor_id", F.col("p.positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"),
                                                   F.col("p.positive_score").alias("positive_score"), F.col("score").alias("negative_score"))
