"""Embedding near-duplicates by NN-descent.

Nodes are the distinct vectors of a label (exact copies are one node with a
weight, so a crowd of copies costs one row).  Every node starts with the best
of its neighbours in a few orders by random-hyperplane signs, then rounds of
local joins refine the lists: all nodes on one node's list (forward and
sampled reverse) are compared with each other, since neighbours of neighbours
are likely neighbours.  Only pairs with a new entry are compared again; rounds end
when few lists change or few new links show up.  The descent runs on half-precision vectors; every
pair near the threshold is then verified in double precision.

Saturation: a list whose every entry is a link may miss links, to its own crowd as well as
to another one beside it.  Such lists are enlarged to everything in range: vectors lie in
the cells of sampled pivots (each with its nearest), a saturated vector is sent to those cells that
the bisecting hyperplanes cannot rule out, and is compared there exactly, in blocks.
Only counts per vector and a spanning forest of the links come back, never all pairs.
So only a link between two unsaturated vectors can be missed.

Audit: a bounded sample of vectors is compared exactly with all vectors of its
label (a map pass).  What counts is the share of vectors all of whose links are found, for
every degree class (bit length of the number of links), so that a crowd cannot hide what is lost in
small groups.  While a class is below ``target_recall`` further descents from new orders are
added; after the last of them every list of the labels concerned is enlarged as
above, which is exact.  A result below the target is never returned.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component link with nothing, neither do those with a null label; vectors of
different length never link; rows with equal label and vector are linked; each input row gives
one output row; equal entries at the end of a list change nothing (a full list of links is enlarged, others end
below the threshold); an invalid or unlinked row is its own component; ``kept`` is
false where vec_id is null; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warnindex.llm.common import run_bounds, written
from warnindex.llm.components import connected_components
from warnindex.session import fits


@dataclass(frozen=True)
class NNParams:
    threshold: float = 0.93
    k: int = 10  # list length
    reverse: int = 10  # reverse neighbours joined per node and round
    trees: int = 6  # orders by random hyperplanes
    planes: int = 24
    window: int = 8  # neighbours looked at on either side in an order
    rounds: int = 8
    least_rounds: int = 2
    stop_share: float = 0.002  # of list entries changed, or of links newly found
    margin: float = 0.005  # half-precision error allowed for
    block: int = 4096
    cell_rows: int = 2048  # rows a pivot, until there are max_pivots
    max_pivots: int = 8192
    audit_queries: int = 1024
    target_recall: float = 0.99  # of vectors, in every degree class
    extra_descents: int = 3
    seed: int = 11


def _pack(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _matrix(col: pa.Array, dtype) -> np.ndarray:
    """Binary column of equally long vectors as a matrix."""
    n = len(col)
    return np.frombuffer(b"".join(col.to_pylist()), dtype=dtype).reshape(n, -1)


def vector_nodes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): every row with its node id (null where invalid), and the nodes:
    nid, grp (label and length), weight, first_id, x (unit vector, doubles), h (half)."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                       F.col(vec_col).cast("array<double>").alias("e"))
    ok = (F.col("label").isNotNull() & F.col("e").isNotNull()
          & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0))
    nid = F.when(F.coalesce(ok, F.lit(False)), F.xxhash64(F.col("label"), F.size("e"), "e"))
    rows = written(v.withColumn("nid", nid), "nn-rows")
    grouped = rows.filter("nid is not null").groupBy("label", "e").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("first_id"), F.first("nid").alias("nid"))
    grouped = grouped.select("nid", F.xxhash64("label", F.size("e")).alias("grp"), "weight", "first_id", "e")

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = []
            for e in b.column(4):
                a = np.asarray(e.values, dtype=np.float64)
                a = a / np.abs(a).max()
                x.append(a / np.sqrt((a * a).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], _pack(x), _pack([a.astype(np.float16) for a in x])],
                                             names=["nid", "grp", "weight", "first_id", "x", "h"])

    nodes = grouped.mapInArrow(unit, "nid long, grp long, weight long, first_id long, x binary, h binary")
    return rows.select("vec_id", "nid"), written(nodes, "nn-nodes")


def _orders(p: NNParams, seed: int):
    """Rows (tree, grp, place, nid, h): place orders a group by random-hyperplane signs."""

    def go(batches):
        for b in batches:
            nid, grp, h = (b.column(i) for i in range(3))
            sizes = np.array([len(v) for v in h.to_pylist()])
            for size in np.unique(sizes):
                sel = pa.array(np.flatnonzero(sizes == size))
                x = _matrix(h.take(sel), np.float16).astype(np.float32)
                for t in range(p.trees):
                    planes = np.random.default_rng((p.seed, seed, t, int(size))).standard_normal((x.shape[1], p.planes)).astype(np.float32)
                    place = ((x @ planes) > 0) @ (1 << np.arange(p.planes, dtype=np.int64)[::-1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, np.int32)), grp.take(sel), pa.array(place), nid.take(sel), h.take(sel)],
                        names=["tree", "grp", "place", "nid", "h"])

    return go


def _adjacent(p: NNParams):
    """Rows sorted by (tree, grp, place) -> the best few links of each row to its neighbours in order."""
    keep = max(2, p.k // 2)

    def pairs(batch_key, nid, x, new_from):
        a_, b_, s_ = [], [], []
        n = len(nid)
        for d in range(1, p.window + 1):
            i = np.arange(max(0, new_from - d), n - d)
            i = i[(batch_key[i] == batch_key[i + d]) & (i + d >= new_from)]
            if len(i):
                s = np.einsum("ij,ij->i", x[i], x[i + d])
                a_.append(i), b_.append(i + d), s_.append(s)
        if not a_:
            return None
        a, b, s = np.concatenate(a_), np.concatenate(b_), np.concatenate(s_)
        u, v, s = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((s, s))
        o = np.lexsort((v, -s, u))
        u, v, s = u[o], v[o], s[o]
        at = run_bounds(u)
        first = np.repeat(at[:-1], np.diff(at))
        ok = np.arange(len(u)) - first < keep
        return nid[u[ok]], nid[v[ok]], s[ok]

    def go(batches):
        key0, nid0, h0 = np.zeros((0, 2), np.int64), np.zeros(0, np.int64), []
        for b in batches:
            key = np.stack((b.column(0).to_numpy().astype(np.int64), b.column(1).to_numpy(zero_copy_only=False)), axis=1)
            key, nid, h = np.concatenate((key0, key)), np.concatenate((nid0, b.column(3).to_numpy(zero_copy_only=False))), h0 + b.column(4).to_pylist()
            start = len(nid0)
            # runs of one key hold vectors of one length
            run = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]).any(axis=1))))
            sizes = np.array([len(v) for v in h])
            for size in np.unique(sizes):
                sel = np.flatnonzero(sizes == size)
                x = np.frombuffer(b"".join(h[i] for i in sel), np.float16).reshape(len(sel), -1).astype(np.float32)
                got = pairs(run[sel], nid[sel], x, int((sel < start).sum()))
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1]), pa.array(got[2].astype(np.float32))], names=["u", "v", "s"])
            key0, nid0, h0 = key[-p.window:], nid[-p.window:], h[-p.window:]

    return go


def _local_join(p: NNParams):
    """Rows (w, u, fresh, bound, h) sorted by w -> pairs of one list that may improve one of them."""

    def solve(w, u, fresh, bound, h):
        at = run_bounds(w)
        sizes = np.array([len(v) for v in h])
        out = ([], [], [])
        for n in np.unique(np.diff(at)):
            if n < 2:
                continue
            heads = at[:-1][np.diff(at) == n]
            for size in np.unique(sizes[heads]):
                hs = heads[sizes[heads] == size]
                for c in range(0, len(hs), max(1, 200_000 // (int(n) * int(n)))):
                    rows = hs[c:c + max(1, 200_000 // (int(n) * int(n))), None] + np.arange(n)
                    x = np.frombuffer(b"".join(h[i] for i in rows.ravel()), np.float16).reshape(len(rows), n, -1).astype(np.float32)
                    s = x @ x.transpose(0, 2, 1)
                    ok = (fresh[rows][:, :, None] | fresh[rows][:, None, :]) & (s > bound[rows][:, :, None])
                    ok &= u[rows][:, :, None] != u[rows][:, None, :]
                    g, i, j = np.nonzero(ok)
                    out[0].append(u[rows[g, i]]), out[1].append(u[rows[g, j]]), out[2].append(s[g, i, j])
        if out[0]:
            a, b, s = (np.concatenate(o) for o in out)
            o = np.lexsort((b, a))
            a, b, s = a[o], b[o], s[o]
            one = np.ones(len(a), bool)
            one[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            return pa.RecordBatch.from_arrays([pa.array(a[one]), pa.array(b[one]), pa.array(s[one].astype(np.float32))], names=["u", "v", "s"])
        return None

    def go(batches):
        rest = None
        for b in batches:
            new = [b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False),
                   b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False), b.column(4).to_pylist()]
            if rest is not None:
                new = [np.concatenate((x, y)) for x, y in zip(rest[:4], new[:4])] + [rest[4] + new[4]]
            last = int(run_bounds(new[0])[-2])  # the last list may go on in the next batch
            got = solve(*(c[:last] for c in new))
            if got is not None:
                yield got
            rest = [c[last:] for c in new]
        if rest is not None:
            got = solve(*rest)
            if got is not None:
                yield got

    return go


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The k best distinct entries of every list; fresh = not there before."""
    e = edges.repartition("u").groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    return e.withColumn("r", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))).filter(F.col("r") <= k).drop("r")


def descend(nodes: DataFrame, p: NNParams, seed: int = 0) -> DataFrame:
    """Neighbour lists ``(u, v, s)`` of ``nodes`` (nid, grp, h); s: half-precision cosine."""
    slim = nodes.select("nid", "grp", "h")
    placed = slim.mapInArrow(_orders(p, seed), "tree int, grp long, place long, nid long, h binary")
    order = ["tree", "grp", "place", "nid"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    start = placed.mapInArrow(_adjacent(p), "u long, v long, s float").withColumn("fresh", F.lit(1))
    lists = written(_best(start, p.k), "nn-lists")
    close = F.col("s") >= p.threshold - p.margin
    for n in range(p.rounds):
        total, changed, links, found = lists.agg(
            F.count("*"), F.sum("fresh"), F.count_if(close), F.count_if(close & (F.col("fresh") == 1))).first()
        # what is sought are links: the lists need not settle far below the threshold
        if not total or changed <= p.stop_share * total or n >= p.least_rounds and found <= p.stop_share * links:
            break
        # a list to improve must beat its last entry; a saturated one is enlarged later, not improved
        last = F.when(F.min("s") >= p.threshold - p.margin, F.lit(2.0)).otherwise(F.min("s"))
        bound = lists.groupBy("u").agg(F.when(F.count("*") >= p.k, last).otherwise(F.lit(-2.0)).cast("float").alias("bound"))
        back = lists.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy(F.desc("fresh"), F.xxhash64("u", "v")))).filter(
            F.col("r") <= p.reverse)
        member = lists.select(F.col("u").alias("w"), F.col("v").alias("m"), "fresh").unionByName(
            back.select(F.col("v").alias("w"), F.col("u").alias("m"), "fresh"))
        member = member.groupBy("w", "m").agg(F.max("fresh").alias("fresh"))
        known = slim.join(bound, slim["nid"] == bound["u"], "left").select(
            F.col("nid").alias("m"), F.coalesce("bound", F.lit(-2.0).cast("float")).alias("bound"), "h")
        rows = member.join(known, "m").select("w", F.col("m").alias("u"), (F.col("fresh") == 1).alias("fresh"), "bound", "h")
        rows = rows.repartition("w").sortWithinPartitions("w", "u")
        found = rows.mapInArrow(_local_join(p), "u long, v long, s float").withColumn("fresh", F.lit(1))
        lists = written(_best(lists.withColumn("fresh", F.lit(0)).unionByName(found), p.k), "nn-lists")
    return lists.select("u", "v", "s")


def verified(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a < b) whose cosine in double precision reaches the threshold."""
    ab = pairs.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    n = nodes.select("nid", "x")
    ab = ab.join(n, ab["a"] == n["nid"]).select("a", "b", F.col("x").alias("xa"))
    ab = ab.join(n, ab["b"] == n["nid"]).select("a", "b", "xa", F.col("x").alias("xb"))

    def go(batches):
        for b in batches:
            s = [float(np.dot(np.frombuffer(x), np.frombuffer(y))) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            ok = pa.array(np.array(s) >= threshold)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], names=["a", "b"])

    return ab.mapInArrow(go, "a long, b long")


def _cells(pivots: dict, p: NNParams):
    """Rows (nid, grp, weight, x, deep) -> (grp, cell, query, nid, weight, deep, x): every row once in the cell of
    its nearest pivot, deep rows as queries in every cell that may hold a link of theirs too."""
    chord = float(np.sqrt(max(0.0, 2 - 2 * p.threshold))) + 1e-9

    def part(x, piv, deep):
        """(row, cell, query) of all copies."""
        n = len(x)
        if piv is None:  # a group without a pivot is one cell
            rows = np.concatenate((np.arange(n), np.flatnonzero(deep)))
            return rows, np.full(len(rows), -1), np.arange(len(rows)) >= n
        at, c = piv
        out = []
        gap = np.sqrt(np.maximum(0.0, 2 - 2 * (c @ c.T)))
        for i in range(0, n, 512):
            s = x[i:i + 512] @ c.T
            home = s.argmax(axis=1)
            out.append((np.arange(i, i + len(s)), home, np.zeros(len(s), bool)))
            # a vector v of cell c has v.(c - home) >= 0, so a link of q needs q.(home - c) <= chord * |home - c|
            q, cell = np.nonzero((s[np.arange(len(s)), home][:, None] - s <= chord * gap[home] + 1e-9) & deep[i:i + 512, None])
            out.append((i + q, cell, np.ones(len(q), bool)))
        rows, cell, query = (np.concatenate(o) for o in zip(*out))
        return rows, at[cell], query

    def go(batches):
        for b in batches:
            grp = b.column(1).to_numpy(zero_copy_only=False)
            for g in np.unique(grp):
                sel = b.take(pa.array(np.flatnonzero(grp == g)))
                x, deep = _matrix(sel.column(3), np.float64), sel.column(4).to_numpy(zero_copy_only=False)
                for i in range(0, len(x), 2048):
                    rows, cell, query = part(x[i:i + 2048], pivots.get(int(g)), deep[i:i + 2048])
                    t = sel.take(pa.array(i + rows))
                    yield pa.RecordBatch.from_arrays(
                        [t.column(1), pa.array(cell.astype(np.int32)), pa.array(query), t.column(0), t.column(2), t.column(4), t.column(3)],
                        names=["grp", "cell", "query", "nid", "weight", "deep", "x"])

    return go


def _in_range(p: NNParams):
    """Rows (task, query, nid, weight, deep, x) sorted by task -> per task the weighted links of every query and of
    every other row to the queries ``(a, null, n)``, and a spanning forest of the links ``(a, b, null)``."""

    def solve(rows):
        query = np.array([r[0] for r in rows])
        nid, w = np.array([r[1] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=np.int64)
        deep, x = np.array([r[3] for r in rows]), np.frombuffer(b"".join(r[4] for r in rows)).reshape(len(rows), -1)
        q, d = np.flatnonzero(query), np.flatnonzero(~query)
        if not len(q) or not len(d):
            return None
        d = d[np.argsort(nid[d])]
        me = np.searchsorted(nid[d], nid[q])
        me = np.where((me < len(d)) & (nid[d][np.minimum(me, len(d) - 1)] == nid[q]), me, -1)
        xd, out, back = x[d], np.zeros(len(q), np.int64), np.zeros(len(d), np.int64)
        label, u, v = np.arange(len(d)), [], []
        for i in range(0, len(q), 256):
            hit = x[q[i:i + 256]] @ xd.T >= p.threshold
            own = np.flatnonzero(me[i:i + 256] >= 0)
            hit[own, me[i:i + 256][own]] = False
            out[i:i + 256] = hit @ w[d]
            back += w[q[i:i + 256]] @ hit
            for k in np.flatnonzero(hit.any(axis=1)):
                roots = np.unique(label[hit[k]])
                if me[i + k] >= 0:  # the query is one of the rows as well
                    mine = label[me[i + k]]
                    u.append(nid[d[roots[roots != mine]]]), v.append(np.full(int((roots != mine).sum()), nid[d[mine]]))
                    roots = np.append(roots[roots != mine], mine)
                else:
                    u.append(nid[d[roots]]), v.append(np.full(len(roots), nid[q[i + k]]))
                if len(roots) > 1:
                    label[np.isin(label, roots)] = roots.min()
        other = ~deep[d] & (back > 0)
        a = np.concatenate((nid[q], nid[d][other], *u))
        n = np.concatenate((out, back[other]))
        links = len(a) - len(n)
        b = np.concatenate((np.zeros(len(n), np.int64), *v))
        none = np.arange(len(a)) < len(n)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=none), pa.array(np.concatenate((n, np.zeros(links, np.int64))), mask=~none)],
                                          names=["a", "b", "n"])

    def go(batches):  # one task's rows at a time: at most two blocks
        rows, task = [], None
        for b in batches:
            for t, *r in zip(*(b.column(i).to_pylist() for i in range(6))):
                if t != task and rows:
                    got = solve(rows)
                    if got is not None:
                        yield got
                    rows = []
                task = t
                rows.append(r)
        got = solve(rows) if rows else None
        if got is not None:
            yield got

    return go


def range_search(nodes: DataFrame, deep: DataFrame, p: NNParams) -> DataFrame:
    """All links of the nodes in ``deep`` (u), exactly: ``(a, null, n)`` partial weighted counts (for nodes not in
    ``deep``: of their links to such nodes) and ``(a, b, null)`` edges that connect what is linked."""
    flagged = nodes.select("nid", "grp", "weight", "x").join(deep.select(F.col("u").alias("nid"), F.lit(True).alias("deep")), "nid", "left")
    flagged = written(flagged.withColumn("deep", F.coalesce("deep", F.lit(False))), "nn-flagged")
    groups = flagged.filter("deep").select("grp").distinct()
    flagged = flagged.join(groups, "grp", "left_semi").select("nid", "grp", "weight", "x", "deep")
    n = min(p.max_pivots, -(-flagged.count() // p.cell_rows))  # a bounded sample
    by: dict[int, tuple[list, list]] = {}
    for i, r in enumerate(flagged.orderBy(F.xxhash64("nid", F.lit(p.seed + 1)), "nid").limit(n).select("grp", "x").collect()):
        at, x = by.setdefault(r["grp"], ([], []))
        at.append(i), x.append(np.frombuffer(r["x"]))
    pivots = {g: (np.array(at), np.stack(x)) for g, (at, x) in by.items()}
    spread = written(flagged.mapInArrow(_cells(pivots, p), "grp long, cell int, query boolean, nid long, weight long, deep boolean, x binary"), "nn-cells")
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.count_if(c) / p.block)).cast("int")
    sizes = spread.groupBy("grp", "cell").agg(blocks(F.col("query")).alias("nq"), blocks(~F.col("query")).alias("nd"))
    m = spread.join(F.broadcast(sizes) if fits(sizes, 20_000) else sizes, ["grp", "cell"])
    mine = F.pmod(F.xxhash64("nid"), F.when(F.col("query"), F.col("nq")).otherwise(F.col("nd"))).cast("int")
    m = m.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("query"), F.col("nd")).otherwise(F.col("nq")) - 1)))
    task = F.xxhash64("grp", "cell", F.when(F.col("query"), F.col("mine")).otherwise(F.col("other")), F.when(F.col("query"), F.col("other")).otherwise(F.col("mine")))
    m = m.select(task.alias("task"), "query", "nid", "weight", "deep", "x").repartition("task").sortWithinPartitions("task")
    return written(m.mapInArrow(_in_range(p), "a long, b long, n long"), "nn-range")


def _true_degrees(nodes: DataFrame, p: NNParams) -> DataFrame:
    """``(q, grp, links, n)``: other nodes linked to each node of a bounded sample, and their weight, by brute force:
    one map pass that hands on sums."""
    sample = nodes.orderBy(F.xxhash64("nid", F.lit(p.seed)), "nid").limit(p.audit_queries).select("nid", "grp", "x").collect()
    by: dict[int, tuple[list, list]] = {}
    for r in sample:
        i, x = by.setdefault(r["grp"], ([], []))
        i.append(r["nid"]), x.append(np.frombuffer(r["x"]))
    shipped = nodes.sparkSession.sparkContext.broadcast({g: (np.array(i, dtype=np.int64), np.stack(x)) for g, (i, x) in by.items()})

    def go(batches):
        for b in batches:
            nid, grp = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for g in np.unique(grp):
                if g in shipped.value:
                    sel = np.flatnonzero(grp == g)
                    q, qx = shipped.value[g]
                    x, w = _matrix(b.column(2).take(pa.array(sel)), np.float64), b.column(3).to_numpy(zero_copy_only=False)[sel]
                    hit = (qx @ x.T >= p.threshold) & (q[:, None] != nid[sel][None, :])
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.full(len(q), g)), pa.array(hit.sum(axis=1)), pa.array(hit @ w)],
                                                     names=["q", "grp", "links", "n"])

    sums = nodes.select("nid", "grp", "x", "weight").mapInArrow(go, "q long, grp long, links long, n long")
    return sums.groupBy("q", "grp").agg(F.sum("links").alias("links"), F.sum("n").alias("n"))


def _linked(nodes: DataFrame, pairs: DataFrame, deep: DataFrame, p: NNParams) -> tuple[DataFrame, DataFrame]:
    """(degrees ``nid, n``, edges ``a, b``) of the lists' pairs and of the enlarged lists of ``deep`` (u)."""
    found = range_search(nodes, deep, p)
    flat = pairs.select("u", "v").join(deep, "u", "left_anti").join(deep.select(F.col("u").alias("v")), "v", "left_anti")
    edges = written(verified(flat, nodes, p.threshold), "nn-edges")
    both = edges.select(F.col("a").alias("nid"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("nid"), F.col("a").alias("v")))
    weight = nodes.select(F.col("nid").alias("v"), F.col("weight").alias("n"))
    parts = both.join(weight, "v").select("nid", "n").unionByName(found.filter("b is null").select(F.col("a").alias("nid"), "n"))
    degree = written(parts.groupBy("nid").agg(F.sum("n").alias("n")), "nn-degrees")
    return degree, edges.unionByName(found.filter("b is not null").select("a", "b"))


def _audit(truth: DataFrame, degree: DataFrame, p: NNParams) -> tuple[float, list[int]]:
    """(the lowest share, over the degree classes, of sampled vectors with all their links; groups with a miss in a class below the target)."""
    d = degree.select(F.col("nid").alias("q"), F.col("n").alias("got"))
    seen = truth.filter("links > 0").join(d, "q", "left").select("grp", "links", (F.coalesce("got", F.lit(0)) == F.col("n")).alias("ok")).collect()  # the sample
    classes: dict[int, list[bool]] = {}
    for r in seen:
        classes.setdefault(int(r["links"]).bit_length(), []).append(r["ok"])
    share = {c: sum(v) / len(v) for c, v in classes.items()}
    low = {c for c, s in share.items() if s < p.target_recall}
    return min(share.values(), default=1.0), sorted({r["grp"] for r in seen if not r["ok"] and int(r["links"]).bit_length() in low})


def near_duplicates(vectors: DataFrame, p: NNParams = NNParams(), id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> tuple[DataFrame, float]:
    """(rows, recall): ``vec_id, n_links, component_id, kept`` per row, and the audited share of vectors with all their
    links, in the worst degree class (at least ``target_recall``; an error otherwise)."""
    rows, nodes = vector_nodes(vectors, id_col, vec_col, label_col)
    truth = written(_true_degrees(nodes, p), "nn-truth")
    pairs = deep = None
    for attempt in range(1 + p.extra_descents):
        lists = descend(nodes, p, attempt)
        near = lists.filter(F.col("s") >= p.threshold - p.margin)
        full = near.groupBy("u").agg(F.count("*").alias("c")).filter(F.col("c") >= p.k).select("u")
        pairs = near if pairs is None else pairs.unionByName(near)
        deep = full if deep is None else deep.unionByName(full).distinct()
        degree, edges = _linked(nodes, pairs, deep, p)
        recall, missed = _audit(truth, degree, p)
        if not missed:
            break
    else:  # every list of the labels concerned is enlarged
        rest = nodes.join(F.broadcast(nodes.sparkSession.createDataFrame([(g,) for g in missed], "grp long")), "grp", "left_semi")
        degree, edges = _linked(nodes, pairs, deep.unionByName(rest.select(F.col("nid").alias("u"))).distinct(), p)
        recall, missed = _audit(truth, degree, p)
        if missed:
            raise RuntimeError(f"links of {recall:.4f} of the audited vectors are complete, below {p.target_recall}")
    comp = written(connected_components(edges), "nn-components")
    named = nodes.select("nid", "weight", "first_id").join(comp, F.col("nid") == comp["node"], "left").withColumn(
        "root", F.coalesce("component", "nid"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_node = named.join(least, "root").join(degree, "nid", "left").select(
        "nid", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.join(per_node, "nid", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))), recall
