import math

import numpy as np
import pytest

from conftest import SF_MID
from warnindex.llm import hard_negatives as H
from warnindex.llm.queries import op11_hard_negatives


def brute(rows, p):
    rows = sorted({(i, lab, tuple(x)) for i, lab, x, *_ in rows}), {(i, lab, tuple(x)) for i, lab, x, a in rows if a}
    every, anchors = rows
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))
    out = []
    for a in sorted(anchors):
        met = [(-dot(a[2], r[2]), r[0], r[1] == a[1]) for r in every if r != a and len(r[2]) == len(a[2])]
        for s, i, _ in sorted(x for x in met if x[2])[:p.positives]:
            s = -s
            neg = sorted((t, j) for t, j, same in met if not same and p.low_percent * s <= -100 * t <= p.high_percent * s)[:p.negatives]
            out += [(a[0], i, n, j, s, -t) for n, (t, j) in enumerate(neg, 1)]
    return sorted(out)


def mined(spark, rows, p):
    df = spark.createDataFrame([(i, lab, list(x), a) for i, lab, x, a in rows], "vec_id long, label long, x array<long>, anchor boolean").repartition(3)
    return sorted(tuple(r) for r in H.hard_negatives(df, p).collect())


def data(seed=1, n=500, dim=6, spread=40):
    """Clusters, a crowd of copies, ties, zero vectors, one label with a third of the rows."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(-200, 200, (12, dim))
    out = []
    for i in range(n):
        x = centres[rng.integers(12)] + rng.integers(-spread, spread + 1, dim)
        if i % 3 == 0:
            x = centres[0] + (i % 2)
        if i % 41 == 0:
            x = np.zeros(dim, int)
        out.append((i * 3 - 50, int(rng.integers(5)) if i % 4 else 1, [int(v) for v in x], i % 17 == 0))
    return out


def test_equals_brute_force(spark):
    rows = data() + data(7, 40, 3)[:40]
    for p in (H.NegativeParams(), H.NegativeParams(positives=3, negatives=7, low_percent=20, high_percent=100, shard_rows=64, sample=50, leaf=2, block=10)):
        want = brute(rows, p)
        assert want and mined(spark, rows, p) == want


def test_large_integers_and_repeated_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 90, i % 3, [int(v) for v in rng.integers(-1, 2, 4) * rng.integers(1 << 28, 1 << 29, 4)], i % 10 == 0) for i in range(120)]
    rows += rows[:30]  # repeated rows
    p = H.NegativeParams(low_percent=1, shard_rows=20)
    assert mined(spark, rows, p) == brute(rows, p)


def test_rows_that_take_no_part(spark):
    rows = [(0, 0, [10, 0], True), (1, 0, [10, 0], False), (2, 1, [9, 0], False), (None, 1, [9, 0], True), (3, None, [9, 0], False), (4, 1, None, True), (5, 1, [9, None], False),
            (6, 1, [9], False), (7, 1, [1 << 40, 0], False), (8, 1, [], True)]
    df = spark.createDataFrame([(i, b, c, d, 0, "x") for i, b, c, d in rows], "vec_id long, label long, x array<long>, anchor boolean, rank int, score string")
    assert [tuple(r) for r in H.hard_negatives(df).collect()] == [(0, 1, 1, 2, 100, 90)]
    assert H.hard_negatives(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_tree_covers_and_separates(seed):
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(-300, 300, (400, 5)) // (1 if seed else 200), axis=0)
    most = math.sqrt((x * x).sum(axis=1).max())
    t = H.build_tree(x, most, leaf=4)
    u = H._augmented(x, most)
    assert sorted(t.point[~t.again].tolist()) == list(range(len(x)))  # every point is scored once

    def below(v):
        return {int(t.point[v])}.union(*(below(c) for c in range(t.first[v], t.last[v])))

    for v in range(len(t.point)):
        if t.last[v] > t.first[v]:
            assert max(H._angles(u[sorted(below(v))], u[t.point[v]])) <= t.radius[v] + 1e-9
            kids = t.point[t.first[v]:t.last[v]]
            if t.again[t.first[v]:t.last[v]].any() or t.last[v] - t.first[v] > 4:
                a = np.array([H._angles(u[kids], u[k]) for k in kids]) + 10 * np.eye(len(kids))
                assert a.min() > t.radius[v] / 2 - 1e-6


def test_descent_skips_what_is_outside():
    """With tight clusters a narrow window leaves most vertices unexpanded."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-1000, 1000, (30, 8))
    x = (centres[rng.integers(0, 30, 3000)] + rng.integers(-5, 6, (3000, 8))).astype(np.int64)
    x = np.unique(x, axis=0)
    most = math.sqrt((x * x).sum(axis=1).max())
    t = H.build_tree(x, most)
    rows = [{"seq": i, "x": x[k].astype("<i8").tobytes(), "label": 0, "ids": [int(k)], "radius": t.radius[i], "first": t.first[i], "last": t.last[i], "again": t.again[i]}
            for i, k in enumerate(t.point)]
    shard, q = H.Shard.of(rows, True), x[5].astype(np.float64)
    best = int(max(x @ x[5]))
    w, scored = H.Wanted(3, best // 2, best * 95 // 100, []), {}
    H.search(shard, H.Anchor(0, -1, 1, q, [w]), False, most, scored)
    s = x @ x[5]
    ok = np.flatnonzero((s >= best // 2) & (s <= best * 95 // 100))
    assert [(a, b) for a, b in w.best] == sorted((-int(s[i]), int(i)) for i in ok)[:3]
    assert sum(int(t.last[v] - t.first[v]) for v in scored if v >= 0) < len(x) / 4


def test_query_on_a_given_table(spark):
    v = spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], [math.floor(256 * c) for c in r["embedding"]], r["vec_id"] % 50 == 0) for r in v]
    assert sorted(tuple(r) for r in op11_hard_negatives(spark, SF_MID).collect()) == brute(rows, H.NegativeParams())
