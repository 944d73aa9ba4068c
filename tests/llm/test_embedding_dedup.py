import numpy as np
import pytest

from conftest import SF_MID
from warnindex.llm import embedding_dedup as E
from warnindex.llm.queries import op4_embedding_near_dedup


def brute(rows, thr=0.93):
    """{row index: (n_links, component_id)} over all pairs."""
    unit = []
    for i, e, l in rows:
        ok = e is not None and l is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e)
        a = np.array(e, dtype=np.float64) if ok else None
        unit.append(None if a is None else (a / np.abs(a).max()) / np.linalg.norm(a / np.abs(a).max()))
    n, adj = len(rows), [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= thr:
                adj[i].add(j), adj[j].add(i)
    out, seen = {}, {}
    for i in range(n):
        if i in seen:
            continue
        stack, comp = [i], {i}
        while stack:
            for j in adj[stack.pop()] - comp:
                comp.add(j), stack.append(j)
        ids = [rows[j][0] for j in comp if rows[j][0] is not None]
        for j in comp:
            seen[j] = True
            out[j] = (len(adj[j]), min(ids) if ids else None)
    return [(rows[i][0], *out[i]) for i in range(n)]


def data(seed):
    rng = np.random.default_rng(seed)
    rows, vid = [], 0

    def add(v, label):
        nonlocal vid
        rows.append((vid, None if v is None else [None if x is None else float(x) for x in v], label))
        vid += 3

    for label in range(2):
        for _ in range(120):
            add(rng.standard_normal(16), label)
        for _ in range(25):
            b = rng.standard_normal(16)
            add(b, label), add(b + 0.08 * rng.standard_normal(16), label)
    b = rng.standard_normal(16)
    for _ in range(90):  # a dense crowd, partly linked
        add(b + 0.28 * rng.standard_normal(16), 1)
    for _ in range(40):
        add(rows[0][1], 0)  # exact copies
    add(None, 0), add([], 0), add([0.0] * 16, 0), add([1.0, None] + [0.0] * 14, 0), add([float("inf")] + [1.0] * 15, 0)
    add([float("nan")] + [1.0] * 15, 0), add(rows[0][1], None), add(rows[0][1][:8], 0), add([x * 1e200 for x in rows[1][1]], 0)
    rows.append((None, rows[2][1], rows[2][2])), rows.append(rows[3])
    return rows


@pytest.mark.parametrize("block", [4096, 16])
def test_against_brute_force(spark, block):
    rows = data(3)
    df = spark.createDataFrame([(i, e, l, 0) for i, e, l in rows], "vec_id long, embedding array<double>, label int, n_links int")
    out, recall = E.near_duplicates(df, E.NNParams(block=block))
    got, want = sorted(map(lambda r: (str(r.vec_id), r.n_links, str(r.component_id)), out.collect())), sorted(
        (str(i), n, str(c)) for i, n, c in brute(rows))
    assert len(got) == len(want) and recall >= 0.95
    assert sum(n for _, n, _ in got) <= sum(n for _, n, _ in want)
    assert sum(a == b for a, b in zip(got, want)) >= 0.95 * len(want)


def touching_groups(seed, n_crowd, n_pairs, dim=16):
    """A crowd and pairs of tight groups of 15 whose centres are at cosine 0.942, all of one label."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v)
    near = lambda c, r: unit(c + r * rng.standard_normal(dim) / np.sqrt(dim))
    c = unit(rng.standard_normal(dim))
    vecs = [near(c, 0.25) for _ in range(n_crowd)]
    for _ in range(n_pairs):
        a = unit(rng.standard_normal(dim))
        o = rng.standard_normal(dim)
        o = unit(o - (o @ a) * a)
        b = 0.942 * a + np.sqrt(1 - 0.942 ** 2) * o
        vecs += [near(a, 0.05) for _ in range(15)] + [near(b, 0.05) for _ in range(15)]
    order = rng.permutation(len(vecs))
    return [(int(i), vecs[j].tolist(), 1) for i, j in enumerate(order)]


@pytest.mark.parametrize("cell_rows", [2048, 100])
def test_touching_groups_beside_a_crowd(spark, cell_rows):
    rows = touching_groups(5, 1500, 40)
    out, recall = E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"),
                                    E.NNParams(cell_rows=cell_rows, block=512))
    x = np.array([r[1] for r in rows])
    hit = x @ x.T >= 0.93
    np.fill_diagonal(hit, False)
    comp, old = np.arange(len(x)), None
    while old is None or (comp != old).any():
        old = comp
        comp = np.minimum(comp, np.where(hit, comp[None, :], len(x)).min(axis=1))
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert got == {i: (int(hit[i].sum()), int(comp[i])) for i in range(len(x))} and recall == 1.0


def test_label_below_the_target_is_searched_exactly(spark):
    """Lists that find next to nothing: the audit sees it and the label's lists are enlarged."""
    rows = [r for r in data(4) if r[0] is not None]
    weak = E.NNParams(trees=1, planes=1, window=1, rounds=0, extra_descents=0)
    out, recall = E.near_duplicates(spark.createDataFrame([(i, e, l) for i, e, l in rows], "vec_id long, embedding array<double>, label int"), weak)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in out.collect())
    assert got == sorted(brute(rows)) and recall == 1.0


def test_audit_counts_vectors_by_degree_class(spark):
    truth = spark.createDataFrame([(i, 7, 1000, 1000) for i in range(100)] + [(200 + i, 8, 2, 2) for i in range(4)], "q long, grp long, links long, n long")
    degree = spark.createDataFrame([(i, 1000) for i in range(100)] + [(200, 2), (201, 2), (202, 1)], "nid long, n long")
    assert E._audit(truth, degree, E.NNParams()) == (0.5, [8])


def test_empty(spark):
    out, recall = E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    assert out.collect() == [] and recall == 1.0


def test_query_matches_sql(spark):
    import duckdb

    from warnindex.llm.queries import ORACLES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_MID}/embeddings.parquet')")
    got = op4_embedding_near_dedup(spark, SF_MID)
    cur = con.execute(ORACLES["op4_embedding_near_dedup"])
    assert [d[0] for d in cur.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())


def test_query_recall(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    want = {i: (n, c) for i, n, c in brute(rows)}
    got = {r.vec_id: (r.n_links, r.component_id) for r in op4_embedding_near_dedup(spark, SF_MID).collect()}
    assert set(got) == set(want)
    assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in got)
