from zlib import crc32

import numpy as np

from conftest import SF_MID
from warnindex.llm import quality as Q
from warnindex.llm.queries import op3_quality_knn

SMALL = Q.KnnParams(words=200, shapes=60, dims=8, k=3, max_per_class=50)


def test_features():
    i, n = Q.features("The cat. THE cat cat\nsame\nsame", SMALL)
    got = dict(zip(i.tolist(), n.tolist()))
    assert got[crc32(b"cat") % 200] >= 3 and (np.diff(i) > 0).all()
    assert got[258] == 2 / 6 and got[259] == 1 / 3
    assert all(len(x) == 0 for t in (None, "", " \n") for x in Q.features(t, SMALL))


def test_basis_is_the_leading_space():
    rng = np.random.default_rng(0)
    rows = [Q.features(" ".join(rng.choice(["aa", "bb", "cc", "dd", "ee", "ff"], 20)), SMALL) for _ in range(80)]
    idf = np.ones(SMALL.size)
    x = Q._dense(rows, idf)
    b = Q.latent_space(rows, idf, SMALL)
    want = np.linalg.svd(x, compute_uv=False)[:8]
    assert np.allclose(np.linalg.svd(x @ b, compute_uv=False), want, rtol=1e-2)


def test_vote_matches_brute_force():
    rng = np.random.default_rng(1)
    rows = [Q.features(" ".join(rng.choice([f"w{i}" for i in range(60)], 15)), SMALL) for _ in range(60)]
    idf = np.ones(SMALL.size)
    basis = Q.latent_space(rows, idf, SMALL)
    y = (np.arange(60) % 3 > 0).astype(np.float32)
    model = {"idf": idf, "basis": basis, "vectors": Q._unit(Q._dense(rows, idf) @ basis), "labels": y, "stands_for": np.where(y > 0, 4.0, 1.0)}
    test = [Q.features(" ".join(rng.choice([f"w{i}" for i in range(80)], 15)), SMALL) for _ in range(20)]
    got = Q.vote(test + [(np.zeros(0, np.int64), np.zeros(0))], model, SMALL)
    d = Q._unit(Q._dense(test, idf) @ basis)
    for r in range(20):
        cos = sorted(((float(d[r] @ v), i) for i, v in enumerate(model["vectors"])), reverse=True)[:3]
        w = [max(c, 0) ** 8 * model["stands_for"][i] for c, i in cos]
        assert np.isclose(got[r], sum(x * y[i] for x, (_, i) in zip(w, cos)) / sum(w), atol=1e-4)
    assert np.isclose(got[20], 160 / 180)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 2.0), (2, "", 3.0), (None, "junk junk junk", 1.0), (4, "x " * 50_000, None), (4, "Good prose.", None),
                                  (6, "junk junk", 0.0), (7, "Good prose again.", 0.0)], "doc_id long, text string, n double")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (4, 0), (4, 1), (6, 0), (7, 1), (99, 1)], "doc_id long, quality int")
    s = Q.score(docs, Q.fit(docs, labels, SMALL), SMALL, score_col="p")
    got = s.collect()
    assert len(got) == 7 and s.columns == ["doc_id", "text", "n", "p"] and all(0 <= r.p <= 1 for r in got)
    none = Q.score(docs, Q.fit(docs, labels.limit(0), SMALL), SMALL)
    assert {r.score for r in none.collect()} == {0.5}
    assert Q.score(docs.limit(0), Q.fit(docs.limit(0), labels, SMALL), SMALL).collect() == []


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op3_quality_knn(spark, SF_MID).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(r.score, r.predicted, labels[i]) for i, r in got.items() if r.held_out and i in labels]
    assert np.mean([p == y for _, p, y in held]) >= 0.95
    pos, neg = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert np.mean([a > b for a in pos for b in neg]) > 0.98
