from zlib import crc32

import numpy as np

from conftest import SF_MID
from warnindex.llm import toxicity as X
from warnindex.llm.queries import op2_toxicity_ftrl

SMALL = X.FtrlParams(bits=16, epochs=6)


def test_features():
    f = X.hashed_features("Aa, bb aa-BB", 16)
    assert len(f) == 4 + 3 + 2 and len(np.unique(f)) == 2 + 2 + 2
    assert len(X.hashed_features(None)) == len(X.hashed_features("")) == 0
    assert len(X.hashed_features("one")) == 1


def test_ftrl_is_sparse_and_separates():
    rng = np.random.default_rng(0)
    y = (np.arange(400) % 8 == 0).astype(float)
    rows = [np.unique(np.concatenate((rng.integers(100, 60_000, 80), [7] if t else []))).astype(np.int32) for t in y]
    w, b = X.ftrl(rows, y, X.FtrlParams(bits=16))
    s = np.array([w[r].sum() + b for r in rows])
    assert (s[y == 1] > 0).all() and (s[y == 0] < 0).all()
    assert np.argmax(w) == 7 and (w != 0).sum() < 6000


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 2.0), (2, "", 3.0), (None, "bad words", 1.0), (4, "x " * 50_000, None), (4, "good", None)],
                                 "doc_id long, text string, weight double")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (4, 0), (4, 1), (9, 1)], "doc_id long, toxic int")
    s = X.score(docs, X.train(docs, labels, SMALL), SMALL, score_col="p")
    got = s.collect()
    assert len(got) == 5 and s.columns == ["doc_id", "text", "weight", "p"]
    assert all(0 <= r.p <= 1 for r in got)
    none = X.score(docs, X.train(docs, labels.limit(0), SMALL), SMALL)
    assert {r.score for r in none.collect()} == {0.5}
    assert X.score(docs.limit(0), X.train(docs, labels, SMALL), SMALL).collect() == []


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op2_toxicity_ftrl(spark, SF_MID).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(r.score, r.predicted, labels[i]) for i, r in got.items() if r.held_out and i in labels]
    assert np.mean([p == y for _, p, y in held]) >= 0.92
    pos, neg = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert np.mean([a > b for a in pos for b in neg]) > 0.9


def test_training_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    from pyspark.sql import functions as F

    from warnindex.llm.common import held_out

    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {(r.idx, r.weight) for r in X.train(docs, labels).collect()}
    assert a == {(r.idx, r.weight) for r in X.train(docs, flipped).collect()}


def test_ftrl_follows_the_published_update_rule():
    """Coordinate by coordinate in plain Python: w = 0 where |z| <= l1, else -(z - sign(z) l1) / ((beta + sqrt n) / alpha + l2);
    z += g - (sqrt(n + g^2) - sqrt n) / alpha * w; n += g^2.  The bias is a coordinate without l1 that starts at the base rate."""
    import math

    import numpy as np

    from warnindex.llm.toxicity import FtrlParams, ftrl

    rng = np.random.default_rng(4)
    p = FtrlParams(bits=6, epochs=3, alpha=0.7, beta=0.9, l1=0.02, l2=0.3, seed=5)
    rows = [np.unique(rng.integers(0, 64, rng.integers(0, 9))) for _ in range(50)]
    y = np.array([float(3 in r or rng.random() < 0.2) for r in rows])
    z, n = [0.0] * 65, [0.0] * 65
    rate = sum(y) / len(y)
    l1 = p.l1 * p.epochs * math.sqrt(max(1.0, len(y) * rate * (1 - rate)))
    start = math.log((rate + 1e-3) / (1 - rate + 1e-3))

    def w(i):
        if i == 64:
            return -z[i] / ((p.beta + math.sqrt(n[i])) / p.alpha)
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((p.beta + math.sqrt(n[i])) / p.alpha + p.l2)

    order = np.random.default_rng(p.seed)
    for _ in range(p.epochs):
        for r in order.permutation(len(y)):
            at = [*rows[r].tolist(), 64]
            now = {i: w(i) for i in at}
            g = 1 / (1 + math.exp(-(sum(now.values()) + start))) - y[r]
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / p.alpha * now[i]
                n[i] += g * g
    got, bias = ftrl(rows, y, p)
    assert np.allclose(got, [w(i) for i in range(64)], atol=1e-9) and abs(bias - start - w(64)) < 1e-9
    assert 0 < np.count_nonzero(got) < 64
