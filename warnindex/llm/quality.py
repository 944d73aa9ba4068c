"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text becomes hashed counts of its words, of its tokens' shapes (letter case,
digits, punctuation), of adjacent repeats and of repeated lines, weighted by
tf-idf; document frequencies are counted over all documents.  A truncated SVD
(randomised, seeded) of a bounded labelled sample gives the latent space.  The
labelled vectors, at most ``2 * max_per_class`` of ``dims`` numbers, are broadcast;
every document takes the exact cosine with each of them, in blocks, and
its ``k`` nearest vote with their similarity as weight, times the number of
labelled documents of the class for which a sampled one stands.

The sample is the smallest hashes of the ids of each class; the SVD runs in one
task over it.  Corpus counts are one vector per task, summed by key.  Scoring is one map pass.

Defined results: null and empty texts, and texts of no known feature, score the
sample's mean label; null labels are ignored, conflicting labels count as the
larger; without any usable label every score is 0.5; repeated rows are scored each;
extra columns are kept by ``score``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warnindex.llm.common import arrow_rows, held_out, written

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def _shape_table() -> bytes:
    t = bytearray(range(256))
    for c in range(256):
        ch = chr(c)
        t[c] = ord("x") if c >= 128 or "a" <= ch <= "z" else ord("X") if "A" <= ch <= "Z" else ord("9") if ch.isdigit() else ord(" ") if ch.isspace() else c
    return bytes(t)


_SHAPES = _shape_table()
REPEATS = 3.0  # weight of the shares of repeats against the unit tf-idf vector


@dataclass(frozen=True)
class KnnParams:
    words: int = 6144  # hashed coordinates of words
    shapes: int = 2048  # and of shapes, the last two of which count repeats
    dims: int = 64
    k: int = 10
    power: float = 8.0  # similarity to this power is the weight of a vote
    max_per_class: int = 2_000
    block: int = 256
    seed: int = 29

    @property
    def size(self) -> int:
        return self.words + self.shapes


def features(text: str | None, p: KnnParams) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, counts) of one text, coordinates ascending."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = _WORD.findall(raw.lower())
    if not raw.strip():
        return np.zeros(0, np.int64), np.zeros(0)
    h = np.fromiter(map(crc32, words), dtype=np.int64, count=len(words))
    shape = np.frombuffer(raw.translate(_SHAPES), dtype=np.uint8)
    shape = shape[np.concatenate(([True], shape[1:] != shape[:-1]))].tobytes()
    kinds = Counter(shape.split())
    ids = [h % p.words, np.array([p.words + crc32(s) % (p.shapes - 2) for s in kinds], dtype=np.int64)]
    wt = [np.ones(len(h)), np.array(list(kinds.values()), dtype=float)]
    lines = Counter(x for x in raw.split(b"\n") if x.strip())
    # shares, not counts: of words that repeat the one before, of lines that occurred before
    extra = ((p.size - 2, float((h[1:] == h[:-1]).mean()) if len(h) > 1 else 0.0),
             (p.size - 1, sum(n - 1 for n in lines.values()) / max(1, sum(lines.values()))))
    ids.append(np.array([i for i, n in extra if n], dtype=np.int64))
    wt.append(np.array([n for _, n in extra if n]))
    i, w = np.concatenate(ids), np.concatenate(wt)
    u, inv = np.unique(i, return_inverse=True)
    return u, np.bincount(inv, weights=w, minlength=len(u))


def document_counts(docs: DataFrame, p: KnnParams, text_col: str = "text") -> DataFrame:
    """``(idx, df)`` over all documents; idx -1 has their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(p.size, dtype=np.int64), 0
        for b in arrow_rows(batches):
            for t in b.column(0).to_pylist():
                df[features(t, p)[0]] += 1
                n += 1
        i = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], i))), pa.array(np.concatenate(([n], df[i])))], names=["idx", "df"])

    return docs.select(text_col).mapInArrow(count, "idx long, df long").groupBy("idx").agg(F.sum("df").alias("df"))


def _idf(df: dict[int, int], p: KnnParams) -> np.ndarray:
    n = df.get(-1, 0)
    d = np.zeros(p.size)
    for i, c in df.items():
        if i >= 0:
            d[i] = c
    return np.log((1 + n) / (1 + d)) + 0.1


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _dense(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    """Unit vectors of a block of texts: tf-idf, and the two shares of repeats beside
    it with a weight of their own."""
    x = np.zeros((len(rows), len(idf)), dtype=np.float32)
    for r, (i, n) in enumerate(rows):
        x[r, i] = np.where(i < len(idf) - 2, (1 + np.log(np.maximum(n, 1))) * idf[i], 0)
    x = _unit(x)
    for r, (i, n) in enumerate(rows):
        s = i >= len(idf) - 2
        x[r, i[s]] = REPEATS * n[s]
    return _unit(x)


def latent_space(rows: list, idf: np.ndarray, p: KnnParams) -> np.ndarray:
    """size x dims basis: randomised truncated SVD with two power iterations."""
    k = min(p.dims, len(rows))
    blocks = lambda: (_dense(rows[i:i + p.block], idf) for i in range(0, len(rows), p.block))
    q = np.random.default_rng(p.seed).standard_normal((len(idf), min(k + 16, len(idf)))).astype(np.float32)
    for _ in range(3):
        y = np.linalg.qr(np.concatenate([b @ q for b in blocks()]))[0]
        z = np.zeros((len(idf), y.shape[1]), dtype=np.float32)
        for n, b in enumerate(blocks()):
            z += b.T @ y[n * p.block:n * p.block + len(b)]
        q = z
    u, s, _ = np.linalg.svd(q, full_matrices=False)
    return np.ascontiguousarray(u[:, :k]).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, p: KnnParams = KnnParams(), id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> dict:
    """Model of bounded size: idf, basis, labelled vectors and labels."""
    df = {r["idx"]: r["df"] for r in document_counts(docs, p, text_col).collect()}  # at most p.size + 1 rows
    idf = _idf(df, p)
    known = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .filter("_id is not null and _y is not null").filter(~held_out(F.col("_id")))
        .groupBy("_id").agg(F.max("_y").alias("_y"))
    )
    totals = {r["y"]: r["n"] for r in known.groupBy((F.col("_y") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    order = (F.xxhash64("_id", F.lit(p.seed)), F.col("_id"))
    known = written(known.filter("_y > 0").orderBy(*order).limit(p.max_per_class).unionByName(
        known.filter("_y <= 0").orderBy(*order).limit(p.max_per_class)), "quality-sample")
    sample = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(known), "_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            f = [features(t, p) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([i for i, _ in f], pa.list_(pa.int64())), pa.array([n for _, n in f], pa.list_(pa.float64())), b.column(3)],
                names=["_id", "_y", "i", "n", "h"])

    feats = sample.select("_id", "_t", "_y", F.xxhash64("_t").alias("h")).mapInArrow(
        extract, "_id long, _y int, i array<long>, n array<double>, h long")
    feats = feats.groupBy("h").agg(F.max("_y").alias("_y"), F.min(F.struct("_id", "i", "n")).alias("r")).select("r._id", "_y", "r.i", "r.n")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            rows += [(i, y, (np.asarray(f.values), np.asarray(n.values))) for i, y, f, n in
                     zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3))]
        rows = sorted((r for r in rows if len(r[2][0])), key=lambda r: r[0])
        if not rows:
            return
        basis = latent_space([r[2] for r in rows], idf, p)
        vec = np.concatenate([_dense([r[2] for r in rows[i:i + p.block]], idf) @ basis for i in range(0, len(rows), p.block)])
        y = np.array([r[1] > 0 for r in rows], dtype=np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (basis, _unit(vec), y)], names=["basis", "vectors", "labels"])

    got = feats.coalesce(1).mapInArrow(learn, "basis binary, vectors binary, labels binary").collect()
    if not got:
        return {"idf": idf, "basis": None}
    y = np.frombuffer(got[0]["labels"], np.float32)
    # each sampled vector stands for so many labelled documents of its class
    stands_for = np.where(y > 0, totals.get(True, 0) / max(1, (y > 0).sum()), totals.get(False, 0) / max(1, (y <= 0).sum()))
    return {"idf": idf, "basis": np.frombuffer(got[0]["basis"], np.float32).reshape(p.size, -1),
            "vectors": np.frombuffer(got[0]["vectors"], np.float32).reshape(len(y), -1), "labels": y, "stands_for": stands_for}


def vote(rows: list, model: dict, p: KnnParams) -> np.ndarray:
    """Scores of a block of feature rows."""
    if model["basis"] is None:
        return np.full(len(rows), 0.5)
    y = model["labels"]
    d = _unit(_dense(rows, model["idf"]) @ model["basis"])
    s = d @ model["vectors"].T
    k = min(p.k, s.shape[1])
    near = np.argpartition(-s, k - 1, axis=1)[:, :k]
    w = np.maximum(np.take_along_axis(s, near, axis=1), 0).astype(np.float64) ** p.power * model["stands_for"][near]
    total = w.sum(axis=1)
    prior = float((y * model["stands_for"]).sum() / model["stands_for"].sum())
    score = np.where(total > 0, (w * y[near]).sum(axis=1) / np.where(total > 0, total, 1), prior)
    return np.where([len(i) > 0 for i, _ in rows], np.clip(score, 0, 1), prior)


def score(docs: DataFrame, model: dict, p: KnnParams = KnnParams(), text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            for i in range(0, b.num_rows, p.block):
                part = b.slice(i, p.block)
                s = vote([features(t, p) for t in part.column(at).to_pylist()], shipped.value, p)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64())], names=[*part.schema.names, score_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))
