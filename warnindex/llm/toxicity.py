"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: the set of its words, adjacent word pairs and pairs with one
word skipped, hashed into 2^bits coordinates (present or absent, so a long text
does not dilute what it holds).  FTRL-proximal keeps a rate per coordinate and
an L1 term that leaves most weights at exactly zero; what remains is a small
(coordinate, weight) table.

Learning uses a bounded sample: at most ``max_train`` labelled documents
(smallest hash of the id), distinct texts only.  Features are extracted in
parallel; FTRL itself is sequential and runs in one task over that bounded
sample.  The weights, at most 2^bits and in practice some hundreds, are
broadcast and every document is scored in one map pass without a shuffle.

Defined results: null and empty texts are scored by the bias alone; null labels
are ignored, conflicting labels of a document count as toxic; without any
usable label every score is 0.5; repeated rows are scored each; extra columns
are kept by ``score`` and clash with nothing (output names are parameters).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warnindex.llm.common import arrow_rows, fresh_name, held_out, written

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


@dataclass(frozen=True)
class FtrlParams:
    bits: int = 20
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 0.05  # per epoch, in units of the gradient noise of a feature that every document has
    l2: float = 0.0
    epochs: int = 12
    max_train: int = 12_000
    seed: int = 17


def hashed_features(text: str | None, bits: int = 20) -> np.ndarray:
    """Coordinates of all words, pairs and skip pairs, repeats included."""
    words = _WORD.findall((text or "").lower().encode("utf-8", "surrogatepass"))
    h = np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))
    shift = np.uint64(64 - bits)
    k1, k2, k3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    one = (h * k1 + k3) * k1 >> shift
    two = (h[:-1] * k1 + h[1:] * k2 + np.uint64(1)) * k1 >> shift
    skip = (h[:-2] * k1 + h[2:] * k2 + np.uint64(2)) * k1 >> shift
    return np.concatenate((one, two, skip)).astype(np.int32)


def ftrl(rows: list[np.ndarray], y: np.ndarray, p: FtrlParams) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes in a seeded order."""
    size = 1 << p.bits
    z, n = np.zeros(size), np.zeros(size)
    zb = nb = 0.0
    rate = float(np.mean(y)) if len(y) else 0.5
    l1 = p.l1 * p.epochs * np.sqrt(max(1.0, len(y) * rate * (1 - rate)))

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2))

    if len(y) == 0:
        return np.zeros(size), 0.0
    bias = np.log((rate + 1e-3) / (1 - rate + 1e-3))  # start at the base rate
    rng = np.random.default_rng(p.seed)
    for _ in range(p.epochs):
        for r in rng.permutation(len(y)):
            i = rows[r]
            w = weights(i)
            wb = bias - zb / ((p.beta + np.sqrt(nb)) / p.alpha)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + wb, -35, 35))) - y[r]
            sig = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / p.alpha
            z[i] += g - sig * w
            n[i] += g * g
            sb = (np.sqrt(nb + g * g) - np.sqrt(nb)) / p.alpha
            zb += g - sb * (wb - bias)
            nb += g * g
    return weights(np.arange(size)), float(bias - zb / ((p.beta + np.sqrt(nb)) / p.alpha))


def train(docs: DataFrame, labels: DataFrame, p: FtrlParams = FtrlParams(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(idx, weight)`` of the nonzero coordinates; the bias has idx -1."""
    known = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .filter("_id is not null and _y is not null").filter(~held_out(F.col("_id")))
        .groupBy("_id").agg(F.max("_y").alias("_y"))
        .orderBy(F.xxhash64("_id", F.lit(p.seed)), "_id").limit(p.max_train)
    )
    known = written(known, "toxic-sample")  # bounded by max_train
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    sample = texts.join(F.broadcast(known), "_id")
    bits = p.bits

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            f = [np.unique(hashed_features(t, bits)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(f, pa.list_(pa.int32())), b.column(3)], names=["_id", "_y", "f", "h"])

    feats = sample.select("_id", "_text", "_y", F.xxhash64("_text").alias("h")).mapInArrow(
        extract, "_id long, _y int, f array<int>, h long")
    feats = feats.groupBy("h").agg(F.max("_y").alias("_y"), F.min(F.struct("_id", "f")).alias("r")).select("r._id", "_y", "r.f")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            rows += [(i, y, np.asarray(f.values)) for i, y, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2))]
        rows.sort(key=lambda r: r[0])
        w, bias = ftrl([r[2] for r in rows], np.array([r[1] for r in rows], dtype=float), p)
        nz = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-1], nz)).astype(np.int64)), pa.array(np.concatenate(([bias], w[nz])))], names=["idx", "weight"])

    return feats.coalesce(1).mapInArrow(learn, "idx long, weight double")


def score(docs: DataFrame, weights: DataFrame, p: FtrlParams = FtrlParams(), text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col`` (prefixed by ``_`` where there is one).  ``weights``: at most 2^bits + 1 rows."""
    score_col = fresh_name(docs, score_col)
    got = weights.collect()
    table = np.zeros(1 << p.bits, dtype=np.float32)
    bias = 0.0
    for r in got:
        if r["idx"] < 0:
            bias = r["weight"]
        else:
            table[r["idx"]] = r["weight"]
    nz = np.flatnonzero(table)
    shipped = docs.sparkSession.sparkContext.broadcast((nz.astype(np.int32), table[nz], float(bias)))
    bits = p.bits
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, val, b0 = shipped.value
        w = np.zeros(1 << bits, dtype=np.float32)
        w[idx] = val

        def one(text):
            f = hashed_features(text, bits)
            f = np.unique(f[w[f] != 0])
            return 1 / (1 + np.exp(-np.clip(float(w[f].sum(dtype=np.float64)) + b0, -35, 35)))

        for b in arrow_rows(batches):
            s = pa.array([one(t) for t in b.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], names=[*b.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, p: FtrlParams = FtrlParams(),
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``; the columns of ``docs``."""
    name = fresh_name(docs, "toxicity_score")
    return score(docs, train(docs, labels, p, id_col, text_col), p, text_col, name).filter(F.col(name) < threshold).drop(name)
