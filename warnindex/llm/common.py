"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warnindex.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts lineage: a lost executor costs a re-read, never a recomputation of
    what came before, and every consumer reads the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that does not clash with those of ``df`` (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id) -> F.Column:
    """True where crc32(doc_id as text) mod 3 is 1: rows never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def arrow_rows(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slice record batches so that no slice holds much more than ``max_bytes``
    (a single longer row is a slice of its own); bounds what a task decodes at once."""
    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        step = max(1, int(n * max_bytes / max(b.nbytes, 1)))
        for i in range(0, n, step):
            yield b.slice(i, step)


def run_bounds(key: np.ndarray) -> np.ndarray:
    """Start offsets of runs of equal keys, closed by the length."""
    if len(key) == 0:
        return np.zeros(1, dtype=np.int64)
    cut = np.flatnonzero(key[1:] != key[:-1]) + 1
    return np.concatenate(([0], cut, [len(key)])).astype(np.int64)
