"""Corpus pipeline: toxicity, SimHash near-duplicates, benchmark decontamination,
secret redaction, mixing to target weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that the stage before it kept.  All but the last return the columns of
documents; the last adds ``copies``, how many times a document is to be used.
``run`` writes every stage's rows as Parquet in the shared folder and rereads
them for the next, so a lost executor never sets back more than one stage.

Defined results are those of the operators: null and empty texts are kept by
the first stage, collapse to one document in the second, hold no leak and no
secret, and are not selected by the last, as they have no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from warnindex.llm import decontaminate, mixing, secrets, simhash_dedup, toxicity
from warnindex.llm.common import table, written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7 for toxicity."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each SimHash component (4-word shingles, 4 bits)."""
    return simhash_dedup.keep_one(docs, shingle=4, max_bits=4)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents selected for the target weights, with ``copies``."""
    return mixing.mix_by_source(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", remove_leaks),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
]

ORACLE_SQL = None  # SQL cannot express the first three stages; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
