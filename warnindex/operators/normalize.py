"""Schema normalisation of raw message rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warnindex.functions.severity import severity_level
from warnindex.functions.timeparse import parse_timestamp
from warnindex.params import RAW_COLUMN_NAMES, REQUIRED_COLUMNS, TIMESTAMP_COLUMNS
from warnindex.schema import require_columns


def rename_raw_columns(df: DataFrame) -> DataFrame:
    """Source names -> schema names, only for columns that are present.  Where a
    column is there under both names, the schema's own comes first."""
    for raw, name in RAW_COLUMN_NAMES.items():
        if raw in df.columns and name in df.columns:
            df = df.withColumn(name, F.coalesce(F.col(f"`{name}`"), F.col(f"`{raw}`"))).drop(raw)
        elif raw in df.columns:
            df = df.withColumnRenamed(raw, name)
    return df


def with_severity_level(df: DataFrame) -> DataFrame:
    """severityLevel from the raw text (kept verbatim in ``severity``)."""
    if "severity" not in df.columns:
        return df
    return df.withColumn("severityLevel", severity_level("severity"))


def normalize_schema(df: DataFrame) -> DataFrame:
    """P1 + P2 + P4 (required columns after mapping)."""
    out = with_severity_level(rename_raw_columns(df))
    require_columns(out, REQUIRED_COLUMNS, "message table")
    return out


def parse_timestamps(df: DataFrame, require_offset: bool = False) -> DataFrame:
    """P5: up to three time columns -> TIMESTAMP_NTZ; native times are kept."""
    out = df
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for c in TIMESTAMP_COLUMNS:
        if c not in types:
            continue
        dt = types[c]
        if isinstance(dt, T.TimestampNTZType):
            continue
        if isinstance(dt, (T.TimestampType, T.DateType)):
            out = out.withColumn(c, F.col(c).cast("timestamp_ntz"))
        else:
            out = out.withColumn(c, parse_timestamp(c, require_offset))
    return out


def unmapped_severities(df: DataFrame) -> DataFrame:
    """Texts that map to no level, with their row counts."""
    return (
        df.where(F.col("severityLevel").isNull() & F.col("severity").isNotNull())
        .groupBy("severity")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def null_timestamps(df: DataFrame) -> DataFrame:
    """Null count per time column present (one pass)."""
    cols = [c for c in TIMESTAMP_COLUMNS if c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in cols],
    )
