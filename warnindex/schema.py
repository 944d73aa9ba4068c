"""Schemas of the tables the library reads and writes, and column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Raw message files: every known column read as text, cast later with try_*.
RAW = T.StructType(
    [
        T.StructField("DATE", T.StringType()),
        T.StructField("CODE", T.StringType()),
        T.StructField("TYPE", T.StringType()),
        T.StructField("WARNING / ALERT AREA NAME", T.StringType()),
        T.StructField("AREA", T.StringType()),
        T.StructField("timeSeverityChanged", T.StringType()),
        T.StructField("timeMessageChanged", T.StringType()),
    ]
)

# Clean message table.
WARNINGS = T.StructType(
    [
        T.StructField("fwdCode", T.StringType()),
        T.StructField("timeRaised", T.TimestampNTZType()),
        T.StructField("severity", T.StringType()),
        T.StructField("severityLevel", T.IntegerType()),
        T.StructField("isTidal", T.BooleanType()),
    ]
)

# Area dimension.
AREAS = T.StructType(
    [
        T.StructField("fwdCode", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("county", T.StringType()),
        T.StructField("riverOrSea", T.StringType()),
        T.StructField("isTidal", T.BooleanType()),
    ]
)

# Landed area items (P20).
ITEMS = T.StructType([T.StructField(c, T.StringType()) for c in ("notation", "label", "description", "county", "riverOrSea")])

BASELINE = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("fluvial_score", T.DoubleType()),
        T.StructField("coastal_score", T.DoubleType()),
        T.StructField("total_score", T.DoubleType()),
        T.StructField("fluvial_hours", T.DoubleType()),
        T.StructField("coastal_hours", T.DoubleType()),
        T.StructField("fluvial_events", T.LongType()),
        T.StructField("coastal_events", T.LongType()),
    ]
)


class MissingColumnsError(ValueError):
    """Raised when a frame lacks columns an operator needs."""


def missing_columns(df: DataFrame, required) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required, what: str = "input") -> None:
    """Driver-side check on the (static) schema; no Spark job is run."""
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumnsError(f"{what} lacks the columns {missing}")
