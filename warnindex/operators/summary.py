"""Data summary, histograms, sampling and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warnindex.operators.normalize import null_timestamps


def data_summary(df: DataFrame) -> DataFrame:
    """A5: rows, distinct areas (a null code counts as one value, N7), first
    and last raise time; one aggregate pass."""
    code = F.col("fwdCode")
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        (F.count_distinct(code) + F.coalesce(F.max(code.isNull().cast("int")), F.lit(0))).cast("bigint").alias("unique_warning_areas"),
        F.min("timeRaised").alias("earliest"),
        F.max("timeRaised").alias("latest"),
    )


def severity_histogram(df: DataFrame) -> DataFrame:
    """Rows per level, null level kept, ordered by level (nulls first)."""
    return df.groupBy("severityLevel").agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("severityLevel").asc_nulls_first())


def class_histogram(df: DataFrame) -> DataFrame | None:
    """Rows per isTidal value (only when the column exists)."""
    if "isTidal" not in df.columns:
        return None
    return df.groupBy("isTidal").agg(F.count(F.lit(1)).alias("count"))


def missing_timestamps(df: DataFrame) -> DataFrame:
    """Null count for each time column present."""
    return null_timestamps(df)


def sample_rows(scored: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` messages by area and time (a top-k, not a full sort)."""
    order = [c for c in ("fwdCode", "timeRaised", "msg_id") if c in scored.columns]
    return scored.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


def union_sources(frames) -> DataFrame:
    """Stack frames of identical schema (by name; a differing set of
    columns is an error)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), list(frames))


def distinct_codes(df: DataFrame) -> DataFrame:
    """The area codes present."""
    return df.select("fwdCode").distinct()


def summary_report(df: DataFrame) -> dict[str, DataFrame]:
    """A5-A8 together: totals and date range, severity histogram, missing
    times, class histogram (when the class column exists)."""
    out = {
        "summary": data_summary(df),
        "severity_distribution": severity_histogram(df),
        "missing_timestamps": missing_timestamps(df),
    }
    tidal = class_histogram(df)
    if tidal is not None:
        out["tidal_distribution"] = tidal
    return out
