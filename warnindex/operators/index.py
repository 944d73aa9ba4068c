"""Normalised indices and the composite.

A fixed baseline is a literal.  A baseline taken from the data (A16) is read
off the annual table itself with a window over all of its rows: that table
has one row per year, so the window is a handful of rows in one task, and
the messages are aggregated once (a scalar subquery or a join would run the
whole duration computation a second time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warnindex.operators.scoring import annual_by_class
from warnindex.params import IndexParams

BASELINE_FIELDS = (
    "fluvial_score", "coastal_score", "total_score", "fluvial_hours", "coastal_hours",
    "fluvial_events", "coastal_events",
)


def baseline_row(annual: DataFrame, params: IndexParams) -> Column:
    """The baseline as a struct column, on every row of ``annual``."""
    if params.baseline is not None:
        b = params.baseline
        return F.struct(
            F.lit(int(b.year)).alias("year"),
            *[F.lit(float(getattr(b, f)) if "events" not in f else int(getattr(b, f))).alias(f)
              for f in BASELINE_FIELDS],
        )
    fields = F.struct(F.col("year"), *[F.col(f) for f in BASELINE_FIELDS])
    every_year = Window.partitionBy()  # year-level table: one row per year
    if params.baseline_year is None:
        # The first year in the data is the baseline.
        return F.min_by(fields, F.col("year")).over(every_year)
    return F.max(F.when(F.col("year") == F.lit(params.baseline_year), fields)).over(every_year)


def _index(score: Column, base: Column) -> Column:
    """Score / baseline * 100, or 0.0 when the baseline is not positive; null
    when there is no baseline (its year is not in the data)."""
    return F.when(base > F.lit(0.0), score / base * F.lit(100.0)).when(base.isNotNull(), F.lit(0.0))


def indicators_from_annual(annual: DataFrame, params: IndexParams | None = None) -> DataFrame:
    """I4 from an A2 table that carries the level counts."""
    p = params or IndexParams()
    b = baseline_row(annual, p)
    fi = _index(F.col("fluvial_score"), b.getField("fluvial_score"))
    ci = _index(F.col("coastal_score"), b.getField("coastal_score"))
    out = annual.select(
        "year",
        F.col("fluvial_score").alias("fluvial_score_raw"),
        F.col("coastal_score").alias("coastal_score_raw"),
        F.col("total_score").alias("total_score_raw"),
        fi.alias("fluvial_index"),
        ci.alias("coastal_index"),
        "fluvial_hours",
        "coastal_hours",
        "fluvial_events",
        "coastal_events",
        "total_events",
        "severe_warnings",
        "flood_warnings",
        "flood_alerts",
    )
    return out.withColumn(
        "composite_index",
        F.col("fluvial_index") * F.lit(p.fluvial_weight) + F.col("coastal_index") * F.lit(p.coastal_weight),
    )


def calculate_indicators(scored: DataFrame, params: IndexParams | None = None) -> DataFrame:
    """I4: one row per year with raw scores, indices, composite and counts."""
    return indicators_from_annual(annual_by_class(scored, with_level_counts=True), params)


def baseline_from_indicators(ind: DataFrame, year: int) -> DataFrame:
    """The row to persist as the baseline (only for the baseline year)."""
    return ind.where(F.col("year") == F.lit(year)).select(
        F.col("year").cast("int").alias("year"),
        F.col("fluvial_score_raw").alias("fluvial_score"),
        F.col("coastal_score_raw").alias("coastal_score"),
        F.col("total_score_raw").alias("total_score"),
        "fluvial_hours",
        "coastal_hours",
        F.col("fluvial_events").cast("bigint").alias("fluvial_events"),
        F.col("coastal_events").cast("bigint").alias("coastal_events"),
    )


def _change_label(idx: Column, up: str, down: str) -> Column:
    return F.when(idx > 100.0, up).when(idx < 100.0, down).otherwise("same")


def baseline_change(ind: DataFrame) -> DataFrame:
    """How each year compares with the baseline (= 100).

    ``composite_pct`` is the distance from 100 in points (the original's
    "% higher/lower"); an index of exactly 100 is labelled "same".
    """
    c = F.col("composite_index")
    return ind.select(
        "year",
        "composite_index",
        _change_label(c, "higher", "lower").alias("composite_vs_baseline"),
        F.abs(c - F.lit(100.0)).alias("composite_pct"),
        _change_label(F.col("fluvial_index"), "increase", "decrease").alias("fluvial_change"),
        F.abs(F.col("fluvial_index") - F.lit(100.0)).alias("fluvial_pct"),
        _change_label(F.col("coastal_index"), "increase", "decrease").alias("coastal_change"),
        F.abs(F.col("coastal_index") - F.lit(100.0)).alias("coastal_pct"),
    )


def yearly_summary(ind: DataFrame, first_year: int | None = None) -> DataFrame:
    """Year, message counts by class, indices rounded to 1 dp
    (half-even, F15).  The counts are the A2 event counts of the same job."""
    out = ind if first_year is None else ind.where(F.col("year") >= F.lit(first_year))
    return out.select(
        "year",
        F.col("total_events").alias("total_warnings"),
        F.col("fluvial_events").alias("fluvial_warnings"),
        F.col("coastal_events").alias("coastal_warnings"),
        F.bround("fluvial_index", 1).alias("fluvial_index"),
        F.bround("coastal_index", 1).alias("coastal_index"),
        F.bround("composite_index", 1).alias("composite_index"),
    )


def index_listing(ind: DataFrame, years) -> DataFrame:
    """I8: one line per requested year."""
    return ind.where(F.col("year").isin(list(years))).select(
        "year", "composite_index", "fluvial_index", "coastal_index"
    )
