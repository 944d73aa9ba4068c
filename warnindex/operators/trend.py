"""Trend over the yearly summary.

The input is the year-level table (one row per year), so the global
``Window.orderBy("year")`` of W2 and the ungrouped aggregates run over as
many rows as there are years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warnindex.functions.text import arrow, bar


def _pct(new, old):
    """(new / old - 1) * 100, null when old is 0 (the original raises)."""
    return F.when(old != F.lit(0.0), (new / old - F.lit(1.0)) * F.lit(100.0))


def year_on_year(summary: DataFrame) -> DataFrame:
    """Composite change from the previous year (rounded values, N9)."""
    w = Window.orderBy("year")
    d = summary.select(
        "year",
        F.lag("year").over(w).alias("prev_year"),
        "composite_index",
        F.lag("composite_index").over(w).alias("prev_composite_index"),
    ).where(F.col("prev_year").isNotNull())
    change = F.col("composite_index") - F.col("prev_composite_index")
    return d.select(
        "prev_year",
        "year",
        "prev_composite_index",
        "composite_index",
        change.alias("change_pts"),
        _pct(F.col("composite_index"), F.col("prev_composite_index")).alias("change_pct"),
        arrow(change).alias("direction"),
    )


def endpoint_change(summary: DataFrame) -> DataFrame:
    """Last minus first year for the composite and both components.

    "From the first year" (N18), not from the configured baseline year.
    Components get points and a true percentage (N24).
    """
    y = F.col("year")
    first = {c: F.min_by(c, y) for c in ("composite_index", "fluvial_index", "coastal_index")}
    last = {c: F.max_by(c, y) for c in ("composite_index", "fluvial_index", "coastal_index")}
    d = summary.agg(
        F.min(y).alias("first_year"),
        F.max(y).alias("last_year"),
        *[first[c].alias(f"first_{c}") for c in first],
        *[last[c].alias(f"last_{c}") for c in last],
    )
    cols = ["first_year", "last_year"]
    for c, name in (("composite_index", "composite"), ("fluvial_index", "fluvial"), ("coastal_index", "coastal")):
        a, b = F.col(f"first_{c}"), F.col(f"last_{c}")
        d = d.withColumn(f"{name}_change_pts", b - a).withColumn(f"{name}_change_pct", _pct(b, a))
        cols += [f"first_{c}", f"last_{c}", f"{name}_change_pts", f"{name}_change_pct"]
    d = d.withColumn("direction", arrow(F.col("composite_change_pts")))
    return d.select(*cols, "direction")


def extreme_years(summary: DataFrame) -> DataFrame:
    """Lowest and highest composite year; the earlier year wins ties."""
    c, y = F.col("composite_index"), F.col("year")
    return summary.agg(
        F.min_by(y, F.struct(c, y)).alias("lowest_year"),
        F.min(c).alias("lowest_composite"),
        F.max_by(y, F.struct(c, -y)).alias("highest_year"),
        F.max(c).alias("highest_composite"),
    )


def trend_totals(summary: DataFrame) -> DataFrame:
    """Total messages over the years and the mean per year."""
    return summary.agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count(F.lit(1)).alias("n_years"),
        F.sum("total_warnings").alias("total_warnings"),
        F.avg("total_warnings").alias("avg_warnings_per_year"),
    )


def trend_bars(summary: DataFrame, step: float = 5.0) -> DataFrame:
    """one '#' per whole 5 index points, per year and component."""
    return summary.select(
        "year",
        "fluvial_index",
        bar("fluvial_index", step).alias("fluvial_bar"),
        "coastal_index",
        bar("coastal_index", step).alias("coastal_bar"),
    )
