"""Annual totals by class and severity.

All years in one job: a single ``groupBy("year")`` with conditional sums, so
the map side pre-aggregates (partial ``HashAggregate``) and only one row per
year and task crosses the shuffle, however the messages are skewed.
Seconds are summed as BIGINT and turned into hours once, after the sum.
The wide aggregate lists are written as Spark SQL expressions (one parse per
aggregate instead of a dozen Column calls; the plan is the same).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warnindex.params import BREAKDOWN_LEVELS
from warnindex.schema import require_columns

COMPONENTS = ("fluvial", "coastal", "other")


def component(c="isTidal") -> Column:
    """False -> fluvial, true -> coastal, null -> other."""
    col = F.col(c)
    return F.when(col.isNull(), "other").when(col, "coastal").otherwise("fluvial")


def _is(comp: str) -> Column:
    t = F.col("isTidal")
    if comp == "fluvial":
        return t == F.lit(False)
    if comp == "coastal":
        return t == F.lit(True)
    return t.isNull()


def _hours(sec_sum: Column) -> Column:
    return F.coalesce(sec_sum, F.lit(0)).cast("double") / F.lit(3600.0)


def year_range(year: int, time_col: str = "timeRaised") -> Column:
    """``year(t) == year`` written as a half-open range, which the parquet
    scan can use (row-group statistics), unlike a function of the column."""
    t = F.col(time_col)
    lo = F.expr(f"TIMESTAMP_NTZ '{int(year):04d}-01-01 00:00:00'")
    hi = F.expr(f"TIMESTAMP_NTZ '{int(year) + 1:04d}-01-01 00:00:00'")
    return (t >= lo) & (t < hi)


def filter_year(df: DataFrame, year: int, time_col: str = "timeRaised") -> DataFrame:
    """Rows of one calendar year (null times dropped)."""
    return df.where(year_range(year, time_col))


def with_year(df: DataFrame, time_col: str = "timeRaised") -> DataFrame:
    """F8: calendar year of the raise time; rows without a time are dropped."""
    return df.withColumn("year", F.year(time_col)).where(F.col("year").isNotNull())


def annual_total(scored: DataFrame) -> DataFrame:
    """A1: per year score, events, hours over all messages."""
    return with_year(scored).groupBy("year").agg(
        _hours(F.sum("score_seconds")).alias("total_score"),
        F.count(F.lit(1)).alias("total_events"),
        _hours(F.sum("duration_seconds")).alias("total_hours"),
    )


_COND_SQL = {"fluvial": "isTidal = false", "coastal": "isTidal = true", "other": "isTidal IS NULL"}


def _hours_sql(sum_sql: str) -> str:
    return f"CAST(coalesce({sum_sql}, 0) AS DOUBLE) / 3600.0D"


def _class_aggs() -> list[Column]:
    exprs = []
    for comp in COMPONENTS:
        cond = _COND_SQL[comp]
        exprs += [
            f"{_hours_sql(f'sum(CASE WHEN {cond} THEN score_seconds END)')} AS {comp}_score",
            f"count_if({cond}) AS {comp}_events",
            f"{_hours_sql(f'sum(CASE WHEN {cond} THEN duration_seconds END)')} AS {comp}_hours",
        ]
    exprs += [
        f"{_hours_sql('sum(score_seconds)')} AS total_score",
        "count(1) AS total_events",
        f"{_hours_sql('sum(duration_seconds)')} AS total_hours",
    ]
    return [F.expr(e) for e in exprs]


def _level_count_aggs(levels=BREAKDOWN_LEVELS) -> list[Column]:
    names = {1: "severe_warnings", 2: "flood_warnings", 3: "flood_alerts"}
    return [F.expr(f"count_if(severityLevel = {int(lv)}) AS {names.get(lv, f'level{lv}_events')}") for lv in levels]


def annual_by_class(scored: DataFrame, with_level_counts: bool = False) -> DataFrame:
    """A2: per year score/events/hours for fluvial, coastal, other and total."""
    if "isTidal" not in scored.columns:
        raise ValueError("annual_by_class needs an isTidal column (join the area dimension first)")
    aggs = _class_aggs() + (_level_count_aggs() if with_level_counts else [])
    return with_year(scored).groupBy("year").agg(*aggs)


def severity_breakdown(scored: DataFrame, levels=BREAKDOWN_LEVELS) -> DataFrame:
    """A3: per year and level 1-3, zero-filled: count, hours, score."""
    return _breakdown(scored, ("total",), levels)


def breakdown_by_class(scored: DataFrame, levels=BREAKDOWN_LEVELS) -> DataFrame:
    """A4: (year, component, level) for fluvial/coastal/other plus their total,
    zero-filled.  One conditional aggregate per year, unpivoted with ``stack``
    (no grouping-set row expansion, no cross join to fill zeros)."""
    if "isTidal" not in scored.columns:
        raise ValueError("breakdown_by_class needs an isTidal column")
    return _breakdown(scored, COMPONENTS + ("total",), levels)


def _breakdown(scored: DataFrame, comps, levels) -> DataFrame:
    aggs, stack_args = [], []
    for comp in comps:
        for lv in levels:
            cond = f"severityLevel = {int(lv)}" + ("" if comp == "total" else f" AND {_COND_SQL[comp]}")
            tag = f"{comp}_{lv}"
            aggs += [
                f"count_if({cond}) AS n_{tag}",
                f"coalesce(sum(CASE WHEN {cond} THEN duration_seconds END), 0) AS h_{tag}",
                f"coalesce(sum(CASE WHEN {cond} THEN score_seconds END), 0) AS s_{tag}",
            ]
            stack_args.append(f"'{comp}', {lv}, n_{tag}, h_{tag}, s_{tag}")
    wide = with_year(scored).groupBy("year").agg(*[F.expr(a) for a in aggs])
    n = len(stack_args)
    longf = wide.selectExpr(
        "year",
        f"stack({n}, {', '.join(stack_args)}) AS (component, severityLevel, event_count, duration_seconds, score_seconds)",
    )
    out = longf.selectExpr(
        "year",
        "component",
        "CAST(severityLevel AS INT) AS severityLevel",
        "CAST(event_count AS BIGINT) AS event_count",
        "CAST(duration_seconds AS DOUBLE) / 3600.0D AS total_hours",
        "CAST(score_seconds AS DOUBLE) / 3600.0D AS weighted_score",
    )
    if comps == ("total",):
        out = out.drop("component")
    return out


def class_counts(df: DataFrame, by_year: bool = True) -> DataFrame:
    """Messages per year, and fluvial (isTidal false) / coastal
    (isTidal true) counts; null isTidal is in neither class."""
    require_columns(df, ("timeRaised", "isTidal"), "class_counts")
    aggs = [
        F.count(F.lit(1)).alias("total_warnings"),
        F.count_if(F.col("isTidal") == F.lit(False)).alias("fluvial_warnings"),
        F.count_if(F.col("isTidal") == F.lit(True)).alias("coastal_warnings"),
    ]
    if by_year:
        return with_year(df).groupBy("year").agg(*aggs)
    return df.agg(*aggs)
