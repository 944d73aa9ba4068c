"""Area dimension: region restriction, class join, area builder, tallies
(P7, P8, J1, P18-P22, J5, A13, A14).

The area dimension is small by nature but is broadcast only behind a
checked row bound (``broadcast_if_small``); above it the join is left to
Spark (sort-merge, or an AQE runtime broadcast on the measured size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warnindex.functions.text import class_from_text, contains_any
from warnindex.session import broadcast_if_small

AREA_BROADCAST_MAX_ROWS = 1_000_000


class EmptyRegionError(ValueError):
    """The area set is empty."""


def check_region(areas: DataFrame) -> DataFrame:
    """An empty area set is an error (one bounded job)."""
    if areas.isEmpty():
        raise EmptyRegionError("the area table is empty")
    return areas


def _area_classes(areas: DataFrame) -> DataFrame:
    cols = ["fwdCode", "isTidal"] if "isTidal" in areas.columns else ["fwdCode"]
    return areas.select(*cols).dropDuplicates(["fwdCode"])


def region_filter(df: DataFrame, areas: DataFrame) -> DataFrame:
    """Keep messages whose area code is in the area set (semi join)."""
    codes = broadcast_if_small(areas.select("fwdCode").distinct(), AREA_BROADCAST_MAX_ROWS)
    return df.join(codes, "fwdCode", "left_semi")


def join_class(df: DataFrame, areas: DataFrame) -> DataFrame:
    """P8 + J1: drop any existing class column, left-join the area's isTidal."""
    dim = broadcast_if_small(_area_classes(areas), AREA_BROADCAST_MAX_ROWS)
    return df.drop("isTidal").join(dim, "fwdCode", "left")


def restrict_to_region(df: DataFrame, areas: DataFrame, require_areas: bool = False) -> DataFrame:
    """P7 + P8 + J1 as one inner join: filter then left join == inner join.

    ``require_areas``: an empty area set is an error (P22); the same bounded
    count decides the broadcast, so the check costs no extra job."""
    dim = _area_classes(areas)
    n = dim.limit(AREA_BROADCAST_MAX_ROWS + 1).count()
    if require_areas and n == 0:
        raise EmptyRegionError("the area table is empty")
    if n <= AREA_BROADCAST_MAX_ROWS:
        dim = F.broadcast(dim)
    return df.drop("isTidal").join(dim, "fwdCode", "inner")


def county_filter(areas: DataFrame, counties) -> DataFrame:
    """Areas whose county text names any of the counties (substring)."""
    return areas.where(contains_any("county", counties))


def areas_from_items(items: DataFrame) -> DataFrame:
    """P19 + P20: landed area records -> area dimension with isTidal."""
    def opt(c, default=None):
        if c in items.columns:
            return F.col(c) if default is None else F.coalesce(F.col(c), F.lit(default))
        return F.lit(default).cast("string")

    return items.select(
        opt("notation").alias("fwdCode"),
        opt("label").alias("label"),
        opt("description", "").alias("description"),
        opt("county").alias("county"),
        opt("riverOrSea", "").alias("riverOrSea"),
        class_from_text(opt("riverOrSea", "")).alias("isTidal"),
    )


def county_tallies(areas: DataFrame, counties) -> DataFrame:
    """J5 + A13: areas per county, zero-filled; a multi-county area counts
    once in every county its text names.  The county list is a parameter,
    so the contains-join is written as one conditional count per county in a
    single aggregate, unpivoted with ``stack`` (no pair join)."""
    counties = list(counties)
    aggs = [F.count_if(contains_any("county", [c])).alias(f"c{i}") for i, c in enumerate(counties)]
    wide = areas.agg(*aggs)
    args = ", ".join(f"{_sql_str(c)}, c{i}" for i, c in enumerate(counties))
    return wide.selectExpr(f"stack({len(counties)}, {args}) AS (county, area_count)")


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def area_class_counts(areas: DataFrame) -> DataFrame:
    """Total, fluvial and coastal area counts."""
    t = F.col("isTidal")
    return areas.agg(
        F.count(F.lit(1)).alias("total_areas"),
        F.count_if(t == F.lit(False)).alias("fluvial_areas"),
        F.count_if(t == F.lit(True)).alias("coastal_areas"),
    )


AREA_METADATA = ("description string, region string, counties array<string>, fetched_at string, total_areas bigint, fluvial_areas bigint, "
                 "coastal_areas bigint, areas_by_county map<string,bigint>")


def area_metadata(areas: DataFrame, region: str, counties, fetched_at: str | None) -> DataFrame:
    """One row about the area table, from one aggregate over it."""
    counties = list(counties)
    t = F.col("isTidal")
    by = [F.count_if(contains_any("county", [c])).alias(f"_c{i}") for i, c in enumerate(counties)]
    d = areas.agg(F.count(F.lit(1)).alias("total_areas"), F.count_if(t == F.lit(False)).alias("fluvial_areas"), F.count_if(t == F.lit(True)).alias("coastal_areas"), *by)
    pairs = [x for i, c in enumerate(counties) for x in (F.lit(c), F.col(f"_c{i}"))]
    return d.select(
        F.lit(f"Warning areas of {region}").alias("description"), F.lit(region).alias("region"), F.array(*map(F.lit, counties)).cast("array<string>").alias("counties"),
        F.lit(fetched_at).cast("string").alias("fetched_at"), "total_areas", "fluvial_areas", "coastal_areas",
        F.create_map(*pairs).cast("map<string,bigint>").alias("areas_by_county"))


def flood_areas(areas: DataFrame, county: str | None = None) -> DataFrame:
    """Optional county predicate over landed areas (falsy = all)."""
    return county_filter(areas, [county]) if county else areas


def current_floods(floods: DataFrame, severity: int | None = None) -> DataFrame:
    """Optional severity predicate over landed current warnings."""
    return floods.where(F.col("severityLevel") == F.lit(int(severity))) if severity else floods
