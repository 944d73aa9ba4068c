"""Adapters from the driver's test tables to the message and area schemas.

These map the given parquet tables onto the warning schema so every query
runs over whole tables and grows with them.  The mapping choices are ours
(they exercise every branch of the rules); they are not domain facts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warnindex.functions.severity import severity_level
from warnindex.operators.regions import county_filter

# Regions of the test tables that play the part of the counties of the
# region of interest (AFRICA is outside it).
TEST_COUNTIES = ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
# Base year of the orders adapter (first year in the orders table).
ORDERS_BASELINE_YEAR = 1995


# Declared schemas of the test tables (as documented with the data), so a
# read needs no schema-inference job.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> messages: one area per user, sub-second times, all rule branches."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    sev = (
        F.when(F.col("event_type") == "error", "Severe Flood Warning")
        .when(F.col("event_type") == "purchase", " Flood Warning ")
        .when(F.col("event_type") == "click", "Update Flood Alert")
        .when(F.col("event_type") == "view", "Flood watch")
        .when(F.col("event_type") == "signup", "Warning No Longer in Force")
    )
    d = e.select(
        F.col("user_id").cast("string").alias("fwdCode"),
        F.col("ts").cast("timestamp_ntz").alias("timeRaised"),
        sev.alias("severity"),
        (F.col("user_id") % 2 == 1).alias("isTidal"),
        F.col("event_id").alias("msg_id"),
    )
    return d.withColumn("severityLevel", severity_level("severity"))


def orders_raw_messages(spark: SparkSession, sf_dir: str, areas: DataFrame | None = None) -> DataFrame:
    """orders + customer -> messages: area = customer's nation.  With
    ``areas`` the customers are first restricted to those areas and get the
    area class (isTidal), before the large orders join."""
    from warnindex.operators.regions import restrict_to_region

    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    if areas is not None:
        c = restrict_to_region(c.withColumn("fwdCode", F.col("c_nationkey").cast("string")), areas).drop("fwdCode")
    pr = F.col("o_orderpriority")
    sev = (
        F.when(pr == "1-URGENT", "Severe Flood Warning")
        .when(pr == "2-HIGH", "Flood Warning")
        .when(pr == "3-MEDIUM", "Flood Alert")
        .when((pr == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "F"), "Warning No Longer in Force")
        .when(pr == "4-NOT SPECIFIED", "Flood Bulletin")
        .when(pr == "5-LOW", "Update Flood Alert")
    )
    d = o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        F.col("c_nationkey").cast("string").alias("fwdCode"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timeRaised"),
        sev.alias("severity"),
        F.col("o_orderkey").alias("msg_id"),
        *(["isTidal"] if areas is not None else []),
    )
    return d.withColumn("severityLevel", severity_level("severity"))


def nation_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation + region -> area dimension.  Class: odd region coastal, even
    fluvial, region 4 unknown (null: the "other" class)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    rk = F.col("n_regionkey")
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("string").alias("fwdCode"),
        F.col("n_name").alias("label"),
        F.col("n_name").alias("description"),
        F.col("r_name").alias("county"),
        F.col("r_name").alias("riverOrSea"),
        F.when(rk == 4, F.lit(None).cast("boolean")).otherwise(rk % 2 == 1).alias("isTidal"),
    )


def region_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region of interest: nation areas in the test counties."""
    return county_filter(nation_areas(spark, sf_dir), TEST_COUNTIES)


def supplier_area_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier + nation + region -> records shaped like landed area items
    (notation, label, description, county, riverOrSea)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("s_suppkey")
    river = (
        F.when(k % 8 == 0, "River Avon")
        .when(k % 8 == 1, "Severn Estuary")
        .when(k % 8 == 2, "Bristol Channel")
        .when(k % 8 == 3, "Seaton Brook")
        .when(k % 8 == 4, "Tidal Frome")
        .when(k % 8 == 5, "Ellerholt Brook")
        .when(k % 8 == 6, "North COAST")
    )
    county = F.when(k % 4 == 0, F.concat(F.col("r_name"), F.lit(", City of "), F.col("n_name"))).otherwise(F.col("r_name"))
    return (
        s.join(n, s.s_nationkey == n.n_nationkey, "inner")
        .join(r, F.col("n_regionkey") == r.r_regionkey, "inner")
        .select(
            k.cast("string").alias("notation"),
            F.col("s_name").alias("label"),
            F.col("n_name").alias("description"),
            county.alias("county"),
            river.alias("riverOrSea"),
        )
    )


def quality_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem + orders -> messages with change times, for the quality checks.

    Area = supplier, raised = order date, severity changed = ship date,
    message changed = ship date of finished lines only (partly null),
    level from the line number: 1-4 -> 1, 2, 3, 1; 5 -> 2 (null when the
    return flag is N); 6 -> 9 (invalid); 7 -> 4, except for every fifth
    supplier (3), so those areas never close; class from the supplier key
    with every third supplier unknown.  Every 23rd order has no raise time,
    every 29th no severity change time.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    sk = F.col("l_suppkey")
    ln = F.col("l_linenumber")
    lvl = (
        F.when(ln == 7, F.when(sk % 5 == 0, F.lit(3)).otherwise(F.lit(4)))
        .when(ln == 6, F.lit(9))
        .when((ln == 5) & (F.col("l_returnflag") == "N"), F.lit(None))
        .otherwise((ln - 1) % 3 + 1)
    )
    # what follows from the line alone is computed before the join, so flags and texts do not cross its shuffle
    li = li.select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate",
        lvl.cast("int").alias("severityLevel"),
        (F.col("l_linestatus") == "F").alias("finished"),
        F.concat(F.lit("line "), F.col("l_returnflag"), F.col("l_linestatus")).alias("severity"),
    )
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        sk.cast("string").alias("fwdCode"),
        F.when(F.col("l_orderkey") % 23 != 0, F.col("o_orderdate").cast("timestamp_ntz")).alias("timeRaised"),
        "severity",
        "severityLevel",
        F.when(F.col("l_orderkey") % 29 != 0, F.col("l_shipdate").cast("timestamp_ntz")).alias("timeSeverityChanged"),
        F.when(F.col("finished"), F.col("l_shipdate").cast("timestamp_ntz")).alias("timeMessageChanged"),
        F.when(sk % 3 == 0, F.lit(None).cast("boolean")).otherwise(sk % 2 == 1).alias("isTidal"),
        F.col("l_orderkey").alias("msg_id"),
        F.col("l_linenumber").alias("line_no"),
    )


def lineitem_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> messages: area = supplier, raised = ship date; no unique
    id (duplicates and histograms only, never the lead window)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus")
    sev = (
        F.when(F.col("l_returnflag") == "R", "Flood Warning")
        .when(F.col("l_returnflag") == "A", "flood alert")
        .when(F.col("l_linestatus") == "F", "Warning No Longer in Force")
        .otherwise("Flood Outlook")
    )
    d = li.select(
        F.col("l_suppkey").cast("string").alias("fwdCode"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("timeRaised"),
        sev.alias("severity"),
    )
    return d.withColumn("severityLevel", severity_level("severity"))
