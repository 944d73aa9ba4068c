"""I4 / I7 kept up to date year by year.

Messages live in a table partitioned by year (S7), their annual totals (A2, one row a
year) in a second one, and a third records which years changed since.  With
``gap_scope="year"`` no duration crosses a year, so new messages touch the totals of
their own years only: a refresh reads those partitions and replaces their totals, and the index is
arithmetic on a row per year.

Order of writes, so that a run that breaks off loses nothing: the changed years are recorded before the
messages are appended, and marked as done after their totals are replaced.  A refresh that is repeated gives the
same totals.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warnindex.operators.durations import calculate_durations
from warnindex.operators.index import indicators_from_annual
from warnindex.operators.scoring import annual_by_class
from warnindex.params import DurationParams, IndexParams
from warnindex.sources.files import read_year, stage_table

CHANGES = T.StructType([T.StructField("batch", T.StringType()), T.StructField("changed_year", T.IntegerType()), T.StructField("done", T.BooleanType())])
YEAR_RULE = DurationParams(gap_scope="year")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _record(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    if rows:
        spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(path)


def append_messages(messages: DataFrame, table_path: str, changes_path: str) -> list[int]:
    """Add messages to the yearly table; the years they fall in, which are recorded as changed.  Messages
    without a time belong to no year and are left out, as in ``write_yearly``."""
    spark = messages.sparkSession
    new = stage_table(messages.withColumn("year", F.year("timeRaised")).where(F.col("year").isNotNull()), "appended")
    years = sorted(r["year"] for r in new.select("year").distinct().collect())  # a row a year
    if years:
        batch = uuid.uuid4().hex
        _record(spark, changes_path, [(batch, y, False) for y in years])
        new.hint("rebalance", "year").write.mode("append").partitionBy("year").parquet(table_path)
    return years


def changed_years(spark: SparkSession, changes_path: str) -> list[tuple[str, int]]:
    """(batch, year) recorded as changed and not yet refreshed."""
    if not _exists(spark, changes_path):
        return []
    log = spark.read.schema(CHANGES).parquet(changes_path)
    open_ = log.groupBy("batch", "changed_year").agg(F.bool_or("done").alias("done")).where(~F.col("done"))
    return sorted((r["batch"], r["changed_year"]) for r in open_.collect())


def changed_messages(spark: SparkSession, table_path: str, years) -> DataFrame:
    """The messages of the given years, by partition pruning."""
    return read_year(spark, table_path).where(F.col("year").isin(*years)).drop("year")


def _rule(duration: DurationParams) -> str:
    if duration.gap_scope != "year":
        raise ValueError("totals are refreshed by year only where gaps do not cross years (gap_scope='year')")
    return repr(duration)


def refresh_totals(spark: SparkSession, table_path: str, totals_path: str, changes_path: str,
                   duration: DurationParams = YEAR_RULE) -> list[int]:
    """Compute the totals of the changed years again and replace them; the years refreshed.  A year whose messages
    are all gone gets a total of no events."""
    rule = _rule(duration)
    pending = changed_years(spark, changes_path)
    years = sorted({y for _, y in pending})
    if not years:
        return []
    fresh = annual_by_class(calculate_durations(changed_messages(spark, table_path, years), duration), with_level_counts=True)
    every = spark.createDataFrame([(y,) for y in years], "year int")
    out = every.join(fresh, "year", "left").withColumns({"total_events": F.coalesce("total_events", F.lit(0).cast("bigint")), "rule": F.lit(rule)})
    out.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(totals_path)
    _record(spark, changes_path, [(b, y, True) for b, y in pending])
    return years


def stored_totals(spark: SparkSession, totals_path: str, duration: DurationParams = YEAR_RULE) -> DataFrame:
    """The A2 table with level counts; an error where totals were made by other duration rules."""
    totals = spark.read.parquet(totals_path)
    others = [r["year"] for r in totals.where(F.col("rule") != F.lit(_rule(duration))).select("year").collect()]
    if others:
        raise ValueError(f"the totals of {sorted(others)} were made by other duration rules: refresh these years")
    return totals.where(F.col("total_events") > 0).drop("rule")


def index_from_totals(spark: SparkSession, totals_path: str, duration: DurationParams = YEAR_RULE,
                      index: IndexParams | None = None) -> DataFrame:
    """I4 from the stored totals: no message is read."""
    return indicators_from_annual(stored_totals(spark, totals_path, duration), index)
