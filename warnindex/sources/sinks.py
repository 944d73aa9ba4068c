"""Result sinks (S10-S12, S14 via files.write_areas, S15 via files.write_baseline).

Year-level results are tiny, so single-file output is fine there; message
tables go through ``files.write_yearly`` (partitioned, dynamic overwrite).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TREND_SCHEMA = ("year int, total_warnings bigint, fluvial_warnings bigint, coastal_warnings bigint, "
                "fluvial_index double, coastal_index double, composite_index double")


def write_trend_csv(summary: DataFrame, path: str) -> None:
    """The yearly summary as one CSV with a header (one row per year),
    sorted by year (O3)."""
    summary.orderBy("year").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_trend_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(TREND_SCHEMA).csv(path)


def write_quality_reports(documents_by_year: DataFrame, path: str) -> None:
    """One JSON document per year (``quality.report_documents``): the counts of
    the report's header and its issues."""
    (documents_by_year.where(F.col("year").isNotNull()).hint("rebalance", "year")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").json(path))


RUN_LOG = ("run_id string, year int, stage string, status string, error string, records bigint, passed boolean, output_path string, logged_at string")
STAGES = ("load", "validation", "export")


def append_run_log(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Append rows of RUN_LOG; each call is one file, committed as a whole."""
    spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    log = spark.read.schema(RUN_LOG).parquet(path)
    return log if run_id is None else log.filter(F.col("run_id") == run_id)


def run_metrics(log: DataFrame) -> DataFrame:
    """A row for each run and year of a run log: status and counts of each stage, the errors, and the run's
    share of successful years in percent.

    A year succeeds when its load and its export did; a validation that broke off is an error
    but no failure, since the export goes on.  A year without records is loaded, checked and exported like any other."""
    stage = lambda name, value: F.max(F.when(F.col("stage") == name, value))
    errors = F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.concat_ws(": ", "stage", "error"))))
    d = log.groupBy("run_id", "year").agg(
        F.coalesce(stage("load", F.col("records")), F.lit(0)).alias("records_loaded"),
        *[stage(s, F.col("status")).alias(f"{s}_status") for s in STAGES],
        stage("validation", F.col("passed")).alias("validation_passed"),
        stage("export", F.col("records")).alias("records_exported"), F.array_join(errors, "; ").alias("errors"))
    d = d.withColumn("success", (F.coalesce("load_status", F.lit("")) == "success") & (F.coalesce("export_status", F.lit("")) == "success"))
    w = Window.partitionBy("run_id")  # one row per year
    return d.withColumn("success_rate_pct", F.avg(F.col("success").cast("double")).over(w) * F.lit(100.0))
