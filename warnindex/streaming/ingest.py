"""Incremental ingestion of landed message files (E1 as a stream).

New CSV files in a landing folder are normalised (P1-P6), restricted to the
region and joined to the area class (stream-static broadcast join, P7/J1),
and appended to the per-year table (S7) by the file sink, whose commit log
makes each file count exactly once across restarts.  Everything is
stateless, so no watermark is needed.  The duration rule itself is not
streamed: a message's duration depends on the next message of its area, so
it is computed by the batch flow over the ingested table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from warnindex.plans.flows import prepare_messages
from warnindex.sources.files import CORRUPT, CSV_FORMAT, null_tokens_to_null

# Column layout expected in streamed files (checked against each file's header).
LANDED_COLUMNS = ("DATE", "CODE", "TYPE", "WARNING / ALERT AREA NAME", "AREA")


def _scan(spark: SparkSession, landing_dir: str, columns, max_files_per_trigger: int | None) -> DataFrame:
    """Streaming scan of header CSV files; every column read as text, and the text of rows that
    have more or fewer fields in ``_corrupt_record`` (seen only where no column is pruned)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
    r = (spark.readStream.schema(schema).options(**CSV_FORMAT).option("enforceSchema", False).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    # not a null test, which would be pushed into the parser before it knows the column; and a second
    # column, as Spark refuses a scan of the corrupt one alone
    some = F.length(F.concat_ws("", CORRUPT, f"`{columns[0]}`")) >= 0
    return r.csv(landing_dir).withColumn("_torn", (F.length(F.concat_ws("", CORRUPT)) > 0) & some)


def landed_stream(spark: SparkSession, landing_dir: str, columns=LANDED_COLUMNS,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The whole rows of landed files; rows whose fields do not match the header are left out, not padded or cut."""
    rows = _scan(spark, landing_dir, columns, max_files_per_trigger)
    return null_tokens_to_null(rows.where(~F.col("_torn")).select(*[F.col(f"`{c}`") for c in columns]))


def torn_stream(spark: SparkSession, landing_dir: str, columns=LANDED_COLUMNS,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """The rows that ``landed_stream`` leaves out: path, reason, record."""
    rows = _scan(spark, landing_dir, columns, max_files_per_trigger)
    return rows.select(F.col("_metadata.file_path").alias("path"), "_torn", CORRUPT).where("_torn").select(
        "path", F.lit("fields do not match the header").alias("reason"), F.col(CORRUPT).alias("record"))


def ingest_messages(raw_stream: DataFrame, areas: DataFrame | None = None) -> DataFrame:
    """Clean messages with a year column (null times dropped, as the per-year
    export does)."""
    msgs = prepare_messages(raw_stream, areas)
    return msgs.withColumn("year", F.year("timeRaised")).where(F.col("year").isNotNull())


def start_ingest(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_dir: str,
                 areas: DataFrame | None = None, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Start the stream: landing folder -> per-year parquet table."""
    out = ingest_messages(landed_stream(spark, landing_dir), areas)
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir).partitionBy("year"))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start(table_path)


def start_quarantine(spark: SparkSession, landing_dir: str, quarantine_path: str, checkpoint_dir: str,
                     available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream of torn rows: landing folder -> JSON lines, exactly once like the ingest, with a
    checkpoint folder of its own."""
    w = torn_stream(spark, landing_dir).writeStream.format("json").outputMode("append").option("checkpointLocation", checkpoint_dir)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start(quarantine_path)
