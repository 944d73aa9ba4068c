"""Queries over landed files.

Each query first lands the given tables in the source format (written by
Spark or by tasks into the shared folder), then scans them back with the
library's readers.  The result must
equal the source table, so these scans get a value check against SQL too.
"""

from __future__ import annotations

import io
import os
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warnindex.operators import regions
from warnindex.operators.normalize import normalize_schema, parse_timestamps
from warnindex.session import scratch_path
from warnindex.sources import adapters as A
from warnindex.sources import files

MSG_COLS = ["fwdCode", "timeRaised", "severity", "severityLevel"]
# Rows per landed file of the fixtures.
ROWS_PER_FILE = 5_000


def _iso(c: str):
    return F.concat(F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def _raw_events(spark: SparkSession, d: str) -> DataFrame:
    """events messages in the raw layout of the landed files."""
    m = A.events_messages(spark, d)
    return m.select(
        _iso("timeRaised").alias("DATE"),
        F.col("fwdCode").alias("CODE"),
        F.col("severity").alias("TYPE"),
        F.lit("NULL").alias("WARNING / ALERT AREA NAME"),
        F.concat(F.lit("A"), F.col("fwdCode")).alias("AREA"),
        F.col("msg_id"),
    )


def _clean(raw: DataFrame) -> DataFrame:
    return parse_timestamps(normalize_schema(raw)).select(*MSG_COLS)


def q_csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """S1 + S5 + S6 + U1: CSV files with two different column orders (header
    drift) and null tokens -> clean messages."""
    raw = _raw_events(spark, d)
    root = scratch_path(spark, "landed-csv")
    chunk = F.floor(F.col("msg_id") / ROWS_PER_FILE)
    (raw.where(F.col("msg_id") % 2 == 0).withColumn("_c", chunk).repartition("_c").drop("_c", "msg_id")
     .write.options(**files.CSV_WRITE).csv(os.path.join(root, "a")))
    (raw.where(F.col("msg_id") % 2 == 1).withColumn("_c", chunk).repartition("_c")
     .select("CODE", "TYPE", "DATE", "AREA", "WARNING / ALERT AREA NAME")
     .write.options(**files.CSV_WRITE).csv(os.path.join(root, "b")))
    return files.load_directory(spark, root).select(*MSG_COLS)


def q_json_scan(spark: SparkSession, d: str) -> DataFrame:
    """Documents that each hold one JSON array of records, some with a torn record, which alone is left out."""
    raw = _raw_events(spark, d)
    root = scratch_path(spark, "landed-json")
    rec = F.struct(*[F.col(f"`{c}`") for c in ("DATE", "CODE", "TYPE", "AREA")])
    docs = (raw.withColumn("_c", F.floor(F.col("msg_id") / ROWS_PER_FILE))
            .groupBy("_c").agg(F.to_json(F.collect_list(rec)).alias("value")))
    torn = F.regexp_replace("value", r"^\[", '[{"DATE": "2024-01-01T00:00:00Z", "CODE" "torn"\n')
    _save_text(docs.withColumn("value", F.when(F.col("_c") % 2 == 0, torn).otherwise(F.col("value"))), root, "json")
    return _clean(files.load_raw(spark, files.list_paths(spark, root)))


def q_torn_records(spark: SparkSession, d: str) -> DataFrame:
    """S2 + S16: a JSON-lines file and an archive per supplier, each with a torn record or member; what
    is torn is named, with its text or its member, and everything else is loaded (counted per file)."""
    s = A.table(spark, d, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    root = scratch_path(spark, "landed-torn")
    line = F.concat(F.lit('{"DATE": "2024-01-01T00:00:00Z", "CODE": "'), k, F.lit('", "TYPE": "Flood Alert"}\n'))
    cut = F.concat(F.lit('{"DATE": "2024-01-01T00:00:00Z", "CODE": "'), k, F.lit("\n"))
    _save_text(s.where(k % 2 == 0).select(k.alias("_c"), F.concat(line, cut, line, line).alias("value")), root, "json")
    _save_zips(s.where(k % 2 == 1).select(k.alias("_c")), root)
    rows, skipped = files.load_checked(spark, files.list_paths(spark, root))
    loaded = rows.groupBy(F.col("CODE").alias("code")).agg(F.count(F.lit(1)).alias("loaded"))
    file = F.element_at(F.split("path", "/"), -1)
    torn = skipped.select(F.regexp_extract(file, r"^(\d+)", 1).alias("code"), F.coalesce("record", F.regexp_extract("reason", "^([^:]*)", 1)).alias("torn"))
    return loaded.join(torn, "code", "full")


def _save_zips(keys: DataFrame, root: str) -> None:
    """Each row (_c) becomes an archive of a whole member, one without the columns and a torn one."""

    def run(it):
        from warnindex.sources.archive import encode_zip
        from warnindex.sources.storage import save_bytes

        for pdf in it:
            for c in pdf["_c"]:
                row = f"{c},2024-01-01T00:00:00Z,Flood Alert\n"
                content = bytearray(encode_zip({"a.csv": "CODE,DATE,TYPE\n" + row * 2, "torn.csv": "CODE,DATE,TYPE\n" + row * 200}))
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                    info = z.getinfo("torn.csv")
                at = info.header_offset + 30 + len("torn.csv") + info.compress_size // 2
                content[at:at + 2] = b"\xff\xff"
                save_bytes(f"{root}/{c}.zip", bytes(content))
            yield pd.DataFrame({"n": [len(pdf)]})

    keys.mapInPandas(run, "n long").write.format("noop").mode("overwrite").save()


RAW_HEADER = ["DATE", "CODE", "TYPE", "WARNING / ALERT AREA NAME", "AREA"]


def _save_files(root: str, suffix: str):
    """The rows of one chunk become one landed file of that chunk's number, in the order of their id: a task that is
    tried again writes the same file."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import io

        from warnindex.sources.archive import encode_zip
        from warnindex.sources.ods import encode_ods
        from warnindex.sources.storage import save_bytes

        pdf = pdf.sort_values("msg_id")
        name = f"warnings_{pdf['_c'].iloc[0]}"
        if suffix == "ods":
            content = encode_ods(RAW_HEADER, pdf[RAW_HEADER].itertuples(index=False, name=None), date_columns=())
        else:
            half, members = len(pdf) // 2, {f"{name}/README.txt": "landed"}
            for k, rows in enumerate((pdf.iloc[:half], pdf.iloc[half:])):
                buf = io.StringIO()
                rows[RAW_HEADER].to_csv(buf, index=False)
                members[f"{name}/data{k}.csv"] = buf.getvalue()
            # one member without the columns, one cut off in the middle of its bytes: neither may cost the others a row
            members[f"{name}/lacking.csv"] = "CODE\nX\n"
            content = encode_zip({**members, f"{name}/torn.csv": ",".join(RAW_HEADER) + "\n" + "x,y,z,,\n" * 400})
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                info = z.getinfo(f"{name}/torn.csv")
            at = info.header_offset + 30 + len(info.filename.encode()) + info.compress_size // 2
            content = content[:at] + b"\xff\xff" + content[at + 2:]
        save_bytes(f"{root}/{name}.{suffix}", content)
        return pd.DataFrame({"path": [f"{root}/{name}.{suffix}"]})

    return run


def _land(raw: DataFrame, root: str, suffix: str) -> None:
    chunks = raw.withColumn("_c", F.floor(F.col("msg_id") / ROWS_PER_FILE))
    chunks.groupBy("_c").applyInPandas(_save_files(root, suffix), "path string").write.format("noop").mode("overwrite").save()


def q_ods_scan(spark: SparkSession, d: str) -> DataFrame:
    """S3: spreadsheets written by tasks into the shared folder -> messages."""
    root = scratch_path(spark, "landed-ods")
    _land(_raw_events(spark, d).withColumn("DATE", F.regexp_replace("DATE", "Z$", "")), root, "ods")
    return _clean(files.load_raw(spark, files.list_paths(spark, root)))


def q_archive_scan(spark: SparkSession, d: str) -> DataFrame:
    """ZIP archives written by tasks -> members -> CSV rows -> messages."""
    root = scratch_path(spark, "landed-zip")
    _land(_raw_events(spark, d), root, "zip")
    return files.load_archives(spark, files.list_paths(spark, root)).select(*MSG_COLS)


def _odd_label():
    """Text with everything that CSV has to quote."""
    k = F.col("msg_id")
    return (F.when(k % 5 == 0, F.concat(F.lit('say "'), F.col("CODE"), F.lit('"'))).when(k % 5 == 1, F.concat(F.lit("a, b, "), F.col("CODE")))
            .when(k % 5 == 2, F.concat(F.col("CODE"), F.lit("\\"))).when(k % 5 == 3, F.concat(F.lit("line\n"), F.col("CODE"), F.lit("\n\"\",\"")))
            .otherwise(F.concat(F.lit("\\\""), F.col("CODE"), F.lit("\\n"))))


def q_csv_quoted(spark: SparkSession, d: str) -> DataFrame:
    """Quoted CSV fields with doubled quotes, commas, backslashes and line breaks."""
    raw = _raw_events(spark, d)
    raw = raw.withColumn("WARNING / ALERT AREA NAME", _odd_label())
    root = scratch_path(spark, "landed-quoted")
    chunk = F.floor(F.col("msg_id") / ROWS_PER_FILE)
    raw.withColumn("_c", chunk).repartition("_c").drop("_c").write.options(**files.CSV_WRITE).option("maxRecordsPerFile", ROWS_PER_FILE).csv(root)
    m = files.load_directory(spark, root, multiline=True)
    return m.select(F.col("msg_id").cast("bigint").alias("msg_id"), "label", *MSG_COLS)


def q_mixed_directory(spark: SparkSession, d: str) -> DataFrame:
    """S4 + S5: one folder of CSV, JSON, spreadsheet and ZIP files, each read in its own format."""
    raw = _raw_events(spark, d)
    root = scratch_path(spark, "landed-mixed")
    part = lambda k: raw.where(F.col("msg_id") % 4 == k)
    part(0).drop("msg_id").write.options(**files.CSV_WRITE).csv(os.path.join(root, "c"))
    rec = F.struct(*[F.col(f"`{c}`") for c in ("DATE", "CODE", "TYPE", "AREA")])
    docs = part(1).withColumn("_c", F.floor(F.col("msg_id") / ROWS_PER_FILE)).groupBy("_c").agg(F.to_json(F.collect_list(rec)).alias("value"))
    _save_text(docs, os.path.join(root, "j"), "json")
    _land(part(2), os.path.join(root, "o"), "ods")
    _land(part(3), os.path.join(root, "z"), "zip")
    return files.load_directory(spark, root, pattern="*").select(*MSG_COLS)


def _save_text(docs: DataFrame, root: str, suffix: str) -> None:
    """Each row (_c, value) becomes the file ``root/_c.suffix``."""

    def run(it):
        from warnindex.sources.storage import save_bytes

        for pdf in it:
            for c, v in zip(pdf["_c"], pdf["value"]):
                save_bytes(f"{root}/{c}.{suffix}", v.encode())
            yield pd.DataFrame({"n": [len(pdf)]})

    docs.mapInPandas(run, "n long").write.format("noop").mode("overwrite").save()


def q_skipped_files(spark: SparkSession, d: str) -> DataFrame:
    """A file per supplier; every third lacks the time column, every third is
    no spreadsheet; those are skipped and named, single malformed rows too."""
    s = A.table(spark, d, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    root = scratch_path(spark, "landed-bad")
    good = F.concat(F.lit("DATE,CODE,TYPE\n2024-01-01T00:00:00Z,"), k, F.lit(",Flood Alert\n"),
                    F.when(k % 2 == 0, F.lit("2024-01-02T00:00:00Z,one,too,many\n")).otherwise(""))
    _save_text(s.where(k % 3 == 0).select(k.alias("_c"), good.alias("value")), root, "csv")
    _save_text(s.where(k % 3 == 1).select(k.alias("_c"), F.concat(F.lit("CODE,TYPE\n"), k, F.lit(",Flood Alert\n")).alias("value")), root, "csv")
    _save_text(s.where(k % 3 == 2).select(k.alias("_c"), F.lit("no spreadsheet").alias("value")), root, "ods")
    _, skipped = files.load_checked(spark, files.list_paths(spark, root))
    return skipped.select(F.element_at(F.split("path", "/"), -1).alias("file"), "reason", "record")


PAGE_ITEMS = 25


def _land_pages(items: DataFrame, root: str, lost=None) -> None:
    """A file per page of PAGE_ITEMS items; ``lost(page)`` gives what a page is torn by or None where it is not landed."""
    page = F.floor(F.col("notation").cast("bigint") / PAGE_ITEMS)
    last = F.max("_p").over(Window.partitionBy())  # a row for each page
    pages = items.withColumn("_p", page).groupBy("_p").agg(F.collect_list(F.struct(*items.columns)).alias("items"))
    meta = F.struct((F.col("_p") * PAGE_ITEMS).alias("offset"), F.lit(PAGE_ITEMS).alias("limit"), F.when(F.col("_p") < last, F.lit("next")).alias("next"))
    docs = pages.select(F.col("_p").alias("_c"), F.to_json(F.struct("items", meta.alias("meta"))).alias("value"))
    if lost is not None:
        docs = docs.filter(~lost[0](F.col("_c"))).withColumn("value", F.when(lost[1](F.col("_c")), F.expr("left(value, 40)")).otherwise(F.col("value")))
    _save_text(docs, root, "json")


def q_landed_pages(spark: SparkSession, d: str) -> DataFrame:
    """S17 + P20: API pages of area items -> area dimension."""
    root = scratch_path(spark, "landed-pages")
    _land_pages(A.supplier_area_items(spark, d), root)
    return regions.areas_from_items(files.read_landed_pages(spark, root))


def q_page_faults(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth page is torn and every seventh is not there: torn pages are named, and so are the
    pages beside a hole; the items of all others are loaded (counted)."""
    root = scratch_path(spark, "landed-pages")
    _land_pages(A.supplier_area_items(spark, d), root, (lambda p: p % 7 == 3, lambda p: p % 5 == 2))
    items, faults = files.load_landed_pages(spark, root)
    file = F.element_at(F.split("path", "/"), -1)
    loaded = items.agg(F.count(F.lit(1)).alias("n")).select(F.lit("all").alias("file"), F.concat(F.lit("items loaded: "), F.col("n").cast("string")).alias("reason"))
    return faults.select(file.alias("file"), "reason").unionByName(loaded)


def q_yearly_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """S7 + S8: per-year partitioned table written and read back (one year by
    partition pruning)."""
    from warnindex.plans.flows import orders_region_messages

    root = scratch_path(spark, "yearly")
    files.write_yearly(orders_region_messages(spark, d), root)
    return files.read_year(spark, root, 1997).select("msg_id", "fwdCode", "timeRaised", "severityLevel", "isTidal", "year")


def q_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """S7 + S8 + S1 in CSV: the per-year export written as CSV and read back
    (every year; times keep their microseconds)."""
    from warnindex.plans.flows import orders_region_messages

    root = scratch_path(spark, "yearly-csv")
    files.write_yearly(orders_region_messages(spark, d), root, fmt="csv")
    extra = T.StructType([T.StructField("msg_id", T.LongType())])
    return files.read_year(spark, root, fmt="csv", schema=extra).select(
        "msg_id", "fwdCode", "timeRaised", "severity", "severityLevel", "isTidal", "year")


def q_discover_years(spark: SparkSession, d: str) -> DataFrame:
    """Years of a per-year table from its partition folders."""
    from warnindex.plans.flows import orders_region_messages

    root = scratch_path(spark, "yearly")
    files.write_yearly(orders_region_messages(spark, d).select("fwdCode", "timeRaised"), root)
    years = files.discover_years(spark, root, first_year=A.ORDERS_BASELINE_YEAR)
    return spark.createDataFrame([(y,) for y in years], "year int")


def q_trend_export(spark: SparkSession, d: str) -> DataFrame:
    """The yearly summary written as CSV and read back."""
    from warnindex.plans.flows import orders_yearly_summary
    from warnindex.sources.sinks import read_trend_csv, write_trend_csv

    root = scratch_path(spark, "trend")
    write_trend_csv(orders_yearly_summary(spark, d), root)
    return read_trend_csv(spark, root)


def q_baseline_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """S15 + I6: the baseline year's scores persisted and read back."""
    from warnindex.operators.index import baseline_from_indicators
    from warnindex.plans.flows import orders_annual_index

    root = scratch_path(spark, "baseline")
    files.write_baseline(baseline_from_indicators(orders_annual_index(spark, d), A.ORDERS_BASELINE_YEAR), root)
    return files.read_baseline(spark, root)


def q_index_from_stored_baseline(spark: SparkSession, d: str) -> DataFrame:
    """S15 + J4: indices of all years against a baseline stored before (that of 1998)."""
    from warnindex.operators.index import baseline_from_indicators
    from warnindex.params import DurationParams
    from warnindex.plans import flows

    root = scratch_path(spark, "baseline")
    files.write_baseline(baseline_from_indicators(flows.orders_annual_index(spark, d), 1998), root)
    return flows.index_from_stored_baseline(flows.orders_region_messages(spark, d), root, DurationParams(gap_scope="year"))


def q_index_refreshed(spark: SparkSession, d: str) -> DataFrame:
    """I4 from stored year totals: all messages but a tenth of two years' land first, those follow, and only
    their years are computed again."""
    from warnindex.plans import refresh
    from warnindex.plans.flows import orders_index_params, orders_region_messages

    root = scratch_path(spark, "refreshed")
    table, totals, changes = (os.path.join(root, n) for n in ("messages", "totals", "changes"))
    messages = files.stage_table(orders_region_messages(spark, d), "refresh-messages")
    late = F.year("timeRaised").isin(1996, 1999) & (F.col("msg_id") % 10 == 0)
    for part in (~F.coalesce(late, F.lit(False)), late):
        refresh.append_messages(messages.where(part), table, changes)
        refresh.refresh_totals(spark, table, totals, changes)
    return refresh.index_from_totals(spark, totals, index=orders_index_params())


def q_quality_by_year(spark: SparkSession, d: str) -> DataFrame:
    """The quality report of every year (header and issues) in one job, written as
    one JSON document per year and read back."""
    from warnindex.operators.quality import report_documents
    from warnindex.sources.sinks import write_quality_reports

    root = scratch_path(spark, "quality")
    docs = report_documents(A.quality_messages(spark, d), by_year=True)
    write_quality_reports(docs, root)
    back = spark.read.schema(docs.schema).json(root)
    return back.select("year", "total_records", "valid_records", "passed", "error_count", "warning_count", "info_count", F.inline("issues"))


def q_run_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The flow loads, checks and exports the requested years (some hold nothing) and logs every
    stage; a second run's load breaks off.  The metrics of both come from the log."""
    from warnindex.plans.flows import run_years
    from warnindex.sources.sinks import read_run_log, run_metrics

    root = scratch_path(spark, "run")

    def broken():
        raise files.LoadError("no input")

    run_years(spark, lambda: A.quality_messages(spark, d), range(1990, 2004), os.path.join(root, "table"), os.path.join(root, "log"), "first")
    run_years(spark, broken, range(1995, 1998), os.path.join(root, "table"), os.path.join(root, "log"), "second")
    return run_metrics(read_run_log(spark, os.path.join(root, "log")))


def q_area_table(spark: SparkSession, d: str) -> DataFrame:
    """S14 + S13: area dimension written (sorted by code, O4) with its class
    and county tallies, and read back."""
    root = scratch_path(spark, "areas")
    areas = regions.areas_from_items(A.supplier_area_items(spark, d))
    files.write_areas(areas, os.path.join(root, "areas"), os.path.join(root, "stats"), A.TEST_COUNTIES)
    return files.read_areas(spark, os.path.join(root, "areas"))


def q_area_stats_table(spark: SparkSession, d: str) -> DataFrame:
    """The county tallies written next to the area table, read back."""
    root = scratch_path(spark, "areas")
    areas = regions.areas_from_items(A.supplier_area_items(spark, d))
    files.write_areas(areas, os.path.join(root, "areas"), os.path.join(root, "stats"), A.TEST_COUNTIES)
    return spark.read.parquet(os.path.join(root, "stats", "counties"))


def q_area_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The metadata document written beside the area table, read back."""
    root = scratch_path(spark, "areas")
    areas = regions.areas_from_items(A.supplier_area_items(spark, d))
    files.write_areas(areas, os.path.join(root, "areas"), os.path.join(root, "stats"), A.TEST_COUNTIES, "the test region", "2024-01-01T00:00:00Z")
    m = files.read_area_metadata(spark, os.path.join(root, "stats"))
    return m.select("description", "region", F.array_join("counties", ",").alias("counties"), "fetched_at", "total_areas", "fluvial_areas", "coastal_areas",
                    *[F.col("areas_by_county")[c].alias("in_" + c.lower().replace(" ", "_")) for c in A.TEST_COUNTIES])


def q_ingest_region(spark: SparkSession, d: str) -> DataFrame:
    """E1 end to end: landed CSV -> clean region messages -> per-year table
    -> per-year quality report.  The region: user areas whose customer lives
    in a nation of the test counties; class from that nation."""
    from warnindex.plans.flows import ingest

    raw = _raw_events(spark, d)
    root = scratch_path(spark, "ingest")
    raw.drop("msg_id").write.options(**files.CSV_WRITE).csv(os.path.join(root, "landing"))
    cust = A.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("fwdCode"), F.col("c_nationkey").cast("string").alias("nation"))
    nations = A.region_areas(spark, d).select(F.col("fwdCode").alias("nation"), "isTidal")
    areas = cust.join(nations, "nation", "inner").select("fwdCode", "isTidal")
    paths = [p for p in files.list_paths(spark, os.path.join(root, "landing")) if p.endswith(".csv")]
    _, rep = ingest(spark, paths, areas, os.path.join(root, "table"), fmt="csv")
    return rep


FILES = {
    "csv_scan": q_csv_scan,
    "json_scan": q_json_scan,
    "ods_scan": q_ods_scan,
    "archive_scan": q_archive_scan,
    "csv_quoted": q_csv_quoted,
    "mixed_directory": q_mixed_directory,
    "skipped_files": q_skipped_files,
    "torn_records": q_torn_records,
    "landed_pages": q_landed_pages,
    "page_faults": q_page_faults,
    "yearly_roundtrip": q_yearly_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "discover_years": q_discover_years,
    "trend_export": q_trend_export,
    "baseline_roundtrip": q_baseline_roundtrip,
    "index_from_stored_baseline": q_index_from_stored_baseline,
    "index_refreshed": q_index_refreshed,
    "quality_by_year": q_quality_by_year,
    "run_metrics": q_run_metrics,
    "area_table": q_area_table,
    "area_stats_table": q_area_stats_table,
    "area_metadata": q_area_metadata,
    "ingest_region": q_ingest_region,
}
