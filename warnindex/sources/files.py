"""Message file scans and the load flow.

Text files are read as all-string columns (no inference pass; a per-file
inferred type would break the union), then cast with ``try_*`` in
``operators.normalize``.  Listing work (which files, which header) touches
metadata only; rows never pass through the driver.
"""

from __future__ import annotations

import fnmatch
import logging
import os
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warnindex.params import CSV_NULL_TOKENS, TREND_FIRST_YEAR, Baseline
from warnindex.schema import AREAS, BASELINE, ITEMS, RAW, WARNINGS
from warnindex.session import broadcast_if_small, scratch_path
from warnindex.sources.decode import lacking

log = logging.getLogger(__name__)


class LoadError(Exception):
    """No input could be loaded, or the format is unknown."""


FORMATS = {".csv": "csv", ".json": "json", ".ods": "ods", ".zip": "zip"}
HEADER_PROBE_TASKS = 256
# CSV writer options: keep text verbatim (Spark's writer trims by default).
# Quotes inside quoted fields are doubled, backslashes are plain text (RFC 4180).
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
CSV_WRITE = CSV_FORMAT
CORRUPT = "_corrupt_record"
SKIPPED = "path string, reason string, record string"


def infer_format(path: str) -> str:
    """Format from the lower-cased file suffix; unknown suffix -> error."""
    suffix = os.path.splitext(path)[1].lower()
    if suffix not in FORMATS:
        raise LoadError(f"no reader for files ending in {suffix!r}: {path}")
    return FORMATS[suffix]


def null_tokens_to_null(df: DataFrame, tokens=CSV_NULL_TOKENS) -> DataFrame:
    """The words null/NULL/None read as null in every string column
    (the CSV reader's ``nullValue`` takes one token; "" is null already)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(*tokens), c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _to_raw(df: DataFrame) -> DataFrame:
    """Known raw columns as text (only those the source has: an optional
    column that is absent stays absent), extra columns kept as they are."""
    known = {f.name for f in RAW.fields}
    cols = [F.col(f"`{f.name}`").cast("string").alias(f.name) for f in RAW.fields if f.name in df.columns]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in known]
    return df.select(*cols, *extra)


def _csv_rows(spark: SparkSession, paths, header_cols=None, multiline: bool = False) -> DataFrame:
    reader = spark.read.options(**CSV_FORMAT).option("inferSchema", False).option("mode", "PERMISSIVE").option("multiLine", multiline)
    if header_cols is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header_cols, CORRUPT]])
        # with pruned columns the parser would not see whether a row is whole
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).schema(schema)
    return reader.csv([paths] if isinstance(paths, str) else list(paths))


def read_csv(spark: SparkSession, paths, header_cols=None, multiline: bool = False) -> DataFrame:
    """Header CSV (RFC 4180), every column a string, null tokens mapped to
    null.  ``multiline``: quoted fields may hold line breaks (a file is then one
    task's work).  With ``header_cols`` a column ``_corrupt_record`` holds the text
    of rows that have more or fewer fields, which are null elsewhere."""
    return null_tokens_to_null(_csv_rows(spark, paths, header_cols, multiline))


def read_json(spark: SparkSession, paths, multiline: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """JSON documents holding records.  With a schema Spark reads the declared members
    (``multiline``: a document a file, else one a line); without one every member
    that occurs becomes a text column, and no inference pass is run."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if schema is not None:
        return spark.read.option("multiLine", multiline).schema(schema).json(paths)
    return load_checked(spark, paths, "json")[0]


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def list_paths(spark: SparkSession, directory: str) -> list[str]:
    """Every file under ``directory`` (recursive; empty files included), from
    the file system's listing -- metadata only."""
    from warnindex.sources.storage import list_tree

    return [p for p in list_tree(directory) if not os.path.basename(p).startswith((".", "_"))]


UNITS = "path string, file string, header array<string>, reason string"


def _probe_headers(it):
    """Header fields of each file, or the reason why there are none: its first line only, read in a task."""
    import csv
    import io

    import pandas as pd

    from warnindex.sources.storage import open_path

    for pdf in it:
        rows = []
        for path, file in zip(pdf["path"], pdf["file"]):
            try:
                with open_path(path) as f:
                    header = next(csv.reader(io.TextIOWrapper(f, encoding="utf-8-sig", newline="")), None)
                if not header:
                    raise ValueError("no rows")
                names = [h.strip() for h in header]
                if len(set(names)) != len(names):
                    raise ValueError("a column name occurs twice")
                miss = lacking(names)
                if miss:
                    raise ValueError("no column for " + ", ".join(miss))
                rows.append((path, file, names, None))
            except Exception as e:  # noqa: BLE001 - any unreadable file is skipped
                rows.append((path, file, None, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(rows, columns=["path", "file", "header", "reason"])


def csv_units(spark: SparkSession, paths) -> DataFrame:
    """Each CSV file's path, its name in scans, and its header or the reason it has none."""
    listed = spark.read.format("binaryFile").load(list(paths)).select("path", F.col("_metadata.file_path").alias("file"))
    probed = listed.repartition(max(1, min(len(paths), HEADER_PROBE_TASKS))).mapInPandas(_probe_headers, UNITS)
    return stage_table(probed, "csv-headers")


def _csv_group(spark: SparkSession, files, headers: list[list[str]], units: DataFrame, multiline: bool) -> tuple[DataFrame, DataFrame]:
    """(whole rows, malformed rows) of files whose headers have the same number of columns: one scan.
    Where headers differ, columns are read by place and each row finds its own by its file's header."""
    width = len(headers[0])
    one = len(headers) == 1
    names = headers[0] if one else [f"_c{i}" for i in range(width)]
    rows = _csv_rows(spark, files, names, multiline)
    # not a null test: that would be pushed into the parser, which does not know the
    # column yet; and a second column, as Spark refuses a scan of the corrupt one alone
    length, any_ = F.length(F.concat_ws("", CORRUPT)), F.length(F.concat_ws("", CORRUPT, f"`{names[0]}`")) >= 0
    torn, whole = (length > 0) & any_, (length == 0) & any_
    malformed = rows.select(F.col("_metadata.file_path").alias("path"), "*").filter(torn).select(
        "path", F.lit("fields do not match the header").alias("reason"), F.col(CORRUPT).alias("record"))
    if one:
        return null_tokens_to_null(rows.filter(whole).drop(CORRUPT)), malformed
    heads = units.filter("reason is null").select(F.col("file").alias("_file"), "header")
    found = rows.select(F.col("_metadata.file_path").alias("_file"), "*").filter(whole).join(broadcast_if_small(heads), "_file")
    cells = F.array(*[F.col(n) for n in names])
    every = sorted({h for header in headers for h in header})
    found = found.select(cells.alias("_cells"), "header").select(
        *[F.get("_cells", F.array_position("header", F.lit(n)).cast("int") - 1).alias(n) for n in every])
    return null_tokens_to_null(found), malformed


def load_csv_files(spark: SparkSession, paths, multiline: bool = False) -> tuple[DataFrame | None, DataFrame, DataFrame | None, int]:
    """S5 for CSV: (rows, skipped files, malformed rows, how many files are skipped).  Headers are read in tasks and only the distinct
    ones reach the driver.  All files whose headers have equally many columns are one scan, in which drifting headers
    land on the same columns (U1 is the union by name).  Files that cannot be read or lack a required column are
    skipped whole, malformed rows one by one."""
    paths = list(paths)
    units = csv_units(spark, paths)
    counts = {None if r["header"] is None else tuple(r["header"]): r["n"] for r in units.groupBy("header").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bad = counts.pop(None, 0)
    skipped = units.filter("reason is not null").select("path", "reason", F.lit(None).cast("string").alias("record"))
    widths: dict[int, list] = {}
    for h in sorted(counts):
        widths.setdefault(len(h), []).append(list(h))
    of = {w: paths for w in widths}
    if n_bad or len(widths) > 1:
        of = {}
        for r in units.filter("reason is null").select("path", F.size("header").alias("w")).collect():
            of.setdefault(r["w"], []).append(r["path"])
    frames, torn = [], []
    for w, headers in sorted(widths.items()):
        rows, malformed = _csv_group(spark, of[w], headers, units, multiline)
        frames.append(_to_raw(rows))
        torn.append(malformed)
    if not frames:
        return None, skipped, None, n_bad
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), skipped, reduce(DataFrame.unionByName, torn), n_bad


def choose_snapshot(spark: SparkSession, directory: str) -> tuple[str, list[str]]:
    """Every CSV if there is any; else only the lexicographically last ODS
    (names start with YYYYMM).  Listing only."""
    rows = list_paths(spark, directory)
    csv = sorted(p for p in rows if p.lower().endswith(".csv"))
    ods = sorted(p for p in rows if p.lower().endswith(".ods"))
    if csv:
        return "csv", csv
    if ods:
        return "ods", [max(ods, key=os.path.basename)]
    raise FileNotFoundError(f"{directory} holds neither CSV nor ODS files")


def load_checked(spark: SparkSession, paths, fmt: str | None = None, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """S4 + S5 raw part: (rows, skipped).  The format of each file is its own
    (by suffix) unless ``fmt`` says otherwise.  A file or archive member that fails to open, to
    decode or to show the required columns is skipped and named in ``skipped`` (path, reason, record: the text of
    single malformed records); the load fails only when nothing is left."""
    from warnindex.sources import decode

    paths = [paths] if isinstance(paths, str) else list(paths)
    kinds: dict[str, list[str]] = {}
    unknown = []
    for p in paths:
        try:
            kinds.setdefault(fmt or infer_format(p), []).append(p)
        except LoadError as e:
            unknown.append((p, str(e), None))
    skipped = spark.createDataFrame(unknown, SKIPPED)
    frames, torn, n = [], [], len(unknown)
    for kind, files in sorted(kinds.items()):
        if kind == "csv":
            df, bad, malformed, failed = load_csv_files(spark, files, multiline)
            if malformed is not None:
                torn.append(malformed)
        elif kind in decode.ROWS:
            rows, failed, n_torn = decode.decode_paths(spark, files, kind)
            df, bad, malformed = decode.assemble(rows, failed)
            if n_torn:
                torn.append(malformed)
            df = df if df is None else _to_raw(df.drop("_source") if kind != "zip" else df)
        else:
            raise LoadError(f"no reader for format {kind!r}")
        n += failed
        if failed:
            skipped = skipped.unionByName(bad)
        if df is not None:
            frames.append(df)
    if n:
        log.warning("%d files or members are skipped, the first: %s", n,
                    [tuple(r) for r in skipped.orderBy("path").limit(5).select("path", "reason").collect()])
    if not frames:
        raise LoadError(f"none of {len(paths)} files could be read")
    skipped = reduce(DataFrame.unionByName, torn, skipped)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), skipped


def load_raw(spark: SparkSession, paths, fmt: str | None = None, multiline: bool = False) -> DataFrame:
    """``load_checked`` without the skipped files (they are logged)."""
    return load_checked(spark, paths, fmt, multiline)[0]


def load_warnings(spark: SparkSession, paths, fmt: str | None = None, areas: DataFrame | None = None,
                  require_offset: bool = False, multiline: bool = False) -> DataFrame:
    """Raw scan -> P1-P6 -> optional region restriction."""
    from warnindex.plans.flows import prepare_messages

    return prepare_messages(load_raw(spark, paths, fmt, multiline), areas, require_offset)


def load_archives(spark: SparkSession, paths, areas: DataFrame | None = None) -> DataFrame:
    """S16 + S4: ZIP archives of CSV files -> clean messages (members read and
    parsed in the tasks)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return load_warnings(spark, paths, "zip", areas)


def load_directory(spark: SparkSession, directory: str, areas: DataFrame | None = None,
                   pattern: str | None = None, multiline: bool = False) -> DataFrame:
    """S5 + S6: load the files of a landing folder.  Without ``pattern`` the
    snapshot rule picks the files (all CSV, else the newest ODS); with one,
    every file whose name matches the glob is loaded, each in its own format."""
    if pattern is None:
        fmt, paths = choose_snapshot(spark, directory)
        return load_warnings(spark, paths, fmt, areas, multiline=multiline)
    paths = sorted(p for p in list_paths(spark, directory) if fnmatch.fnmatch(os.path.basename(p), pattern))
    if not paths:
        raise LoadError(f"{directory} holds no file like {pattern!r}")
    return load_warnings(spark, paths, None, areas, multiline=multiline)


# ---- partitioned per-year tables (S7-S9) ---------------------------------------

TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_yearly(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One partition per year; only the years present are replaced.  Rows are
    rebalanced by year first: a small year becomes one file, a large one as many
    as the advisory partition size asks for."""
    out = df.withColumn("year", F.year("timeRaised")).where(F.col("year").isNotNull()).hint("rebalance", "year")
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year")
    if fmt == "csv":
        w.options(**CSV_WRITE).option("timestampNTZFormat", TIME_TEXT).option("emptyValue", '""').csv(path)
    else:
        w.format(fmt).save(path)


def read_year(spark: SparkSession, path: str, year: int | None = None, fmt: str = "parquet",
              schema: T.StructType | None = None) -> DataFrame:
    """Read back (all years, or one by partition pruning) with declared types:
    the message table's and those of ``schema`` for further columns.  A missing
    year or table is an empty frame of those types, not an error."""
    known = {f.name: f for f in [*WARNINGS.fields, *(schema.fields if schema is not None else [])]}
    fs, p = _jvm_fs(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], T.StructType([*known.values(), T.StructField("year", T.IntegerType())]))
    if fmt == "csv":
        # the header, from one file's first line, says which columns there are
        header = spark.read.options(**CSV_FORMAT).option("inferSchema", False).csv(path).columns
        fields = [known.get(c, T.StructField(c, T.IntegerType() if c == "year" else T.StringType())) for c in header]
        df = (spark.read.options(**CSV_FORMAT).option("timestampNTZFormat", TIME_TEXT).option("emptyValue", "")
              .schema(T.StructType(fields)).csv(path))
    else:
        df = spark.read.format(fmt).load(path)
    return df if year is None else df.where(F.col("year") == F.lit(year))


_YEAR_DIR = re.compile(r"/year=(\d{4})(/|$)")


def discover_years(spark: SparkSession, path: str, first_year: int | None = TREND_FIRST_YEAR) -> list[int]:
    """The years present, from partition directory names (metadata only);
    badly named folders are ignored."""
    fs, p = _jvm_fs(spark, path)
    if not fs.exists(p):
        return []
    years = set()
    for st in fs.listStatus(p):
        m = _YEAR_DIR.search(st.getPath().toString())
        if st.isDirectory() and m:
            years.add(int(m.group(1)))
    return sorted(y for y in years if first_year is None or y >= first_year)


# ---- landed pages, areas, baseline (S13-S15, S17) ------------------------------

PAGE_META = T.StructType([T.StructField("offset", T.LongType()), T.StructField("limit", T.LongType()), T.StructField("next", T.StringType())])


def load_landed_pages(spark: SparkSession, paths, multiline: bool = True, item_schema: T.StructType = ITEMS) -> tuple[DataFrame, DataFrame]:
    """API response pages ({"items": [...], "meta": {...}}) -> (items of the declared fields, faults).

    ``multiline``: a file is one document, however it is indented; else every line is one.  Faults
    (path, reason, record) name each page that is torn, with its text, and the holes that the pages' ``meta`` gives away: a
    page with a ``next`` link and none that starts where it ends, or one that starts beyond 0
    where none ends.  The pages of one folder belong together.  Pages are read once."""
    fields = [T.StructField("items", T.ArrayType(item_schema)), T.StructField("meta", PAGE_META), T.StructField(CORRUPT, T.StringType())]
    pages = (spark.read.option("multiLine", multiline).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
             .schema(T.StructType(fields)).json(paths).select(F.col("_metadata.file_path").alias("path"), "items", "meta", CORRUPT))
    pages = stage_table(pages, "landed-pages")
    items = pages.filter(F.col(CORRUPT).isNull()).select(F.explode("items").alias("item")).select("item.*")
    torn = pages.filter(F.col(CORRUPT).isNotNull()).select("path", F.lit("not a page of items").alias("reason"), F.col(CORRUPT).alias("record"))
    spans = pages.filter(F.col(CORRUPT).isNull() & F.col("meta.offset").isNotNull() & F.col("meta.limit").isNotNull()).select(
        "path", F.regexp_replace("path", "/[^/]*$", "").alias("chain"), F.col("meta.offset").alias("start"),
        (F.col("meta.offset") + F.col("meta.limit")).alias("end"), F.col("meta.next").alias("next"))
    at = lambda c: spans.select("chain", F.col(c).alias("at")).distinct()
    none = F.lit(None).cast("string").alias("record")
    after = spans.filter("next is not null").withColumn("at", F.col("end")).join(at("start"), ["chain", "at"], "left_anti").select(
        "path", F.concat(F.lit("no page starts at offset "), F.col("at").cast("string")).alias("reason"), none)
    before = spans.filter("start > 0").withColumn("at", F.col("start")).join(at("end"), ["chain", "at"], "left_anti").select(
        "path", F.concat(F.lit("no page ends at offset "), F.col("at").cast("string")).alias("reason"), none)
    return items, torn.unionByName(after).unionByName(before)


def read_landed_pages(spark: SparkSession, paths, multiline: bool = True, item_schema: T.StructType = ITEMS) -> DataFrame:
    """``load_landed_pages`` without the faults (they are logged)."""
    items, faults = load_landed_pages(spark, paths, multiline, item_schema)
    first = faults.limit(5).collect()
    if first:
        log.warning("landed pages are torn or missing, among them: %s", [(r["path"], r["reason"]) for r in first])
    return items


def read_areas(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Area dimension table."""
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in AREAS.fields])


def write_areas(areas: DataFrame, path: str, stats_path: str | None = None, counties=None, region: str | None = None,
                fetched_at: str | None = None) -> None:
    """Areas sorted by code (O4), the class and county tallies, and (with ``region``) the metadata
    document: what the areas are, for which region and counties, when they were fetched (given, as text), and the tallies."""
    from warnindex.operators.regions import area_class_counts, area_metadata, county_tallies

    areas.orderBy("fwdCode").write.mode("overwrite").parquet(path)
    areas = areas.sparkSession.read.schema(areas.schema).parquet(path)  # the tallies read what was written
    if stats_path is not None:
        area_class_counts(areas).write.mode("overwrite").parquet(os.path.join(stats_path, "classes"))
        if counties:
            county_tallies(areas, counties).write.mode("overwrite").parquet(os.path.join(stats_path, "counties"))
        if region is not None:
            area_metadata(areas, region, counties or (), fetched_at).coalesce(1).write.mode("overwrite").json(os.path.join(stats_path, "metadata"))


def read_area_metadata(spark: SparkSession, stats_path: str) -> DataFrame:
    """The metadata document written beside the tallies."""
    from warnindex.operators.regions import AREA_METADATA

    return spark.read.schema(AREA_METADATA).json(os.path.join(stats_path, "metadata"))


def read_baseline(spark: SparkSession, path: str) -> DataFrame | None:
    """One-row baseline table; missing -> None; optional fields -> 0."""
    fs, p = _jvm_fs(spark, path)
    if not fs.exists(p):
        return None
    df = spark.read.parquet(path)
    cols = []
    for f in BASELINE.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name not in ("year", "fluvial_score", "coastal_score", "total_score"):
            c = F.coalesce(c.cast(f.dataType), F.lit(0).cast(f.dataType))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def load_baseline(spark: SparkSession, path: str) -> Baseline | None:
    """S15 -> J4: the stored row as ``IndexParams.baseline`` (one row reaches the
    driver); None when there is no table, an error when it does not hold one row."""
    df = read_baseline(spark, path)
    if df is None:
        return None
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise LoadError(f"{path} holds {'no' if not rows else 'more than one'} baseline")
    return Baseline(**rows[0].asDict())


def write_baseline(baseline_row: DataFrame, path: str) -> None:
    """Persist the baseline row."""
    baseline_row.coalesce(1).write.mode("overwrite").parquet(path)


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back
    (cuts lineage; survives executor loss, unlike a local checkpoint)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
