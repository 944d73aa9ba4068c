"""Compositions of the operators into the three end-to-end flows.

E1 ingest: raw files -> normalise -> parse -> region + class -> per-year table.
E2 annual index: messages -> durations -> annual scores -> indices.
E3 trend: indices of all years -> yearly summary -> trend tables.
Each flow is one lazy plan; nothing but year-level rows reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from warnindex.operators.durations import calculate_durations
from warnindex.operators.index import calculate_indicators, yearly_summary
from warnindex.operators.normalize import normalize_schema, parse_timestamps
from warnindex.operators.regions import restrict_to_region
from warnindex.params import DurationParams, IndexParams
from warnindex.sources import adapters


def prepare_messages(raw: DataFrame, areas: DataFrame | None = None, require_offset: bool = False) -> DataFrame:
    """E1 step 4: P1-P6, then (optionally) P7 + J1."""
    d = parse_timestamps(normalize_schema(raw), require_offset)
    if areas is not None:
        d = restrict_to_region(d, areas, require_areas=True)
    return d


def ingest(spark: SparkSession, paths, areas: DataFrame, table_path: str, fmt: str | None = None,
           require_offset: bool = False) -> tuple[dict, DataFrame]:
    """Raw files -> clean messages of the region -> per-year table.

    Returns (load metrics, report_by_year).  The metrics -- rows loaded,
    unmapped severity texts (P3), missing or invalid raise times (P6, and V2
    before the year split, N14), rows kept by the region (P7) -- are
    ``observe``d while the table is written, so they cost no extra pass.  The
    per-year report (A18) runs on the written table, one job for all years.
    """
    from warnindex.operators.quality import report
    from warnindex.sources.files import load_raw, read_year, stage_table, write_yearly

    parsed = parse_timestamps(normalize_schema(load_raw(spark, paths, fmt)), require_offset)
    loaded = Observation("loaded")
    parsed = parsed.observe(
        loaded,
        F.count(F.lit(1)).alias("records_loaded"),
        F.count_if(F.col("severityLevel").isNull() & F.col("severity").isNotNull()).alias("unmapped_severity"),
        F.count_if(F.col("timeRaised").isNull()).alias("missing_timeRaised"),
    )
    areas = stage_table(areas.select("fwdCode", "isTidal").dropDuplicates(["fwdCode"]), "areas")  # counted and joined
    kept = Observation("region")
    region = restrict_to_region(parsed, areas, require_areas=True).observe(kept, F.count(F.lit(1)).alias("region_records"))
    write_yearly(region, table_path)
    return {**loaded.get, **kept.get}, report(read_year(spark, table_path).drop("year"), by_year=True)


def run_years(spark: SparkSession, load, years, table_path: str, log_path: str, run_id: str, reports_path: str | None = None,
              validate: bool = True, logged_at: str | None = None) -> DataFrame:
    """E1 for the requested years, stage by stage, with a run record (S12): load, validation, export.

    ``load``: a function that gives the region's clean messages (or these themselves).  All years go through each
    stage in one job; a stage that breaks off breaks off for all of them.  Without a load there is
    nothing further; a validation that breaks off is recorded and the export goes on.  Each stage's rows
    are appended to the log as soon as it ends.  Returns the run's metrics."""
    from warnindex.operators.quality import report_documents
    from warnindex.sources.files import read_year, stage_table, write_yearly
    from warnindex.sources.sinks import append_run_log, read_run_log, run_metrics, write_quality_reports

    years = sorted({int(y) for y in years})

    def record(stage, status, error=None, records=None, passed=None, path=None):
        append_run_log(spark, log_path, [(run_id, y, stage, status, error, records and records.get(y, 0) or (0 if records is not None else None),
                                          passed.get(y, True) if passed is not None else None, path, logged_at) for y in years])

    def reason(e):
        return f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500]

    try:
        messages = stage_table(load() if callable(load) else load, "run-messages")
        year = F.year("timeRaised")
        messages = messages.where(year.isin(years))
        counts = {r["year"]: r["count"] for r in messages.groupBy(year.alias("year")).count().collect()}
        record("load", "success", records=counts)
    except Exception as e:  # noqa: BLE001 - whatever breaks a load is recorded
        record("load", "failed", reason(e))
        return run_metrics(read_run_log(spark, log_path, run_id))
    if validate:
        try:
            docs = stage_table(report_documents(messages, by_year=True), "run-reports")
            if reports_path is not None:
                write_quality_reports(docs, reports_path)
            passed = {r["year"]: r["passed"] for r in docs.select("year", "passed").collect()}
            record("validation", "success", passed=passed)
        except Exception as e:  # noqa: BLE001
            record("validation", "failed", reason(e))
    try:
        write_yearly(messages, table_path)
        written = read_year(spark, table_path).where(F.col("year").isin(years)).groupBy("year").count().collect()
        record("export", "success", records={r["year"]: r["count"] for r in written}, path=table_path)
    except Exception as e:  # noqa: BLE001
        record("export", "failed", reason(e), path=table_path)
    return run_metrics(read_run_log(spark, log_path, run_id))


def annual_index(messages: DataFrame, duration: DurationParams | None = None,
                 index: IndexParams | None = None, years=None, stage_input: bool = False) -> DataFrame:
    """E2 for every year at once (one row per year, I4), or for ``years``.

    With ``gap_scope="year"`` no gap crosses a year, so the requested years
    (plus a data-derived baseline year) are selected *before* the window --
    a timestamp range the parquet scan can use.  With ``"all"`` gaps cross
    years, so the selection happens after the computation.

    ``stage_input``: write the projected messages once as a table in the
    shared folder first (the plan reads its input once either way; a table
    also survives for further calls).
    """
    from functools import reduce

    from warnindex.operators.scoring import year_range

    d = duration or DurationParams()
    ip = index or IndexParams()
    if stage_input:
        from warnindex.sources.files import stage_table

        cols = [c for c in ("fwdCode", "timeRaised", "severity", "severityLevel", "isTidal", "msg_id")
                if c in messages.columns]
        messages = stage_table(messages.select(*cols), "messages")
    if years is None:
        return calculate_indicators(calculate_durations(messages, d), ip)
    wanted = sorted({int(y) for y in years})
    if d.gap_scope == "year" and (ip.baseline is not None or ip.baseline_year is not None):
        keep = set(wanted) | ({ip.baseline_year} if ip.baseline is None else set())
        messages = messages.where(reduce(lambda a, b: a | b, [year_range(y) for y in sorted(keep)]))
    ind = calculate_indicators(calculate_durations(messages, d), ip)
    return ind.where(F.col("year").isin(wanted))


def index_from_stored_baseline(messages: DataFrame, baseline_path: str, duration: DurationParams | None = None,
                               index: IndexParams | None = None, years=None) -> DataFrame:
    """E2 against the baseline stored at ``baseline_path`` (S15, J4); without one there, an error."""
    from dataclasses import replace

    from warnindex.sources.files import LoadError, load_baseline

    stored = load_baseline(messages.sparkSession, baseline_path)
    if stored is None:
        raise LoadError(f"no baseline is stored at {baseline_path}")
    return annual_index(messages, duration, replace(index or IndexParams(), baseline=stored), years)


def trend_summary(messages: DataFrame, duration: DurationParams | None = None,
                  index: IndexParams | None = None, first_year: int | None = None) -> DataFrame:
    """E3 first step: the yearly summary table."""
    return yearly_summary(annual_index(messages, duration, index), first_year)


# ---- the same flows over the driver's test tables ---------------------------

def orders_region_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders adapter restricted to the region, with the area class joined.

    The region is applied to the customers first (customer x small area
    table), so the large orders join only meets customers of the region;
    same rows as restricting the joined messages afterwards."""
    return adapters.orders_raw_messages(spark, sf_dir, areas=adapters.region_areas(spark, sf_dir))


def orders_index_params() -> IndexParams:
    return IndexParams(baseline_year=adapters.ORDERS_BASELINE_YEAR)


def orders_annual_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annual_index(orders_region_messages(spark, sf_dir), DurationParams(gap_scope="year"), orders_index_params())


def orders_yearly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yearly_summary(orders_annual_index(spark, sf_dir))


def calculate_year(messages: DataFrame, year: int, duration: DurationParams | None = None,
                   index: IndexParams | None = None, save_baseline_to: str | None = None) -> DataFrame:
    """E2 for one year (the single-year command): that year's indicator row.

    ``save_baseline_to``: persist the year's scores as the baseline, only when
    ``year`` is the baseline year (I6); otherwise nothing is written.
    """
    from warnindex.operators.index import baseline_from_indicators
    from warnindex.sources.files import write_baseline

    ip = index or IndexParams()
    ind = annual_index(messages, duration, ip, years=[year])
    base_year = ip.baseline.year if ip.baseline is not None else ip.baseline_year
    if save_baseline_to is not None and base_year is not None and int(year) == int(base_year):
        write_baseline(baseline_from_indicators(ind, year), save_baseline_to)
    return ind


def trend_report(summary: DataFrame) -> dict[str, DataFrame]:
    """Every table of the trend report from the yearly summary (W2-W4,
    A15, F17).  The summary, a row per year, is computed once and written; all
    six tables read that."""
    from warnindex.operators import trend
    from warnindex.sources.files import stage_table

    summary = stage_table(summary, "summary")

    return {
        "summary": summary,
        "year_on_year": trend.year_on_year(summary),
        "endpoint_change": trend.endpoint_change(summary),
        "extreme_years": trend.extreme_years(summary),
        "totals": trend.trend_totals(summary),
        "bars": trend.trend_bars(summary),
    }
