"""Registry of the queries the driver runs: name -> (spark, sf_dir) -> DataFrame.

Keys follow SURVEY §7.5; every one has a DuckDB twin in ``oracles.py``.  All
queries read the given tables whole (or data Spark derives from them).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from warnindex.functions.severity import normalized_severity
from warnindex.functions.timeparse import parse_timestamp
from warnindex.operators import durations, index, normalize, regions, scoring, trend
from warnindex.params import DurationParams
from warnindex.plans import flows
from warnindex.sources import adapters as A

ALL = DurationParams(gap_scope="all")
YEAR = DurationParams(gap_scope="year")


def _events_scored(spark, d):
    return durations.calculate_durations(A.events_messages(spark, d), ALL)


def _orders_scored(spark, d):
    return durations.calculate_durations(flows.orders_region_messages(spark, d), YEAR)


def _orders_ind(spark, d):
    return flows.orders_annual_index(spark, d)


def _summary(spark, d):
    return flows.orders_yearly_summary(spark, d)


def q_severity_normalize(spark, d):
    return A.events_messages(spark, d).select(
        "msg_id", "severity", normalized_severity("severity").alias("normalized"), "severityLevel"
    )


def q_unmapped_severity(spark, d):
    return normalize.unmapped_severities(A.orders_raw_messages(spark, d))


def q_is_update_flag(spark, d):
    from warnindex.functions.severity import is_update

    return A.events_messages(spark, d).select("msg_id", "severity", is_update("severity").alias("is_update"))


def q_region_filter(spark, d):
    return regions.region_filter(A.orders_raw_messages(spark, d), A.region_areas(spark, d)).select("msg_id", "fwdCode")


def q_region_join_class(spark, d):
    return regions.join_class(A.orders_raw_messages(spark, d), A.nation_areas(spark, d)).select("msg_id", "fwdCode", "isTidal")


def q_year_filter(spark, d):
    return scoring.filter_year(flows.orders_region_messages(spark, d), 1997).select("msg_id", "fwdCode", "timeRaised")


def q_lead_gap_all(spark, d):
    return durations.lead_gaps(A.events_messages(spark, d), ALL).select("msg_id", "gap_seconds", "gap_to_next_hours")


def q_lead_gap_year(spark, d):
    return durations.lead_gaps(flows.orders_region_messages(spark, d), YEAR).select("msg_id", "gap_seconds", "gap_to_next_hours")


def q_duration_rule(spark, d):
    return _events_scored(spark, d).select("msg_id", "is_update", "gap_seconds", "duration_seconds", "duration_hours")


def q_message_scores(spark, d):
    return _events_scored(spark, d).select("msg_id", "severityLevel", "weight", "score_seconds", "score")


def q_annual_total(spark, d):
    return scoring.annual_total(_orders_scored(spark, d))


def q_annual_by_class(spark, d):
    return scoring.annual_by_class(_events_scored(spark, d))


def q_severity_breakdown(spark, d):
    return scoring.severity_breakdown(_orders_scored(spark, d))


def q_breakdown_grouping_sets(spark, d):
    return scoring.breakdown_by_class(_orders_scored(spark, d))


def q_self_baseline(spark, d):
    return index.baseline_from_indicators(_orders_ind(spark, d), A.ORDERS_BASELINE_YEAR)


def q_annual_index(spark, d):
    return _orders_ind(spark, d)


def q_baseline_change(spark, d):
    return index.baseline_change(_orders_ind(spark, d))


def q_yearly_summary(spark, d):
    return _summary(spark, d)


def q_index_listing(spark, d):
    """I8 for three years; year scope lets the year selection reach the scan."""
    years = [1996, 1998, 2000]
    ind = flows.annual_index(flows.orders_region_messages(spark, d), YEAR, flows.orders_index_params(), years=years)
    return index.index_listing(ind, years)


def q_year_on_year(spark, d):
    return trend.year_on_year(_summary(spark, d))


def q_endpoint_change(spark, d):
    return trend.endpoint_change(_summary(spark, d))


def q_extreme_years(spark, d):
    return trend.extreme_years(_summary(spark, d))


def q_trend_totals(spark, d):
    return trend.trend_totals(_summary(spark, d))


def q_trend_bars(spark, d):
    return trend.trend_bars(_summary(spark, d))


def q_sample_first_rows(spark, d):
    from warnindex.operators.summary import sample_rows

    return sample_rows(_events_scored(spark, d), 10).select(
        "fwdCode", "timeRaised", "msg_id", "severity", "duration_seconds", "score_seconds"
    )


def q_union_sources(spark, d):
    from warnindex.operators.summary import union_sources

    cols = ["fwdCode", "timeRaised", "severity", "severityLevel"]
    return union_sources([A.events_messages(spark, d).select(*cols), A.orders_raw_messages(spark, d).select(*cols)])


def q_timestamp_parse(spark, d):
    e = A.table(spark, d, "events").select("event_id", "ts", "props")
    k = F.col("event_id") % 7
    txt = (
        F.when(k == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
        .when(k == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(k == 2, F.col("props"))
        .when(k == 3, F.date_format("ts", "HH:mm:ss"))
        .when(k == 4, F.date_format("ts", "yyyy"))
        .when(k == 5, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(" Europe/Paris")))
    )
    return e.select("event_id", txt.alias("txt")).select("event_id", "txt", parse_timestamp("txt").alias("parsed"))


FRACTIONS = {1: 2.5, 2: 1.25, 3: 0.3333, 4: 0.0}


def q_lead_gap_null_area(spark, d):
    """W1 where many messages have no area code: they are one area of their own."""
    m = A.events_messages(spark, d)
    m = m.withColumn("fwdCode", F.when(F.col("fwdCode").cast("bigint") % 5 != 0, F.col("fwdCode")))
    return durations.lead_gaps(m, ALL).select("msg_id", "fwdCode", "gap_seconds", "gap_to_next_hours")


def q_message_scores_fractional(spark, d):
    p = DurationParams(gap_scope="all", weights=FRACTIONS, fallback_weight=0.5)
    s = durations.calculate_durations(A.events_messages(spark, d), p)
    return s.select("msg_id", "severityLevel", F.col("weight").cast("double").alias("weight"), "score")


def q_annual_total_fractional(spark, d):
    p = DurationParams(gap_scope="year", weights=FRACTIONS, fallback_weight=0.5)
    return scoring.annual_total(durations.calculate_durations(flows.orders_region_messages(spark, d), p))


def q_index_without_baseline(spark, d):
    """The baseline year is not in the data, so there are no indices."""
    from warnindex.params import IndexParams

    ind = flows.annual_index(flows.orders_region_messages(spark, d), YEAR, IndexParams(baseline_year=1899))
    return ind.select("year", "total_score_raw", "fluvial_index", "composite_index")


def q_index_other_weights(spark, d):
    """Other class weights that add up to one."""
    from dataclasses import replace

    p = replace(flows.orders_index_params(), fluvial_weight=0.6, coastal_weight=0.4)
    ind = flows.annual_index(flows.orders_region_messages(spark, d), YEAR, p)
    return ind.select("year", F.col("composite_index").alias("composite"))


def q_durations_with_empty_part(spark, d):
    """Scoring no messages gives no rows of the same columns and types."""
    m = A.events_messages(spark, d)
    none = durations.calculate_durations(scoring.filter_year(m, 1899), ALL)
    return none.union(durations.calculate_durations(m, ALL)).select("msg_id", "duration_seconds", "weight", "score_seconds")


def q_region_checked(spark, d):
    """P22 before P7 and J1: the region must not be empty."""
    areas = regions.check_region(A.region_areas(spark, d))
    return regions.restrict_to_region(A.orders_raw_messages(spark, d), areas).select("msg_id", "fwdCode", "isTidal")


CORE = {
    "lead_gap_null_area": q_lead_gap_null_area,
    "message_scores_fractional": q_message_scores_fractional,
    "annual_total_fractional": q_annual_total_fractional,
    "index_without_baseline": q_index_without_baseline,
    "index_other_weights": q_index_other_weights,
    "durations_with_empty_part": q_durations_with_empty_part,
    "region_checked": q_region_checked,
    "severity_normalize": q_severity_normalize,
    "unmapped_severity": q_unmapped_severity,
    "is_update_flag": q_is_update_flag,
    "region_filter": q_region_filter,
    "region_join_class": q_region_join_class,
    "year_filter": q_year_filter,
    "lead_gap_all": q_lead_gap_all,
    "lead_gap_year": q_lead_gap_year,
    "duration_rule": q_duration_rule,
    "message_scores": q_message_scores,
    "annual_total": q_annual_total,
    "annual_by_class": q_annual_by_class,
    "severity_breakdown": q_severity_breakdown,
    "breakdown_grouping_sets": q_breakdown_grouping_sets,
    "self_baseline": q_self_baseline,
    "annual_index": q_annual_index,
    "baseline_change": q_baseline_change,
    "yearly_summary": q_yearly_summary,
    "index_listing": q_index_listing,
    "year_on_year": q_year_on_year,
    "endpoint_change": q_endpoint_change,
    "extreme_years": q_extreme_years,
    "trend_totals": q_trend_totals,
    "trend_bars": q_trend_bars,
    "sample_first_rows": q_sample_first_rows,
    "union_sources": q_union_sources,
    "timestamp_parse": q_timestamp_parse,
}


# ---- quality, summary, areas --------------------------------------------------

def _q_msgs(spark, d):
    return A.quality_messages(spark, d)


def _supplier_areas(spark, d):
    return regions.areas_from_items(A.supplier_area_items(spark, d))


def q_data_summary(spark, d):
    from warnindex.operators.summary import data_summary

    return data_summary(A.lineitem_messages(spark, d))


def q_severity_histogram(spark, d):
    from warnindex.operators.summary import severity_histogram

    return severity_histogram(A.lineitem_messages(spark, d))


def q_class_histogram(spark, d):
    from warnindex.operators.summary import class_histogram

    return class_histogram(_q_msgs(spark, d))


def q_null_timestamps(spark, d):
    return normalize.null_timestamps(_q_msgs(spark, d))


def q_duplicate_keys(spark, d):
    from warnindex.operators import quality

    return quality.duplicate_keys(_q_msgs(spark, d))


def q_incomplete_areas(spark, d):
    from warnindex.operators import quality

    return quality.incomplete_areas(_q_msgs(spark, d))


def q_long_spans(spark, d):
    from warnindex.operators import quality

    return quality.long_spans(_q_msgs(spark, d))


def q_time_inconsistency(spark, d):
    from warnindex.operators import quality

    return quality.time_inconsistency(_q_msgs(spark, d))


def q_completeness(spark, d):
    from warnindex.operators import quality

    return quality.completeness(_q_msgs(spark, d))


def q_invalid_levels(spark, d):
    from warnindex.operators import quality

    return quality.invalid_levels(_q_msgs(spark, d))


def q_quality_issues(spark, d):
    from warnindex.operators import quality

    return quality.validate(_q_msgs(spark, d))


def q_quality_report(spark, d):
    from warnindex.operators import quality

    return quality.report(_q_msgs(spark, d))


def q_issue_examples(spark, d):
    from warnindex.operators import quality

    return quality.issue_examples(_q_msgs(spark, d))


def q_issue_examples_by_year(spark, d):
    from warnindex.operators import quality

    return quality.issue_examples(_q_msgs(spark, d), by_year=True)


def q_quality_missing_column(spark, d):
    """V1: messages without their levels."""
    from warnindex.operators import quality

    return quality.validate(_q_msgs(spark, d).drop("severityLevel"))


def _expected_areas(spark, d):
    """Supplier areas of the test counties, and one area per nation that has no message."""
    own = regions.county_filter(_supplier_areas(spark, d), A.TEST_COUNTIES).select("fwdCode")
    return own.union(A.table(spark, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))))


def q_area_coverage(spark, d):
    from warnindex.operators import quality

    return quality.area_coverage(A.lineitem_messages(spark, d), _expected_areas(spark, d))


def q_coverage_examples(spark, d):
    from warnindex.operators import quality

    return quality.coverage_examples(A.lineitem_messages(spark, d), _expected_areas(spark, d))


def q_county_filter(spark, d):
    return regions.county_filter(_supplier_areas(spark, d), A.TEST_COUNTIES).select("fwdCode", "county")


def q_class_from_text(spark, d):
    return _supplier_areas(spark, d).select("fwdCode", "riverOrSea", "isTidal")


def q_area_dimension(spark, d):
    return _supplier_areas(spark, d)


def q_county_tallies(spark, d):
    return regions.county_tallies(_supplier_areas(spark, d), A.TEST_COUNTIES)


def q_area_class_counts(spark, d):
    return regions.area_class_counts(regions.county_filter(_supplier_areas(spark, d), A.TEST_COUNTIES))


def q_area_codes(spark, d):
    from warnindex.operators.summary import distinct_codes

    return distinct_codes(A.lineitem_messages(spark, d))


def q_flood_areas(spark, d):
    return regions.flood_areas(_supplier_areas(spark, d), "EUROPE").select("fwdCode", "county")


def q_current_floods(spark, d):
    return regions.current_floods(A.events_messages(spark, d), 1).select("msg_id", "fwdCode", "severityLevel")


def q_class_counts(spark, d):
    return scoring.class_counts(flows.orders_region_messages(spark, d))


QUALITY = {
    "class_counts": q_class_counts,
    "data_summary": q_data_summary,
    "severity_histogram": q_severity_histogram,
    "class_histogram": q_class_histogram,
    "null_timestamps": q_null_timestamps,
    "duplicate_keys": q_duplicate_keys,
    "incomplete_areas": q_incomplete_areas,
    "long_spans": q_long_spans,
    "time_inconsistency": q_time_inconsistency,
    "completeness": q_completeness,
    "invalid_levels": q_invalid_levels,
    "quality_issues": q_quality_issues,
    "quality_report": q_quality_report,
    "issue_examples": q_issue_examples,
    "issue_examples_by_year": q_issue_examples_by_year,
    "quality_missing_column": q_quality_missing_column,
    "area_coverage": q_area_coverage,
    "coverage_examples": q_coverage_examples,
    "county_filter": q_county_filter,
    "class_from_text": q_class_from_text,
    "area_dimension": q_area_dimension,
    "county_tallies": q_county_tallies,
    "area_class_counts": q_area_class_counts,
    "area_codes": q_area_codes,
    "flood_areas": q_flood_areas,
    "current_floods": q_current_floods,
}


def registry() -> dict:
    from warnindex.plans.filequeries import FILES

    return {**CORE, **QUALITY, **FILES}
