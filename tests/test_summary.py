"""A5-A8, N7, N12."""

from datetime import datetime

from warnindex.operators.durations import calculate_durations
from warnindex.operators.scoring import annual_by_class
from warnindex.operators.summary import class_histogram, data_summary, sample_rows, severity_histogram
from warnindex.params import DurationParams


def test_summary_counts_null_code_once(spark):
    df = spark.createDataFrame([("A", datetime(2024, 1, 1), 1), (None, datetime(2024, 1, 3), None),
                                (None, None, 4), ("B", datetime(2023, 5, 1), 4)],
                               "fwdCode string, timeRaised timestamp_ntz, severityLevel int")
    r = data_summary(df).collect()[0]
    assert (r.total_records, r.unique_warning_areas) == (4, 3)          # N7
    assert (r.earliest, r.latest) == (datetime(2023, 5, 1), datetime(2024, 1, 3))
    hist = [(x.severityLevel, x["count"]) for x in severity_histogram(df).collect()]
    assert hist == [(None, 1), (1, 1), (4, 2)]
    assert class_histogram(df) is None


def test_level_four_counts_as_event(msgs):
    # A closing message scores 0 but is counted.
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Flood Alert", 3),
                                  ("A", "2024-01-01T06:00:00", "Warning No Longer in Force", 4)]),
                            DurationParams(gap_scope="all"))
    r = annual_by_class(d).collect()[0]
    assert (r.fluvial_events, r.fluvial_hours, r.fluvial_score) == (2, 6.0, 6.0)
    top = sample_rows(d, 1).collect()
    assert len(top) == 1 and top[0].severityLevel == 3


def test_summary_report_bundle(spark):
    from warnindex.operators.summary import summary_report

    df = spark.createDataFrame([("A", datetime(2024, 1, 1), 1, True)],
                               "fwdCode string, timeRaised timestamp_ntz, severityLevel int, isTidal boolean")
    rep = summary_report(df)
    assert set(rep) == {"summary", "severity_distribution", "missing_timestamps", "tidal_distribution"}
    assert rep["missing_timestamps"].collect()[0].missing_timeRaised == 0


def test_summary_of_nothing(spark):
    r = data_summary(spark.createDataFrame([], "fwdCode string, timeRaised timestamp_ntz")).collect()[0]
    assert (r.total_records, r.unique_warning_areas, r.earliest) == (0, 0, None)
