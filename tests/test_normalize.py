"""Raw columns, severity levels, update flag, timestamps."""

from datetime import datetime

import pytest

from warnindex.functions.severity import is_update, severity_level
from warnindex.operators.normalize import (
    normalize_schema,
    null_timestamps,
    parse_timestamps,
    unmapped_severities,
)
from warnindex.schema import MissingColumnsError


def levels(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "severity string")
    return [r.lvl for r in df.select(severity_level("severity").alias("lvl")).collect()]


def test_standard_texts_and_unknown(spark):
    texts = ["Severe Flood Warning", "Flood Warning", "Flood Alert", "Warning No Longer in Force", "Unknown Type"]
    assert levels(spark, texts) == [1, 2, 3, 4, None]


def test_update_prefix_watch_case_and_whitespace(spark):
    texts = ["Update Flood Alert", "Flood Watch", "Flood alert", "  Flood Warning\t", "\tUPDATE  Severe Flood Warning ",
             "Update Flood Alert", " Flood Alert ", "Flood Alert Update", None]
    assert levels(spark, texts) == [3, 3, 3, 2, 1, 3, 3, None, None]


def test_unicode_space_after_update(spark):
    # A no-break space after "Update" still strips the prefix and flags an update.
    df = spark.createDataFrame([("Update\u00a0Flood Alert",), ("Flood Alert\u00a0",)], "severity string")
    got = [(r.lvl, r.u) for r in df.select(severity_level("severity").alias("lvl"), is_update("severity").alias("u")).collect()]
    assert got == [(3, True), (3, False)]


def test_is_update_uses_raw_text(spark):
    # Leading space -> mapped but not an update; suffix -> neither.
    texts = ["Update Flood Alert", " Update Flood Alert", "Flood Alert Update", "update flood alert", "Updated x", None]
    df = spark.createDataFrame([(t,) for t in texts], "severity string")
    got = [r.u for r in df.select(is_update("severity").alias("u")).collect()]
    assert got == [True, False, False, True, False, None]


def test_rename_and_required(spark):
    raw = spark.createDataFrame([("2024-01-01T00:00:00Z", "C1", "Flood Alert", "Label", "Ref")],
                                "DATE string, CODE string, TYPE string, `WARNING / ALERT AREA NAME` string, AREA string")
    out = normalize_schema(raw)
    assert set(out.columns) >= {"timeRaised", "fwdCode", "severity", "label", "area_ref", "severityLevel"}
    with pytest.raises(MissingColumnsError):
        normalize_schema(raw.drop("CODE"))


def test_timestamp_parse(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00+01:00",), ("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00",),
                                ("not a time",), (None,)], "timeRaised string")
    got = [r.timeRaised for r in parse_timestamps(df).collect()]
    assert got == [datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10), None, None]
    strict = [r.timeRaised for r in parse_timestamps(df, require_offset=True).collect()]
    assert strict == [datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 10), None, None, None]
    nulls = null_timestamps(parse_timestamps(df)).collect()[0]
    assert nulls.total_records == 5 and nulls.missing_timeRaised == 2


def test_native_times_kept(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5),)], "timeRaised timestamp_ntz")
    out = parse_timestamps(df)
    assert out.collect()[0].timeRaised == datetime(2024, 1, 1, 5)


def test_unmapped_report(spark):
    df = spark.createDataFrame([("Flood Bulletin",), ("Flood Bulletin",), ("Flood Alert",), (None,)], "severity string")
    df = df.withColumn("severityLevel", severity_level("severity"))
    got = {r.severity: r.n_rows for r in unmapped_severities(df).collect()}
    assert got == {"Flood Bulletin": 2}
