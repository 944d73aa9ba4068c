"""Durations, scores and annual totals."""

import re
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from warnindex.operators.durations import calculate_durations, lead_gaps
from warnindex.operators.scoring import annual_by_class, annual_total, breakdown_by_class, severity_breakdown
from warnindex.params import DurationParams

ALL = DurationParams(gap_scope="all")


def by_id(df, *cols):
    return {r["msg_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_single_message_gets_default(msgs):
    d = calculate_durations(msgs([("A", "2024-01-01T10:00:00", "Flood Alert", 3)]), ALL)
    r = d.collect()[0]
    assert r.duration_hours == 48.0 and r.gap_to_next_hours is None and r.score == 48.0


def test_gap_under_default(msgs):
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Flood Alert", 3),
                                  ("A", "2024-01-01T17:30:00", "Flood Alert", 3)]), ALL)
    assert sorted(v[0] for v in by_id(d, "duration_hours").values()) == [17.5, 48.0]


def test_gap_over_max_gets_default(msgs):
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Flood Warning", 2),
                                  ("A", "2024-01-04T00:00:01", "Flood Alert", 3)]), ALL)
    assert by_id(d, "duration_hours")[0] == (24.0,)


def test_gap_exactly_max_is_not_over(msgs):
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Update Flood Alert", 3),
                                  ("A", "2024-01-04T00:00:00", "Flood Alert", 3)]), ALL)
    assert by_id(d, "duration_hours")[0] == (72.0,)


def test_update_keeps_full_gap_above_default(msgs):
    # An update keeps a 60 h gap although its default is 48 h.
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Update Flood Alert", 3),
                                  ("A", "2024-01-03T12:00:00", "Flood Alert", 3)]), ALL)
    assert by_id(d, "is_update", "duration_hours")[0] == (True, 60.0)


def test_suffix_update_is_not_update(msgs):
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Flood Alert Update", None),
                                  ("A", "2024-01-02T06:00:00", "Flood Alert", 3)]), ALL)
    upd, hours, score = by_id(d, "is_update", "duration_hours", "score")[0]
    assert upd is False and hours == 24.0 and score == 0.0  # N1: null level -> 24 h, weight 0


def test_level_four_scores_zero(msgs):
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Warning No Longer in Force", 4)]), ALL)
    r = d.collect()[0]
    assert r.duration_hours == 0.0 and r.score == 0.0 and r.weight == 0


def test_update_level_four_keeps_gap_hours(msgs):
    # Weight 0 but hours count the gap.
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Update Warning No Longer in Force", 4),
                                  ("A", "2024-01-01T05:00:00", "Flood Alert", 3)]), ALL)
    assert by_id(d, "duration_hours", "score")[0] == (5.0, 0.0)


def test_empty_frame_keeps_schema(msgs):
    d = calculate_durations(msgs([]), ALL)
    assert d.count() == 0
    assert {"duration_hours", "score", "gap_to_next_hours", "is_update", "weight"} <= set(d.columns)


def test_missing_columns_raise(msgs):
    with pytest.raises(ValueError):
        calculate_durations(msgs([]).drop("severity"), ALL)


def test_weights_by_level(msgs):
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Severe Flood Warning", 1),
                                  ("B", "2024-01-01T00:00:00", "Flood Warning", 2),
                                  ("C", "2024-01-01T00:00:00", "Flood Alert", 3)]), ALL)
    assert sorted(v[0] for v in by_id(d, "score").values()) == [36.0, 48.0, 48.0]


def test_class_split_and_year_filter(msgs):
    d = calculate_durations(msgs([("A", "2020-06-01T00:00:00", "Flood Alert", 3, False),
                                  ("B", "2020-06-01T00:00:00", "Flood Alert", 3, True),
                                  ("C", "2021-06-01T00:00:00", "Flood Alert", 3, None)]), ALL)
    rows = {r.year: r for r in annual_by_class(d).collect()}
    r20 = rows[2020]
    assert (r20.fluvial_events, r20.coastal_events, r20.other_events, r20.total_events) == (1, 1, 0, 2)
    assert (r20.fluvial_hours, r20.coastal_hours, r20.other_score) == (48.0, 48.0, 0.0)
    assert rows[2021].other_events == 1 and rows[2021].fluvial_score == 0.0
    tot = {r.year: r.total_events for r in annual_total(d).collect()}
    assert tot == {2020: 2, 2021: 1}


def test_severity_breakdown_zero_filled(msgs):
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Severe Flood Warning", 1),
                                  ("B", "2024-01-01T00:00:00", "Flood Alert", 3)]), ALL)
    got = {r.severityLevel: (r.event_count, r.total_hours, r.weighted_score) for r in severity_breakdown(d).collect()}
    assert got == {1: (1, 12.0, 36.0), 2: (0, 0.0, 0.0), 3: (1, 48.0, 48.0)}
    comp = breakdown_by_class(d).collect()
    assert len(comp) == 12  # 4 components x 3 levels, zero-filled


def test_fixture_by_hand(msgs):
    # by hand: fluvial 7 + 13 + 48 = 68 h, all weight 1; coastal 5 + 24 = 29 h, weight 2
    d = calculate_durations(msgs([
        ("F", "2024-01-01T00:00:00", "Flood Alert", 3, False),
        ("F", "2024-01-01T07:00:00", "Flood Alert", 3, False),
        ("F", "2024-01-01T20:00:00", "Flood Alert", 3, False),
        ("C", "2024-01-01T00:00:00", "Flood Warning", 2, True),
        ("C", "2024-01-01T05:00:00", "Flood Warning", 2, True),
    ]), ALL)
    r = annual_by_class(d).collect()[0]
    assert (r.fluvial_hours, r.fluvial_score, r.coastal_hours, r.coastal_score) == (68.0, 68.0, 29.0, 58.0)


def test_whole_seconds_truncated(msgs):
    # 00.9 -> 02.1 is one whole second.
    d = lead_gaps(msgs([("A", datetime(2024, 1, 1, 0, 0, 0, 900000), "Flood Alert", 3),
                        ("A", datetime(2024, 1, 1, 0, 0, 2, 100000), "Flood Alert", 3)]), ALL)
    assert by_id(d, "gap_seconds")[0] == (1,)


def test_gap_scope_year_vs_all(msgs):
    # The last message of a year gets the default in year scope.
    rows = [("A", "2020-12-31T20:00:00", "Flood Alert", 3), ("A", "2021-01-01T02:00:00", "Flood Alert", 3)]
    all_ = by_id(calculate_durations(msgs(rows), ALL), "duration_hours")[0]
    year = by_id(calculate_durations(msgs(rows), DurationParams(gap_scope="year")), "duration_hours")[0]
    assert all_ == (6.0,) and year == (48.0,)


def test_tie_break_is_deterministic(msgs):
    # Equal (area, time): ordered by level, text, id.
    rows = [("A", "2024-01-01T00:00:00", "Flood Alert", 3), ("A", "2024-01-01T00:00:00", "Severe Flood Warning", 1),
            ("A", "2024-01-01T05:00:00", "Flood Alert", 3)]
    got = by_id(calculate_durations(msgs(rows), ALL), "gap_seconds")
    assert got == {1: (0,), 0: (5 * 3600,), 2: (None,)}


def test_null_time_rows_get_default(msgs):
    rows = [("A", None, "Flood Alert", 3), ("A", None, "Flood Alert", 3), ("A", "2024-01-01T00:00:00", "Flood Alert", 3),
            ("A", "2024-01-01T01:00:00", "Flood Alert", 3)]
    got = by_id(calculate_durations(msgs(rows), ALL), "gap_seconds", "duration_hours")
    assert got[0] == (None, 48.0) and got[1] == (None, 48.0) and got[2] == (3600, 1.0)


# ---- brute force ----------------------------------------------------------------

TEXTS = ["Flood Alert", "Update Flood Alert", "update  flood warning", " Flood Warning ", "Severe Flood Warning",
         "Warning No Longer in Force", "Flood watch", "Flood Bulletin", None, "UPDATE\tSevere Flood Warning"]
LEVEL = {"flood alert": 3, "flood warning": 2, "severe flood warning": 1, "warning no longer in force": 4,
         "flood watch": 3}


def level_of(text):
    if text is None:
        return None
    s = re.sub(r"^update\s+", "", text.strip(), flags=re.I).lower()
    return LEVEL.get(s)


def brute(rows, scope, p):
    """Straight Python model of the rule on (code, time, text, level, id)."""
    groups = {}
    for r in rows:
        code, t = r[0], r[1]
        key = (code, t.year if (scope == "year" and t is not None) else None)
        groups.setdefault(key, []).append(r)
    out = {}
    ds, fb, mx, ws = p.default_seconds, p.fallback_seconds, p.max_gap_seconds, p.int_weights

    def nf(v):
        return (v is not None, v if v is not None else 0)

    for g in groups.values():
        g.sort(key=lambda r: (nf(r[1]), nf(r[3]), nf(r[2]) if r[2] is not None else (False, ""), r[4]))
        for i, r in enumerate(g):
            nxt = g[i + 1][1] if i + 1 < len(g) else None
            gap = None
            if r[1] is not None and nxt is not None:
                dlt = nxt - r[1]
                gap = dlt.days * 86400 + dlt.seconds
            d = ds.get(r[3], fb)
            upd = r[2] is not None and re.match(r"(?i)^update\s", r[2]) is not None
            if gap is None or gap > mx:
                dur = d
            elif upd:
                dur = gap
            else:
                dur = min(gap, d)
            out[r[4]] = (gap, dur, dur * ws.get(r[3], p.fallback_weight))
    return out


BASE = datetime(2023, 12, 30, 0, 0, 0)
row_st = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.integers(min_value=0, max_value=6 * 24 * 3600).map(
        lambda s: BASE + timedelta(seconds=s, microseconds=(s * 7919) % 1000000))),
    st.sampled_from(TEXTS),
)


@settings(max_examples=24, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row_st, min_size=0, max_size=25), scope=st.sampled_from(["all", "year"]),
       bucket=st.sampled_from([1, 600, 3600, 86400, 10 * 365 * 86400]), coarse=st.sampled_from([None, 2, 24]))
def test_brute_force_matches(spark, rows, scope, bucket, coarse):
    data = [(c, t, s, level_of(s), i) for i, (c, t, s) in enumerate(rows)]
    p = DurationParams(gap_scope=scope, bucket_seconds=bucket,
                       coarse_bucket_seconds=None if coarse is None else coarse * bucket)
    df = spark.createDataFrame(
        [(c, t, s, lv, True, i) for c, t, s, lv, i in data],
        "fwdCode string, timeRaised timestamp_ntz, severity string, severityLevel int, isTidal boolean, msg_id bigint",
    ).repartition(3)
    got = {r.msg_id: (r.gap_seconds, r.duration_seconds, r.score_seconds)
           for r in calculate_durations(df, p).collect()}
    assert got == brute(data, scope, p)


def test_result_independent_of_partitions_and_bucket_width(spark):
    from warnindex.sources.adapters import events_messages

    base = events_messages(spark, "/root/testdata/sf0.001")
    ref = {r.msg_id: (r.gap_seconds, r.score_seconds) for r in calculate_durations(base, ALL).collect()}
    for parts, width, coarse in ((1, 60, None), (7, 86400 * 40, None), (3, 1, None), (5, 1, 3600), (2, 60, 86400)):
        p = DurationParams(gap_scope="all", bucket_seconds=width, coarse_bucket_seconds=coarse)
        got = {r.msg_id: (r.gap_seconds, r.score_seconds)
               for r in calculate_durations(base.repartition(parts), p).collect()}
        assert got == ref


def test_hot_area_is_split_across_window_groups(spark):
    """One area with half of all rows: no window group holds more than the
    rows of one area-hour, and the answer equals the unsplit window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from warnindex.operators.durations import window_group_sizes

    base = spark.range(0, 6000).select(
        F.when(F.col("id") % 2 == 0, F.lit("HOT")).otherwise((F.col("id") % 50).cast("string")).alias("fwdCode"),
        (F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_dt_interval(secs=F.col("id") * 37)).alias("timeRaised"),
        F.lit("Flood Alert").alias("severity"),
        F.lit(3).alias("severityLevel"),
        F.lit(False).alias("isTidal"),
        F.col("id").alias("msg_id"),
    )
    p = DurationParams(gap_scope="all", bucket_seconds=3600)
    sizes = window_group_sizes(base, p)
    top = sizes.first()
    hot_rows = base.where("fwdCode = 'HOT'").count()
    assert top.rows <= 3600 // 37 // 2 + 2 and hot_rows == 3000
    got = {r.msg_id: r.gap_seconds for r in lead_gaps(base, p).collect()}
    w = Window.partitionBy("fwdCode").orderBy("timeRaised", "msg_id")
    plain = base.withColumn("g", F.timestamp_diff("SECOND", "timeRaised", F.lead("timeRaised").over(w)))
    assert got == {r.msg_id: r.g for r in plain.collect()}


def test_class_tables_need_the_class_column(msgs):
    # Without isTidal the class tables fail with a clear error; the totals still work.
    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Flood Alert", 3)]).drop("isTidal"), ALL)
    with pytest.raises(ValueError, match="isTidal"):
        annual_by_class(d)
    with pytest.raises(ValueError, match="isTidal"):
        breakdown_by_class(d)
    assert annual_total(d).collect()[0].total_events == 1


def test_burst_in_one_hour_is_split_with_two_levels(spark):
    """Half of all rows in one area within one hour: 1 s buckets under 1 h
    coarse buckets keep every window group small, and the answer is exact."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from warnindex.operators.durations import window_group_sizes

    base = spark.range(0, 4000).select(
        F.when(F.col("id") % 2 == 0, F.lit("HOT")).otherwise((F.col("id") % 40).cast("string")).alias("fwdCode"),
        (F.expr("TIMESTAMP_NTZ '2024-03-01 10:00:00'")
         + F.make_dt_interval(secs=F.when(F.col("id") % 2 == 0, F.col("id") / 2 % 3600).otherwise(F.col("id") * 97))
         ).alias("timeRaised"),
        F.lit("Flood Warning").alias("severity"),
        F.lit(2).alias("severityLevel"),
        F.lit(True).alias("isTidal"),
        F.col("id").alias("msg_id"),
    )
    one_level = DurationParams(gap_scope="all")
    assert window_group_sizes(base, one_level).first().rows >= 2000      # the burst is one hour-bucket
    p = DurationParams(gap_scope="all", bucket_seconds=1, coarse_bucket_seconds=3600)
    assert window_group_sizes(base, p).first().rows <= 2
    got = {r.msg_id: r.gap_seconds for r in lead_gaps(base, p).collect()}
    w = Window.partitionBy("fwdCode").orderBy("timeRaised", "severityLevel", "severity", "msg_id")
    plain = base.withColumn("g", F.timestamp_diff("SECOND", "timeRaised", F.lead("timeRaised").over(w)))
    assert got == {r.msg_id: r.g for r in plain.collect()}


def test_null_codes_are_one_area_at_any_width(msgs):
    rows = [(None, "2024-01-01T00:00:00", "Flood Alert", 3), (None, "2024-01-01T05:00:00", "Flood Alert", 3)]
    for width in (60, 3600, 86400):
        got = by_id(calculate_durations(msgs(rows), DurationParams(gap_scope="all", bucket_seconds=width)), "gap_seconds")
        assert got == {0: (18000,), 1: (None,)}


def test_fractional_weights_sum_exactly(spark, msgs):
    from warnindex.operators.scoring import annual_by_class

    p = DurationParams(gap_scope="all", weights={3: 0.1}, fallback_weight=0.3)
    rows = [("A", f"2024-01-{d:02d}T00:00:00", "Flood Alert", 3) for d in range(1, 31)]
    d = calculate_durations(msgs(rows), p)
    assert dict(d.dtypes)["weight"] == "decimal(9,4)"
    # 29 gaps of 24 h and one default of 48 h, times a tenth
    assert annual_by_class(d).collect()[0].total_score == (29 * 24 + 48) / 10


def executed_plan(df):
    """The plan that ran, stages shared."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "== Final Plan ==" in text
    return text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]


def test_input_is_read_once(spark):
    from warnindex.plans.flows import orders_annual_index

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed_plan(orders_annual_index(spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("orders.parquet") == 1
    assert len(re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[o_custkey", plan)) == 1


@pytest.mark.parametrize("coarse", [None, 86400])
def test_messages_are_shuffled_once(spark, coarse):
    """One exchange takes the input rows; whatever else is exchanged comes from ends of buckets."""
    from warnindex.sources import adapters

    events = adapters.events_messages(spark, "/root/testdata/sf0.01")
    plan = executed_plan(lead_gaps(events, DurationParams(gap_scope="all", bucket_seconds=3600, coarse_bucket_seconds=coarse)))
    assert plan.count("events.parquet") == 1
    assert len(re.findall(r"- Exchange hashpartitioning\([^)]*_salt", plan)) == 1 and "ReusedExchange" in plan
