"""I1-I8, J4, A16, W2-W4, A15, F15-F17."""

import pytest

from warnindex.operators.durations import calculate_durations
from warnindex.operators.index import (
    baseline_change,
    baseline_from_indicators,
    calculate_indicators,
    index_listing,
    yearly_summary,
)
from warnindex.operators.trend import endpoint_change, extreme_years, trend_bars, trend_totals, year_on_year
from warnindex.params import Baseline, DurationParams, IndexParams

ALL = DurationParams(gap_scope="all")


def scored(msgs, rows):
    return calculate_durations(msgs(rows), ALL)


ROWS = [
    ("F", "2020-03-01T00:00:00", "Flood Alert", 3, False),   # 48 h, score 48
    ("C", "2020-03-01T00:00:00", "Flood Warning", 2, True),  # 24 h, score 48
    ("F", "2021-03-01T00:00:00", "Flood Alert", 3, False),
    ("F", "2021-03-05T00:00:00", "Flood Alert", 3, False),   # fluvial 96
    ("C", "2021-03-01T00:00:00", "Severe Flood Warning", 1, True),  # 12 h x3 = 36
]


def test_self_baseline_gives_100(msgs):
    ind = {r.year: r for r in calculate_indicators(scored(msgs, ROWS), IndexParams(baseline_year=2020)).collect()}
    r = ind[2020]
    assert (r.fluvial_index, r.coastal_index, r.composite_index) == (100.0, 100.0, 100.0)
    assert ind[2021].fluvial_index == 200.0 and ind[2021].coastal_index == 75.0
    assert ind[2021].composite_index == pytest.approx(0.55 * 200 + 0.45 * 75)


def test_first_year_is_baseline_when_unset(msgs):
    ind = {r.year: r for r in calculate_indicators(scored(msgs, ROWS), IndexParams()).collect()}
    assert ind[2020].composite_index == 100.0


def test_fixed_baseline(msgs):
    b = Baseline(year=2020, fluvial_score=24.0, coastal_score=96.0, total_score=120.0)
    ind = {r.year: r for r in calculate_indicators(scored(msgs, ROWS), IndexParams(baseline=b)).collect()}
    assert ind[2020].fluvial_index == 200.0 and ind[2020].coastal_index == 50.0
    assert ind[2020].composite_index == pytest.approx(0.55 * 200 + 0.45 * 50)


def test_zero_fluvial_baseline_gives_zero(msgs):
    b = Baseline(year=2020, fluvial_score=0.0, coastal_score=48.0, total_score=48.0)
    r = [x for x in calculate_indicators(scored(msgs, ROWS), IndexParams(baseline=b)).collect() if x.year == 2020][0]
    assert r.fluvial_index == 0.0 and r.coastal_index == 100.0


def test_counts_and_baseline_row(msgs):
    ind = calculate_indicators(scored(msgs, ROWS), IndexParams(baseline_year=2020))
    r = [x for x in ind.collect() if x.year == 2021][0]
    assert (r.fluvial_events, r.coastal_events, r.total_events, r.severe_warnings, r.flood_alerts) == (2, 1, 3, 1, 2)
    b = baseline_from_indicators(ind, 2020).collect()[0]
    assert (b.year, b.fluvial_score, b.coastal_score, b.fluvial_events) == (2020, 48.0, 48.0, 1)
    assert [x.year for x in index_listing(ind, [2021]).collect()] == [2021]


def test_baseline_change_labels(msgs):
    ind = calculate_indicators(scored(msgs, ROWS), IndexParams(baseline_year=2020))
    got = {r.year: (r.composite_vs_baseline, r.fluvial_change, r.coastal_change) for r in baseline_change(ind).collect()}
    assert got[2020] == ("same", "same", "same")  # N25
    assert got[2021] == ("higher", "increase", "decrease")


def summary_frame(spark, rows):
    return spark.createDataFrame(rows, "year int, total_warnings bigint, fluvial_warnings bigint, coastal_warnings bigint, "
                                       "fluvial_index double, coastal_index double, composite_index double")


def test_trend_tables(spark):
    s = summary_frame(spark, [(2020, 95, 23, 72, 100.0, 100.0, 100.0), (2021, 28, 10, 18, 44.6, 33.5, 39.6),
                              (2022, 23, 8, 15, 31.9, 26.1, 29.3), (2023, 54, 30, 24, 150.6, 40.8, 101.2)])
    yoy = {r.year: r for r in year_on_year(s).collect()}
    assert yoy[2021].direction == "v" and yoy[2021].change_pts == pytest.approx(-60.4)
    assert yoy[2021].change_pct == pytest.approx(-60.4)
    e = endpoint_change(s).collect()[0]
    assert (e.first_year, e.last_year, e.direction) == (2020, 2023, "^")
    # Points and a true percentage for the components
    assert e.coastal_change_pts == pytest.approx(-59.2) and e.coastal_change_pct == pytest.approx(-59.2)
    assert e.fluvial_change_pct == pytest.approx(50.6)
    assert e.composite_change_pts == pytest.approx(1.2) and e.fluvial_change_pts == pytest.approx(50.6)
    x = extreme_years(s).collect()[0]
    assert (x.lowest_year, x.highest_year) == (2022, 2023)
    t = trend_totals(s).collect()[0]
    assert (t.total_warnings, t.avg_warnings_per_year) == (200, 50.0)
    bars = {r.year: (r.fluvial_bar, r.coastal_bar) for r in trend_bars(s).collect()}
    assert bars[2021] == ("#" * 8, "#" * 6)


def test_extreme_ties_take_earlier_year_and_zero_pct_is_null(spark):
    s = summary_frame(spark, [(2020, 1, 1, 0, 0.0, 0.0, 0.0), (2021, 1, 1, 0, 0.0, 0.0, 0.0), (2022, 1, 1, 0, 5.0, 5.0, 5.0)])
    x = extreme_years(s).collect()[0]
    assert (x.lowest_year, x.highest_year) == (2020, 2022)
    assert [r.change_pct for r in year_on_year(s).orderBy("year").collect()] == [None, None]
    assert endpoint_change(s).collect()[0].composite_change_pct is None  # N17


def test_yearly_summary_rounds_half_even(spark):
    ind = spark.createDataFrame([(2020, 10, 4, 6, 0.25, 2.35, 100.05)],
                                "year int, total_events bigint, fluvial_events bigint, coastal_events bigint, "
                                "fluvial_index double, coastal_index double, composite_index double")
    r = yearly_summary(ind).collect()[0]
    assert (r.fluvial_index, r.total_warnings) == (0.2, 10)


def test_year_selection_before_the_window_is_exact(spark):
    from warnindex.plans.flows import annual_index, orders_region_messages

    msgs = orders_region_messages(spark, "/root/testdata/sf0.001")
    for scope in ("year", "all"):
        p, ip = DurationParams(gap_scope=scope), IndexParams(baseline_year=1995)
        full = {r.year: tuple(r) for r in annual_index(msgs, p, ip).collect()}
        some = {r.year: tuple(r) for r in annual_index(msgs, p, ip, years=[1997, 2000]).collect()}
        assert some == {y: full[y] for y in (1997, 2000)}


def test_calculate_year_and_trend_report(spark, tmp_path):
    from warnindex.plans.flows import calculate_year, orders_region_messages, trend_report, trend_summary
    from warnindex.sources.files import read_baseline

    msgs = orders_region_messages(spark, "/root/testdata/sf0.001")
    ip = IndexParams(baseline_year=1995)
    r = calculate_year(msgs, 1995, DurationParams(), ip, save_baseline_to=str(tmp_path / "b")).collect()
    assert len(r) == 1 and r[0].composite_index == 100.0
    assert read_baseline(spark, str(tmp_path / "b")).collect()[0].year == 1995
    calculate_year(msgs, 1996, DurationParams(), ip, save_baseline_to=str(tmp_path / "c")).collect()
    assert read_baseline(spark, str(tmp_path / "c")) is None          # only the baseline year is saved
    rep = trend_report(trend_summary(msgs, DurationParams(), ip))
    assert set(rep) == {"summary", "year_on_year", "endpoint_change", "extreme_years", "totals", "bars"}
    assert rep["totals"].collect()[0].n_years == rep["summary"].count()


def test_staged_input_gives_the_same_index(spark):
    from warnindex.plans.flows import annual_index, orders_region_messages

    msgs = orders_region_messages(spark, "/root/testdata/sf0.001")
    p, ip = DurationParams(), IndexParams(baseline_year=1995)
    assert sorted(map(tuple, annual_index(msgs, p, ip, stage_input=True).collect())) == \
        sorted(map(tuple, annual_index(msgs, p, ip).collect()))


def test_absent_baseline_year_gives_no_index(spark, msgs):
    from warnindex.operators.durations import calculate_durations
    from warnindex.operators.index import calculate_indicators
    from warnindex.params import DurationParams, IndexParams

    d = calculate_durations(msgs([("A", "2024-01-01T00:00:00", "Flood Alert", 3)]), DurationParams())
    r = calculate_indicators(d, IndexParams(baseline_year=1999)).collect()[0]
    assert (r.fluvial_index, r.coastal_index, r.composite_index) == (None, None, None) and r.fluvial_score_raw == 48.0


def test_stored_baseline_feeds_the_index(spark, msgs, tmp_path):
    import pytest

    from warnindex.plans.flows import index_from_stored_baseline
    from warnindex.sources import files

    m = msgs([("A", "2024-01-01T00:00:00", "Flood Alert", 3)])
    with pytest.raises(files.LoadError):
        index_from_stored_baseline(m, str(tmp_path / "none"))
    files.write_baseline(spark.createDataFrame([(2020, 96.0, 10.0, 106.0)], "year int, fluvial_score double, coastal_score double, total_score double"),
                         str(tmp_path / "b"))
    assert files.load_baseline(spark, str(tmp_path / "b")).fluvial_score == 96.0
    assert index_from_stored_baseline(m, str(tmp_path / "b")).collect()[0].fluvial_index == 50.0
