"""V1-V11, A9-A12, A18, J3, O5 on hand-made rows (FIXTURES §5)."""

from collections import Counter
from datetime import datetime, timedelta

from warnindex.operators import quality

SCHEMA = ("fwdCode string, timeRaised timestamp_ntz, severityLevel int, timeSeverityChanged timestamp_ntz, "
          "timeMessageChanged timestamp_ntz, isTidal boolean")
T0 = datetime(2024, 1, 1)


def frame(spark):
    rows = [
        ("A", None, 1, T0, T0, True),                                  # null raise time (V2)
        ("A", T0, None, T0, None, True),                               # null level: not invalid (N6)
        ("A", T0 + timedelta(hours=1), 9, T0, None, True),             # level 9 (V4) + change before raise (V8)
        ("B", T0, 2, None, None, False), ("B", T0, 2, None, None, False), ("B", T0, 2, None, None, False),  # dup x3
        ("B", T0 + timedelta(days=1), 4, T0 + timedelta(days=15, hours=23), None, False),  # 14 d 23 h: not flagged
        ("C", T0, None, T0 + timedelta(days=16), T0, None),            # only null levels; 16 d: flagged
        ("D", T0, 4, T0 + timedelta(days=15), T0, None),               # exactly 15 d: flagged
        ("D", T0 + timedelta(days=2), 3, T0 + timedelta(days=2), T0, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def issues(spark, df=None):
    return {r.category: r for r in quality.validate(df if df is not None else frame(spark)).collect()}


def test_each_check(spark):
    got = issues(spark)
    assert got["Missing timeRaised"]["count"] == 1 and got["Missing timeRaised"].severity == "error"
    assert got["Invalid Severity Levels"]["count"] == 1
    assert got["Duplicate Records"]["count"] == 2
    assert got["Timestamp Inconsistency"]["count"] == 1
    lw = got["Unusually Long Warnings"]
    assert lw["count"] == 2 and lw.message.endswith("Longest: 16.0 days")
    # areas A and C lack a level 4: 3 + 1 records
    assert got["Incomplete Warning Lifecycles"]["count"] == 4 and got["Incomplete Warning Lifecycles"].severity == "info"
    assert got["Missing timeSeverityChanged"]["count"] == 3
    assert got["Field Completeness: isTidal"].severity == "info"        # 7 of 10 = 70 %
    tm = got["Field Completeness: timeMessageChanged"]                  # 4 of 10
    assert tm.message == "Field is 40.0% complete" and tm.severity == "warning"


def test_report_counts(spark):
    r = quality.report(frame(spark)).collect()[0]
    # valid = 10 - V2 (1) - V4 (1) - V8 (1), one row may count twice
    assert (r.total_records, r.valid_records, r.passed) == (10, 7, False)
    assert (r.error_count, r.warning_count, r.info_count) == (3, 4, 3)


def test_completeness_threshold(spark):
    rows = [("A", T0, 4, None, None, True)] * 51 + [("A", T0, 4, T0, None, True)] * 49
    got = issues(spark, spark.createDataFrame(rows, SCHEMA))
    assert got["Field Completeness: timeSeverityChanged"].severity == "warning"   # 49 %
    rows = [("A", T0, 4, None, None, True)] * 50 + [("A", T0, 4, T0, None, True)] * 50
    got = issues(spark, spark.createDataFrame(rows, SCHEMA))
    assert got["Field Completeness: timeSeverityChanged"].severity == "info"      # 50 %


def test_zero_rows_and_missing_column(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert issues(spark, empty) == {}   # no share of nothing (N16: the original divides by zero)
    r = quality.report(empty).collect()[0]
    assert r.total_records == 0 and r.passed
    got = issues(spark, frame(spark).drop("severityLevel"))
    assert got["Missing Required Fields"].severity == "error"
    assert got["Missing Required Fields"]["count"] == 10
    assert "Invalid Severity Levels" not in got and "Duplicate Records" not in got   # N20


def test_by_year_and_examples(spark):
    by = quality.validate(frame(spark), by_year=True)
    years = {r.year for r in by.collect()}
    assert years == {2024, None}
    ex = {r.category: r.examples for r in quality.issue_examples(frame(spark)).collect()}
    assert len(ex["Invalid Severity Levels"]) == 1 and '"severityLevel":9' in ex["Invalid Severity Levels"][0]


def test_area_coverage(spark):
    df = spark.createDataFrame([("A",), ("A",), ("X",), ("X",), ("X",), (None,)], "fwdCode string")
    expected = spark.createDataFrame([("A",), ("B",), ("C",)], "fwdCode string")
    got = {r.category: r for r in quality.area_coverage(df, expected).collect()}
    assert got["Missing Warning Areas"]["count"] == 2 and got["Missing Warning Areas"].message.startswith("2 ")
    assert got["Unexpected Warning Areas"]["count"] == 4
    ex = {r.category: r.examples for r in quality.coverage_examples(df, expected).collect()}
    assert ex["Missing Warning Areas"] == ["B", "C"]


def test_validate_with_examples(spark):
    got = {r.category: r.examples for r in quality.validate(frame(spark), examples=True).collect()}
    assert len(got["Timestamp Inconsistency"]) == 1
    assert got["Duplicate Records"] == ['{"fwdCode":"B","severityLevel":2,"timeRaised":"2024-01-01T00:00:00.000","count":3}']
    assert [x[:14] for x in got["Incomplete Warning Lifecycles"]] == ['{"fwdCode":"A"', '{"fwdCode":"C"']
    by = {(r.year, r.category): r.examples for r in quality.validate(frame(spark), by_year=True, examples=True).collect()}
    assert len(by[2024, "Duplicate Records"]) == 1 and len(by[None, "Missing timeRaised"]) == 1


def test_report_documents(spark, tmp_path):
    from warnindex.sources.sinks import write_quality_reports

    docs = quality.report_documents(frame(spark), by_year=True)
    write_quality_reports(docs, str(tmp_path / "q"))
    back = spark.read.schema(docs.schema).json(str(tmp_path / "q")).collect()
    assert [(r.year, r.total_records, r.error_count) for r in back] == [(2024, 9, 2)]
    assert [i.check_order for i in back[0].issues] == sorted(i.check_order for i in back[0].issues)


def test_run_record(spark, tmp_path, monkeypatch):
    """Load and export decide; a validation that breaks off is an error only; a year without records succeeds."""
    from warnindex.plans import flows
    from warnindex.sources import files
    from warnindex.sources.sinks import read_run_log, run_metrics

    def run(name, load=lambda: frame(spark), years=range(2023, 2025), **more):
        return {r.year: r for r in flows.run_years(spark, load, years, str(tmp_path / "t"), str(tmp_path / "log"), name, **more).collect()}

    ok = run("ok", reports_path=str(tmp_path / "reports"), logged_at="2025-01-01T00:00:00")
    assert [(r.load_status, r.validation_status, r.export_status, r.success, r.errors) for r in (ok[2023], ok[2024])] == [("success",) * 3 + (True, "")] * 2
    assert (ok[2024].records_loaded, ok[2024].records_exported, ok[2024].validation_passed, ok[2023].records_loaded) == (9, 9, False, 0)
    assert ok[2024].success_rate_pct == 100.0 and (tmp_path / "reports" / "year=2024").exists()

    def broken():
        raise files.LoadError("nothing there")

    bad = run("load", broken)
    assert {(r.load_status, r.validation_status, r.export_status, r.success, r.errors) for r in bad.values()} == {("failed", None, None, False, "load: LoadError: nothing there")}
    assert bad[2023].success_rate_pct == 0.0

    def breaks(*a, **k):
        raise RuntimeError("broke off")

    with monkeypatch.context() as m:
        m.setattr(quality, "report_documents", breaks)
        got = run("validation")
    assert {(r.validation_status, r.validation_passed, r.export_status, r.success, r.errors) for r in got.values()} == {
        ("failed", None, "success", True, "validation: RuntimeError: broke off")}
    with monkeypatch.context() as m:
        m.setattr(files, "write_yearly", breaks)
        got = run("export", validate=False)
    assert {(r.validation_status, r.export_status, r.success) for r in got.values()} == {(None, "failed", False)}
    log = read_run_log(spark, str(tmp_path / "log"))
    assert {r.run_id: r.success_rate_pct for r in run_metrics(log).collect()} == {"ok": 100.0, "load": 0.0, "validation": 100.0, "export": 0.0}
    assert log.filter("run_id = 'ok'").select("logged_at").distinct().collect()[0][0] == "2025-01-01T00:00:00"
    assert log.filter("run_id = 'ok' and stage = 'export'").count() == 2


def test_messages_are_computed_once(spark):
    """However many checks read them: a report computes its input once, examples once more for whole rows."""
    seen = spark.sparkContext.accumulator(0)

    def passing(it):
        for pdf in it:
            seen.add(len(pdf))
            yield pdf

    def computed(run):
        before = seen.value
        run(frame(spark).mapInPandas(passing, SCHEMA)).collect()
        return (seen.value - before) / 10

    assert computed(lambda df: quality.report_documents(df, by_year=True)) == 1
    assert computed(quality.validate) == 1
    assert computed(quality.duplicate_keys) == 1
    assert computed(lambda df: quality.issue_examples(df, by_year=True)) == 2
    assert computed(lambda df: quality.validate(df, examples=True)) == 2


def test_many_repeated_keys_pass_a_bitmap(spark, monkeypatch):
    """Beyond the broadcast bound rows meet a bitmap of bounded size, not a join that shuffles all of them."""
    rows = [(f"A{i % 1500}", T0 + timedelta(hours=i % 11), i % 4 if i % 7 else None) for i in range(20_000)] + [(None, None, None)] * 2
    rows += [(f"B{i}", None, i % 3) for i in range(3000)]
    want = {(k[0], k[2], k[1], n) for k, n in Counter(rows).items() if n > 1}
    df = spark.createDataFrame(rows, "fwdCode string, timeRaised timestamp_ntz, severityLevel int").repartition(5)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = quality.repeated_keys(df, max_broadcast=0)
        assert {tuple(r) for r in got.collect()} == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        # a full bitmap lets every row pass; the exact count still decides
        monkeypatch.setattr(quality, "MAX_FILTER_BITS", 64)
        monkeypatch.setattr(quality, "BITMAP_BITS", 8)
        assert {tuple(r) for r in quality.repeated_keys(df, max_broadcast=0).collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
