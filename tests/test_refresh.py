"""Totals refreshed by year (I4, I7) and duplicates counted in two phases."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from warnindex.operators import quality as Q
from warnindex.operators.index import yearly_summary
from warnindex.params import DurationParams, IndexParams
from warnindex.plans import refresh as R
from warnindex.plans.flows import annual_index
from warnindex.session import scratch_path

INDEX = IndexParams(baseline_year=2020)


def messages(make, seed, years):
    rows = []
    for y in years:
        for i in range(20):
            t = datetime(y, 1, 1) + timedelta(hours=(i * 37 + seed * 11) % 8000)
            rows.append((f"A{i % 3}", t.isoformat(), "Flood Alert", 1 + (i + seed) % 4, None if i == 7 else bool(i % 2)))
    return make([*rows, ("A0", None, "Flood Alert", 3)])


def paths(spark):
    root = scratch_path(spark, "refresh-test")
    return f"{root}/messages", f"{root}/totals", f"{root}/changes"


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()))


def test_only_changed_years_are_computed_again(spark, msgs):
    table, totals, changes = paths(spark)
    assert R.refresh_totals(spark, table, totals, changes) == []
    first, more = messages(msgs, 1, range(2018, 2023)), messages(msgs, 2, (2019, 2021))
    assert R.append_messages(first, table, changes) == list(range(2018, 2023))
    assert R.refresh_totals(spark, table, totals, changes) == list(range(2018, 2023))
    files = {f.split("/year=")[1] for f in spark.read.parquet(totals).inputFiles()}
    assert R.append_messages(more, table, changes) == [2019, 2021]
    plan = R.changed_messages(spark, table, [2019, 2021])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [year" in plan and "IN (2019,2021)" in plan
    assert {f.split("/year=")[1][:4] for f in R.changed_messages(spark, table, [2019, 2021]).inputFiles()} >= {"2019", "2021"}
    assert R.refresh_totals(spark, table, totals, changes) == [2019, 2021]
    after = {f.split("/year=")[1] for f in spark.read.parquet(totals).inputFiles()}
    assert {f[:4] for f in files - after} == {"2019", "2021"}  # the others' files are untouched
    full = annual_index(first.unionByName(more), R.YEAR_RULE, INDEX)
    got = R.index_from_totals(spark, totals, index=INDEX)
    assert rows(got) == rows(full) and rows(yearly_summary(got)) == rows(yearly_summary(full))
    assert R.refresh_totals(spark, table, totals, changes) == []


def test_a_broken_run_is_made_up_for(spark, msgs, monkeypatch):
    table, totals, changes = paths(spark)
    data = messages(msgs, 3, (2020, 2021))
    R.append_messages(data, table, changes)
    with monkeypatch.context() as m:
        m.setattr(R, "annual_by_class", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            R.refresh_totals(spark, table, totals, changes)
    # recorded, but never appended
    R._record(spark, changes, [("lost", 2033, False)])
    assert R.refresh_totals(spark, table, totals, changes) == [2020, 2021, 2033]
    assert rows(R.index_from_totals(spark, totals, index=INDEX)) == rows(annual_index(data, R.YEAR_RULE, INDEX))


def test_rules_of_the_totals(spark, msgs):
    table, totals, changes = paths(spark)
    R.append_messages(messages(msgs, 4, (2020,)), table, changes)
    with pytest.raises(ValueError, match="gap_scope"):
        R.refresh_totals(spark, table, totals, changes, DurationParams(gap_scope="all"))
    R.refresh_totals(spark, table, totals, changes)
    with pytest.raises(ValueError, match="other duration rules"):
        R.index_from_totals(spark, totals, DurationParams(gap_scope="year", bucket_seconds=7), INDEX)
    assert R.append_messages(messages(msgs, 4, ()), table, changes) == []


def test_repeated_keys(spark, msgs, monkeypatch):
    t = "2020-01-01T00:00:00"
    df = msgs([("A", t, "x", 1)] * 3 + [("A", None, "x", None)] * 2 + [(None, t, "x", 2)] * 2 + [("A", t, "x", 2), ("B", t, "x", 1), (None, None, "x", None)])
    want = {("A", 1, datetime(2020, 1, 1), 3), ("A", None, None, 2), (None, 2, datetime(2020, 1, 1), 2)}
    assert {tuple(r) for r in Q.repeated_keys(df).collect()} == want
    assert {tuple(r) for r in Q.repeated_keys(df, max_broadcast=0).collect()} == want
    assert tuple(Q.duplicate_keys(df).first()) == (3, 4)
    # equal hashes of unequal keys are told apart
    monkeypatch.setattr(Q.F, "xxhash64", lambda *c: F.lit(5).cast("bigint"))
    assert {tuple(r) for r in Q.repeated_keys(df).collect()} == want
    assert tuple(Q.duplicate_keys(df.limit(0)).first()) == (0, 0)


def test_keys_are_not_shuffled_whole(spark, msgs):
    """The first count exchanges hashes; rows enter the second one behind the broadcast of repeated hashes."""
    plan = Q.repeated_keys(msgs([("A", "2020-01-01T00:00:00", "x", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("Exchange hashpartitioning(fwdCode") and "BroadcastHashJoin" in plan
