"""Driver contract: entry(), queries() and oracle_sql(); every query against
its DuckDB twin on the smallest tables."""

import importlib.util
import os
import re

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

import __spark_entry__ as E

_spec = importlib.util.spec_from_file_location("check_oracles", os.path.join(ROOT, "tools", "check_oracles.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)

ROWS_ONLY: set[str] = set()  # every query has a SQL twin


def own(names):
    """Queries of the library itself; those of the training-data subpackage are tested beside it."""
    return {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert own(q) - own(o) == ROWS_ONLY


def test_bench_headline_is_registered():
    import bench

    assert set(bench.HEADLINE) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"year", "fluvial_index", "coastal_index", "composite_index"} <= set(df.columns)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in check.TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(own(E.oracle_sql())))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    srows = sorted((tuple(check.norm(r[c]) for c in cols) for r in df.collect()), key=check.key)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    orows = sorted((tuple(check.norm(r[i]) for i in idx) for r in cur.fetchall()), key=check.key)
    assert srows == orows
