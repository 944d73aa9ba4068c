"""Incremental ingest: landed CSV files -> per-year table, exactly once."""

import os

from warnindex.sources.files import read_year
from warnindex.streaming.ingest import start_ingest, start_quarantine


def test_ingest_is_incremental(spark, tmp_path):
    land, table, ckpt = (str(tmp_path / n) for n in ("landing", "table", "ckpt"))
    os.makedirs(land)
    areas = spark.createDataFrame([("C1", False), ("C2", True)], "fwdCode string, isTidal boolean")
    hdr = "DATE,CODE,TYPE,WARNING / ALERT AREA NAME,AREA\n"
    with open(os.path.join(land, "a.csv"), "w") as fh:
        fh.write(hdr + "2023-12-31T23:00:00Z,C1,Flood Alert,L,A\n2024-01-01T01:00:00Z,C2,Flood Warning,L,A\n"
                       "2024-01-01T02:00:00Z,XX,Flood Warning,L,A\n")
    start_ingest(spark, land, table, ckpt, areas).awaitTermination()
    assert read_year(spark, table).count() == 2
    with open(os.path.join(land, "b.csv"), "w") as fh:
        fh.write(hdr + "2024-03-01T00:00:00Z,C1,Severe Flood Warning,L,A\n")
    start_ingest(spark, land, table, ckpt, areas).awaitTermination()
    got = sorted((r.year, r.fwdCode, r.isTidal) for r in read_year(spark, table).collect())
    assert got == [(2023, "C1", False), (2024, "C1", False), (2024, "C2", True)]


def test_torn_rows_are_named_not_padded(spark, tmp_path):
    land, table, torn = (str(tmp_path / n) for n in ("landing", "table", "torn"))
    os.makedirs(land)
    rows = ["2024-01-01T01:00:00Z,C1,Flood Alert,L,A", "2024-01-01T02:00:00Z,C2,Flood Alert", "2024-01-01T03:00:00Z,C3,Flood Alert,L,A,more", '2024-01-01T04:00:00Z,C4,null,"L, x",']
    with open(os.path.join(land, "a.csv"), "w") as fh:
        fh.write("DATE,CODE,TYPE,WARNING / ALERT AREA NAME,AREA\n" + "\n".join(rows) + "\n")
    start_ingest(spark, land, table, str(tmp_path / "c1")).awaitTermination()
    start_quarantine(spark, land, torn, str(tmp_path / "c2")).awaitTermination()
    assert sorted((r.fwdCode, r.severity, r.label) for r in read_year(spark, table).collect()) == [("C1", "Flood Alert", "L"), ("C4", None, "L, x")]
    got = spark.read.json(torn).collect()
    assert sorted(r.record for r in got) == sorted(rows[1:3])
    assert all(r.path.endswith("a.csv") and r.reason for r in got)
