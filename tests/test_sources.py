"""S1-S17 against real files in a temporary folder."""

import json
import os
from datetime import datetime

import pytest

from warnindex.sources import files
from warnindex.sources.archive import UnsafeMemberError, archive_members, encode_zip, safe_member
from warnindex.sources.ods import encode_ods


def write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as fh:
        fh.write(text)


def test_format_from_suffix():
    assert files.infer_format("/x/A.CSV") == "csv" and files.infer_format("b.ods") == "ods"
    with pytest.raises(files.LoadError):
        files.infer_format("c.xlsx")


def test_csv_null_tokens_and_header_drift(spark, tmp_path):
    d = str(tmp_path / "landing")
    write(f"{d}/a.csv", "DATE,CODE,TYPE,AREA\n2024-01-01T00:00:00Z,C1,Flood Alert,None\n"
                        "2024-01-01T01:00:00Z,C1, Update Flood Alert ,NULL\n")
    write(f"{d}/b.csv", "CODE,TYPE,DATE\nC2,Flood Warning,2024-01-02T00:00:00+01:00\nC2,null,\n")
    write(f"{d}/c.csv", "")  # empty file: skipped, logged
    df = files.load_directory(spark, d)
    rows = sorted(df.select("fwdCode", "timeRaised", "severity", "severityLevel", "area_ref").collect(),
                  key=lambda r: (r.fwdCode, r.timeRaised is not None, str(r.timeRaised)))
    assert [r.area_ref for r in rows] == [None] * 4
    c2 = [r for r in rows if r.fwdCode == "C2"]
    assert c2[0].timeRaised is None and c2[0].severity is None
    assert c2[1].timeRaised == datetime(2024, 1, 1, 23) and c2[1].severityLevel == 2
    c1 = [r for r in rows if r.fwdCode == "C1"]
    assert c1[1].severity == " Update Flood Alert " and c1[1].severityLevel == 3


def test_all_files_failing_is_an_error(spark, tmp_path):
    write(str(tmp_path / "x" / "a.csv"), "")
    with pytest.raises(files.LoadError):
        files.load_directory(spark, str(tmp_path / "x"))


def test_json_array_documents(spark, tmp_path):
    p = str(tmp_path / "w.json")
    write(p, json.dumps([{"DATE": "2024-01-01T00:00:00Z", "CODE": "C1", "TYPE": "Flood Alert", "EXTRA": 1},
                         {"DATE": "2024-01-01T05:00:00Z", "CODE": 7, "TYPE": "Flood Warning"}]))
    df = files.load_warnings(spark, p)
    got = sorted((r.fwdCode, r.severityLevel) for r in df.collect())
    assert got == [("7", 2), ("C1", 3)]


def test_ods_snapshot_choice_and_repeats(spark, tmp_path):
    d = tmp_path / "ods"
    os.makedirs(d)
    hdr = ["DATE", "CODE", "TYPE"]
    old = encode_ods(hdr, [("2024-01-01T00:00:00", "OLD", "Flood Alert")], date_columns=("DATE",))
    new = encode_ods(hdr, [("2024-01-01T00:00:00", "C1", "Flood Alert"), ("2024-01-01T00:00:00", "C1", "Flood Alert"),
                           ("2024-02-01T00:00:00", "C2", "Severe Flood Warning")], date_columns=("DATE",))
    (d / "202401_warnings.ods").write_bytes(old)
    (d / "202406_warnings.ods").write_bytes(new)
    fmt, paths = files.choose_snapshot(spark, str(d))
    assert fmt == "ods" and paths[0].endswith("202406_warnings.ods")
    df = files.load_directory(spark, str(d))
    got = sorted((r.fwdCode, r.timeRaised, r.severityLevel) for r in df.collect())
    assert got == [("C1", datetime(2024, 1, 1), 3), ("C1", datetime(2024, 1, 1), 3),
                   ("C2", datetime(2024, 2, 1), 1)]
    # any CSV wins over ODS
    write(str(d / "x.csv"), "DATE,CODE,TYPE\n2024-01-01T00:00:00Z,Z,Flood Alert\n")
    assert files.choose_snapshot(spark, str(d))[0] == "csv"


def test_archive_members_and_unsafe_paths(spark, tmp_path):
    assert safe_member("a/b.csv") and not safe_member("../x.csv") and not safe_member("/etc/x")
    good = encode_zip({"data/w.csv": "DATE,CODE,TYPE\n2024-01-01T00:00:00Z,C1,\"Flood, Alert\"\n", "data/": ""})
    (tmp_path / "good.zip").write_bytes(good)
    bins = spark.read.format("binaryFile").load(str(tmp_path / "good.zip"))
    members = archive_members(bins)
    assert [r.member for r in members.collect()] == ["data/w.csv"]
    raw = files.load_raw(spark, str(tmp_path / "good.zip")).collect()
    assert raw[0].CODE == "C1" and raw[0].TYPE == "Flood, Alert"
    (tmp_path / "bad.zip").write_bytes(encode_zip({"../evil.csv": "x"}))
    bad = spark.read.format("binaryFile").load(str(tmp_path / "bad.zip"))
    with pytest.raises(Exception, match="outside the archive"):
        archive_members(bad).collect()
    assert issubclass(UnsafeMemberError, ValueError)


def test_yearly_table_discovery_and_missing_year(spark, tmp_path):
    df = spark.createDataFrame([("A", datetime(2019, 5, 1)), ("A", datetime(2021, 5, 1)), ("B", datetime(2022, 1, 1))],
                               "fwdCode string, timeRaised timestamp_ntz")
    root = str(tmp_path / "yearly")
    files.write_yearly(df, root)
    os.makedirs(os.path.join(root, "year=abcd"))
    assert files.discover_years(spark, root) == [2021, 2022]
    assert files.discover_years(spark, root, first_year=None) == [2019, 2021, 2022]
    assert files.read_year(spark, root, 2030).count() == 0
    assert files.read_year(spark, root, 2021).count() == 1
    # dynamic overwrite replaces only the years written
    files.write_yearly(spark.createDataFrame([("C", datetime(2021, 7, 1))], "fwdCode string, timeRaised timestamp_ntz"), root)
    assert sorted(r.fwdCode for r in files.read_year(spark, root).collect()) == ["A", "B", "C"]
    assert files.discover_years(spark, str(tmp_path / "none")) == []


def test_baseline_roundtrip(spark, tmp_path):
    assert files.read_baseline(spark, str(tmp_path / "missing")) is None
    df = spark.createDataFrame([(2020, 1.5, 2.5, 4.0)], "year int, fluvial_score double, coastal_score double, total_score double")
    files.write_baseline(df, str(tmp_path / "b"))
    r = files.read_baseline(spark, str(tmp_path / "b")).collect()[0]
    assert (r.year, r.fluvial_score, r.fluvial_hours, r.coastal_events) == (2020, 1.5, 0.0, 0)


def test_landed_pages(spark, tmp_path):
    p = str(tmp_path / "pages.json")
    write(p, "\n".join(json.dumps({"meta": {"next": None}, "items": [{"notation": f"N{i}", "county": "Bristol",
                                                                       "riverOrSea": "Sea"} for i in range(k, k + 2)]})
                       for k in (0, 2)))
    items = files.read_landed_pages(spark, p, multiline=False)
    assert sorted(r.notation for r in items.collect()) == ["N0", "N1", "N2", "N3"]
    write(str(tmp_path / "one.json"), json.dumps({"items": [{"notation": "X", "extra": 1}], "meta": {}}, indent=2))
    assert [(r.notation, r.county) for r in files.read_landed_pages(spark, str(tmp_path / "one.json")).collect()] == [("X", None)]


def test_ingest_flow_observes_counts(spark, tmp_path):
    from warnindex.plans.flows import ingest

    d = str(tmp_path / "land")
    write(f"{d}/a.csv", "DATE,CODE,TYPE\n2024-01-01T00:00:00Z,C1,Flood Alert\nbad,C1,Flood Alert\n"
                        "2024-01-02T00:00:00Z,C9,Flood Bulletin\n2023-05-01T00:00:00Z,C2,Flood Warning\n")
    areas = spark.createDataFrame([("C1", False), ("C2", True)], "fwdCode string, isTidal boolean")
    metrics, rep = ingest(spark, [f"{d}/a.csv"], areas, str(tmp_path / "table"))
    assert metrics == {"records_loaded": 4, "unmapped_severity": 1, "missing_timeRaised": 1, "region_records": 3}
    got = {r.year: r.total_records for r in rep.collect()}
    assert got == {2023: 1, 2024: 1}


def test_ods_cell_text_and_repeats():
    import io
    import zipfile

    from warnindex.sources.ods import NS, iter_sheet_rows

    xml = (f'<office:document-content xmlns:office="{NS["office"]}" xmlns:table="{NS["table"]}" '
           f'xmlns:text="{NS["text"]}"><office:body><office:spreadsheet><table:table>'
           '<table:table-row><table:table-cell office:value-type="string"><text:p>A<text:s text:c="2"/>B'
           '<text:span>C</text:span><text:tab/>D</text:p></table:table-cell><table:table-cell '
           'table:number-columns-repeated="2" office:value-type="float" office:value="3"/></table:table-row>'
           '<table:table-row table:number-rows-repeated="2"><table:table-cell office:value-type="date" '
           'office:date-value="2024-01-01T05:00:00"/></table:table-row>'
           '<table:table-row table:number-rows-repeated="500"><table:table-cell table:number-columns-repeated="99"/>'
           '</table:table-row></table:table><table:table><table:table-row><table:table-cell office:value-type="string">'
           '<text:p>second sheet</text:p></table:table-cell></table:table-row></table:table>'
           '</office:spreadsheet></office:body></office:document-content>')
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("content.xml", xml)
    assert list(iter_sheet_rows(b.getvalue())) == [["A  BC\tD", "3", "3"], ["2024-01-01T05:00:00"],
                                                   ["2024-01-01T05:00:00"]]


def test_load_archives(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"a{k}.zip").write_bytes(encode_zip({f"d/w{k}.csv": f"CODE,DATE,TYPE\nC{k},2024-01-0{k + 1}T00:00:00Z,Flood Alert\n"}))
    df = files.load_archives(spark, [str(tmp_path / f"a{k}.zip") for k in range(3)])
    got = sorted((r.fwdCode, r.timeRaised.day, r.severityLevel) for r in df.collect())
    assert got == [("C0", 1, 3), ("C1", 2, 3), ("C2", 3, 3)]
    assert "timeSeverityChanged" not in df.columns


def test_load_directory_with_pattern(spark, tmp_path):
    d = str(tmp_path / "p")
    write(f"{d}/warnings_2024.csv", "DATE,CODE,TYPE\n2024-01-01T00:00:00Z,C1,Flood Alert\n")
    write(f"{d}/other.csv", "DATE,CODE,TYPE\n2024-01-01T00:00:00Z,C2,Flood Alert\n")
    assert [r.fwdCode for r in files.load_directory(spark, d, pattern="warnings_*.csv").collect()] == ["C1"]
    with pytest.raises(files.LoadError):
        files.load_directory(spark, d, pattern="*.json")


def test_quoted_csv(spark, tmp_path):
    write(str(tmp_path / "q.csv"), 'DATE,CODE,TYPE,WARNING / ALERT AREA NAME,AREA\n'
          '2024-01-01T00:00:00Z,C1,Flood Alert,"River ""Big"" Avon, north",a1\n'
          '2024-01-01T00:00:00Z,C2,Flood Alert,"back\\",a2\n2024-01-01T00:00:00Z,C3,Flood Alert,"two\nlines",a3\n')
    got = {r.fwdCode: (r.label, r.area_ref) for r in files.load_directory(spark, str(tmp_path), multiline=True).collect()}
    assert got == {"C1": ('River "Big" Avon, north', "a1"), "C2": ("back\\", "a2"), "C3": ("two\nlines", "a3")}


def test_mixed_formats_and_skipped_files(spark, tmp_path):
    d = str(tmp_path / "m")
    write(f"{d}/a.csv", "DATE,CODE,TYPE,extra\n2024-01-01T00:00:00Z,A,Flood Alert,e\n2024-01-01T00:00:00Z,B,too,many,fields\nshort\n")
    write(f"{d}/b.json", json.dumps([{"DATE": "2024-01-01T00:00:00Z", "CODE": "J", "TYPE": "Flood Warning", "extra": 5}]))
    write(f"{d}/bad.json", "[{")
    write(f"{d}/foo.csv", "foo,bar\n1,2\n")
    write(f"{d}/bad.ods", "not a spreadsheet")
    write(f"{d}/notes.txt", "text")
    (tmp_path / "m" / "c.ods").write_bytes(encode_ods(["DATE", "CODE", "TYPE", "extra"], [("2024-01-01T00:00:00", "O", "Flood Alert", "x")]))
    (tmp_path / "m" / "d.zip").write_bytes(encode_zip({"x/w.csv": 'CODE,DATE,TYPE,extra\nZ,2024-01-01T00:00:00Z,"Flood ""x""\nAlert",z\n'}))
    (tmp_path / "m" / "e.zip").write_bytes(encode_zip({"ok.csv": "CODE,DATE,TYPE\nGOOD,2024-01-01T00:00:00Z,Flood Alert\n", "bad.csv": "CODE\nX\n"}))
    (tmp_path / "m" / "f.zip").write_bytes(encode_zip({"../evil.csv": "CODE,DATE,TYPE\nE,2024-01-01T00:00:00Z,Flood Alert\n"}))
    paths = files.list_paths(spark, d)
    rows, skipped = files.load_checked(spark, paths)
    assert sorted((r.CODE, r.extra, r.TYPE) for r in rows.collect()) == [
        ("A", "e", "Flood Alert"), ("GOOD", None, "Flood Alert"), ("J", "5", "Flood Warning"), ("O", "x", "Flood Alert"), ("Z", "z", 'Flood "x"\nAlert')]
    assert rows.count() == 5
    got = sorted((os.path.basename(r.path), r.record) for r in skipped.collect())
    assert got == [("a.csv", "2024-01-01T00:00:00Z,B,too,many,fields"), ("a.csv", "short"), ("bad.json", None), ("bad.ods", None),
                   ("e.zip", None), ("f.zip", None), ("foo.csv", None), ("notes.txt", None)]
    assert all(r.reason for r in skipped.collect())
    assert [r.reason for r in skipped.collect() if r.path.endswith("e.zip")] == ["bad.csv: ValueError: no column for timeRaised, severity"]
    assert files.load_directory(spark, d, pattern="*").count() == 5


def test_quoted_files_grow_with_the_table(spark, tmp_path, monkeypatch):
    from conftest import SF_SMALL
    from warnindex.plans import filequeries as Q

    monkeypatch.setattr(Q, "ROWS_PER_FILE", 50)
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: str(tmp_path / name))
    n = Q.q_csv_quoted(spark, SF_SMALL).count()
    assert n == spark.read.parquet(f"{SF_SMALL}/events.parquet").count() and len(list((tmp_path / "landed-quoted").glob("*.csv"))) >= n / 50 > 4


def test_malformed_rows_of_an_archive(spark, tmp_path):
    row = "C{},2024-01-01T00:00:00Z,{}\n"
    whole = "CODE,DATE,TYPE\n" + "".join(row.format(i, "Flood Alert") for i in range(3))
    torn = ("CODE,DATE,TYPE\n" + row.format(3, "too,many") + row.format(4, '"two\nlines"') + "short\n" + row.format(5, '"open') + row.format(6, "Flood\x85 Alert")
            + row.format(7, '"a ""b"""') + row.format(8, '"last'))
    (tmp_path / "t.zip").write_bytes(encode_zip({"a.csv": whole, "b.csv": torn, "c.csv": whole.replace("\nC", "\nD")}))
    rows, skipped = files.load_checked(spark, [str(tmp_path / "t.zip")])
    assert sorted((r.CODE, r.TYPE) for r in rows.collect()) == [
        ("C0", "Flood Alert"), ("C1", "Flood Alert"), ("C2", "Flood Alert"), ("C4", "two\nlines"), ("C6", "Flood\x85 Alert"), ("C7", 'a "b"'),
        ("D0", "Flood Alert"), ("D1", "Flood Alert"), ("D2", "Flood Alert")]
    got = skipped.collect()
    assert sorted(r.record for r in got) == ["C3,2024-01-01T00:00:00Z,too,many", 'C5,2024-01-01T00:00:00Z,"open', 'C8,2024-01-01T00:00:00Z,"last', "short"]
    assert all(r.reason and os.path.basename(r.path) == "t.zip" for r in got)


def test_normalised_columns_pass(spark, tmp_path):
    (tmp_path / "n.ods").write_bytes(encode_ods(["timeRaised", "fwdCode", "severity"], [("2024-01-01T00:00:00", "N", "Flood Alert")]))
    r = files.load_directory(spark, str(tmp_path)).collect()[0]
    assert (r.fwdCode, r.severityLevel, r.timeRaised.year) == ("N", 3, 2024)


def test_long_runs_of_empty_cells_and_comments():
    from warnindex.sources.ods import NS, iter_sheet_rows

    cell = '<table:table-cell office:value-type="string"><text:p>{}</text:p></table:table-cell>'
    row = ('<table:table-row>' + cell.format("a") + '<table:table-cell table:number-columns-repeated="2000"/>'
           '<table:table-cell office:value-type="string"><office:annotation><text:p>a note</text:p></office:annotation><text:p>Flood Alert</text:p>'
           '<table:table><table:table-row>' + cell.format("inner") + '</table:table-row></table:table></table:table-cell></table:table-row>')
    xml = (f'<office:document-content xmlns:office="{NS["office"]}" xmlns:table="{NS["table"]}" xmlns:text="{NS["text"]}"><office:body>'
           f'<office:spreadsheet><table:table>{row}<table:table-row>{cell.format("next")}</table:table-row></table:table></office:spreadsheet></office:body></office:document-content>')
    import io
    import zipfile

    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("content.xml", xml)
    assert list(iter_sheet_rows(b.getvalue())) == [["a"] + [None] * 2000 + ["Flood Alert"], ["next"]]


def test_typed_read_back_and_absent_table(spark, tmp_path):
    df = spark.createDataFrame([("A", datetime(2021, 5, 1, 3, 4, 5, 678), " odd \"text\", ", 3, True, 7)],
                               "fwdCode string, timeRaised timestamp_ntz, severity string, severityLevel int, isTidal boolean, msg_id bigint")
    files.write_yearly(df, str(tmp_path / "t"), fmt="csv")
    from pyspark.sql import types as T

    back = files.read_year(spark, str(tmp_path / "t"), fmt="csv", schema=T.StructType([T.StructField("msg_id", T.LongType())]))
    assert [tuple(r) for r in back.select(*df.columns).collect()] == [tuple(r) for r in df.collect()]
    assert {f.name: f.dataType for f in back.schema.fields} == {**{f.name: f.dataType for f in df.schema.fields}, "year": T.IntegerType()}
    none = files.read_year(spark, str(tmp_path / "none"), 2020)
    assert none.collect() == [] and set(none.columns) >= {"fwdCode", "timeRaised", "severityLevel", "year"}


def test_yearly_write_is_one_file_a_small_year(spark, tmp_path):
    import glob

    df = spark.range(7000, numPartitions=8).selectExpr("cast(id as string) fwdCode", "timestamp_ntz'2018-01-01 00:00:00' + make_interval(id % 7) timeRaised")
    files.write_yearly(df, str(tmp_path / "t"))
    assert len(glob.glob(str(tmp_path / "t" / "year=*" / "*.parquet"))) == 7


def test_json_lines(spark, tmp_path):
    write(str(tmp_path / "l.json"), '{"DATE": "2024-01-01T00:00:00Z", "CODE": "A", "TYPE": "Flood {Alert}"}\n  {"CODE": "B", "TYPE": "x"}\n\n')
    assert sorted((r.CODE, r.TYPE) for r in files.load_raw(spark, str(tmp_path / "l.json")).collect()) == [("A", "Flood {Alert}"), ("B", "x")]


def test_listing(spark, tmp_path):
    for n in ("a/b.csv", "a/_c.csv", ".d.csv", "e.ods"):
        write(str(tmp_path / n), "x")
    want = [str(tmp_path / "a/b.csv"), str(tmp_path / "e.ods")]
    assert files.list_paths(spark, str(tmp_path)) == want
    assert files.list_paths(spark, f"file://{tmp_path}") == [f"file:{p}" for p in want]
    assert files.list_paths(spark, str(tmp_path / "none")) == []


def test_json_loses_only_torn_records(spark, tmp_path):
    row = '{{"DATE": "2024-01-01T00:00:00Z", "CODE": "{}", "TYPE": "Flood Alert"}}'
    write(str(tmp_path / "l.json"), "\n".join([row.format("A"), '{"DATE": "2024-01-01T00:00:00Z", "CODE": ', row.format("B"), '{"CODE": "x', "7", row.format("C")]))
    write(str(tmp_path / "a.json"), "[\n  " + ",\n  ".join([row.format("D"), '{"CODE": "torn" "TYPE"}', row.format("E")]) + "\n]")
    write(str(tmp_path / "p.json"), json.dumps([{"DATE": "2024-01-01T00:00:00Z", "CODE": "F", "TYPE": None, "n": 1.50, "o": {"k": [1, "é", None]}, "b": True},
                                               {"CODE": "G", "late": "x"}], indent=2))
    write(str(tmp_path / "m.json"), '[{"CODE": "only"}]')
    rows, skipped = files.load_checked(spark, files.list_paths(spark, str(tmp_path)))
    got = {r.CODE: r for r in rows.collect()}
    assert set(got) == set("ABCDEFG") and rows.count() == 7
    f = got["F"]
    assert (f.TYPE, f.n, f.o, f.b, f.late, got["G"].late, got["G"].TYPE) == (None, "1.5", '{"k":[1,"é",null]}', "true", None, "x", None)
    torn = sorted((os.path.basename(r.path), r.record) for r in skipped.collect())
    assert torn == [("a.json", '{"CODE": "torn" "TYPE"},'), ("l.json", '{"CODE": "x\n7'), ("l.json", '{"DATE": "2024-01-01T00:00:00Z", "CODE":'), ("m.json", None)]


def test_json_is_read_in_bounded_parts(monkeypatch):
    import io

    from warnindex.sources import decode

    monkeypatch.setattr(decode, "CHUNK", 16)
    records = [{"a": "x" * n, "b": [n, {"c": "}{,\n"}], "d": n * 1.5} for n in range(60)]
    want = [{"a": r["a"], "b": json.dumps(r["b"], separators=(",", ":")), "d": str(r["d"])} for r in records]
    for text in (json.dumps(records), json.dumps(records, indent=1), "\n".join(map(json.dumps, records)), "".join(map(json.dumps, records))):
        assert list(decode.json_records(io.StringIO(text))) == want
    monkeypatch.setattr(decode, "MAX_RECORD", 100)
    kinds = [type(r).__name__ for r in decode.json_records(io.StringIO('{"a": "' + "y" * 500 + "\n" + '{"a": "z"}\n{"a": "w"}'))]
    assert kinds == ["Malformed", "dict", "dict"]


def test_archive_members_are_units(spark, tmp_path):
    import zipfile

    from warnindex.sources import decode

    head = "CODE,DATE,TYPE\n"
    many = {f"d/m{i:03}.csv": head + f"C{i},2024-01-01T00:00:00Z,Flood Alert\n" for i in range(60)}
    (tmp_path / "many.zip").write_bytes(encode_zip({**many, "d/lacks.csv": "CODE\nX\n", "d/empty.csv": "", "d/readme.txt": "text"}))
    torn = bytearray(encode_zip({"ok.csv": head + "OK,2024-01-01T00:00:00Z,Flood Alert\n", "bad.csv": head + "BAD,2024-01-01T00:00:00Z,Flood Alert\n" * 50}))
    with zipfile.ZipFile(__import__("io").BytesIO(bytes(torn))) as z:
        info = z.getinfo("bad.csv")
    at = info.header_offset + 30 + len("bad.csv") + info.compress_size // 2
    torn[at:at + 8] = b"\xff" * 8
    (tmp_path / "torn.zip").write_bytes(bytes(torn))
    with zipfile.ZipFile(tmp_path / "stored.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("s.csv", head + "S,2024-01-01T00:00:00Z,Flood Alert\n")
    with zipfile.ZipFile(tmp_path / "lzma.zip", "w", zipfile.ZIP_LZMA) as z:
        z.writestr("x.csv", head + "L,2024-01-01T00:00:00Z,Flood Alert\n")
    paths = files.list_paths(spark, str(tmp_path))
    rows, skipped = files.load_checked(spark, paths)
    assert sorted(r.CODE for r in rows.collect()) == sorted(["OK", "S"] + [f"C{i}" for i in range(60)])
    bad = sorted((os.path.basename(r.path), r.reason.split(":")[0]) for r in skipped.collect())
    assert bad == [("lzma.zip", "x.csv"), ("many.zip", "d/empty.csv"), ("many.zip", "d/lacks.csv"), ("torn.zip", "bad.csv")]
    # one archive with many members is many tasks' work
    staged, failed, torn_rows = decode.decode_paths(spark, [str(tmp_path / "many.zip")], "zip")
    assert (failed, torn_rows) == (2, 0)
    assert decode.list_members(spark, [str(tmp_path / "many.zip")]).count() == 62
    from pyspark.sql import functions as F

    used = staged.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("f")).distinct().count()
    assert used >= 12  # four for each core of this session, some of which may get none


def test_drifting_headers_are_one_scan(spark, tmp_path):
    import itertools

    names = ["DATE", "CODE", "TYPE", "AREA", "x", "y z"]
    for k, order in enumerate(itertools.islice(itertools.permutations(names), 0, 700, 7)):
        cell = {"DATE": "2024-01-01T00:00:00Z", "CODE": f"C{k}", "TYPE": "Flood Alert", "AREA": "", "x": f"{k},x", "y z": "null"}
        write(str(tmp_path / f"f {k}.csv"), ",".join(order) + "\n" + ",".join(f'"{cell[c]}"' if "," in cell[c] else cell[c] for c in order) + "\n" + ("a,b\n" if k == 5 else ""))
    paths = files.list_paths(spark, str(tmp_path))
    rows, skipped, malformed, n_bad = files.load_csv_files(spark, paths)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation [_c0") == 1
    assert sorted((r.CODE, r.x, r.AREA, r["y z"]) for r in rows.collect()) == sorted((f"C{k}", f"{k},x", None, None) for k in range(100))
    assert n_bad == 0 and skipped.count() == 0 and [r.record for r in malformed.collect()] == ["a,b"]


def test_landed_pages_name_what_is_torn_or_missing(spark, tmp_path):
    page = lambda k, nxt=None, n=2: json.dumps({"meta": {"offset": 2 * k, "limit": 2, "next": nxt}, "items": [{"notation": f"N{2 * k + i}"} for i in range(n)]}, indent=1)
    for k, text in {0: page(0, "u1"), 1: page(1, "u2")[:50], 2: page(2, "u3"), 4: page(4, "u5"), 5: page(5, None, 1)}.items():
        write(str(tmp_path / "a" / f"{k}.json"), text)
    write(str(tmp_path / "b" / "0.json"), page(0))
    write(str(tmp_path / "b" / "plain.json"), json.dumps({"items": [{"notation": "X"}]}))
    items, faults = files.load_landed_pages(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted(r.notation for r in items.collect()) == ["N0", "N0", "N1", "N1", "N10", "N4", "N5", "N8", "N9", "X"]
    got = sorted((os.path.basename(r.path), r.reason, r.record) for r in faults.collect())
    assert got == [("0.json", "no page starts at offset 2", None), ("1.json", "not a page of items", page(1, "u2")[:50]), ("2.json", "no page ends at offset 4", None),
                   ("2.json", "no page starts at offset 6", None), ("4.json", "no page ends at offset 8", None)]
    assert files.read_landed_pages(spark, str(tmp_path / "a")).count() == 7


def test_area_metadata(spark, tmp_path):
    areas = spark.createDataFrame([("B", "Bristol", True), ("A", "Bristol, Bath", False), ("C", None, None)], "fwdCode string, county string, isTidal boolean")
    files.write_areas(areas, str(tmp_path / "a"), str(tmp_path / "s"), ["Bristol", "Bath", "Devon"], "West", "2024-05-01T10:00:00+00:00")
    m = files.read_area_metadata(spark, str(tmp_path / "s")).collect()
    assert len(m) == 1
    assert m[0].asDict() == {"description": "Warning areas of West", "region": "West", "counties": ["Bristol", "Bath", "Devon"], "fetched_at": "2024-05-01T10:00:00+00:00",
                             "total_areas": 3, "fluvial_areas": 1, "coastal_areas": 1, "areas_by_county": {"Bristol": 2, "Bath": 1, "Devon": 0}}
