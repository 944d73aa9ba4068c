import hashlib
import io
import random
import struct

import duckdb
import pytest
import zstandard as zstd

from conftest import SF_MID
from warnindex.llm import warc as W
from warnindex.llm.queries import ORACLES, op1_warc_archives


def expect(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, u, h in rows:
        b = (h or "").encode()
        f = first.get(b)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if f is None or f == i else "revisit", None if f is None or f == i else f))
    return out


def sort(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def pages(n=300):
    rng = random.Random(4)
    big = "x" * 100
    body = lambda: "<p>" + " ".join(rng.choice(["alpha", "beta", "ünï", "😀"]) for _ in range(rng.randrange(0, 400))) + "</p>"
    rows = [(i, f"http://h/{i}", body()) for i in range(n)]
    rows += [(1000, None, None), (1001, "http://a\r\nX: y", ""), (1003, "u", big), (1002, "u", big), (1002, "u", big), (None, "u", big),
             (1004, "u", big[:99]), (1005, "u", big[:99]), (None, "n", "n" * 200), (None, "n", "n" * 200), (1006, "r", "\r\n\r\nWARC/1.1\r\n\r\n" * 30),
             (1007, "l", "é" * 3_000_000), (1008, "l", "é" * 3_000_000)]
    return rows


@pytest.mark.parametrize("p", [W.WarcParams(), W.WarcParams(sample_bytes=1, archive_bytes=20_000), W.WarcParams(sample_bytes=20_000, archive_bytes=200_000)])
def test_round_trip(spark, tmp_path, p):
    rows = pages()
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    manifest = W.write_archives(df, f"file://{tmp_path}/arc", p)
    got = W.read_archives(spark, manifest).collect()
    assert sort((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sort(expect(rows))
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
        else:
            assert r.payload is None
    assert sum(r.records for r in manifest.collect()) == len(rows)
    for r in manifest.collect():  # dictionary first, then one frame a record, each readable alone
        raw = open(r.path.removeprefix("file://"), "rb").read()
        magic, n = struct.unpack("<II", raw[:8])
        assert magic == W.DICT_MAGIC
        d, at, frames = zstd.ZstdCompressionDict(raw[8:8 + n]), 8 + n, 0
        while at < len(raw):
            o = zstd.ZstdDecompressor(dict_data=d).decompressobj()
            rec = o.decompress(raw[at:])
            assert rec.startswith(b"WARC/1.1\r\n") and rec.endswith(b"\r\n\r\n")
            at, frames = len(raw) - len(o.unused_data), frames + 1
        assert frames == r.records


def test_dictionary_pays():
    rng = random.Random(1)
    recs = [W.make_record(i, f"http://h/{i}", ("<html><head><title>" + "menu " * 30 + str(rng.random()) + "</title>").encode(), "0" * 64, None, "d") for i in range(400)]
    d = zstd.ZstdCompressionDict(W.train(recs, 8192))
    plain, with_d = (sum(len(c.compress(r)) for r in recs) for c in (zstd.ZstdCompressor(), zstd.ZstdCompressor(dict_data=d)))
    assert with_d < 0.6 * plain


def test_corrupt_archive():
    with pytest.raises(ValueError):
        list(W.read_records(io.BytesIO(b"12345678")))
    assert list(W.read_records(io.BytesIO(b""))) == []


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.read_archives(spark, W.write_archives(df, str(tmp_path))).collect() == []


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_MID}/pages.parquet')")
    df = op1_warc_archives(spark, SF_MID)
    cur = con.execute(ORACLES["op1_warc_archives"])
    assert [d[0] for d in cur.description] == df.columns
    assert sort(map(tuple, df.collect())) == sort(cur.fetchall())
