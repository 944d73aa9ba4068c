"""WARC archives with dictionary-compressed records (``.warc.zst``).

An archive starts with a skippable frame (magic 0x184D2A5D) that holds a
Zstandard dictionary trained on records of that very archive; every record then
is a frame of its own, so any record can be read alone with the dictionary.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the smallest
page_id is a ``response``; the others are ``revisit`` records without payload
that name it.  The groups are found by a map-side-combined aggregate over
digests; only digests that occur more than once come back to the pages.

Each task streams its rows into archives of bounded size in the shared folder,
training on a bounded buffer of the first records, and returns one manifest row
per finished archive.  A retried task writes under new names; only archives in the
manifest count.  Reading spreads the manifest over tasks and streams record by
record; payload digests are checked.

Defined results: null html is an empty payload; null url and null page_id are
left out of the record; rows with the group's smallest page_id are responses,
all of them where rows repeat; where every page_id of a group is null, all are
responses; an empty table writes no archive; extra columns are not archived.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warnindex.llm.common import written
from warnindex.session import fits, scratch_path

DICT_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGESTS_TO_BROADCAST = 100_000


@dataclass(frozen=True)
class WarcParams:
    min_revisit: int = 100
    level: int = 3
    dict_bytes: int = 32 << 10
    sample_bytes: int = 1 << 20  # records buffered to train the dictionary
    archive_bytes: int = 256 << 20  # of records before compression
    date: str = "1970-01-01T00:00:00Z"  # the pages carry no capture time


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file named by path or URI."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def _line(s: str) -> str:
    """A header value: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in s)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}>"


def make_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record; a revisit (refers_to given) holds the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or, where there is too little to train on, the records
    themselves as a raw one; empty without records."""
    try:
        return zstd.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples, k=512, d=8).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


class ArchiveWriter:
    """Streams records into one archive."""

    def __init__(self, out, p: WarcParams):
        self.out, self.p = out, p
        self.buffer, self.held = [], 0
        self.compress = None
        self.records = self.raw = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        self.raw += len(record)
        if self.compress is None:
            self.buffer.append(record)
            self.held += len(record)
            if self.held >= self.p.sample_bytes:
                self._start()
        else:
            self.out.write(self.compress(record))

    def _start(self) -> None:
        d = train(self.buffer, self.p.dict_bytes)
        self.out.write(struct.pack("<II", DICT_MAGIC, len(d)) + d)
        self.compress = zstd.ZstdCompressor(level=self.p.level, dict_data=zstd.ZstdCompressionDict(d), write_checksum=True).compress
        for r in self.buffer:
            self.out.write(self.compress(r))
        self.buffer = []

    def close(self) -> None:
        if self.compress is None:
            self._start()
        self.out.close()


def _exactly(f, n: int) -> bytes:
    parts = []
    while n:
        b = f.read(n)
        if not b:
            raise EOFError("archive ends inside a record")
        parts.append(b)
        n -= len(b)
    return b"".join(parts)


def read_records(f) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of an open archive."""
    head = f.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head)
    if magic != DICT_MAGIC:
        raise ValueError("archive does not start with a dictionary frame")
    d = _exactly(f, size)
    if d[:4] == ZSTD_MAGIC:
        d = zstd.ZstdDecompressor().decompress(d)
    stream = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(d)).stream_reader(f, read_across_frames=True)
    left = b""
    while True:
        while (end := left.find(b"\r\n\r\n")) < 0:
            more = stream.read(1 << 16)
            if not more:
                if left:
                    raise EOFError("archive ends inside a header")
                return
            left += more
        lines = left[:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(headers["content-length"])
        left = left[end + 4:]
        if len(left) < n + 4:
            left += _exactly(stream, n + 4 - len(left))
        yield headers, left[:n]
        left = left[n + 4:]


def mark_revisits(pages: DataFrame, p: WarcParams = WarcParams()) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null: a response)."""
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    d = d.withColumn("digest", F.sha2("payload", 256))
    groups = d.filter(F.octet_length("payload") >= p.min_revisit).groupBy("digest").agg(
        F.count("*").alias("n"), F.min("page_id").alias("first_id"))
    groups = written(groups.filter("n > 1 and first_id is not null").select(F.col("digest").alias("d"), "first_id"), "warc-groups")
    d = d.join(F.broadcast(groups) if fits(groups, DIGESTS_TO_BROADCAST) else groups, F.col("digest") == F.col("d"), "left")
    return d.select("page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, p: WarcParams = WarcParams()) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) under ``folder``; the manifest
    (path, records, bytes), itself a written table."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        name = w = None
        done = []

        def finish():
            w.close()
            done.append((f"{folder}/{name}", w.records, w.raw))

        for b in batches:
            cols = [b.column(i) for i in range(5)]
            for r in range(b.num_rows):
                page_id, url, payload, digest, refers_to = (c[r].as_py() for c in cols)
                if w is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    w = ArchiveWriter(fs.open_output_stream(f"{base}/{name}", compression=None), p)
                w.add(make_record(page_id, url, payload, digest, refers_to, p.date))
                if w.raw >= p.archive_bytes:
                    finish()
                    w = None
        if w is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64()),
                                          pa.array([x[2] for x in done], pa.int64())], names=["path", "records", "bytes"])

    return written(mark_revisits(pages, p).mapInArrow(go, "path string, records long, bytes long"), "warc-manifest")


def _page_of(urn: str | None) -> int | None:
    x = urn.split(":")[2] if urn else ""
    return int(x) if x else None


def read_archives(spark: SparkSession, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the manifest's archives: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, unless left out, payload (null for revisits)."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [c.split()[0] for c in schema.split(", ")] + ["payload"] * with_payload

    def batch(rows):
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, at = filesystem(path)
                rows, held = [], 0
                with fs.open_input_stream(at, compression=None) as f:
                    for h, block in read_records(f):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        digest, kind = h["warc-payload-digest"].removeprefix("sha256:"), h["warc-type"]
                        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
                        rows.append((_page_of(h["warc-record-id"]), h.get("warc-target-uri"), size, digest, kind, _page_of(h.get("warc-refers-to")),
                                     *([payload if kind == "response" else None] if with_payload else [])))
                        held += len(payload) if with_payload else 100
                        if held >= 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    spread = manifest.select("path").repartition(max(1, spark.sparkContext.defaultParallelism), "path")
    return spread.mapInArrow(go, schema + (", payload binary" if with_payload else ""))


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
