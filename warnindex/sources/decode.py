"""File decoding in tasks: spreadsheets, ZIP members and JSON documents.

The unit of work is a spreadsheet, a JSON file or one member of an archive.  A first pass over archives reads
their central directories only; members are then spread over all tasks and opened by their offset.  A task
streams its unit, maps nothing and hands back bounded batches: one row with the unit's header, then rows of cells in
that order.  The rows are written once to the shared folder; the column names come from the header
rows, a few per distinct header.

What is lost is what is torn: a unit that fails to open, to decode or to show the required columns gives one row with
the reason, and rows it gave before are left out; a malformed record of a unit gives a row with the
reason and its text as ``record``, the others stay.  An archive is refused as a whole only when it
is unreadable or a member lies outside of it.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from warnindex.params import CSV_NULL_TOKENS, RAW_COLUMN_NAMES
from warnindex.session import broadcast_if_small, scratch_path
from warnindex.sources.storage import open_path

UNITS = "path string, member string, offset long, packed long, method int, crc long, error string"
DECODED = "_path string, _source string, hid long, header array<string>, cells array<string>, error string, record string"
_ARROW = pa.schema([("_path", pa.string()), ("_source", pa.string()), ("hid", pa.int64()), ("header", pa.list_(pa.string())),
                    ("cells", pa.list_(pa.string())), ("error", pa.string()), ("record", pa.string())])
BATCH_ROWS = 5_000
MAX_TASKS = 8_192
CHUNK = 1 << 20  # characters or bytes read at once
MAX_RECORD = 1 << 26  # characters of one JSON record; what is longer is malformed
SHOWN = 2_000  # characters of a malformed JSON record that are reported
# Either the raw or the clean name of each column that a message file must have.
NEEDED = tuple((raw, clean) for raw, clean in RAW_COLUMN_NAMES.items() if clean in ("timeRaised", "fwdCode", "severity"))


def lacking(columns) -> list[str]:
    """Clean names of the required columns that ``columns`` does not offer."""
    have = set(columns)
    return [clean for raw, clean in NEEDED if raw not in have and clean not in have
            and not (clean == "severity" and "severityLevel" in have)]


def _check(header) -> None:
    miss = lacking(header)
    if miss:
        raise ValueError("no column for " + ", ".join(miss))


@dataclass(frozen=True)
class Malformed:
    reason: str
    record: str


# ---- spreadsheets ---------------------------------------------------------------

def spreadsheet_rows(unit: dict) -> Iterator[list]:
    """The header, then the rows of the first sheet."""
    from warnindex.sources.ods import iter_sheet_rows

    header = None
    with open_path(unit["path"]) as f:
        for row in iter_sheet_rows(f):
            if header is None:
                header = [(h or "").strip() for h in row]
                _check(header)
                yield header
            else:
                yield row
    if header is None:
        raise ValueError("no rows")


# ---- archive members ------------------------------------------------------------

class MemberStream(io.RawIOBase):
    """One stored or deflated member of an open ZIP file, read from its offset in bounded memory and
    checked against its CRC."""

    def __init__(self, f, offset: int, packed: int, method: int, crc: int):
        super().__init__()
        if method not in (0, 8):
            raise ValueError(f"compression method {method} is not read")
        f.seek(offset)
        head = f.read(30)
        if len(head) < 30 or head[:4] != b"PK\x03\x04":
            raise ValueError("no member starts at its offset")
        if head[6] & 1:
            raise ValueError("the member is encrypted")
        f.seek(offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
        self._f, self._left, self._crc, self._want = f, packed, 0, crc
        self._z = zlib.decompressobj(-15) if method == 8 else None
        self._held, self._ended = b"", False

    def readable(self) -> bool:
        return True

    def _more(self) -> bytes:
        while True:
            if self._z is not None and self._z.unconsumed_tail:
                raw = self._z.unconsumed_tail
            else:
                raw = self._f.read(min(CHUNK, self._left))
                self._left -= len(raw)
                if not raw:
                    if self._left:
                        raise ValueError("the member is cut off")
                    out = self._z.flush() if self._z is not None else b""
                    if self._z is not None and not self._z.eof:
                        raise ValueError("the member is cut off")
                    self._ended = True
                    return out
            out = self._z.decompress(raw, CHUNK) if self._z is not None else raw
            if out:
                return out

    def readinto(self, b) -> int:
        while not self._held and not self._ended:
            self._held = self._more()
            self._crc = zlib.crc32(self._held, self._crc)
        n = min(len(b), len(self._held))
        if not n and self._ended and self._crc != self._want:
            raise ValueError("the member's check sum does not match")
        b[:n], self._held = self._held[:n], self._held[n:]
        return n


def _csv_records(lines: Iterator[str]) -> Iterator[tuple[list, str] | Malformed]:
    """The records of CSV text and their text; a line without a quote is a record of its own.  Where quotes do not
    match, the first line goes as malformed and those that its open quote took in are read again."""
    held: list[str] = []  # lines of the record being read
    again: list[str] = []  # lines to read anew, the last one first

    def feed():
        while again or (line := next(lines, None)) is not None:
            held.append(again.pop() if again else line)
            yield held[-1]

    while True:
        line = again.pop() if again else next(lines, None)
        if line is None:
            return
        if '"' not in line:
            text = line.rstrip("\r\n")
            yield (text.split(",") if text else []), text
            continue
        again.append(line)
        try:
            row = next(csv.reader(feed(), strict=True))
        except csv.Error as e:
            bad = Malformed(f"quotes do not match: {e}", held[0].rstrip("\r\n"))
            again.extend(reversed(held[1:]))
            held.clear()
            yield bad
            continue
        text = "".join(held).rstrip("\r\n")
        held.clear()
        yield row, text


def member_rows(unit: dict) -> Iterator[list | Malformed]:
    """The header, then the rows of one CSV member (quoted line breaks included)."""
    with open_path(unit["path"]) as f:
        stream = MemberStream(f, unit["offset"], unit["packed"], unit["method"], unit["crc"])
        records = _csv_records(io.TextIOWrapper(io.BufferedReader(stream, CHUNK), encoding="utf-8-sig", newline=""))
        first = next(records, ([], ""))
        if isinstance(first, Malformed):
            raise ValueError(first.reason)
        header = [h.strip() for h in first[0]]
        _check(header)
        yield header
        for r in records:
            if isinstance(r, Malformed):
                yield r
                continue
            row, text = r
            if not row:
                continue
            if len(row) != len(header):
                yield Malformed("fields do not match the header", text)
                continue
            yield [None if v == "" or v in CSV_NULL_TOKENS else v for v in row]


def _directories(pattern: str):
    def run(batches):
        import zipfile

        from warnindex.sources.archive import UnsafeMemberError, safe_member

        rx = re.compile(pattern)
        names = [c.split()[0] for c in UNITS.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                try:
                    with open_path(path) as f, zipfile.ZipFile(f) as z:
                        for i in z.infolist():
                            if not safe_member(i.filename):
                                raise UnsafeMemberError(f"member lies outside the archive: {i.filename}")
                            if not i.is_dir() and rx.search(i.filename):
                                rows.append((path, i.filename, i.header_offset, i.compress_size, i.compress_type, i.CRC, None))
                    if not rows:
                        raise ValueError("no member of that kind")
                except Exception as e:  # noqa: BLE001 - whatever a file holds, the others load
                    rows = [(path, None, None, None, None, None, f"{type(e).__name__}: {e}")]
                for i in range(0, len(rows), BATCH_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + BATCH_ROWS]), kinds)], names=names)

    return run


def list_members(spark: SparkSession, paths, pattern: str = r"(?i)\.csv$") -> DataFrame:
    """UNITS of archives, from their central directories (read in tasks)."""
    paths = list(paths)
    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), MAX_TASKS)))
    path = scratch_path(spark, "members")
    rows.mapInArrow(_directories(pattern), UNITS).write.parquet(path)
    return spark.read.schema(UNITS).parquet(path)


# ---- JSON -----------------------------------------------------------------------

_DECODER = json.JSONDecoder(parse_float=str, parse_int=str, parse_constant=str)
_GAP = re.compile(r"[\s,\[\]]*")
_NEXT = re.compile(r"[\r\n]\s*,?\s*\{")


def json_records(f) -> Iterator[dict | Malformed]:
    """Records of a text stream that holds an array of them, one a line, or one after another,
    in bounded memory.  What does not parse goes as malformed up to the next line that starts a record."""
    buf, ended, seen = "", False, False

    def more() -> None:
        nonlocal buf, ended
        part = f.read(max(CHUNK, len(buf)))  # doubles while one record goes on
        ended = not part
        buf += part

    pos = 0
    while True:
        pos = _GAP.match(buf, pos).end()
        if pos >= len(buf):
            if ended:
                break
            buf, pos = "", 0
            more()
            continue
        try:
            value, end = _DECODER.raw_decode(buf, pos)
            if end >= len(buf) - 1 and not ended and not isinstance(value, dict):
                buf, pos = buf[pos:], 0  # a number may go on
                more()
                continue
        except ValueError as e:
            cut = _NEXT.search(buf, pos + 1)
            # a line break in a string is an error of its own: an unterminated string goes on beyond the buffer
            goes_on = getattr(e, "pos", pos) >= len(buf) - 16 or "Unterminated" in str(e)
            if not ended and (cut is None or goes_on) and len(buf) - pos < MAX_RECORD:
                buf, pos = buf[pos:], 0
                more()
                continue
            stop = cut.start() if cut else len(buf)
            yield Malformed(f"not a JSON record: {e.msg}" if isinstance(e, json.JSONDecodeError) else "not a JSON record", buf[pos:stop].strip()[:SHOWN])
            while cut is None and not ended:  # a record beyond the limit: skip to the next, holding a line's beginning at most
                buf = buf[max(buf.rfind("\n"), buf.rfind("\r"), 0):][:CHUNK]
                more()
                cut = _NEXT.search(buf)
            buf, pos, seen = buf[cut.start():] if cut else "", 0, True
            continue
        if isinstance(value, dict):
            yield {k: _as_text(v, buf, pos, end, k) for k, v in value.items()}
        else:
            yield Malformed("not a JSON record: no object", buf[pos:end][:SHOWN])
        seen = True
        pos = end
        if pos > CHUNK:
            buf, pos = buf[pos:], 0
    if not seen:
        raise ValueError("no rows")


def _as_text(v, buf: str, start: int, end: int, key: str) -> str | None:
    if v is None or isinstance(v, str):
        return v
    if isinstance(v, bool):
        return "true" if v else "false"
    return json.dumps(json.loads(buf[start:end])[key], separators=(",", ":"), ensure_ascii=False)


def document_rows(unit: dict) -> Iterator[list | Malformed]:
    """Rows of a JSON file; the header, every member that occurs in the order of its
    first appearance, comes last."""
    place: dict[str, int] = {}
    with open_path(unit["path"]) as f:
        for r in json_records(io.TextIOWrapper(f, encoding="utf-8-sig")):
            if isinstance(r, Malformed):
                yield r
                continue
            for k in r:
                place.setdefault(k, len(place))
            row: list = [None] * len(place)
            for k, v in r.items():
                row[place[k]] = v
            yield row
    if not place:
        raise ValueError("not a JSON document of records")
    _check(place)
    yield list(place)


# ---- one pass over all units ----------------------------------------------------

ROWS = {"ods": spreadsheet_rows, "zip": member_rows, "json": document_rows}


def header_id(header: list[str]) -> int:
    return xxhash.xxh64_intdigest("\x00".join(header).encode("utf-8", "replace")) - (1 << 63)


def _decode(fmt: str):
    read, last = ROWS[fmt], fmt == "json"

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    def run(batches):
        for b in batches:
            for unit in b.to_pylist():
                path, source = unit["path"], unit.get("member") or unit["path"]
                if unit.get("error"):
                    yield batch([(path, source, None, None, None, unit["error"], None)])
                    continue
                # rows of a unit whose header comes last carry an id of the unit; the header row repeats it
                hid = header_id(["", path, source]) if last else None
                out: list[tuple] = []
                try:
                    header = None
                    for row in read(unit):
                        if isinstance(row, Malformed):
                            out.append((path, source, None, None, None, row.reason, row.record))
                        elif hid is None:
                            header, hid = row, header_id(row)
                            out.append((path, source, hid, header, None, None, None))
                        else:
                            out.append((path, source, hid, None, row, None, None))
                        if len(out) >= BATCH_ROWS:
                            yield batch(out)
                            out = []
                    if last and out and out[-1][4] is not None:  # the last row is the header
                        out[-1] = (path, source, hid, out[-1][4], None, None, None)
                except Exception as e:  # noqa: BLE001 - whatever a unit holds, the others load
                    out = [(path, source, None, None, None, f"{type(e).__name__}: {e}", None)]
                if out:
                    yield batch(out)

    return run


def decode_paths(spark: SparkSession, paths, fmt: str) -> tuple[DataFrame, int, int]:
    """(staged DECODED rows, units that failed, malformed records) of spreadsheets, archives or JSON files."""
    paths = list(paths)
    if fmt == "zip":
        units = list_members(spark, paths)
        n = units.count()
    else:
        units, n = spark.createDataFrame([(p,) for p in paths], "path string"), len(paths)
    seen = Observation(f"decoded-{fmt}")
    tasks = min(n, MAX_TASKS, 4 * spark.sparkContext.defaultParallelism)  # a few units each: small ones cost less than a task
    rows = units.repartition(max(1, tasks)).mapInArrow(_decode(fmt), DECODED).observe(
        seen, F.count_if(F.col("error").isNotNull() & F.col("record").isNull()).alias("failed"), F.count_if(F.col("record").isNotNull()).alias("torn"))
    path = scratch_path(spark, f"decoded-{fmt}")
    rows.write.parquet(path)
    return spark.read.schema(DECODED).parquet(path), seen.get["failed"], seen.get["torn"]


def assemble(decoded: DataFrame, failed: int) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """(rows as text columns and ``_source``, units that failed, malformed records, both
    ``path, reason, record``) of staged DECODED rows."""
    bad = decoded.filter("error is not null and record is null").select("_path", "_source", "error")
    named = F.when(F.col("_source") == F.col("_path"), F.col("error")).otherwise(F.concat_ws(": ", "_source", "error"))
    skipped = bad.select(F.col("_path").alias("path"), named.alias("reason"), F.lit(None).cast("string").alias("record"))
    malformed = decoded.filter("record is not null").select(F.col("_path").alias("path"), F.col("error").alias("reason"), "record")
    good = decoded.filter("error is null")
    if failed:
        good = good.join(bad.select("_path", "_source"), ["_path", "_source"], "left_anti")
    heads = good.filter("header is not null")
    distinct = heads.select("header").distinct().limit(2).collect()
    if not distinct:
        return None, skipped, malformed
    rows = good.filter("cells is not null")
    if len(distinct) == 1:  # one header: places are constants
        header = distinct[0]["header"]
        place = {h: F.get("cells", F.lit(i)) for i, h in reversed(list(enumerate(header))) if h}  # the first of a name wins
    else:
        names = [r["n"] for r in heads.select(F.explode("header").alias("n")).distinct().collect()]
        rows = rows.drop("header").join(broadcast_if_small(heads.select("hid", "header").dropDuplicates(["hid"])), "hid")
        place = {n: F.get("cells", F.array_position("header", F.lit(n)).cast("int") - 1) for n in names if n}
    return rows.select(*[place[n].alias(n) for n in sorted(place)], "_source"), skipped, malformed
