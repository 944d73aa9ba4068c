"""Archive member scan.

Archives are opened by path in the task that got the path; members come out
one at a time as (archive, member, size, content).  A member whose normalised
path is absolute or climbs out of the archive root fails the job, as
extraction would.  Message rows of CSV members: ``sources.decode``.
"""

from __future__ import annotations

import io
import posixpath
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from warnindex.sources.storage import open_path

MEMBERS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


class UnsafeMemberError(ValueError):
    """A member would be written outside the extraction folder."""


def safe_member(name: str) -> bool:
    if name.startswith("/") or name.startswith("\\") or (len(name) > 1 and name[1] == ":"):
        return False
    norm = posixpath.normpath(name.replace("\\", "/"))
    return not (norm == ".." or norm.startswith("../"))


def _members(it):
    for pdf in it:
        for path in pdf["path"]:
            with open_path(path) as f, zipfile.ZipFile(f) as z:
                infos = z.infolist()
                for info in infos:
                    if not safe_member(info.filename):
                        raise UnsafeMemberError(f"member lies outside the archive: {info.filename}")
                for info in infos:
                    if not info.is_dir():  # one member in memory at a time
                        yield pd.DataFrame([(path, info.filename, info.file_size, z.read(info))],
                                           columns=["archive", "member", "size", "content"])


def archive_members(files: DataFrame) -> DataFrame:
    """(path, ...) archives -> one row per member file (whole content)."""
    return files.select("path").mapInPandas(_members, MEMBERS)


def encode_zip(members: dict) -> bytes:
    """Build a ZIP archive from {name: bytes|str} (fixtures, exports)."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return buf.getvalue()
