"""Timestamp parsing and differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"(Z|z|[+-]\d{2}(:?\d{2})?)$"
# A full date and a time of day (seconds optional), then at most an offset: a time
# alone, a year, a date or a zone name is no instant.
_INSTANT = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}([.]\d+)?)? ?(Z|z|[+-]\d{2}(:?\d{2})?)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, require_offset: bool = False) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ in UTC wall time; bad text -> null.

    Strings with an offset become the UTC instant; naive strings are read as
    UTC (session zone is pinned to UTC).  ``require_offset`` makes naive
    strings null, as a strict ``%+`` parse would.
    """
    col = _col(c)
    txt = F.trim(col.cast("string"))
    parsed = F.when(txt.rlike(_INSTANT), F.try_to_timestamp(txt)).cast("timestamp_ntz")
    if require_offset:
        parsed = F.when(txt.rlike(_OFFSET), parsed)
    return parsed


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (truncated), BIGINT."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def whole_days_between(start, end) -> Column:
    """Whole days elapsed (14 d 23 h -> 14), not calendar-date difference."""
    return F.timestamp_diff("DAY", _col(start), _col(end))
