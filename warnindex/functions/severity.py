"""Severity text, level, default duration and weight as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from warnindex.params import SEVERITY_LEVELS, DurationParams

# (?U): Unicode classes, so \s also covers no-break and other Unicode spaces.
_EDGE_WS = r"(?U)^\s+|\s+$"
_UPDATE_PREFIX = r"(?iU)^update\s+"
_UPDATE_FLAG = r"(?iU)^update\s"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Strip leading and trailing (Unicode) whitespace; ``F.trim`` only strips spaces."""
    return F.regexp_replace(_col(c), _EDGE_WS, "")


def _case(key: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def _map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def normalized_severity(c="severity") -> Column:
    """Stripped text without one leading 'Update ', lower case."""
    return F.lower(F.regexp_replace(strip_ws(c), _UPDATE_PREFIX, ""))


def severity_level(c="severity") -> Column:
    """Level 1-4 from the message text; unknown or null text gives null.

    One map lookup, so the regex work runs once per row."""
    return F.try_element_at(_map(SEVERITY_LEVELS), normalized_severity(c)).cast("int")


def is_update(c="severity") -> Column:
    """Raw text (not stripped) starts with 'update' and a whitespace, any case."""
    return _col(c).rlike(_UPDATE_FLAG)


def sql_case(col_sql: str, mapping: dict, default) -> str:
    """``CASE col WHEN k THEN v ... ELSE default END`` for maps of exact numbers (SQL text)."""
    whens = " ".join(f"WHEN {int(k)} THEN {v}" for k, v in mapping.items())
    return f"CASE {col_sql} {whens} ELSE {default} END"


def default_seconds(level="severityLevel", params: DurationParams | None = None) -> Column:
    p = params or DurationParams()
    return _case(_col(level), p.default_seconds, p.fallback_seconds).cast("bigint")


def weight(level="severityLevel", params: DurationParams | None = None) -> Column:
    p = params or DurationParams()
    w = p.exact_weights
    return _case(_col(level), {k: v for k, v in w.items() if k is not None}, w[None]).cast(p.weight_type)
