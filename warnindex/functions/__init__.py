"""Column-level helpers: built-in Spark expressions only (codegen, no UDFs)."""

from warnindex.functions.severity import (
    default_seconds,
    is_update,
    normalized_severity,
    severity_level,
    sql_case,
    strip_ws,
    weight,
)
from warnindex.functions.text import arrow, bar, class_from_text, contains_any
from warnindex.functions.timeparse import parse_timestamp, seconds_between, whole_days_between

__all__ = [
    "arrow",
    "bar",
    "class_from_text",
    "contains_any",
    "default_seconds",
    "is_update",
    "normalized_severity",
    "parse_timestamp",
    "seconds_between",
    "severity_level",
    "sql_case",
    "strip_ws",
    "weight",
    "whole_days_between",
]
