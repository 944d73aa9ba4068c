"""Per-message durations from the gap to the next message in the same area.

W1 (lead gap), P10-P15.  The gap needs the rows of one area in time order.
A plain ``Window.partitionBy("fwdCode")`` puts every message of an area into
one task, so one very busy area (a third of all rows, say) would be one
task.  Instead the window is split by fixed time buckets:

1. ``lead`` over ``(scope, bucket)`` gives the next message inside the bucket;
2. the first and the last message of every bucket then meet in a second window
   over the area (at most two rows per non-empty bucket), where the last one finds the head of
   the next bucket; all other rows stay where they are.
   With ``coarse_bucket_seconds`` there is a level in between.

The messages are shuffled once: the rows that stay and the ends are two readings of the same
exchange, which Spark reuses, and their union is the result.  The input is computed once and nothing is
joined; windows group null area codes like any other value.  The result is exactly the unsplit lead for any
bucket width; the width only bounds the largest task (messages of one area
in one bucket, or buckets of one area).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warnindex.functions.severity import is_update, sql_case
from warnindex.functions.timeparse import seconds_between
from warnindex.params import DURATION_REQUIRED_COLUMNS, DurationParams
from warnindex.schema import require_columns

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
# Null times never get a gap; they are spread over this many window groups.
_NULL_TIME_SALT = 1024

def tie_break_columns(df: DataFrame, id_col: str | None = None) -> list[str]:
    """Order of messages with equal (area, time): level, text, then an id."""
    cols = [c for c in ("severityLevel", "severity") if c in df.columns]
    if id_col is None and "msg_id" in df.columns:
        id_col = "msg_id"
    if id_col is not None:
        cols.append(id_col)
    return cols


def scope_columns(params: DurationParams) -> list[str]:
    return ["fwdCode"] if params.gap_scope == "all" else ["_scope_year", "fwdCode"]


def _with_window_keys(df: DataFrame, p: DurationParams, t: Column) -> DataFrame:
    d = df
    if p.gap_scope == "year":
        d = d.withColumn("_scope_year", F.year(t))
    return d.withColumn(
        "_bucket",
        F.floor(F.timestamp_diff("SECOND", F.expr(_EPOCH), t) / F.lit(p.bucket_seconds)).cast("bigint"),
    ).withColumn(
        # null times: spread by a hash of the whole row (their gap is null
        # whatever group they land in, so the grouping never changes results)
        "_salt",
        F.when(t.isNull(), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(_NULL_TIME_SALT)))
        .otherwise(F.lit(0))
        .cast("int"),
    )


def window_group_sizes(df: DataFrame, params: DurationParams | None = None, id_col: str | None = None,
                       time_col: str = "timeRaised") -> DataFrame:
    """Diagnostic: rows per window group (the unit one task sorts), largest
    first -- bounded by messages per area and bucket, not per area."""
    p = params or DurationParams()
    d = _with_window_keys(df, p, F.col(time_col))
    keys = scope_columns(p) + ["_bucket", "_salt"]
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("rows").desc())


def with_next_time(df: DataFrame, params: DurationParams | None = None, id_col: str | None = None,
                   time_col: str = "timeRaised") -> DataFrame:
    """Add ``_next_time``: the time of the next message of the same area (and
    year, for ``gap_scope="year"``), ordered by time then tie-break.

    O1: the per-area time order is the window's own partition sort; there is
    no global sort of the messages."""
    p = params or DurationParams()
    t = F.col(time_col)
    ties = tie_break_columns(df, id_col)
    scope = scope_columns(p)
    d = _with_window_keys(df, p, t)
    w = Window.partitionBy(*scope, "_bucket", "_salt").orderBy(*([t] + [F.col(c).asc_nulls_first() for c in ties]))
    d = d.withColumns({"_next_time": F.lead(t).over(w), "_pos": F.row_number().over(w), "_end": F.lead(F.lit(1)).over(w).isNull()})
    # the ends of a group, in order, as long as they still matter: first its head, then its last row
    d = d.withColumn("_at", F.when(t.isNotNull() & (F.col("_end") | (F.col("_pos") == 1)), F.col("_pos")))
    groups = [scope]
    if p.coarse_bucket_seconds is not None:
        ratio = p.coarse_bucket_seconds // p.bucket_seconds
        groups.insert(0, [*scope, F.floor(F.col("_bucket") / F.lit(ratio)).cast("bigint")])
    # all parts read the same exchange, so the input is computed and shuffled once
    open_ = F.col("_at").isNotNull()
    parts, ends = [d.where(~open_)], d.where(open_)
    for group in groups:
        ends = _link_ends(ends, group, t)
        if group is not scope:
            parts.append(ends.where(~open_))
            ends = ends.where(open_)
    d = reduce(DataFrame.unionByName, [*parts, ends])
    return d.drop("_bucket", "_salt", "_scope_year", "_pos", "_end", "_at")


def _link_ends(ends: DataFrame, group: list, t: Column) -> DataFrame:
    """Among the end rows: the last row of a bucket takes the time of the next row of its group, which is the head
    of the next non-empty bucket.  Only the group's own head and last row stay open (``_at``) for a wider group."""
    w = Window.partitionBy(*group).orderBy("_bucket", "_pos")
    e = ends.withColumns({"_lead": F.lead(t).over(w), "_rank": F.row_number().over(w), "_closes": F.lead(F.lit(1)).over(w).isNull()})
    e = e.withColumns({
        "_next_time": F.when(F.col("_end") & F.col("_next_time").isNull(), F.col("_lead")).otherwise(F.col("_next_time")),
        "_at": F.when((F.col("_rank") == 1) | F.col("_closes"), F.col("_at"))})
    return e.drop("_lead", "_rank", "_closes")


def calculate_durations(df: DataFrame, params: DurationParams | None = None,
                        id_col: str | None = None) -> DataFrame:
    """Scored messages: input columns plus is_update, gap_seconds,
    gap_to_next_hours, duration_seconds, duration_hours, weight,
    score_seconds, score.  Seconds are BIGINT and weights BIGINT or DECIMAL (exact
    sums); hours = s/3600.

    P15/F18: an empty input needs no special case -- the schema is static, so
    an empty frame comes back with the added (typed) columns."""
    p = params or DurationParams()
    require_columns(df, DURATION_REQUIRED_COLUMNS, "calculate_durations")
    keep = [f"`{c}`" for c in df.columns]
    w = p.exact_weights
    total = "BIGINT" if p.weight_type == "BIGINT" else "DECIMAL(28,4)"
    d = with_next_time(df, p, id_col).withColumn("is_update", is_update("severity"))
    d = d.selectExpr(
        *keep,
        "is_update",
        "timestampdiff(SECOND, timeRaised, _next_time) AS gap_seconds",
        f"CAST({sql_case('severityLevel', p.default_seconds, p.fallback_seconds)} AS BIGINT) AS _default_s",
        f"CAST({sql_case('severityLevel', {k: v for k, v in w.items() if k is not None}, w[None])} AS {p.weight_type}) AS weight",
    )
    # Null gap or gap > max -> default; update -> gap; else min(gap, default).
    # F11 (branches in order), F12 (``least``; no null reaches it), F13 (null test)
    d = d.selectExpr(
        *keep, "is_update", "gap_seconds", "weight",
        f"""CAST(CASE WHEN gap_seconds IS NULL OR gap_seconds > {p.max_gap_seconds} THEN _default_s
                 WHEN is_update THEN gap_seconds ELSE least(gap_seconds, _default_s) END AS BIGINT) AS duration_seconds""",
    )
    return d.selectExpr(
        *keep,
        "is_update",
        "gap_seconds",
        "gap_seconds / 3600.0D AS gap_to_next_hours",
        "duration_seconds",
        "duration_seconds / 3600.0D AS duration_hours",
        "weight",
        f"CAST(duration_seconds * weight AS {total}) AS score_seconds",
        "CAST(duration_seconds * weight AS DOUBLE) / 3600.0D AS score",
    )


def lead_gaps(df: DataFrame, params: DurationParams | None = None, id_col: str | None = None) -> DataFrame:
    """W1 alone: the gap to the next message, whole seconds and hours."""
    p = params or DurationParams()
    d = with_next_time(df, p, id_col)
    gap = seconds_between(F.col("timeRaised"), F.col("_next_time"))
    return d.withColumn("gap_seconds", gap).withColumn(
        "gap_to_next_hours", F.col("gap_seconds") / F.lit(3600.0)
    ).drop("_next_time")
