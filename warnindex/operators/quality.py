"""Data-quality checks and the report.

Plan shape for ``validate`` (V11):
the messages are computed once and staged as a narrow table (the duplicate key
and a flag per row-level check); narrow scans of it give
* per report (or per year): the totals of V2-V4, V7-V9, straight from the rows;
* per area: lifecycle (any level 4, A10/V6) and row count, so the records of
  areas without a closing message are summed from per-area counts (no semi
  join over the messages, J2);
* the duplicate keys (A9/V5), by hashes first (``repeated_keys``).
These meet in one row per report, turned into issue rows by one ``explode`` of
an array of conditional structs.  Every aggregate is map-side combined; nothing
but the handful of issue rows reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warnindex.functions.timeparse import whole_days_between
from warnindex.params import (
    COMPLETENESS_WARN_PCT,
    COVERAGE_EXAMPLES,
    ISSUE_EXAMPLES,
    MAX_WARNING_DURATION_DAYS,
    OPTIONAL_COLUMNS,
    REQUIRED_COLUMNS,
    VALID_LEVELS,
)
from warnindex.schema import missing_columns

ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("check_order", T.IntegerType()),
        T.StructField("severity", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("subtracts_valid", T.BooleanType()),
    ]
)
DUP_KEYS = ("fwdCode", "severityLevel", "timeRaised")
# Fixed texts of the issues (category and message).
CAT_REQUIRED = "Missing Required Fields"
CAT_NULL_RAISED = "Missing timeRaised"
MSG_NULL_RAISED = "Records have missing or invalid timeRaised timestamps"
CAT_NULL_CHANGED = "Missing timeSeverityChanged"
MSG_NULL_CHANGED = "Records have missing timeSeverityChanged timestamps"
CAT_INVALID_LEVEL = "Invalid Severity Levels"
MSG_INVALID_LEVEL = "Severity levels outside range {1, 2, 3, 4}"
CAT_DUPLICATES = "Duplicate Records"
MSG_DUPLICATES = "Duplicate records found with identical key fields"
CAT_INCOMPLETE = "Incomplete Warning Lifecycles"
MSG_INCOMPLETE = ("Warning areas have no severity level 4 records "
                  "(may indicate ongoing warnings or data truncation)")
CAT_LONG = "Unusually Long Warnings"
CAT_INCONSISTENT = "Timestamp Inconsistency"
MSG_INCONSISTENT = "Records have timeSeverityChanged before timeRaised"
CAT_COMPLETENESS = "Field Completeness: {}"
CAT_MISSING_AREAS = "Missing Warning Areas"
CAT_UNEXPECTED_AREAS = "Unexpected Warning Areas"
MSG_REQUIRED = "Required fields are missing: "
MSG_LONG = "Warnings exceed maximum expected duration ({days} days). Longest: {longest} days"
MSG_COMPLETENESS = "Field is {}% complete"
MSG_MISSING_AREAS = "{} expected areas have no data"
MSG_UNEXPECTED_AREAS = "{} areas not in expected set"


def _has(df: DataFrame, *cols) -> bool:
    return all(c in df.columns for c in cols)


def _both_times(df: DataFrame) -> Column:
    return F.col("timeRaised").isNotNull() & F.col("timeSeverityChanged").isNotNull()


def span_days(df: DataFrame) -> Column:
    """whole days from raise to severity change."""
    return whole_days_between(F.col("timeRaised"), F.col("timeSeverityChanged"))


def invalid_level(c: str = "severityLevel") -> Column:
    """V4: level outside 1-4; a null level is not flagged (NOT IN on null is
    null).  F14: ``isin`` and its negation both leave null as null."""
    return ~F.col(c).isin(*VALID_LEVELS)


# ---- single checks (each one small job; ``validate`` fuses them) ------------

def invalid_levels(df: DataFrame) -> DataFrame:
    """V4 alone."""
    return df.agg(F.count_if(invalid_level()).alias("invalid_records"))


# Bits of the filter per repeated hash, and at most in all (32 MiB).
FILTER_BITS_PER_HASH = 16
MAX_FILTER_BITS = 1 << 28
BITMAP_BITS = 32_768  # of one row of bitmap_construct_agg


def repeated_keys(df: DataFrame, keys=DUP_KEYS, max_broadcast: int = 1_000_000, staged: bool = False) -> DataFrame:
    """``keys`` and ``n`` of the key groups seen more than once, exactly.

    Counted in two phases, as most keys occur once: 64-bit hashes of the keys first (8 bytes a row are
    shuffled, with a count), then only rows whose hash repeats meet in the exact aggregate, which tells
    equal keys from equal hashes.  Null keys are equal to each other.  The keys are staged once (``staged``: ``df``
    is a stored table already), so ``df`` is not computed for each phase.  The repeated hashes are a table in the
    shared folder: broadcast when there are few, else as a bitmap of bounded size, which lets some rows more pass
    into the exact aggregate but no key in part; the rows of other keys are not shuffled either way."""
    from warnindex.sources.files import stage_table

    slim = df.select(*keys)
    slim = (slim if staged else stage_table(slim, "keys")).withColumn("_hash", F.xxhash64(*keys))
    twice = slim.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_hash")
    twice = stage_table(twice, "repeated-hashes")
    n = twice.count()  # from the files' footers
    rows = slim.join(F.broadcast(twice), "_hash", "left_semi") if n <= max_broadcast else _in_bitmap(slim, twice, n)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _in_bitmap(rows: DataFrame, hashes: DataFrame, n: int) -> DataFrame:
    """The rows whose ``_hash`` falls on a bit set by one of the ``n`` hashes: all rows of these hashes, and few others."""
    blocks = -(-min(n * FILTER_BITS_PER_HASH, MAX_FILTER_BITS) // BITMAP_BITS)
    bit = F.expr(f"pmod(_hash, {blocks * BITMAP_BITS}L)")
    block, at = F.floor(bit / BITMAP_BITS), (bit % BITMAP_BITS).cast("int")
    bitmaps = hashes.groupBy(block.alias("_block")).agg(F.bitmap_construct_agg(at.cast("bigint")).alias("_bits"))
    byte = F.conv(F.hex(F.expr("substring(_bits, _at div 8 + 1, 1)")), 16, 10).cast("int")
    near = rows.withColumns({"_block": block, "_at": at}).join(F.broadcast(bitmaps), "_block")
    return near.where(F.bit_get(byte, F.col("_at") % 8) == 1).drop("_block", "_at", "_bits")


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Key groups seen more than once, and the excess rows."""
    return repeated_keys(df).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).cast("bigint").alias("excess_records"),
    )


def area_lifecycle(df: DataFrame) -> DataFrame:
    """A10: per area min/max level, whether a level 4 exists, and row count."""
    lvl = F.col("severityLevel")
    return df.groupBy("fwdCode").agg(
        F.min(lvl).alias("min_severity"),
        F.max(lvl).alias("max_severity"),
        F.coalesce(F.bool_or(lvl == F.lit(4)), F.lit(False)).alias("has_level_4"),
        F.count(F.lit(1)).alias("n_records"),
    )


def incomplete_areas(df: DataFrame) -> DataFrame:
    """A10 + J2: areas with no level-4 message and how many records they hold."""
    return area_lifecycle(df).where(~F.col("has_level_4"))


def long_spans(df: DataFrame, max_days: int = MAX_WARNING_DURATION_DAYS) -> DataFrame:
    """V7 + A12: rows whose change came more than ``max_days`` whole days after
    the raise, and the longest such span."""
    days = span_days(df)
    cond = _both_times(df) & (days > F.lit(max_days))
    return df.agg(
        F.count_if(cond).alias("long_records"),
        F.max(F.when(cond, days)).alias("longest_days"),
    )


def time_inconsistency(df: DataFrame) -> DataFrame:
    """V8: severity changed before the message was raised."""
    cond = _both_times(df) & (F.col("timeSeverityChanged") < F.col("timeRaised"))
    return df.agg(F.count_if(cond).alias("inconsistent_records"))


def completeness(df: DataFrame) -> DataFrame:
    """Non-null share of each optional column present (one pass)."""
    cols = [c for c in OPTIONAL_COLUMNS if c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(F.col(c)).alias(f"nn{i}") for i, c in enumerate(cols)])
    if not cols:
        return wide.selectExpr("CAST(NULL AS STRING) AS column", "total").where("false")
    args = ", ".join(f"'{c}', nn{i}" for i, c in enumerate(cols))
    longf = wide.selectExpr("total", f"stack({len(cols)}, {args}) AS (column, non_null)")
    pct = F.try_divide(F.col("non_null").cast("double"), F.col("total").cast("double")) * F.lit(100.0)
    return longf.select(
        "column",
        F.col("non_null").cast("bigint").alias("non_null"),
        (F.col("total") - F.col("non_null")).cast("bigint").alias("missing"),
        pct.alias("completeness_pct"),
        F.when(pct < F.lit(COMPLETENESS_WARN_PCT), "warning").otherwise("info").alias("severity"),
    )


# ---- the fused report -------------------------------------------------------

def validate(df: DataFrame, max_days: int = MAX_WARNING_DURATION_DAYS, by_year: bool = False,
             examples: bool = False) -> DataFrame:
    """All checks in order -> issue rows (check_order, severity,
    category, message, count, subtracts_valid).  ``by_year``: the same checks
    for every calendar year of ``timeRaised`` in one job (leading ``year``
    column), instead of one job per year.  ``examples`` adds up to three
    examples (JSON) to the issues that have some (O5)."""
    checked = _checked_rows(df, max_days) if _has(df, *DUP_KEYS) else None
    out = _issues(df, max_days, by_year, checked).where(F.col("check_order").isNotNull()).drop("total_records")
    if examples:
        # both sides hold a handful of rows (one per issue / category and year)
        ex = issue_examples(df, ISSUE_EXAMPLES, max_days, by_year, checked).withColumnsRenamed({"category": "_cat", "year": "_year"})
        on = F.col("category") == F.col("_cat")
        if by_year:
            on = on & F.col("year").eqNullSafe(F.col("_year"))
        out = out.join(ex, on, "left").drop("_cat", "_year")
    return out


def report_documents(df: DataFrame, max_days: int = MAX_WARNING_DURATION_DAYS, by_year: bool = False) -> DataFrame:
    """One row per report (or year): the header of A18 and ``issues``, the issue rows in order."""
    keys = ["year"] if by_year else []
    i = _issues(df, max_days, by_year)
    one = F.struct(*[F.col(f.name) for f in ISSUE_SCHEMA.fields])
    lists = i.groupBy(*keys).agg(*_report_aggs(), F.array_sort(F.collect_list(F.when(F.col("check_order").isNotNull(), one))).alias("issues"))
    return lists


def _s(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _issue_sql(order: int, severity: str, category: str, message: str, count: str, subtracts: bool) -> str:
    """An issue row as SQL (severity/message may be SQL expressions)."""
    return (f"named_struct('check_order', {order}, 'severity', {severity}, 'category', {_s(category)}, "
            f"'message', {message}, 'count', CAST({count} AS BIGINT), 'subtracts_valid', {str(subtracts).lower()})")


def _fmt1_sql(x: str) -> str:
    return f"format_string('%.1f', bround(CAST({x} AS DOUBLE), 1))"


def _row_checks(df: DataFrame, max_days: int) -> tuple[dict[str, str], dict[str, str]]:
    """The row-level checks that the columns of ``df`` allow, as SQL: conditions to count and values to take the maximum of."""
    both = "timeRaised IS NOT NULL AND timeSeverityChanged IS NOT NULL"
    days = "timestampdiff(DAY, timeRaised, timeSeverityChanged)"
    counters: dict[str, str] = {}  # per-row conditions, summed
    maxima: dict[str, str] = {}
    if _has(df, "timeRaised"):
        counters["v2"] = "timeRaised IS NULL"
    if _has(df, "timeSeverityChanged"):
        counters["v3"] = "timeSeverityChanged IS NULL"
    if _has(df, "severityLevel"):
        counters["v4"] = "NOT (severityLevel IN (" + ", ".join(str(v) for v in VALID_LEVELS) + "))"
    if _has(df, "timeRaised", "timeSeverityChanged"):
        long_cond = f"{both} AND {days} > {int(max_days)}"
        counters["v7"] = long_cond
        maxima["v7max"] = f"CASE WHEN {long_cond} THEN {days} END"
        counters["v8"] = f"{both} AND timeSeverityChanged < timeRaised"
    for i, c in enumerate(OPTIONAL_COLUMNS):
        if c in df.columns:
            counters[f"nn{i}"] = f"`{c}` IS NOT NULL"
    return counters, maxima


def _checked_rows(df: DataFrame, max_days: int) -> DataFrame:
    """A row per message with what the report needs of it: the duplicate key, a flag per row-level check, the
    long span.  Staged, as several aggregates read it and ``df`` may be a join of large tables."""
    from warnindex.sources.files import stage_table

    counters, maxima = _row_checks(df, max_days)
    return stage_table(df.selectExpr(*DUP_KEYS, *[f"{e} AS {k}" for k, e in {**counters, **maxima}.items()]), "quality-rows")


def _issues(df: DataFrame, max_days: int, by_year: bool = False, checked: DataFrame | None = None) -> DataFrame:
    """Issue rows, each carrying ``total_records``; there is always at least
    one row per group (a null issue when none fired).

    ``df`` is computed once, into ``_checked_rows`` (or ``checked``, if these are there already); totals per
    report, areas and duplicate groups (``repeated_keys``, which shuffles a hash a row and only
    repeated keys whole) are aggregates over that table.
    The aggregate lists are Spark SQL expressions (same plan, far fewer
    driver round trips than composing Column objects).
    """
    miss = missing_columns(df, REQUIRED_COLUMNS)
    grp = ["year"] if by_year else []
    counters, maxima = _row_checks(df, max_days)
    opt = [(i, c) for i, c in enumerate(OPTIONAL_COLUMNS) if c in df.columns]

    def agg(frame: DataFrame, keys, exprs) -> DataFrame:
        return frame.groupBy(*keys).agg(*[F.expr(e) for e in exprs])

    def with_year(frame: DataFrame) -> DataFrame:
        return frame.withColumn("year", F.year("timeRaised")) if by_year else frame

    def totals(frame: DataFrame, counted: dict[str, str], largest: dict[str, str]) -> DataFrame:
        return agg(frame, grp, ["count(1) AS total"]
                   + [f"sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS {k}" for k, c in counted.items()]
                   + [f"max({e}) AS {k}" for k, e in largest.items()])

    has_keys = _has(df, *DUP_KEYS)
    if has_keys:
        rows = with_year(_checked_rows(df, max_days) if checked is None else checked)
        w = totals(rows, {k: k for k in counters}, {k: k for k in maxima})
        a = agg(rows, [*grp, "fwdCode"], ["count(1) AS n", "coalesce(bool_or(severityLevel = 4), false) AS has4"])
        areas = agg(a, grp, ["count_if(NOT has4) AS inc_areas", "sum(CASE WHEN NOT has4 THEN n END) AS inc_records"])
        # the year follows from the key
        dups = agg(with_year(repeated_keys(rows, staged=True)), grp, ["count(1) AS groups", "sum(n - 1) AS excess"])
        # one row per report from each side; sums and maxima skip the columns a side lacks
        w = w.unionByName(areas, allowMissingColumns=True).unionByName(dups, allowMissingColumns=True)
        w = agg(w, grp, [f"{'max' if c in maxima else 'sum'}({c}) AS {c}" for c in w.columns if c not in grp])
    else:
        w = totals(with_year(df), counters, maxima)
    zero = [c for c in w.columns if c not in grp and c not in maxima]
    w = w.selectExpr(*grp, *[f"coalesce({c}, 0) AS {c}" for c in zero], *maxima)

    rows: list[tuple[str, str]] = []  # (issue struct, emit condition)
    if miss:
        rows.append((_issue_sql(1, "'error'", CAT_REQUIRED, _s(MSG_REQUIRED + ", ".join(sorted(miss))), "total", False),
                     "true"))
    if "v2" in counters:
        rows.append((_issue_sql(2, "'error'", CAT_NULL_RAISED, _s(MSG_NULL_RAISED), "v2", True), "v2 > 0"))
    if "v3" in counters:
        rows.append((_issue_sql(3, "'warning'", CAT_NULL_CHANGED, _s(MSG_NULL_CHANGED), "v3", False), "v3 > 0"))
    if "v4" in counters:
        rows.append((_issue_sql(4, "'error'", CAT_INVALID_LEVEL, _s(MSG_INVALID_LEVEL), "v4", True), "v4 > 0"))
    if has_keys:
        rows.append((_issue_sql(5, "'warning'", CAT_DUPLICATES, _s(MSG_DUPLICATES), "excess", False), "groups > 0"))
        rows.append((_issue_sql(6, "'info'", CAT_INCOMPLETE, _s(MSG_INCOMPLETE), "inc_records", False),
                     "inc_areas > 0"))
    if "v7" in counters:
        head, tail = MSG_LONG.format(days=max_days, longest="{}").split("{}")
        msg7 = f"concat({_s(head)}, {_fmt1_sql('v7max')}, {_s(tail)})"
        rows.append((_issue_sql(7, "'warning'", CAT_LONG, msg7, "v7", False), "v7 > 0"))
        rows.append((_issue_sql(8, "'error'", CAT_INCONSISTENT, _s(MSG_INCONSISTENT), "v8", True), "v8 > 0"))
    head, tail = MSG_COMPLETENESS.split("{}")
    for i, c in opt:
        pct = f"(try_divide(CAST(nn{i} AS DOUBLE), CAST(total AS DOUBLE)) * 100.0D)"
        sev = f"CASE WHEN {pct} < {float(COMPLETENESS_WARN_PCT)}D THEN 'warning' ELSE 'info' END"
        msg = f"concat({_s(head)}, {_fmt1_sql(pct)}, {_s(tail)})"
        # emitted for every optional column present, when there are rows
        rows.append((_issue_sql(9 + i, sev, CAT_COMPLETENESS.format(c), msg, f"total - nn{i}", False), "total > 0"))

    arr = "filter(array(" + ", ".join(f"CASE WHEN {cond} THEN {st} END" for st, cond in rows) + "), x -> x IS NOT NULL)"
    return w.selectExpr(*grp, "CAST(total AS BIGINT) AS total_records", f"explode_outer({arr}) AS i").selectExpr(
        *grp, "i.*", "total_records"
    ).select(*grp, *[f.name for f in ISSUE_SCHEMA.fields], "total_records")


def report(df: DataFrame, max_days: int = MAX_WARNING_DURATION_DAYS, by_year: bool = False) -> DataFrame:
    """One row: total, valid (minus the error counts of V2, V4, V8 -- a
    row failing two checks is subtracted twice, N15), passed (no error), and
    the numbers of errors / warnings / infos."""
    return _issues(df, max_days, by_year).groupBy(*(["year"] if by_year else [])).agg(*_report_aggs())


def _report_aggs() -> list[Column]:
    sev = F.col("severity")
    total = F.max("total_records")
    return [
        total.alias("total_records"),
        (total - F.coalesce(F.sum(F.when(F.col("subtracts_valid"), F.col("count"))), F.lit(0))).alias("valid_records"),
        (F.count_if(sev == "error") == 0).alias("passed"),
        F.count_if(sev == "error").alias("error_count"),
        F.count_if(sev == "warning").alias("warning_count"),
        F.count_if(sev == "info").alias("info_count"),
    ]


# ---- examples (O5) -----------------------------------------------------------

def issue_examples(df: DataFrame, k: int = ISSUE_EXAMPLES, max_days: int = MAX_WARNING_DURATION_DAYS,
                   by_year: bool = False, checked: DataFrame | None = None) -> DataFrame:
    """Up to ``k`` examples (as JSON) per check, whole or per year: offending rows for the
    row-level checks, key groups with their counts for the duplicates, areas with their level range
    for the incomplete ones; smallest (area, time) first.  ``row_number() <= k`` lets Spark cut each
    partition to k rows per check before the shuffle, so no check's rows gather whole; only
    the kept rows are turned into JSON.  Key groups and areas are found in the staged keys (``checked``, if these
    rows are staged already)."""
    from warnindex.sources.files import stage_table

    if by_year:
        df = df.withColumn("year", F.year("timeRaised"))
    grp = ["year"] if by_year else []
    own = [c for c in df.columns if c not in grp]
    checks = []
    if _has(df, "timeRaised"):
        checks.append((CAT_NULL_RAISED, F.col("timeRaised").isNull()))
    if _has(df, "severityLevel"):
        checks.append((CAT_INVALID_LEVEL, invalid_level()))
    if _has(df, "timeRaised", "timeSeverityChanged"):
        checks.append((CAT_INCONSISTENT, _both_times(df) & (F.col("timeSeverityChanged") < F.col("timeRaised"))))
    order = [c for c in ("fwdCode", "timeRaised", "severityLevel", "msg_id") if c in df.columns]
    cats = F.filter(F.array(*[F.when(cond, F.lit(cat)) for cat, cond in checks]), lambda x: x.isNotNull())
    atomic = all(isinstance(f.dataType, T.AtomicType) for f in df.schema.fields)
    row = F.struct(*[F.col(f"`{c}`") for c in own])
    # the row itself decides ties, column by column (a total order SQL can state too), or a hash
    # of it when some column is not orderable; equal rows give equal JSON, whichever is kept
    picked = [_first_rows(df.select(F.explode(cats).alias("category"), *grp, *order, row.alias("_row")), grp, k,
                          [*order, "_row" if atomic else F.xxhash64("_row")])]
    if _has(df, *DUP_KEYS):
        staged = (stage_table(df.select(*DUP_KEYS), "keys") if checked is None else checked).select(*DUP_KEYS)
        year = {"year": F.year("timeRaised")} if by_year else {}
        g = repeated_keys(staged, staged=True).withColumnRenamed("n", "count").withColumns(year)
        dup = g.select(
            F.lit(CAT_DUPLICATES).alias("category"), *grp, *DUP_KEYS, F.struct(*DUP_KEYS, "count").alias("_row"))
        picked.append(_first_rows(dup, grp, k, ["fwdCode", "timeRaised", "severityLevel"]))
        a = staged.withColumns(year).groupBy(*grp, "fwdCode").agg(F.min("severityLevel").alias("min_severity"), F.max("severityLevel").alias("max_severity"),
                                           F.coalesce(F.bool_or(F.col("severityLevel") == 4), F.lit(False)).alias("has_level_4"))
        area = a.where(~F.col("has_level_4")).select(
            F.lit(CAT_INCOMPLETE).alias("category"), *grp, "fwdCode", F.struct("fwdCode", "min_severity", "max_severity", "has_level_4").alias("_row"))
        picked.append(_first_rows(area, grp, k, ["fwdCode"]))
    top = picked[0]
    for p in picked[1:]:
        top = top.unionByName(p)
    return top.groupBy(*grp, "category").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rn", "example"))), lambda s: s["example"]).alias("examples")
    )


def _first_rows(rows: DataFrame, grp: list[str], k: int, order: list) -> DataFrame:
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*grp, "category").orderBy(*[c.asc_nulls_first() for c in cols])
    top = rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    return top.select(*grp, "category", "rn", F.to_json("_row").alias("example"))


# ---- area coverage (J3, U3) --------------------------------------------------

def area_coverage(df: DataFrame, expected_areas: DataFrame, k: int = COVERAGE_EXAMPLES) -> DataFrame:
    """Expected areas with no data, and records of areas outside the
    expected set.  Messages are reduced to one row per area first (partial
    aggregation), then full-outer-joined with the expected codes."""
    actual = df.groupBy("fwdCode").agg(F.count(F.lit(1)).alias("n"))
    expected = expected_areas.select("fwdCode").distinct().withColumn("_exp", F.lit(True))
    j = actual.join(expected, "fwdCode", "full_outer")
    missing = F.col("n").isNull()
    unexpected = F.col("_exp").isNull()
    code = F.col("fwdCode")
    agg = j.agg(
        F.count_if(missing).alias("missing_areas"),
        F.count_if(unexpected).alias("unexpected_areas"),
        F.coalesce(F.sum(F.when(unexpected, F.col("n"))), F.lit(0)).alias("unexpected_records"),
    )
    rows = agg.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("warning").alias("severity"),
                    F.lit(CAT_MISSING_AREAS).alias("category"),
                    F.concat(F.col("missing_areas").cast("string"), F.lit(MSG_MISSING_AREAS.split("{}")[1])).alias("message"),
                    F.col("missing_areas").cast("bigint").alias("count"),
                ),
                F.struct(
                    F.lit("warning").alias("severity"),
                    F.lit(CAT_UNEXPECTED_AREAS).alias("category"),
                    F.concat(F.col("unexpected_areas").cast("string"), F.lit(MSG_UNEXPECTED_AREAS.split("{}")[1])).alias("message"),
                    F.col("unexpected_records").cast("bigint").alias("count"),
                ),
            )
        ).alias("i"),
        "missing_areas",
        "unexpected_areas",
    )
    rows = rows.where(
        ((F.col("i.category") == CAT_MISSING_AREAS) & (F.col("missing_areas") > 0))
        | ((F.col("i.category") == CAT_UNEXPECTED_AREAS) & (F.col("unexpected_areas") > 0))
    ).select("i.*")
    return rows


def coverage_examples(df: DataFrame, expected_areas: DataFrame, k: int = COVERAGE_EXAMPLES) -> DataFrame:
    """Up to ``k`` codes (smallest first) of missing and of unexpected areas."""
    actual = df.select("fwdCode").distinct().withColumn("_act", F.lit(True))
    expected = expected_areas.select("fwdCode").distinct().withColumn("_exp", F.lit(True))
    cat = F.when(F.col("_act").isNull(), CAT_MISSING_AREAS).when(F.col("_exp").isNull(), CAT_UNEXPECTED_AREAS)
    j = actual.join(expected, "fwdCode", "full_outer").select(cat.alias("category"), "fwdCode")
    j = j.where(F.col("category").isNotNull())
    w = Window.partitionBy("category").orderBy(F.col("fwdCode").asc_nulls_first())
    return (
        j.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= k)
        .groupBy("category")
        .agg(F.array_sort(F.collect_list("fwdCode")).alias("examples"))
    )
