"""DuckDB SQL twins of the registered queries (the correctness oracle).

Every query in ``queries.py`` has here the same computation written as plain
SQL over the driver's tables.  Conventions that keep results bit-equal:
seconds are summed as integers and cast to BIGINT before one division by
``3600.0::DOUBLE``; windows state ``NULLS FIRST`` (Spark's ascending order);
the year is cast to INTEGER like Spark's ``year()``.
"""

from __future__ import annotations

from warnindex.operators import quality as Q
from warnindex.params import (
    SEVERITY_LEVELS,
    COASTAL_KEYWORDS,
    FLUVIAL_WEIGHT,
    COASTAL_WEIGHT,
    COVERAGE_EXAMPLES,
    ISSUE_EXAMPLES,
    MAX_WARNING_DURATION_DAYS,
    DurationParams,
)
from warnindex.sources.adapters import ORDERS_BASELINE_YEAR, TEST_COUNTIES

H = "3600.0::DOUBLE"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _contains_any(col: str, words) -> str:
    return "(" + " OR ".join(f"contains(coalesce({col}, ''), {_q(w)})" for w in words) + ")"


def level(c: str = "severity") -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {v}" for k, v in SEVERITY_LEVELS.items())
    norm = f"lower(regexp_replace(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '^update\\s+', '', 'i'))"
    return f"CAST(CASE {norm} {whens} END AS INTEGER)"


def is_update(c: str = "severity") -> str:
    return f"regexp_matches({c}, '^update\\s', 'i')"


# ---- adapters ----------------------------------------------------------------

EVENTS_MSGS = f"""SELECT CAST(user_id AS VARCHAR) AS fwdCode, ts AS timeRaised,
    CASE event_type WHEN 'error' THEN 'Severe Flood Warning' WHEN 'purchase' THEN ' Flood Warning '
      WHEN 'click' THEN 'Update Flood Alert' WHEN 'view' THEN 'Flood watch'
      WHEN 'signup' THEN 'Warning No Longer in Force' END AS severity,
    (user_id % 2 = 1) AS isTidal, event_id AS msg_id
  FROM events"""

EVENTS = f"""SELECT *, {level()} AS severityLevel FROM ({EVENTS_MSGS})"""

ORDERS_RAW = f"""SELECT *, {level()} AS severityLevel FROM (
  SELECT CAST(c.c_nationkey AS VARCHAR) AS fwdCode, o.o_orderdate AS timeRaised,
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Severe Flood Warning'
      WHEN o.o_orderpriority = '2-HIGH' THEN 'Flood Warning'
      WHEN o.o_orderpriority = '3-MEDIUM' THEN 'Flood Alert'
      WHEN o.o_orderpriority = '4-NOT SPECIFIED' AND o.o_orderstatus = 'F' THEN 'Warning No Longer in Force'
      WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'Flood Bulletin'
      WHEN o.o_orderpriority = '5-LOW' THEN 'Update Flood Alert' END AS severity,
    o.o_orderkey AS msg_id
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

NATION_AREAS = """SELECT CAST(n.n_nationkey AS VARCHAR) AS fwdCode, n.n_name AS label, n.n_name AS description,
    r.r_name AS county, r.r_name AS riverOrSea,
    CASE WHEN n.n_regionkey = 4 THEN NULL ELSE n.n_regionkey % 2 = 1 END AS isTidal
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""

REGION_AREAS = f"SELECT * FROM ({NATION_AREAS}) WHERE {_contains_any('county', TEST_COUNTIES)}"

ORDERS_REGION = f"""SELECT m.fwdCode, m.timeRaised, m.severity, m.msg_id, m.severityLevel, a.isTidal
  FROM ({ORDERS_RAW}) m JOIN (SELECT DISTINCT fwdCode, isTidal FROM ({REGION_AREAS})) a ON m.fwdCode = a.fwdCode"""

SUPPLIER_ITEMS = """SELECT CAST(s.s_suppkey AS VARCHAR) AS notation, s.s_name AS label, n.n_name AS description,
    CASE WHEN s.s_suppkey % 4 = 0 THEN r.r_name || ', City of ' || n.n_name ELSE r.r_name END AS county,
    CASE s.s_suppkey % 8 WHEN 0 THEN 'River Avon' WHEN 1 THEN 'Severn Estuary' WHEN 2 THEN 'Bristol Channel'
      WHEN 3 THEN 'Seaton Brook' WHEN 4 THEN 'Tidal Frome' WHEN 5 THEN 'Ellerholt Brook'
      WHEN 6 THEN 'North COAST' END AS riverOrSea
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""

SUPPLIER_AREAS = f"""SELECT notation AS fwdCode, label, coalesce(description, '') AS description, county,
    coalesce(riverOrSea, '') AS riverOrSea, {_contains_any("lower(coalesce(riverOrSea, ''))", COASTAL_KEYWORDS)} AS isTidal
  FROM ({SUPPLIER_ITEMS})"""

QUALITY_MSGS = """SELECT CAST(l.l_suppkey AS VARCHAR) AS fwdCode,
    CASE WHEN l.l_orderkey % 23 = 0 THEN NULL ELSE o.o_orderdate END AS timeRaised,
    'line ' || l.l_returnflag || l.l_linestatus AS severity, CAST(CASE WHEN l.l_linenumber = 7 THEN (CASE WHEN l.l_suppkey % 5 = 0 THEN 3 ELSE 4 END)
      WHEN l.l_linenumber = 6 THEN 9 WHEN l.l_linenumber = 5 AND l.l_returnflag = 'N' THEN NULL
      ELSE (l.l_linenumber - 1) % 3 + 1 END AS INTEGER) AS severityLevel,
    CASE WHEN l.l_orderkey % 29 = 0 THEN NULL ELSE l.l_shipdate END AS timeSeverityChanged,
    CASE WHEN l.l_linestatus = 'F' THEN l.l_shipdate END AS timeMessageChanged,
    CASE WHEN l.l_suppkey % 3 = 0 THEN NULL ELSE l.l_suppkey % 2 = 1 END AS isTidal,
    l.l_orderkey AS msg_id, l.l_linenumber AS line_no
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

LINEITEM_MSGS = f"""SELECT *, {level()} AS severityLevel FROM (
  SELECT CAST(l_suppkey AS VARCHAR) AS fwdCode, l_shipdate AS timeRaised,
    CASE WHEN l_returnflag = 'R' THEN 'Flood Warning' WHEN l_returnflag = 'A' THEN 'flood alert'
      WHEN l_linestatus = 'F' THEN 'Warning No Longer in Force' ELSE 'Flood Outlook' END AS severity
  FROM lineitem)"""


# ---- durations ---------------------------------------------------------------

def _order(ties=("severityLevel", "severity", "msg_id")) -> str:
    return "timeRaised ASC NULLS FIRST, " + ", ".join(f"{c} ASC NULLS FIRST" for c in ties)


def gaps(src: str, scope: str) -> str:
    part = "fwdCode" if scope == "all" else "year(timeRaised), fwdCode"
    return f"""SELECT *, (epoch_us(_next) - epoch_us(timeRaised)) // 1000000 AS gap_seconds FROM (
  SELECT *, lead(timeRaised) OVER (PARTITION BY {part} ORDER BY {_order()}) AS _next FROM ({src}))"""


def scored(src: str, scope: str, p: DurationParams | None = None) -> str:
    p = p or DurationParams()
    ds = p.default_seconds
    dcase = "CASE severityLevel " + " ".join(f"WHEN {k} THEN {v}" for k, v in ds.items()) + f" ELSE {p.fallback_seconds} END"
    wcase = "CASE severityLevel " + " ".join(f"WHEN {k} THEN {v}" for k, v in p.int_weights.items()) + f" ELSE {int(p.fallback_weight)} END"
    return f"""SELECT *, CAST(duration_seconds * weight AS BIGINT) AS score_seconds FROM (
  SELECT *, CAST(CASE WHEN gap_seconds IS NULL OR gap_seconds > {p.max_gap_seconds} THEN {dcase}
      WHEN is_update THEN gap_seconds ELSE least(gap_seconds, {dcase}) END AS BIGINT) AS duration_seconds,
    CAST({wcase} AS BIGINT) AS weight
  FROM (SELECT *, {is_update()} AS is_update FROM ({gaps(src, scope)})))"""


def _hours(expr: str) -> str:
    return f"CAST(coalesce({expr}, 0) AS BIGINT) / {H}"


def annual_by_class(sc: str, level_counts: bool = True) -> str:
    parts = []
    for comp, cond in (("fluvial", "isTidal = false"), ("coastal", "isTidal = true"), ("other", "isTidal IS NULL")):
        parts += [
            f"{_hours(f'sum(CASE WHEN {cond} THEN score_seconds END)')} AS {comp}_score",
            f"count(*) FILTER (WHERE {cond}) AS {comp}_events",
            f"{_hours(f'sum(CASE WHEN {cond} THEN duration_seconds END)')} AS {comp}_hours",
        ]
    parts += [f"{_hours('sum(score_seconds)')} AS total_score", "count(*) AS total_events",
               f"{_hours('sum(duration_seconds)')} AS total_hours"]
    if level_counts:
        parts += ["count(*) FILTER (WHERE severityLevel = 1) AS severe_warnings",
                  "count(*) FILTER (WHERE severityLevel = 2) AS flood_warnings",
                  "count(*) FILTER (WHERE severityLevel = 3) AS flood_alerts"]
    return f"""SELECT CAST(year(timeRaised) AS INTEGER) AS year, {', '.join(parts)}
  FROM ({sc}) WHERE timeRaised IS NOT NULL GROUP BY 1"""


def indicators(annual: str, baseline_year: int | None) -> str:
    bsel = (f"SELECT * FROM ({annual}) WHERE year = {baseline_year}" if baseline_year is not None
            else f"SELECT * FROM ({annual}) ORDER BY year LIMIT 1")
    fi = f"CASE WHEN b.fluvial_score > 0.0 THEN a.fluvial_score / b.fluvial_score * 100.0::DOUBLE ELSE 0.0::DOUBLE END"
    ci = f"CASE WHEN b.coastal_score > 0.0 THEN a.coastal_score / b.coastal_score * 100.0::DOUBLE ELSE 0.0::DOUBLE END"
    return f"""SELECT *, fluvial_index * {FLUVIAL_WEIGHT}::DOUBLE + coastal_index * {COASTAL_WEIGHT}::DOUBLE AS composite_index FROM (
  SELECT a.year, a.fluvial_score AS fluvial_score_raw, a.coastal_score AS coastal_score_raw,
    a.total_score AS total_score_raw, {fi} AS fluvial_index, {ci} AS coastal_index,
    a.fluvial_hours, a.coastal_hours, a.fluvial_events, a.coastal_events, a.total_events,
    a.severe_warnings, a.flood_warnings, a.flood_alerts
  FROM ({annual}) a LEFT JOIN ({bsel}) b ON true)"""


ORDERS_SCORED = scored(ORDERS_REGION, "year")
ORDERS_ANNUAL = annual_by_class(ORDERS_SCORED)
ORDERS_IND = indicators(ORDERS_ANNUAL, ORDERS_BASELINE_YEAR)
ORDERS_SUMMARY = f"""SELECT year, total_events AS total_warnings, fluvial_events AS fluvial_warnings,
    coastal_events AS coastal_warnings, round_even(fluvial_index, 1) AS fluvial_index,
    round_even(coastal_index, 1) AS coastal_index, round_even(composite_index, 1) AS composite_index
  FROM ({ORDERS_IND})"""
EVENTS_SCORED = scored(EVENTS, "all")


def _breakdown(sc: str, comps) -> str:
    conds = {"fluvial": "isTidal = false", "coastal": "isTidal = true", "other": "isTidal IS NULL", "total": "true"}
    comp_dim = " UNION ALL ".join(f"SELECT {_q(c)} AS component" for c in comps)
    lvl_dim = "SELECT 1 AS lv UNION ALL SELECT 2 UNION ALL SELECT 3"
    sums = []
    for c in comps:
        sums.append(f"""SELECT {_q(c)} AS component, CAST(year(timeRaised) AS INTEGER) AS year, severityLevel AS lv,
      count(*) AS n, sum(duration_seconds) AS ds, sum(score_seconds) AS ss
    FROM ({sc}) WHERE timeRaised IS NOT NULL AND severityLevel IN (1, 2, 3) AND {conds[c]} GROUP BY 2, 3""")
    comp_sel = "d.component, " if comps != ("total",) else ""
    return f"""SELECT d.year, {comp_sel}CAST(d.lv AS INTEGER) AS severityLevel, CAST(coalesce(s.n, 0) AS BIGINT) AS event_count,
    {_hours('s.ds')} AS total_hours, {_hours('s.ss')} AS weighted_score
  FROM (SELECT y.year, c.component, l.lv FROM (SELECT DISTINCT CAST(year(timeRaised) AS INTEGER) AS year FROM ({sc})
        WHERE timeRaised IS NOT NULL) y, ({comp_dim}) c, ({lvl_dim}) l) d
  LEFT JOIN ({' UNION ALL '.join(sums)}) s ON d.year = s.year AND d.component = s.component AND d.lv = s.lv"""


def _pct(new: str, old: str) -> str:
    return f"CASE WHEN {old} <> 0.0 THEN ({new} / {old} - 1.0::DOUBLE) * 100.0::DOUBLE END"


def _arrow(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN '^' WHEN {x} < 0 THEN 'v' ELSE '-' END"


def _label(x: str, up: str, down: str) -> str:
    return f"CASE WHEN {x} > 100.0 THEN '{up}' WHEN {x} < 100.0 THEN '{down}' ELSE 'same' END"


S = ORDERS_SUMMARY


def core_oracles() -> dict[str, str]:
    ev_sc = EVENTS_SCORED
    endpoint_cols = []
    for c, name in (("composite_index", "composite"), ("fluvial_index", "fluvial"), ("coastal_index", "coastal")):
        a, b = f"first_{c}", f"last_{c}"
        endpoint_cols += [a, b, f"{b} - {a} AS {name}_change_pts", f"{_pct(b, a)} AS {name}_change_pct"]
    return {
        "severity_normalize": f"""SELECT msg_id, severity,
            lower(regexp_replace(regexp_replace(severity, '^\\s+|\\s+$', '', 'g'), '^update\\s+', '', 'i')) AS normalized,
            severityLevel FROM ({EVENTS})""",
        "unmapped_severity": f"""SELECT severity, count(*) AS n_rows FROM ({ORDERS_RAW})
            WHERE severityLevel IS NULL AND severity IS NOT NULL GROUP BY severity""",
        "is_update_flag": f"SELECT msg_id, severity, {is_update()} AS is_update FROM ({EVENTS})",
        "region_filter": f"""SELECT msg_id, fwdCode FROM ({ORDERS_RAW})
            WHERE fwdCode IN (SELECT fwdCode FROM ({REGION_AREAS}))""",
        "region_join_class": f"""SELECT m.msg_id, m.fwdCode, a.isTidal FROM ({ORDERS_RAW}) m
            LEFT JOIN (SELECT DISTINCT fwdCode, isTidal FROM ({NATION_AREAS})) a ON m.fwdCode = a.fwdCode""",
        "year_filter": f"SELECT msg_id, fwdCode, timeRaised FROM ({ORDERS_REGION}) WHERE year(timeRaised) = 1997",
        "lead_gap_all": f"SELECT msg_id, gap_seconds, gap_seconds / {H} AS gap_to_next_hours FROM ({gaps(EVENTS, 'all')})",
        "lead_gap_year": f"SELECT msg_id, gap_seconds, gap_seconds / {H} AS gap_to_next_hours FROM ({gaps(ORDERS_REGION, 'year')})",
        "duration_rule": f"""SELECT msg_id, is_update, gap_seconds, duration_seconds, duration_seconds / {H} AS duration_hours
            FROM ({ev_sc})""",
        "message_scores": f"""SELECT msg_id, severityLevel, weight, score_seconds, score_seconds / {H} AS score FROM ({ev_sc})""",
        "annual_total": f"""SELECT CAST(year(timeRaised) AS INTEGER) AS year, {_hours('sum(score_seconds)')} AS total_score,
            count(*) AS total_events, {_hours('sum(duration_seconds)')} AS total_hours
            FROM ({ORDERS_SCORED}) WHERE timeRaised IS NOT NULL GROUP BY 1""",
        "annual_by_class": annual_by_class(ev_sc, level_counts=False),
        "severity_breakdown": _breakdown(ORDERS_SCORED, ("total",)),
        "breakdown_grouping_sets": _breakdown(ORDERS_SCORED, ("fluvial", "coastal", "other", "total")),
        "self_baseline": f"""SELECT year, fluvial_score_raw AS fluvial_score, coastal_score_raw AS coastal_score,
            total_score_raw AS total_score, fluvial_hours, coastal_hours, fluvial_events, coastal_events
            FROM ({ORDERS_IND}) WHERE year = {ORDERS_BASELINE_YEAR}""",
        "annual_index": ORDERS_IND,
        "index_refreshed": ORDERS_IND,
        "baseline_change": f"""SELECT year, composite_index, {_label('composite_index', 'higher', 'lower')} AS composite_vs_baseline,
            abs(composite_index - 100.0::DOUBLE) AS composite_pct,
            {_label('fluvial_index', 'increase', 'decrease')} AS fluvial_change, abs(fluvial_index - 100.0::DOUBLE) AS fluvial_pct,
            {_label('coastal_index', 'increase', 'decrease')} AS coastal_change, abs(coastal_index - 100.0::DOUBLE) AS coastal_pct
            FROM ({ORDERS_IND})""",
        "yearly_summary": S,
        "index_listing": f"""SELECT year, composite_index, fluvial_index, coastal_index FROM ({ORDERS_IND})
            WHERE year IN (1996, 1998, 2000)""",
        "year_on_year": f"""SELECT prev_year, year, prev_composite_index, composite_index,
            composite_index - prev_composite_index AS change_pts,
            {_pct('composite_index', 'prev_composite_index')} AS change_pct,
            {_arrow('composite_index - prev_composite_index')} AS direction
            FROM (SELECT year, lag(year) OVER (ORDER BY year) AS prev_year, composite_index,
                  lag(composite_index) OVER (ORDER BY year) AS prev_composite_index FROM ({S}))
            WHERE prev_year IS NOT NULL""",
        "endpoint_change": f"""SELECT first_year, last_year, {', '.join(endpoint_cols)},
            {_arrow('last_composite_index - first_composite_index')} AS direction FROM (
              SELECT min(year) AS first_year, max(year) AS last_year,
                arg_min(composite_index, year) AS first_composite_index, arg_min(fluvial_index, year) AS first_fluvial_index,
                arg_min(coastal_index, year) AS first_coastal_index,
                arg_max(composite_index, year) AS last_composite_index, arg_max(fluvial_index, year) AS last_fluvial_index,
                arg_max(coastal_index, year) AS last_coastal_index
              FROM ({S}))""",
        "extreme_years": f"""SELECT
              (SELECT year FROM ({S}) ORDER BY composite_index, year LIMIT 1) AS lowest_year,
              (SELECT min(composite_index) FROM ({S})) AS lowest_composite,
              (SELECT year FROM ({S}) ORDER BY composite_index DESC, year LIMIT 1) AS highest_year,
              (SELECT max(composite_index) FROM ({S})) AS highest_composite""",
        "trend_totals": f"""SELECT min(year) AS first_year, max(year) AS last_year, count(*) AS n_years,
            CAST(sum(total_warnings) AS BIGINT) AS total_warnings, avg(total_warnings) AS avg_warnings_per_year FROM ({S})""",
        "trend_bars": f"""SELECT year, fluvial_index, repeat('#', CAST(greatest(trunc(fluvial_index / 5.0::DOUBLE), 0) AS INTEGER)) AS fluvial_bar,
            coastal_index, repeat('#', CAST(greatest(trunc(coastal_index / 5.0::DOUBLE), 0) AS INTEGER)) AS coastal_bar FROM ({S})""",
        "sample_first_rows": f"""SELECT fwdCode, timeRaised, msg_id, severity, duration_seconds, score_seconds
            FROM ({ev_sc}) ORDER BY fwdCode, timeRaised, msg_id LIMIT 10""",
        "union_sources": f"""SELECT fwdCode, timeRaised, severity, severityLevel FROM ({EVENTS})
            UNION ALL SELECT fwdCode, timeRaised, severity, severityLevel FROM ({ORDERS_RAW})""",
        # offsets are taken off by hand: only the first two texts of a row's seven are instants, and the sixth, naive one
        "timestamp_parse": """SELECT event_id, CASE event_id % 7 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
              WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' WHEN 2 THEN props WHEN 3 THEN strftime(ts, '%H:%M:%S')
              WHEN 4 THEN strftime(ts, '%Y') WHEN 5 THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || ' Europe/Paris' END AS txt,
            CASE event_id % 7 WHEN 0 THEN ts WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR WHEN 5 THEN date_trunc('minute', ts) END AS parsed
            FROM events""",
        "lead_gap_null_area": f"""SELECT msg_id, fwdCode, gap_seconds, gap_seconds / {H} AS gap_to_next_hours FROM ({gaps(
            f"SELECT * REPLACE (CASE WHEN CAST(fwdCode AS BIGINT) % 5 = 0 THEN NULL ELSE fwdCode END AS fwdCode) FROM ({EVENTS})", 'all')})""",
        "message_scores_fractional": f"""SELECT msg_id, severityLevel, CAST(w AS DOUBLE) AS weight, CAST(duration_seconds * w AS DOUBLE) / {H} AS score FROM (
            SELECT *, CAST(CASE severityLevel WHEN 1 THEN 2.5 WHEN 2 THEN 1.25 WHEN 3 THEN 0.3333 WHEN 4 THEN 0 ELSE 0.5 END AS DECIMAL(9,4)) AS w FROM ({ev_sc}))""",
        "annual_total_fractional": f"""SELECT CAST(year(timeRaised) AS INTEGER) AS year, CAST(sum(duration_seconds * CAST(CASE severityLevel
              WHEN 1 THEN 2.5 WHEN 2 THEN 1.25 WHEN 3 THEN 0.3333 WHEN 4 THEN 0 ELSE 0.5 END AS DECIMAL(9,4))) AS DOUBLE) / {H} AS total_score,
            count(*) AS total_events, {_hours('sum(duration_seconds)')} AS total_hours
            FROM ({ORDERS_SCORED}) WHERE timeRaised IS NOT NULL GROUP BY 1""",
        "index_without_baseline": f"""SELECT year, total_score AS total_score_raw, CAST(NULL AS DOUBLE) AS fluvial_index, CAST(NULL AS DOUBLE) AS composite_index
            FROM ({ORDERS_ANNUAL})""",
        "index_other_weights": f"""SELECT year, composite FROM (SELECT year, fluvial_index * 0.6::DOUBLE + coastal_index * 0.4::DOUBLE AS composite FROM ({ORDERS_IND}))""",
        "durations_with_empty_part": f"SELECT msg_id, duration_seconds, weight, score_seconds FROM ({ev_sc})",
        "region_checked": f"""SELECT msg_id, fwdCode, isTidal FROM ({ORDERS_REGION})""",
    }


def _fmt1(x: str) -> str:
    return f"printf('%.1f', round_even(CAST({x} AS DOUBLE), 1))"


def quality_sql(q: str, by_year: bool = False, has_changes: bool = True,
                optional=("timeSeverityChanged", "timeMessageChanged", "isTidal")) -> tuple[str, str]:
    """(issues, report) SQL for the quality checks, optionally per year.
    ``has_changes``: the frame has timeSeverityChanged; ``optional``: the
    optional columns it has."""
    y = "CAST(year(timeRaised) AS INTEGER)"
    gsel, gby, gcol, gjoin = ((f"{y} AS year, ", "GROUP BY 1", "year, ", "year")
                              if by_year else ("", "", "", None))
    both = "timeRaised IS NOT NULL AND timeSeverityChanged IS NOT NULL"
    days = "((epoch_us(timeSeverityChanged) - epoch_us(timeRaised)) // 86400000000)"
    md = MAX_WARNING_DURATION_DAYS
    long_head, long_tail = Q.MSG_LONG.format(days=md, longest="{}").split("{}")
    long_cond = f"{both} AND {days} > {md}"
    incons = f"{both} AND timeSeverityChanged < timeRaised"
    invalid = "NOT (severityLevel IN (1, 2, 3, 4))"
    cols = ("timeSeverityChanged", "timeMessageChanged", "isTidal")
    compl_rows = []
    for i, c in enumerate(cols):
        if c not in optional:
            continue
        pct = f"(nn{i}::DOUBLE / total::DOUBLE * 100.0::DOUBLE)"
        compl_rows.append(f"""SELECT {gcol}{9 + i} AS check_order, CASE WHEN {pct} < 50.0 THEN 'warning' ELSE 'info' END AS severity,
            {_q(Q.CAT_COMPLETENESS.format(c))} AS category, {_q(Q.MSG_COMPLETENESS.split('{}')[0])} || {_fmt1(pct)} || {_q(Q.MSG_COMPLETENESS.split('{}')[1])} AS message,
            CAST(total - nn{i} AS BIGINT) AS count, false AS subtracts_valid FROM w WHERE total > 0""")
    g_year = f"{y} AS year, " if by_year else ""
    if has_changes:
        change_aggs = f"""count(*) FILTER (WHERE timeSeverityChanged IS NULL) AS v3,
          count(*) FILTER (WHERE {long_cond}) AS v7, max(CASE WHEN {long_cond} THEN {days} END) AS v7max,
          count(*) FILTER (WHERE {incons}) AS v8"""
    else:
        change_aggs = "0 AS v3, 0 AS v7, NULL AS v7max, 0 AS v8"
    nn = ", ".join(f"count({c}) AS nn{i}" for i, c in enumerate(cols) if c in optional) or "0 AS nn_none"
    wide = f"""w AS (SELECT {gsel}count(*) AS total, count(*) FILTER (WHERE timeRaised IS NULL) AS v2,
          count(*) FILTER (WHERE {invalid}) AS v4, {change_aggs}, {nn} FROM ({q}) {gby}),
        g AS (SELECT {g_year}fwdCode, severityLevel, timeRaised, count(*) AS n FROM ({q}) GROUP BY ALL),
        dup AS (SELECT {gcol}count(*) AS groups, coalesce(sum(n), 0) - count(*) AS excess FROM g WHERE n > 1
                {"GROUP BY year" if by_year else ""}),
        inc AS (SELECT {gcol}count(*) AS areas, sum(n) AS records FROM (
            SELECT {gcol}fwdCode, coalesce(bool_or(severityLevel = 4), false) AS has4, sum(n) AS n FROM g GROUP BY ALL)
          WHERE NOT has4 {"GROUP BY year" if by_year else ""})"""
    issues = f"""WITH {wide}
      SELECT * FROM (
        SELECT {gcol}2 AS check_order, 'error' AS severity, {_q(Q.CAT_NULL_RAISED)} AS category,
          {_q(Q.MSG_NULL_RAISED)} AS message, CAST(v2 AS BIGINT) AS count, true AS subtracts_valid FROM w WHERE v2 > 0
        UNION ALL SELECT {gcol}3, 'warning', {_q(Q.CAT_NULL_CHANGED)}, {_q(Q.MSG_NULL_CHANGED)}, CAST(v3 AS BIGINT), false FROM w WHERE v3 > 0
        UNION ALL SELECT {gcol}4, 'error', {_q(Q.CAT_INVALID_LEVEL)}, {_q(Q.MSG_INVALID_LEVEL)}, CAST(v4 AS BIGINT), true FROM w WHERE v4 > 0
        UNION ALL SELECT {gcol}5, 'warning', {_q(Q.CAT_DUPLICATES)}, {_q(Q.MSG_DUPLICATES)}, CAST(excess AS BIGINT), false FROM dup WHERE groups > 0
        UNION ALL SELECT {gcol}6, 'info', {_q(Q.CAT_INCOMPLETE)},
          {_q(Q.MSG_INCOMPLETE)}, CAST(records AS BIGINT), false FROM inc WHERE areas > 0
        UNION ALL SELECT {gcol}7, 'warning', {_q(Q.CAT_LONG)},
          {_q(long_head)} || {_fmt1('v7max')} || {_q(long_tail)}, CAST(v7 AS BIGINT), false FROM w WHERE v7 > 0
        UNION ALL SELECT {gcol}8, 'error', {_q(Q.CAT_INCONSISTENT)}, {_q(Q.MSG_INCONSISTENT)}, CAST(v8 AS BIGINT), true FROM w WHERE v8 > 0
        {''.join(' UNION ALL ' + r for r in compl_rows)})"""
    if by_year:
        report = f"""WITH iss AS ({issues}), w2 AS (SELECT {y} AS year, count(*) AS total FROM ({q}) GROUP BY 1)
          SELECT w2.year, w2.total AS total_records,
            CAST(w2.total - coalesce(sum(CASE WHEN subtracts_valid THEN count END), 0) AS BIGINT) AS valid_records,
            count(*) FILTER (WHERE severity = 'error') = 0 AS passed,
            count(*) FILTER (WHERE severity = 'error') AS error_count,
            count(*) FILTER (WHERE severity = 'warning') AS warning_count,
            count(*) FILTER (WHERE severity = 'info') AS info_count
          FROM w2 LEFT JOIN iss ON iss.year IS NOT DISTINCT FROM w2.year GROUP BY w2.year, w2.total"""
    else:
        report = f"""WITH iss AS ({issues}), w2 AS (SELECT count(*) AS total FROM ({q}))
          SELECT (SELECT total FROM w2) AS total_records,
            CAST((SELECT total FROM w2) - coalesce(sum(CASE WHEN subtracts_valid THEN count END), 0) AS BIGINT) AS valid_records,
            count(*) FILTER (WHERE severity = 'error') = 0 AS passed,
            count(*) FILTER (WHERE severity = 'error') AS error_count,
            count(*) FILTER (WHERE severity = 'warning') AS warning_count,
            count(*) FILTER (WHERE severity = 'info') AS info_count FROM iss"""
    return issues, report


def tallies() -> str:
    return " UNION ALL ".join(
        f"SELECT {_q(c)} AS county, count(*) FILTER (WHERE contains(coalesce(county, ''), {_q(c)})) AS area_count FROM ({SUPPLIER_AREAS})"
        for c in TEST_COUNTIES)


def quality_oracles() -> dict[str, str]:
    q = QUALITY_MSGS
    both = "timeRaised IS NOT NULL AND timeSeverityChanged IS NOT NULL"
    days = "((epoch_us(timeSeverityChanged) - epoch_us(timeRaised)) // 86400000000)"
    md = MAX_WARNING_DURATION_DAYS
    long_cond = f"{both} AND {days} > {md}"
    incons = f"{both} AND timeSeverityChanged < timeRaised"
    invalid = "NOT (severityLevel IN (1, 2, 3, 4))"
    cols = ("timeSeverityChanged", "timeMessageChanged", "isTidal")
    issues, report = quality_sql(q)
    compl = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS non_null, CAST(count(*) - count({c}) AS BIGINT) AS missing,
            count({c})::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE AS completeness_pct,
            CASE WHEN count({c})::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE < 50.0 THEN 'warning' ELSE 'info' END AS severity
            FROM ({q})""" for c in cols)
    expected = (f"SELECT fwdCode FROM ({SUPPLIER_AREAS}) WHERE {_contains_any('county', TEST_COUNTIES)} "
                "UNION SELECT 'N' || n_nationkey FROM nation")
    coverage = f"""WITH a AS (SELECT fwdCode, count(*) AS n FROM ({LINEITEM_MSGS}) GROUP BY fwdCode),
        e AS ({expected}),
        j AS (SELECT a.n, e.fwdCode AS efc, a.fwdCode AS afc FROM a FULL OUTER JOIN e ON a.fwdCode = e.fwdCode),
        s AS (SELECT count(*) FILTER (WHERE n IS NULL) AS missing_areas, count(*) FILTER (WHERE efc IS NULL) AS unexpected_areas,
                coalesce(sum(CASE WHEN efc IS NULL THEN n END), 0) AS unexpected_records FROM j)
      SELECT 'warning' AS severity, {_q(Q.CAT_MISSING_AREAS)} AS category,
        CAST(missing_areas AS VARCHAR) || {_q(Q.MSG_MISSING_AREAS.split("{}")[1])} AS message,
        CAST(missing_areas AS BIGINT) AS count FROM s WHERE missing_areas > 0
      UNION ALL SELECT 'warning', {_q(Q.CAT_UNEXPECTED_AREAS)}, CAST(unexpected_areas AS VARCHAR) || {_q(Q.MSG_UNEXPECTED_AREAS.split("{}")[1])},
        CAST(unexpected_records AS BIGINT) FROM s WHERE unexpected_areas > 0"""
    return {
        "data_summary": f"""SELECT count(*) AS total_records,
            CAST(count(DISTINCT fwdCode) + max(CAST(fwdCode IS NULL AS INTEGER)) AS BIGINT) AS unique_warning_areas,
            min(timeRaised) AS earliest, max(timeRaised) AS latest FROM ({LINEITEM_MSGS})""",
        "severity_histogram": f"SELECT severityLevel, count(*) AS count FROM ({LINEITEM_MSGS}) GROUP BY severityLevel",
        "class_histogram": f"SELECT isTidal, count(*) AS count FROM ({q}) GROUP BY isTidal",
        "null_timestamps": f"""SELECT count(*) AS total_records, count(*) FILTER (WHERE timeRaised IS NULL) AS missing_timeRaised,
            count(*) FILTER (WHERE timeSeverityChanged IS NULL) AS missing_timeSeverityChanged,
            count(*) FILTER (WHERE timeMessageChanged IS NULL) AS missing_timeMessageChanged FROM ({q})""",
        "duplicate_keys": f"""SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) - count(*) AS BIGINT) AS excess_records
            FROM (SELECT count(*) AS n FROM ({q}) GROUP BY fwdCode, severityLevel, timeRaised) WHERE n > 1""",
        "incomplete_areas": f"""SELECT * FROM (SELECT fwdCode, min(severityLevel) AS min_severity, max(severityLevel) AS max_severity,
            coalesce(bool_or(severityLevel = 4), false) AS has_level_4, count(*) AS n_records FROM ({q}) GROUP BY fwdCode)
            WHERE NOT has_level_4""",
        "long_spans": f"""SELECT count(*) FILTER (WHERE {long_cond}) AS long_records,
            max(CASE WHEN {long_cond} THEN {days} END) AS longest_days FROM ({q})""",
        "time_inconsistency": f"SELECT count(*) FILTER (WHERE {incons}) AS inconsistent_records FROM ({q})",
        "completeness": compl,
        "invalid_levels": f"SELECT count(*) FILTER (WHERE {invalid}) AS invalid_records FROM ({q})",
        "quality_issues": issues,
        "quality_report": report,
        "area_coverage": coverage,
        "issue_examples": issue_examples_sql(),
        "issue_examples_by_year": issue_examples_sql(by_year=True),
        "quality_missing_column": quality_missing_column_sql(),
        "coverage_examples": f"""WITH a AS (SELECT DISTINCT fwdCode FROM ({LINEITEM_MSGS})), e AS ({expected}),
            j AS (SELECT CASE WHEN a.fwdCode IS NULL THEN {_q(Q.CAT_MISSING_AREAS)}
                              WHEN e.fwdCode IS NULL THEN {_q(Q.CAT_UNEXPECTED_AREAS)} END AS category,
                         coalesce(a.fwdCode, e.fwdCode) AS fwdCode
                  FROM a FULL OUTER JOIN e ON a.fwdCode = e.fwdCode)
            SELECT category, list_sort(list_filter(list(fwdCode ORDER BY fwdCode NULLS FIRST)[1:{COVERAGE_EXAMPLES}],
                                                   lambda x: x IS NOT NULL)) AS examples
            FROM j WHERE category IS NOT NULL GROUP BY category""",
        "county_filter": f"SELECT fwdCode, county FROM ({SUPPLIER_AREAS}) WHERE {_contains_any('county', TEST_COUNTIES)}",
        "class_from_text": f"SELECT fwdCode, riverOrSea, isTidal FROM ({SUPPLIER_AREAS})",
        "area_dimension": SUPPLIER_AREAS,
        "county_tallies": tallies(),
        "area_class_counts": f"""SELECT count(*) AS total_areas, count(*) FILTER (WHERE isTidal = false) AS fluvial_areas,
            count(*) FILTER (WHERE isTidal = true) AS coastal_areas FROM ({SUPPLIER_AREAS})
            WHERE {_contains_any('county', TEST_COUNTIES)}""",
        "area_codes": f"SELECT DISTINCT fwdCode FROM ({LINEITEM_MSGS})",
        "flood_areas": f"SELECT fwdCode, county FROM ({SUPPLIER_AREAS}) WHERE contains(coalesce(county, ''), 'EUROPE')",
        "current_floods": f"SELECT msg_id, fwdCode, severityLevel FROM ({EVENTS}) WHERE severityLevel = 1",
        "class_counts": f"""SELECT CAST(year(timeRaised) AS INTEGER) AS year, count(*) AS total_warnings,
            count(*) FILTER (WHERE isTidal = false) AS fluvial_warnings, count(*) FILTER (WHERE isTidal = true) AS coastal_warnings
            FROM ({ORDERS_REGION}) WHERE timeRaised IS NOT NULL GROUP BY 1""",
    }


def ingest_region_sql() -> str:
    msgs = f"""SELECT e.fwdCode, e.timeRaised, e.severity, e.severityLevel, a.isTidal
      FROM ({EVENTS}) e JOIN (SELECT DISTINCT CAST(c.c_custkey AS VARCHAR) AS fwdCode, r.isTidal
                              FROM customer c JOIN ({REGION_AREAS}) r ON CAST(c.c_nationkey AS VARCHAR) = r.fwdCode) a
        ON e.fwdCode = a.fwdCode"""
    return quality_sql(msgs, by_year=True, has_changes=False, optional=("isTidal",))[1]


def _json_field(name: str, kind: str) -> str:
    """One "name":value member as Spark's to_json writes it (null -> omitted)."""
    key = f"'\"{name}\":'"
    if kind == "string":
        val = f"to_json({name})"
    elif kind == "timestamp":
        val = f"'\"' || strftime({name}, '%Y-%m-%dT%H:%M:%S.%g') || '\"'"
    elif kind == "boolean":
        val = f"CASE WHEN {name} THEN 'true' ELSE 'false' END"
    else:
        val = f"CAST({name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN NULL ELSE {key} || {val} END"


def quality_missing_column_sql() -> str:
    """Without levels only the column check and those that need no level are left."""
    full = quality_sql(QUALITY_MSGS)[0]
    return f"""SELECT * FROM ({full}) WHERE check_order NOT IN (4, 5, 6)
      UNION ALL SELECT 1, 'error', {_q(Q.CAT_REQUIRED)}, {_q(Q.MSG_REQUIRED + 'severityLevel')}, count(*), false FROM ({QUALITY_MSGS})"""


def issue_examples_sql(by_year: bool = False) -> str:
    cols = [("fwdCode", "string"), ("timeRaised", "timestamp"), ("severity", "string"), ("severityLevel", "int"),
            ("timeSeverityChanged", "timestamp"), ("timeMessageChanged", "timestamp"), ("isTidal", "boolean"),
            ("msg_id", "bigint"), ("line_no", "int")]
    js = "'{' || concat_ws(',', " + ", ".join(_json_field(c, k) for c, k in cols) + ") || '}'"
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ["fwdCode", "timeRaised", "severityLevel", "msg_id"]
                      + [c for c, _ in cols])
    q = QUALITY_MSGS
    both = "timeRaised IS NOT NULL AND timeSeverityChanged IS NOT NULL"
    y = "CAST(year(timeRaised) AS INTEGER) AS year, " if by_year else ""
    ys, yg = ("year, ", "year, ") if by_year else ("", "")

    def js_of(*fields):
        return "'{' || concat_ws(',', " + ", ".join(_json_field(c, k) for c, k in fields) + ") || '}'"

    dup = js_of(("fwdCode", "string"), ("severityLevel", "int"), ("timeRaised", "timestamp"), ("count", "bigint")).replace("count", '"count"').replace('""count""', '"count"')
    area = js_of(("fwdCode", "string"), ("min_severity", "int"), ("max_severity", "int"), ("has_level_4", "boolean"))
    return f"""WITH x AS (
        SELECT {_q(Q.CAT_NULL_RAISED)} AS category, {y}* FROM ({q}) WHERE timeRaised IS NULL
        UNION ALL SELECT {_q(Q.CAT_INVALID_LEVEL)}, {y}* FROM ({q}) WHERE NOT (severityLevel IN (1, 2, 3, 4))
        UNION ALL SELECT {_q(Q.CAT_INCONSISTENT)}, {y}* FROM ({q}) WHERE {both} AND timeSeverityChanged < timeRaised),
      g AS (SELECT {y}fwdCode, severityLevel, timeRaised, count(*) AS "count" FROM ({q}) GROUP BY ALL),
      a AS (SELECT {ys}fwdCode, min(severityLevel) AS min_severity, max(severityLevel) AS max_severity,
              coalesce(bool_or(severityLevel = 4), false) AS has_level_4 FROM g GROUP BY {yg}fwdCode)
      SELECT category, {ys}list({js} ORDER BY {order})[1:{ISSUE_EXAMPLES}] AS examples FROM x GROUP BY {yg}category
      UNION ALL SELECT {_q(Q.CAT_DUPLICATES)}, {ys}list({dup} ORDER BY fwdCode NULLS FIRST, timeRaised NULLS FIRST, severityLevel NULLS FIRST)[1:{ISSUE_EXAMPLES}]
        FROM g WHERE "count" > 1 {"GROUP BY year" if by_year else "HAVING count(*) > 0"}
      UNION ALL SELECT {_q(Q.CAT_INCOMPLETE)}, {ys}list({area} ORDER BY fwdCode NULLS FIRST)[1:{ISSUE_EXAMPLES}]
        FROM a WHERE NOT has_level_4 {"GROUP BY year" if by_year else "HAVING count(*) > 0"}"""


def file_oracles() -> dict[str, str]:
    msgs = f"SELECT fwdCode, timeRaised, severity, severityLevel FROM ({EVENTS})"
    issues_y, report_y = quality_sql(QUALITY_MSGS, by_year=True)
    return {
        "csv_scan": msgs,
        "json_scan": msgs,
        "ods_scan": msgs,
        "archive_scan": msgs,
        "mixed_directory": msgs,
        "csv_quoted": f"""SELECT msg_id, CASE msg_id % 5 WHEN 0 THEN 'say "' || fwdCode || '"' WHEN 1 THEN 'a, b, ' || fwdCode
            WHEN 2 THEN fwdCode || chr(92) WHEN 3 THEN 'line' || chr(10) || fwdCode || chr(10) || '"","'
            ELSE chr(92) || '"' || fwdCode || chr(92) || 'n' END AS label, fwdCode, timeRaised, severity, severityLevel FROM ({EVENTS})""",
        "skipped_files": """SELECT s_suppkey || '.csv' AS file, 'ValueError: no column for timeRaised' AS reason, CAST(NULL AS VARCHAR) AS record
              FROM supplier WHERE s_suppkey % 3 = 1
            UNION ALL SELECT s_suppkey || '.ods', 'BadZipFile: File is not a zip file', NULL FROM supplier WHERE s_suppkey % 3 = 2
            UNION ALL SELECT s_suppkey || '.csv', 'fields do not match the header', '2024-01-02T00:00:00Z,one,too,many'
              FROM supplier WHERE s_suppkey % 6 = 0""",
        "landed_pages": SUPPLIER_AREAS,
        "yearly_roundtrip": f"""SELECT msg_id, fwdCode, timeRaised, severityLevel, isTidal, CAST(1997 AS INTEGER) AS year
            FROM ({ORDERS_REGION}) WHERE year(timeRaised) = 1997""",
        "csv_roundtrip": f"""SELECT msg_id, fwdCode, timeRaised, severity, severityLevel, isTidal, CAST(year(timeRaised) AS INTEGER) AS year
            FROM ({ORDERS_REGION}) WHERE timeRaised IS NOT NULL""",
        "discover_years": f"""SELECT DISTINCT CAST(year(timeRaised) AS INTEGER) AS year FROM ({ORDERS_REGION})
            WHERE year(timeRaised) >= {ORDERS_BASELINE_YEAR}""",
        "trend_export": ORDERS_SUMMARY,
        "baseline_roundtrip": core_oracles()["self_baseline"],
        "quality_by_year": f"""SELECT r.*, i.* EXCLUDE (year) FROM ({report_y}) r JOIN ({issues_y}) i ON r.year = i.year""",
        "index_from_stored_baseline": indicators(ORDERS_ANNUAL, 1998),
        "area_table": SUPPLIER_AREAS,
        "area_stats_table": tallies(),
        "ingest_region": ingest_region_sql(),
        "area_metadata": f"""SELECT 'Warning areas of the test region' AS description, 'the test region' AS region, {_q(",".join(TEST_COUNTIES))} AS counties,
            '2024-01-01T00:00:00Z' AS fetched_at, count(*) AS total_areas, count(*) FILTER (WHERE NOT isTidal) AS fluvial_areas,
            count(*) FILTER (WHERE isTidal) AS coastal_areas,
            {", ".join(f"count(*) FILTER (WHERE contains(coalesce(county, ''), {_q(c)})) AS in_{c.lower().replace(' ', '_')}" for c in TEST_COUNTIES)}
            FROM ({SUPPLIER_AREAS})""",
        "torn_records": """SELECT CAST(s_suppkey AS VARCHAR) AS code, 3::BIGINT AS loaded,
              '{"DATE": "2024-01-01T00:00:00Z", "CODE": "' || s_suppkey AS torn FROM supplier WHERE s_suppkey % 2 = 0
            UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 2::BIGINT, 'torn.csv' FROM supplier WHERE s_suppkey % 2 = 1""",
        "page_faults": f"""WITH i AS (SELECT CAST(notation AS BIGINT) // 25 AS p FROM ({SUPPLIER_ITEMS})),
            pages AS (SELECT p, count(*) AS n FROM i GROUP BY p), top AS (SELECT max(p) AS m FROM pages),
            good AS (SELECT * FROM pages WHERE p % 7 <> 3 AND p % 5 <> 2)
            SELECT p || '.json' AS file, 'not a page of items' AS reason FROM pages WHERE p % 7 <> 3 AND p % 5 = 2
            UNION ALL SELECT p || '.json', 'no page starts at offset ' || ((p + 1) * 25) FROM good, top WHERE p < m AND p + 1 NOT IN (SELECT p FROM good)
            UNION ALL SELECT p || '.json', 'no page ends at offset ' || (p * 25) FROM good WHERE p > 0 AND p - 1 NOT IN (SELECT p FROM good)
            UNION ALL SELECT 'all', 'items loaded: ' || coalesce(sum(n), 0) FROM good""",
        # after the run record of the yearly download: load and export decide, a year without records succeeds too
        "run_metrics": f"""WITH per AS (SELECT CAST(year(timeRaised) AS INTEGER) AS year, count(*) AS n,
              bool_or((severityLevel IS NOT NULL AND severityLevel NOT IN (1, 2, 3, 4)) OR timeSeverityChanged < timeRaised) AS wrong
              FROM ({QUALITY_MSGS}) WHERE timeRaised IS NOT NULL GROUP BY 1),
            y AS (SELECT CAST(range AS INTEGER) AS year FROM range(1990, 2004))
            SELECT 'first' AS run_id, y.year, coalesce(n, 0) AS records_loaded, 'success' AS load_status, 'success' AS validation_status, 'success' AS export_status,
              NOT coalesce(wrong, false) AS validation_passed, coalesce(n, 0) AS records_exported, '' AS errors, true AS success, 100.0::DOUBLE AS success_rate_pct
            FROM y LEFT JOIN per ON per.year = y.year
            UNION ALL SELECT 'second', CAST(range AS INTEGER), 0, 'failed', NULL, NULL, NULL, NULL, 'load: LoadError: no input', false, 0.0::DOUBLE FROM range(1995, 1998)""",
    }


def registry() -> dict[str, str]:
    return {**core_oracles(), **quality_oracles(), **file_oracles()}
