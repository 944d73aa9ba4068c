"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list, default: the headline set below).
Each query runs to completion through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  Every query is run once
untimed first (JIT, Python workers, file listings), then timed once: the
numbers are steady-state times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from warnindex.plans.queries import registry  # noqa: E402
from warnindex.session import build_session  # noqa: E402

HEADLINE = [
    "annual_index",
    "index_listing",
    "yearly_summary",
    "year_on_year",
    "breakdown_grouping_sets",
    "lead_gap_all",
    "lead_gap_year",
    "duration_rule",
    "annual_by_class",
    "region_join_class",
    "severity_normalize",
    "quality_issues",
    "quality_by_year",
    "quality_report",
    "issue_examples",
    "area_coverage",
    "data_summary",
    "county_tallies",
    "union_sources",
    "csv_scan",
    "ods_scan",
    "archive_scan",
    "ingest_region",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8), app="warnindex-bench",
                          extra={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    qs = registry()
    errors = {}

    def run(n):
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for n in names:  # warm-up pass, untimed
        try:
            run(n)
        except Exception as e:  # noqa: BLE001 - report, keep benchmarking the rest
            errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
    times = {}
    for n in names:
        if n in errors:
            times[n] = None
            continue
        t0 = time.perf_counter()
        run(n)
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
