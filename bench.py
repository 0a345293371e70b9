"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores.
Every query runs once untimed, so that code generation and class loading do not
count, and then once timed to the end of its last stage.
"""

from __future__ import annotations

import json
import os
import time

from gaugeloom.session import local_session
from workload.queries import QUERIES

HEADLINE = (
    "scan_delimited",
    "interval_catalog",
    "extract_links",
    "write_year_partitions",
    "first_non_null",
    "apply_filters",
    "join_station",
    "densify_grid",
    "regularize_interval",
    "resolve_overlaps",
    "fill_missing_intervals",
    "alignment_check",
    "duration_stack",
    "profile_missing",
    "profile_range",
    "temporal_jumps",
    "variable_status",
    "cleaning_report",
    "global_missing_pct",
    "year_summary",
    "interannual_cv",
    "levene",
    "ks_normality",
    "shape_stats",
    "gap_runs",
    "fill_gaps",
    "fill_stats",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=8 if cores == "*" else int(cores))

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
