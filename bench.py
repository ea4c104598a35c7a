"""Bench: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query's full plan is executed with the ``noop`` sink (no collect to the
driver). Every query runs ``BENCH_REPEAT`` times (default 3) after a warm-up
on sf0.001; the reported time per query is the fastest run.
"""

from __future__ import annotations

import importlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall.session import local_session  # noqa: E402

HEADLINE = [
    "reconcile_zone",
    "reconcile_summary",
    "run_zone",
    "accumulate_zones",
    "nearmiss_report",
    "read_export",
    "dedupe_email",
    "cascade_match",
]


def _execute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="rollcall-bench")
    entry = importlib.import_module("__spark_entry__")
    qs = entry.queries()
    _execute(qs["reconcile_zone"](spark, "/root/testdata/sf0.001"))  # warm-up, not timed
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t = time.perf_counter()
            _execute(qs[name](spark, sf_dir))
            dt = time.perf_counter() - t
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
