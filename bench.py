"""Benchmark the registered queries.

Runs every batch query of the catalog and the ingest round trips through the
``noop`` sink (full execution, nothing collected on the driver), plus one run
of the whole streaming job (``availableNow`` over the events file stream).
Each is timed cold once and then warm ``BENCH_REPEAT - 1`` times; the reported
figure per query is the median of all runs. Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3), BENCH_ONLY (comma-separated query names)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pageflow.plans import catalog, ingest  # noqa: E402
from pageflow.session import get_session, scratch_path  # noqa: E402
from pageflow.sources.fixtures import stream_page_events  # noqa: E402
from pageflow.streaming.runner import run_available_now  # noqa: E402


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]

    spark = get_session(f"local[{cpus}]", max(8, 2 * cpus), "pageflow-bench",
                        {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")

    jobs = {}
    for name, q in list(catalog.QUERIES.items()) + list(ingest.QUERIES.items()):
        jobs[name] = (lambda q=q: q(spark, sf_dir).write.format("noop").mode("overwrite").save())

    def stream_job():
        base = scratch_path(spark, "bench-stream")
        run_available_now(stream_page_events(spark, sf_dir), f"{base}/tables", f"{base}/cp")

    jobs["stream_job"] = stream_job
    if only:
        jobs = {k: v for k, v in jobs.items() if k in only}

    # the raw text dumps are written once per session (like arriving files); write them before timing
    if "sse_frames" in jobs:
        ingest.sse_dump_path(spark, sf_dir)
    if "normalize_events" in jobs:
        ingest.raw_dump_path(spark, sf_dir)
    if "normalize_rejects" in jobs:
        ingest.raw_dump_path(spark, sf_dir, corrupt=True)

    results, first = {}, {}
    for name, job in jobs.items():
        runs = [_timed(job) for _ in range(repeat)]
        first[name] = round(runs[0], 3)
        results[name] = round(statistics.median(runs), 3)
        print(f"{name}: first {runs[0]:.2f}s median {results[name]:.2f}s", file=sys.stderr)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "first_run": first,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
