"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS``
(default 8), ``BENCH_REPEATS`` (default 3; the median is reported per query).
Each query is built from scratch and executed in full with a ``noop`` write, so the
time covers planning, every upstream step it depends on, and execution. The tables it derives
its landing from are first dealt into ``FILES`` Parquet files each (not timed): the given ones are one row
group, which a single task would have to read.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from filegate.plans import catalog  # noqa: E402
from filegate.session import checkpoint_dir, local_session, staged_frames  # noqa: E402

HEADLINE = [
    "file_events",            # parse + keys over every landing row
    "dedupe_files",           # keyed de-duplication of the whole landing
    "group_aggregate",        # per-group fold of the registered events
    "vw_group_status",        # flagship: register -> refresh -> evaluate -> report
    "group_state_upsert",     # two runs: keyed append + upsert against stored state
    "mark_dispatched",        # two runs end to end, including dispatch and marking
    "dispatch_payload",       # dispatch rows with part snapshots
    "audit_append",           # every audit event of both runs, keyed append
]


FILES = 32
TABLES = ("lineitem", "orders", "events")


def dealt(spark, sf_dir: str, root: str) -> str:
    """The tables of the landing as many files, with the rows and columns they have."""
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(FILES).write.parquet(f"{root}/{name}.parquet")
    return root


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cores=cpus, app="filegate-bench")
    registry = catalog.registry()
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    checkpoint_dir(spark, default=f"file:{scratch}/checkpoints")
    given, sf_dir = sf_dir, dealt(spark, sf_dir, f"{scratch}/tables")

    # warm-up: JVM, JIT, code generation caches, file listing
    for name in ("parse_landing", "vw_group_status", "vw_group_status"):
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            with staged_frames(spark):
                registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
        print(f"# {name}: {runs}", file=sys.stderr)

    sf_match = re.search(r"sf([0-9.]+)", given)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf_match.group(1)) if sf_match else given,
        "cpus": int(cpus) if str(cpus).isdigit() else cpus,
        "repeats": repeats,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
