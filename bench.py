"""Bench: run the registered analyses at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed in full through Spark's ``noop`` sink (every row is
computed, nothing is pulled to the driver).  Prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
Set ``BENCH_QUERIES`` (comma separated) to run a subset; without it every analysis runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablecraft.plans import queries  # noqa: E402
from tablecraft.session import local_session  # noqa: E402



def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    # One shuffle partition per core locally (AQE coalesces further); on a
    # cluster size it from the data instead (see README, "On a cluster").
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    registry = queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = [n.strip() for n in wanted.split(",")] if wanted else sorted(registry)

    # Warm-up, not timed: one pass over the smallest tables compiles the same
    # generated code and JIT-warms the JVM, so the timed pass measures steady
    # state (what a long-lived cluster session sees), not first-use compilation.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.001"))
    warmed = os.path.isdir(warm_dir) and os.environ.get("BENCH_WARMUP", "1") == "1"
    if warmed:
        for name in names:
            try:
                registry[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - failures are reported by the timed pass
                pass
    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report and keep going
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": cpus,
        "warmup": warm_dir if warmed else None,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
