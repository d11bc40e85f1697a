"""Benchmark: wall time of the headline jobs at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2; best of N per query).  Prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = ["gmv_report", "volume_report", "daily_origin", "daily_global", "history_origin",
            "daily_mart", "backfill_origin"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from promolens.session import build_session
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "8g"})
    from promolens import catalog

    qs = catalog.queries()

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    run(qs["sales_lines"](spark, sf_dir))  # warm-up (JIT, file listing caches)
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(qs[name](spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_jobs_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "repeat": repeat}))


if __name__ == "__main__":
    main()
