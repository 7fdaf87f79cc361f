"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3 timed runs after one warm-up; the median counts),
BENCH_ONLY (comma-separated query names).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "f10_flag_decode", "f12_default_mask", "g07_resample_nearest", "g12_interpolate_tie", "j03_overlap_intersect",
    "j06_overlap_extent", "r01_granule_counters", "r03_daily_composite", "r05_central_bands", "r06_joint_composite",
    "r07_monthly_composite", "r09_climatology", "r11_granule_sets", "r12_set_summary", "w01_index_granules",
    "x03_smooth_3x3", "o03_group_granules", "a03_kd490", "a06_gpr_doy", "a09_plankton_classes", "a11_band_shift",
    "a14_plankton_chain", "plan_monthly_chlorophyll", "t02_sliding_batch",
)


def main() -> None:
    from chromasea.queries import QUERIES
    from chromasea.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in only or HEADLINE:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken[1:]), 4)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of medians of warm runs", "value": round(sum(times.values()), 4),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "memory": "16g driver",
    }))


if __name__ == "__main__":
    main()
