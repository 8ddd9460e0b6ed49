"""Headline timings at one scale factor; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully executed (rows written to a no-op sink), build included.
Before timing, every headline query runs once on a smaller scale factor
(``BENCH_WARMUP_DIR``, default the sibling ``sf0.01`` folder when present) so
JVM start-up and JIT compilation are not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tramflow.plans import catalog  # noqa: E402
from tramflow.session import build_session  # noqa: E402

HEADLINE = [
    "c1_delay_fact",
    "j9_nearest_stop",
    "j4_band_join",
    "w6_previous_stops",
    "c5_route_variants_load",
    "c6_timetables_load",
    "x_text_blocks",
]


def run(build) -> float:
    """Time building the query (some stages materialize eagerly) and running it."""
    t0 = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01"))
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in HEADLINE:  # warm-up on the small tables
        run(lambda: catalog.REGISTRY[name].build(spark, warm_dir))
    times = {}
    for name in HEADLINE:
        times[name] = round(run(lambda: catalog.REGISTRY[name].build(spark, sf_dir)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
