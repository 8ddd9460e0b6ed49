"""Print the formatted physical plan of registered queries (plan review).

    python scripts/show_plans.py [sf_dir] [name ...]

Look for: PushedFilters / ReadSchema on every scan, no BatchEvalPython,
no SinglePartition exchange, broadcast joins only on checked dimensions,
and the number of Exchange nodes per query.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or ["c1_delay_fact", "j9_nearest_stop", "j4_band_join", "w6_previous_stops"]
    from tramflow.plans.catalog import REGISTRY
    from tramflow.session import build_session

    spark = build_session("local[8]")
    for name in names:
        df = REGISTRY[name].build(spark, sf)
        print(f"===== {name} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
