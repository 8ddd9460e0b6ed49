"""A far stop that must not widen the grid, odd lines of the dump, and one-pass key checks."""

import math
import random

from tramflow.operators.nearest import nearest_match
from tramflow.operators.quality import dedupe_keep_first_id, split_foreign_key
from tramflow.sources.schedule_text import calendar_days, departures


def _lines(spark, text):
    rows = [("f", 0, 1, i, line) for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "_file string, _block int, _rec int, pos int, line string")


def _metres(a, b):
    (x, y), (u, v) = ((math.radians(p), math.radians(q)) for p, q in (a, b))
    h = math.sin((v - y) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin((u - x) / 2) ** 2
    return round(2 * math.asin(math.sqrt(h)) * 6371000, 2)


def test_nearest_with_one_far_stop(spark):
    rng = random.Random(3)
    stops = [("L", f"s{i:03d}", 21 + rng.random() / 10, 52 + rng.random() / 10) for i in range(150)] + [("L", "far", -70.0, -30.0)]
    stops += [("L", "s000b", *stops[0][2:])]  # a tie of distance
    pings = [("L", i // 2, f"v{i}", 21 + rng.random() / 10, 52 + rng.random() / 10) for i in range(200)] + [("L", 900, "v", -69.0, -30.0)]
    left = spark.createDataFrame(pings, "line string, grp int, veh string, x double, y double")
    right = spark.createDataFrame(stops, "line string, stop string, sx double, sy double")
    want = {}
    for _, grp, veh, x, y in pings:
        want[grp] = min([want[grp]] if grp in want else [], default=None)
        best = min((_metres((x, y), (u, v)), stop, veh) for _, stop, u, v in stops)
        want[grp] = best if want[grp] is None else min(want[grp], best)
    for grid in ("auto", None):
        got = nearest_match(left, right, ["line"], ("x", "y"), ("sx", "sy"), ["line", "grp"], ["stop"],
                            right_order=["stop"], left_order=["veh"], cell_deg=grid)
        assert {r["grp"]: (r["distance"], r["stop"], r["veh"]) for r in got.collect()} == want


def test_unreadable_count_takes_no_neighbours_count(spark):
    text = "   Linia:   1  - X\n*RP 1\n100101 A,\n*OD 2\n\t06.00 a/DP/1\n 07.00 a/DP/2\n*OD ??\n08.00 a/DP/3\n*OD 1\n09.00 a/DP/4"
    got = [(r["departure_time"], r["order"], r["unit"]) for r in departures(_lines(spark, text)).collect()]
    assert sorted(got) == [("06:00:00", 0, "1001"), ("07:00:00", 1, "1001"), ("09:00:00", 0, "1001")]


def test_calendar_block_ends_at_its_marker(spark):
    text = "2020-01-01 1 XX\n*KA 2\n\t2024-05-06  2  D1  DP\n \t \n2024-05-07 1 D2\n#KA\n2024-05-08 1 D3"
    got = sorted((str(r["day"]), list(r["day_types"])) for r in calendar_days(_lines(spark, text)).collect())
    assert got == [("2024-05-06", ["D1", "DP"]), ("2024-05-07", ["D2"])]


def test_key_checks_split_every_row_once(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id long, k string")
    once = dedupe_keep_first_id(rows, ["k"])
    assert sorted(r["id"] for r in once.accepted.collect()) == [1, 3, 5]
    assert sorted(r["id"] for r in once.rejected.collect()) == [2, 4]
    parents = spark.createDataFrame([("a",), ("a",)], "p string")
    for null_passes, kept in ((True, [1, 2, 3, 4]), (False, [1, 2])):
        split = split_foreign_key(rows, parents, "k", "p", null_passes)
        assert sorted(r["id"] for r in split.accepted.collect()) == kept
        assert sorted(r["id"] for r in split.rejected.collect()) == sorted({1, 2, 3, 4, 5} - set(kept))
        assert split.accepted.columns == rows.columns
