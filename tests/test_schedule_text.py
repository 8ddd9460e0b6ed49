"""Schedule dump parsing (S3, X1-X7) on a hand-written Latin-1 fixture."""

import datetime as dt
import os

import pytest

from tramflow.sources.schedule_text import parse_calendar, parse_routes, parse_timetable

DUMP = """*KA  3
   2021-01-01    4    DP  D5  N5  NP
   2021-01-02    3    SB  D6  N6
	 2021-01-03    2    N7  NS
#KA
   Linia:   1  - LINIA TRAMWAJOWA
      *TR  1
         TP-A  ,  START  ==>  END
            *LW  2
    MAIN ST.,    100101   Stop One,   --  |  |  |
             r   100202   Stop Two,   --  | 1| 2|
            #LW
            *RP  1
               100101   Stop One,
            *OD  2
               06.15   TP-A/DP/06.15
               24.05   TP-A/DP/24.05
            #OD
   #WK
   Linia:   T  - LINIA TRAMWAJOWA
      *TR  1
         TP-X  ,  A  ==>  B
            *LW  1
    SIDE ST.,    300301   Side,   --  |  |  |
            #LW
            *RP  1
               300301   Side,
            *OD  1
               10.00   TP-X/DP/10.00
   #WK
   Linia: 100  - LINIA AUTOBUSOWA
            *RP  1
               400401   Bus Stop,
            *OD  1
               07.00   TP-B/DP/07.00
   #WK
   Linia:   2  - LINIA TRAMWAJOWA
      *TR  2
         TP-C  ,  X  ==>  Y
            *LW  2
    GRÓJECKA,    200101   Plac Banków,   --  |  |  |
                 200102   Second,   --  | 3| 4|
            #LW
         TP-D  ,  Y  ==>  X
            *LW  1
                 200102   Second,   --  |  |  |
            #LW
            *RP  1
               200101   Plac Banków,
            *OD  1
               05.30   TP-C/SB/05.30
            *RP  1
               200102   Second,
            *OD  2
               25.10   TP-D/DS/25.10
               12.00   TP-D/DP/12.00
   #WK
   Linia:   1  - LINIA TRAMWAJOWA
            *RP  1
               100101   Stop One,
            *OD  1
               08.00   TP-A/SB/08.00
   Linia:   3  - LINIA TRAMWAJOWA
            *RP  1
               100202   Stop Two,
            *OD  1
               09.00   TP-A/DP/09.00
"""


@pytest.fixture(scope="module")
def dump_path(tmp_path_factory):
    p = tmp_path_factory.mktemp("dump") / "schedule.txt"
    p.write_bytes(DUMP.encode("iso-8859-1"))
    assert b"\xf3" in p.read_bytes()
    return str(p)


def test_timetable(spark, dump_path):
    got = sorted(tuple(r) for r in parse_timetable(spark, dump_path).collect())
    # the first section of line 1 is overwritten by the later one; line T and
    # the three-digit line do not count; a section without an end marker runs
    # to the end of the file and switches to line 3 at its header; the line
    # after a departure block is not swallowed.
    assert got == sorted([
        ("2", "TP-C", "SB", "2001", "01", "05:30:00", 19800, 0),
        ("2", "TP-D", "DS", "2001", "02", "01:10:00", 90600, 0),
        ("2", "TP-D", "DP", "2001", "02", "12:00:00", 43200, 1),
        ("1", "TP-A", "SB", "1001", "01", "08:00:00", 28800, 0),
        ("3", "TP-A", "DP", "1002", "02", "09:00:00", 32400, 0),
    ])


def test_calendar(spark, dump_path):
    got = sorted((r["day"], list(r["day_types"])) for r in parse_calendar(spark, dump_path).collect())
    assert got == [
        (dt.date(2021, 1, 1), ["DP", "D5", "N5", "NP"]),
        (dt.date(2021, 1, 2), ["SB", "D6", "N6"]),
        (dt.date(2021, 1, 3), ["N7", "NS"]),
    ]


def test_routes(spark, dump_path):
    docs = {r["line_nr"]: r for r in parse_routes(spark, dump_path).collect()}
    assert sorted(docs) == ["1", "2"]
    one = docs["1"]
    assert one["number_of_routes"] == 1
    (tp_a,) = one["routes"]
    assert (tp_a["route_nr"], tp_a["number_of_stops"]) == ("TP-A", 2)
    assert [tuple(s) for s in tp_a["stops"]] == [
        ("100101", "Stop One", "MAIN ST. ", False, 0, 0),
        ("100202", "Stop Two", "MAIN ST. ", True, 1, 2),
    ]
    two = docs["2"]
    assert two["number_of_routes"] == 2
    tp_c, tp_d = two["routes"]
    assert [tuple(s) for s in tp_c["stops"]] == [
        ("200101", "Plac Banków", "GRÓJECKA ", False, 0, 0),
        ("200102", "Second", "GRÓJECKA ", False, 3, 4),
    ]
    assert [tuple(s) for s in tp_d["stops"]] == [("200102", "Second", "", False, 0, 0)]


def test_reference_import_writes_collections(spark, dump_path, scratch):
    import json

    from tramflow.plans.reference_import import COLLECTIONS, run_import

    feed = {"result": [{"values": [{"value": v, "key": str(i)} for i, v in enumerate(
        ["1001", "01", "Stop One", "5", "52.2", "21.0", "north", "2024-01-01 00:00:00.0"])]}]}
    feed_path = os.path.join(scratch, "stops.json")
    with open(feed_path, "w") as f:
        json.dump(feed, f)
    paths = run_import(spark, dump_path, feed_path, os.path.join(scratch, "collections"))
    assert sorted(paths) == sorted(COLLECTIONS)
    counts = {k: spark.read.parquet(p).count() for k, p in paths.items()}
    assert counts == {"Timetable": 5, "Calendar": 3, "Stops": 1, "Routes": 2}
    # replacing again keeps one copy
    run_import(spark, dump_path, feed_path, os.path.join(scratch, "collections"))
    assert spark.read.parquet(paths["Timetable"]).count() == 5


def test_route_without_stops_keeps_empty_array(spark, tmp_path):
    text = """   Linia:   4  - LINIA TRAMWAJOWA
      *TR  2
         TP-E  ,  A  ==>  B
            *LW  0
            #LW
         TP-F  ,  B  ==>  A
            *LW  1
                 400101   Only,   --  | 2|  |
            #LW
   #WK
"""
    p = tmp_path / "empty_route.txt"
    p.write_bytes(text.encode("iso-8859-1"))
    (doc,) = parse_routes(spark, str(p)).collect()
    assert doc["line_nr"] == "4" and doc["number_of_routes"] == 2
    e, f = doc["routes"]
    assert (e["route_nr"], e["number_of_stops"], list(e["stops"])) == ("TP-E", 0, [])
    assert [tuple(x) for x in f["stops"]] == [("400101", "Only", "", False, 2, 0)]
