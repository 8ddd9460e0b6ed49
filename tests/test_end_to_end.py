"""The whole flow on the transit data model: schedule dump + stops feed ->
collections (C2) -> relational tables (C3-C6), and GPS snapshots -> delay
fact (C1), with hand-computed expectations."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from test_schedule_text import DUMP
from tramflow.plans import delays, loads
from tramflow.plans.reference_import import run_import
from tramflow.sources.readers import read_pings


def _feed(rows):
    return {"result": [{"values": [{"value": v, "key": str(i)} for i, v in enumerate(r)]} for r in rows]}


STOPS = [
    # unit, post, name, street id, lat, lon, direction, valid from
    ("1001", "01", "Stop One", "1", "52.2000", "21.0000", "north", "2024-01-01 00:00:00.0"),
    ("1002", "02", "Stop Two", "1", "52.2100", "21.0100", "north", "2024-01-01 00:00:00.0"),
    ("2001", "01", "Plac Banków", "2", "52.2300", "21.0300", "east", "2024-01-01 00:00:00.0"),
    ("2001", "02", "Second", "2", "52.2310", "21.0310", "west", "2024-01-01 00:00:00.0"),
    ("2001", "02", "Second copy", "2", "52.2310", "21.0310", "west", "2024-01-01 00:00:00.0"),
    ("R001", "01", "Depot", "null", "null", "null", "south", "null"),
]


@pytest.fixture(scope="module")
def collections(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("e2e")
    dump = base / "schedule.txt"
    dump.write_bytes(DUMP.encode("iso-8859-1"))
    feed = base / "stops.json"
    feed.write_text(json.dumps(_feed(STOPS)))
    paths = run_import(spark, str(dump), str(feed), str(base / "collections"))
    return {k: spark.read.parquet(p) for k, p in paths.items()}


def test_relational_loads_from_parsed_collections(spark, collections):
    stops = loads.load_stops(collections["Stops"])
    acc = {r["id"]: r["full_name"] for r in stops.accepted.collect()}
    # R unit dropped; the duplicate (2001, 02) rejected, the first by name kept
    assert acc == {100101: "Stop One", 100202: "Stop Two", 200101: "Plac Banków", 200102: "Second"}
    assert stops.rejected.count() == 1

    routes = loads.load_routes(collections["Routes"])
    got = sorted((r["id"], r["line_name"], r["stops_cnt"]) for r in routes.accepted.collect())
    assert got == [(1, "1TP-A", 2), (2, "2TP-C", 2), (3, "2TP-D", 1)]

    variants = loads.load_route_variants(collections["Routes"], stops.accepted, routes.accepted, check_foreign_keys=True)
    rows = sorted((r["id"], r["stop_id"], r["route_id"], r["stop_sequence_nr"]) for r in variants.accepted.collect())
    assert rows == [(1, 100101, 1, 1), (2, 100202, 1, 2), (3, 200101, 2, 1), (4, 200102, 2, 2), (5, 200102, 3, 1)]
    assert variants.rejected.count() == 0

    tt = loads.load_timetables(collections["Timetable"], stops.accepted)
    kept = sorted((r["line_nr"], r["stop_id"], r["departure_time"]) for r in tt.accepted.collect())
    assert kept == [("1", 100101, "08:00:00"), ("2", 200101, "05:30:00"), ("2", 200102, "01:10:00"),
                    ("2", 200102, "12:00:00"), ("3", 100202, "09:00:00")]


def test_delay_fact_from_snapshots(spark, collections, tmp_path):
    # line 2 runs TP-C (Plac Banków -> Second) and TP-D (Second); the calendar
    # says 2021-01-02 is a Saturday (SB) and 2021-01-03 a Sunday (N7 -> DS).
    # delay = ping - departure must lie strictly inside (-180 s, 600 s)
    snaps = [
        ("2", 21.0300, 52.2300, "V1", "2021-01-02 05:33:00", "7"),   # Plac Banków, SB 05:30 -> +180
        ("2", 21.0300, 52.2300, "V1", "2021-01-02 05:32:59", "7"),   # +179
        ("2", 21.0300, 52.2300, "V3", "2021-01-02 05:27:00", "5"),   # -180: excluded
        ("2", 21.0300, 52.2300, "V4", "2021-01-02 05:40:00", "6"),   # +600: excluded
        ("2", 21.0310, 52.2310, "V1", "2021-01-03 01:05:00", "7"),   # 25:10 belongs to 2021-01-02 (SB): no DS match
        ("2", 21.0310, 52.2310, "V2", "2021-01-04 01:12:00", "8"),   # DS 25:10 of Sunday 2021-01-03 -> +120
    ]
    folder = tmp_path / "gps"
    folder.mkdir()
    for i, (ln, lon, lat, veh, t, br) in enumerate(snaps):
        (folder / f"trams_{i}.json").write_text(json.dumps(
            {"result": [{"Lines": ln, "Lon": lon, "Lat": lat, "VehicleNumber": veh, "Time": t, "Brigade": br}]}))
    pings = read_pings(spark, str(folder / "trams_*.json"))
    stops = collections["Stops"]
    route_stops = (
        collections["Routes"].select("line_nr", F.explode("routes").alias("r"))
        .select("line_nr", F.col("r.route_nr").alias("route_nr"), F.posexplode("r.stops").alias("pos", "s"))
        .select("line_nr", "route_nr", F.col("s.stop_nr").alias("stop_nr"), F.col("s.stop_name").alias("StopName"),
                F.col("pos").cast("long").alias("min_time"))
    )
    coords = stops.select(F.concat("unit", "post").alias("stop_nr"), F.col("latitude").alias("Lat"),
                          F.col("longitude").alias("Lon"), F.col("unit").alias("Unit"))
    route_stops = route_stops.join(coords, "stop_nr")
    tt = collections["Timetable"].select(
        F.col("line").alias("Lines"), F.col("route").alias("Route"), F.concat("unit", "post").alias("StopNo"),
        "dep_sec", F.col("order").alias("Order"), F.col("day_type").alias("DayType"), F.col("unit").alias("Unit"))
    cal = collections["Calendar"]
    fact = delays.delay_fact(delays.run_delays(pings, route_stops, tt, cal))
    got = sorted((r["StopNo"], r["VehicleNumber"], r["Date"], r["DepTime"], r["Delay"]) for r in fact.collect())
    assert got == [
        (200101, "V1", dt.date(2021, 1, 2), "05:30:00", 179),
        (200101, "V1", dt.date(2021, 1, 2), "05:30:00", 180),
        (200102, "V2", dt.date(2021, 1, 4), "01:10:00", 120),
    ]
