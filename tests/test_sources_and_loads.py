"""Readers, sinks and the relational loads (C3-C7) with their invariants."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import SF001, SF01
from tramflow.operators.quality import load_counts
from tramflow.plans import delays, loads
from tramflow.plans import driver_views as dv
from tramflow.sources import read_pings, write_table
from tramflow.sources.readers import read_collection, read_stops_feed


def test_read_pings_multiline_json(spark, scratch):
    snap = {"result": [
        {"Lines": "17", "Lon": 21.0, "Lat": 52.2, "VehicleNumber": "1001", "Time": "2024-01-02 00:05:00", "Brigade": "3"},
        {"Lines": "17", "Lon": 21.1, "Lat": 52.3, "VehicleNumber": "1002", "Time": "garbage", "Brigade": "4"},
    ]}
    with open(os.path.join(scratch, "trams_0001.json"), "w") as f:
        json.dump(snap, f, indent=2)
    rows = sorted(read_pings(spark, os.path.join(scratch, "trams_*.json")).collect(), key=lambda r: r["VehicleNumber"])
    assert rows[0]["Time"] == dt.datetime(2024, 1, 2, 0, 5) and rows[0]["CurrTramTime"] == "00:05:00"
    assert rows[0]["DateText"] == "2024-01-02"
    assert rows[1]["Time"] is None


def test_stops_feed_positional_and_null_text(spark, scratch):
    def vals(*xs):
        return {"values": [{"value": x, "key": f"k{i}"} for i, x in enumerate(xs)]}

    feed = {"result": [
        vals("1001", "01", "Stop One", "12", "52.2", "21.0", "north", "2024-01-01 00:00:00.0"),
        vals("R001", "01", "Depot", "null", "null", "null", "south", "null"),
    ]}
    path = os.path.join(scratch, "stops.json")
    with open(path, "w") as f:
        json.dump(feed, f)
    rows = sorted(read_stops_feed(spark, path).collect(), key=lambda r: r["unit"])
    assert tuple(rows[0])[:7] == ("1001", "01", "Stop One", 12, 52.2, 21.0, "north")
    assert rows[0]["valid_from"] == dt.datetime(2024, 1, 1)
    assert rows[1]["street_id"] is None and rows[1]["latitude"] is None and rows[1]["valid_from"] is None


def test_stops_load_invariants(spark):
    # count conservation and key uniqueness, as the original load tests check
    feed = dv.stops_feed(spark, SF01)
    split = loads.load_stops(feed)
    c = load_counts(split).first()
    n_not_r = feed.filter(~F.col("unit").rlike("^R")).count()
    assert c["accepted"] + c["rejected"] == n_not_r
    assert c["accepted"] == feed.filter(~F.col("unit").rlike("^R")).select("unit", "post").distinct().count()
    assert split.accepted.select("id").distinct().count() == c["accepted"]
    assert split.accepted.filter(F.col("unit").rlike("^R")).count() == 0


def test_routes_and_variants_loads(spark):
    routes = dv.routes_nested(spark, SF001)
    stops_ok = loads.load_stops(dv.stops_feed(spark, SF001)).accepted
    r = loads.load_routes(routes)
    assert r.accepted.select("line_name").distinct().count() == r.accepted.count()
    assert r.accepted.count() + r.rejected.count() == loads.route_rows(routes).count()
    v = loads.load_route_variants(routes, stops_ok, r.accepted)
    total = loads.variant_rows(routes).count()
    assert v.accepted.count() + v.rejected.count() == total
    assert v.accepted.filter("stop_id IS NULL OR route_id IS NULL").count() == 0
    # ids are assigned before rejection: together they are 1..n without repeats
    ids = sorted(x["id"] for x in v.accepted.unionByName(v.rejected).select("id").collect())
    assert ids == list(range(1, total + 1))


def test_timetables_load_fk(spark):
    stops_ok = loads.load_stops(dv.stops_feed(spark, SF001)).accepted
    tt = dv.timetable(spark, SF001).select(
        F.col("Lines").alias("line"), F.col("Route").alias("route"), F.col("DayType").alias("day_type"),
        F.col("Unit").alias("unit"), F.substr(F.col("StopNo"), F.lit(5)).alias("post"),
        F.col("dep_sec").cast("string").alias("departure_time"), F.col("Order").alias("order"))
    t = loads.load_timetables(tt, stops_ok)
    assert t.accepted.join(stops_ok, t.accepted["stop_id"] == stops_ok["id"], "left_anti").count() == 0
    assert t.accepted.count() + t.rejected.count() == tt.distinct().count()


def test_fact_sink_partitioned_by_date(spark, scratch):
    fact = delays.delay_fact(delays.run_delays(dv.pings(spark, SF001), dv.route_stops(spark, SF001),
                                               dv.timetable(spark, SF001), dv.calendar_raw(spark, SF001)))
    out = os.path.join(scratch, "fact")
    write_table(fact, out, partition_by=["Date"])
    back = read_collection(spark, out)
    assert back.count() == fact.count()
    some_day = back.select("Date").first()[0]
    plan = back.filter(F.col("Date") == some_day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    # Overwrite replaces, S8: append adds
    write_table(fact.limit(3), out, mode="overwrite")
    assert read_collection(spark, out).count() == 3
    write_table(fact.limit(2), out, mode="append")
    assert read_collection(spark, out).count() == 5
