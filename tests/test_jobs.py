"""Jobs that write: days replaced, tables reloaded in stages, ids continued from a ledger."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from test_end_to_end import STOPS, _feed
from test_schedule_text import DUMP
from tramflow.operators import LastChange, LastValue, Number, Previous, mark_keep_first, segmented_scan
from tramflow.operators.cellindex import CellIndex, candidates, cell_index
from tramflow.functions.geo import haversine_m
from tramflow.plans import delays, jobs, loads
from tramflow.plans import driver_views as dv
from tramflow.plans.reference_import import run_import
from tramflow.sources.readers import read_pings
from tramflow.sources.sinks import publish, read_published
from tramflow.streaming import load_snapshots
from tramflow.streaming.gps_stream import last_id_before

FACT = "StopNo int, VehicleNumber string, Date date, DepTime string, Delay int"


def day(n):
    return dt.date(2024, 1, n)


def test_replaced_days_keep_no_old_rows_and_touch_no_other_day(spark, scratch):
    path = f"{scratch}/fact"
    rows = lambda *days: spark.createDataFrame([(d, "v", day(d), "08:00:00", k) for d in days for k in range(2)], FACT)
    assert jobs.replace_days(rows(1, 2, 3, 4), path, day(1), day(4)) == 8
    assert jobs.replace_days(rows(1, 3), path, day(2), day(3)) == 2  # day 2 has no rows now, and day 1 is not the job's
    found = Counter(r.Date.day for r in jobs.read_fact(spark, path).collect())
    assert found == {1: 2, 3: 2, 4: 2}
    assert jobs.replace_days(rows(), path, day(1), day(4)) == 0
    assert jobs.read_fact(spark, path).count() == 0


def test_one_day_again_gives_the_fact_of_all_days(spark, scratch):
    pings, given = dv.pings(spark, SF001), jobs.DelayInputs(dv.route_stops(spark, SF001), dv.timetable(spark, SF001), dv.calendar_raw(spark, SF001))
    first, last = jobs.day_bounds(pings)
    jobs.delay_days(pings, given, f"{scratch}/fact", first, last)
    whole = Counter(map(tuple, jobs.read_fact(spark, f"{scratch}/fact").collect()))
    middle = first + (last - first) / 2
    n = jobs.delay_days(pings, given, f"{scratch}/fact", middle, middle)
    assert Counter(map(tuple, jobs.read_fact(spark, f"{scratch}/fact").collect())) == whole and n == sum(v for r, v in whole.items() if r[2] == middle)
    direct = delays.delay_fact(delays.run_delays(pings, *given))
    assert Counter(map(tuple, direct.collect())) == whole
    pruned = jobs.read_fact(spark, f"{scratch}/fact").filter(F.col("Date") == F.lit(middle))
    assert "PartitionFilters: [isnotnull(Date" in pruned._jdf.queryExecution().toString()


def test_delays_from_imported_collections(spark, scratch, tmp_path):
    import json

    (tmp_path / "dump.txt").write_bytes(DUMP.encode("iso-8859-1"))
    (tmp_path / "stops.json").write_text(json.dumps(_feed(STOPS)))
    run_import(spark, str(tmp_path / "dump.txt"), str(tmp_path / "stops.json"), f"{scratch}/c")
    given = jobs.collection_inputs(spark, f"{scratch}/c")
    timetable = spark.read.parquet(f"{scratch}/c/Timetable")
    first = timetable.filter("dep_sec < 80000").orderBy("dep_sec").first()
    stop = given.route_stops.filter((F.col("stop_nr") == first.unit + first.post) & (F.col("line_nr") == first.line)).first()
    when = [r.day for r in delays.calendar(given.calendar_raw).filter(F.col("DayType") == first.day_type).collect()][0]
    seen = dt.datetime.combine(when, dt.time()) + dt.timedelta(seconds=first.dep_sec + 60)
    ping = {"Lines": first.line, "Lon": stop.Lon, "Lat": stop.Lat, "VehicleNumber": "7", "Brigade": "1", "Time": f"{seen:%Y-%m-%d %H:%M:%S}"}
    (tmp_path / "ping.json").write_text(json.dumps({"result": [ping]}))
    pings = read_pings(spark, str(tmp_path / "ping.json"))
    jobs.delay_days(pings, given, f"{scratch}/fact", seen.date(), seen.date())
    rows = jobs.read_fact(spark, f"{scratch}/fact").collect()
    assert (int(stop.stop_nr), "7", seen.date(), 60) in {(r.StopNo, r.VehicleNumber, r.Date, r.Delay) for r in rows}
    # a timetable that has its departures as text alone
    as_text = given._replace(timetable=jobs.inputs.timetable_stops(timetable.drop("dep_sec")))
    assert as_text.timetable.filter("dep_sec IS NULL").count() == 0


def test_a_failing_publication_leaves_the_old_rows(spark, scratch):
    path = f"{scratch}/table"
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish(spark.range(5), path)
    old = read_published(spark, path)
    with pytest.raises(Exception, match="no more"):
        publish(spark.range(9).withColumn("x", F.raise_error(F.lit("no more"))), path)
    assert read_published(spark, path).count() == 5
    publish(spark.range(7).filter("id < 0"), path)  # empty: the schema is kept with the pointer
    assert read_published(spark, path).columns == ["id"] and read_published(spark, path).count() == 0
    assert old.count() == 5


def test_tables_are_reloaded_with_short_keys_padded(spark, scratch):
    schema = "unit string, post string, unit_name string, street_id int, latitude double, longitude double, direction string"
    stops = spark.createDataFrame([("7", "1", "a", 1, 1.0, 2.0, "n"), ("0007", "01", "b", 1, 1.0, 2.0, "n"), ("1002", "02", "c", 1, 1.0, 2.0, "s"), ("R001", "1", "d", 1, 1.0, 2.0, "s"), (None, "1", "e", 1, 1.0, 2.0, "s")], schema)
    stop = "struct<stop_nr:string,stop_name:string,street:string,r_flag:boolean,min_time:int,max_time:int>"
    routes = spark.createDataFrame([("1", 1, [("TP", 2, [("000701", "a", "", False, 0, 1), ("999901", "x", "", False, 1, 2)])])], f"line_nr string, number_of_routes int, routes array<struct<route_nr:string,number_of_stops:int,stops:array<{stop}>>>")
    timetable = spark.createDataFrame([("1", "TP", "DP", "7", "1", "08:00:00", 0), ("1", "TP", "DP", "9", "9", "08:00:00", 1)], "line string, route string, day_type string, unit string, post string, departure_time string, `order` int")
    for _ in range(2):
        counts = jobs.reload_tables(stops, routes, timetable, f"{scratch}/db", dt.datetime(2024, 5, 1))
        assert counts == {"stops": (2, 2), "routes": (1, 0), "route_variants": (1, 1), "timetables": (1, 1)}
    got = read_published(spark, f"{scratch}/db/stops").filter("accepted").orderBy("id").collect()
    assert [(r.id, r.unit, r.post, r.full_name, r.created_at) for r in got] == [(701, "0007", "01", "a", dt.datetime(2024, 5, 1)), (100202, "1002", "02", "c", dt.datetime(2024, 5, 1))]
    assert read_published(spark, f"{scratch}/db/timetables").filter("accepted").first().stop_id == 701


def test_ids_go_on_from_the_ledger(spark, scratch):
    pings = dv.pings(spark, SF001)
    source = f"{scratch}/in"
    spark.createDataFrame([], pings.schema).write.parquet(source)
    stream = spark.readStream.schema(pings.schema).parquet(source)

    def deliver(part):
        part.write.mode("append").parquet(source)
        q = load_snapshots(stream, f"{scratch}/db", f"{scratch}/ck")
        q.awaitTermination()
        assert q.exception() is None

    sizes = []
    for k in range(3):
        part = pings.filter(F.hour("Time") % 3 == k)
        sizes.append(part.count())
        deliver(part)
    trams = spark.read.parquet(f"{scratch}/db/trams")
    assert sorted(r.id for r in trams.collect()) == list(range(1, sum(sizes) + 1))
    ledger = f"{scratch}/db/id_ledger"
    rows = spark.read.json(ledger).orderBy("batch_id").collect()
    assert [(r.first_id, r.max_id) for r in rows] == [(1 + sum(sizes[:k]), sum(sizes[: k + 1])) for k in range(3)]
    assert last_id_before(spark, ledger, 0) == 0 and last_id_before(spark, ledger, 2) == sum(sizes[:2])
    assert last_id_before(spark, ledger, 9) == sum(sizes)  # batches that left no row
    assert last_id_before(spark, f"{scratch}/none", 3) == 0


def test_segmented_scans_equal_the_plain_scan(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), rng.choice([None, 1, 2]), k, rng.choice([None, "x", "y"])) for k in range(600)]
    df = spark.createDataFrame(rows, "g string, h int, t int, v string").repartition(7)
    scans = {"nr": Number(), "prev": Previous("v"), "last": LastValue("v"), "changed": LastChange("v")}
    for width in (1, 7, 1000):
        got = segmented_scan(df, ["g", "h"], ["t"], F.floor(F.col("t") / width), scans).collect()
        groups, want = defaultdict(list), {}
        for g, h, t, v in rows:
            seen = groups[g, h]
            prev = seen[-1] if seen else None
            seen.append(v)
            marks = [a for a, b in zip([None, *seen], seen) if a is not None and b is not None and a != b]
            full = [x for x in seen if x is not None]
            want[t] = (g, h, v, len(seen), prev, full[-1] if full else None, marks[-1] if marks else None)
        assert {r.t: (r.g, r.h, r.v, r.nr, r.prev, r.last, r.changed) for r in got} == want
    spread = segmented_scan(df, ["g", "h"], ["t"], F.floor(F.col("t") / 7), scans)._jdf.queryExecution().toString()
    assert "Window" in spread and "exceptAll" not in spread


def test_first_of_each_key_by_counts(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "p", "q"]), rng.choice([None, 0.5, float("nan")])) for _ in range(80)]
    marked = mark_keep_first(spark.createDataFrame(rows, "k int, o string, x double"), ["k"], ["o"])
    got = marked.collect()
    text = lambda r: tuple(str(c) for c in r)
    assert Counter(text(r[:3]) for r in got) == Counter(map(text, rows))
    order = lambda r: tuple((c is not None, "z" if c != c else str(c)) for c in (r[1], r[2]))
    for key in (None, 1, 2, 3):
        won = [r for r in got if r.k == key and r.accepted]
        assert len(won) == 1 and order(won[0]) == min(order(r) for r in rows if r[0] == key)
    plan = loads.mark_stops(dv.stops_feed(spark, SF001))._jdf.queryExecution().toString()
    assert "Except" not in plan and "Union" not in plan


@pytest.mark.parametrize("spread", [0.05, 20.0])
def test_cell_candidates_hold_the_nearest(spark, spread):
    rng = random.Random(9)
    at = lambda: (21 + rng.uniform(-spread, spread), 52 + rng.uniform(-spread, spread))
    stops = [(f"l{k % 3}", k, *at()) for k in range(150)] + [("l0", 900, None, 52.0), ("l0", 901, 21.5, 52.5), ("l0", 902, 21.5, 52.5)]
    pings = [(k, f"l{k % 4}", *at()) for k in range(400)] + [(k, "l0", 21 + rng.uniform(-90, 90), rng.uniform(-89, 89)) for k in range(400, 460)] + [(500, "l1", None, 1.0), (501, "l0", 21.5, 52.5)]
    s = spark.createDataFrame(stops, "line string, stop int, sx double, sy double")
    p = spark.createDataFrame(pings, "id int, l string, x double, y double")
    index = CellIndex(*[part.persist() for part in cell_index(s, "line", "sx", "sy")])
    d = haversine_m("x", "y", "sx", "sy")
    best = F.min(F.struct(d.alias("d"), "stop")).alias("b")
    got = candidates(p, index, "line", "l", "x", "y", lambda df: df)
    want = p.join(s.filter("sx IS NOT NULL"), F.col("l") == F.col("line")).filter("x IS NOT NULL").groupBy("id").agg(best)
    assert {tuple(r) for r in got.groupBy("id").agg(best).collect()} == {tuple(r) for r in want.collect()}
    assert index.cells.count() > 0


def test_stops_without_minutes_follow_their_place(spark):
    rows = [("1", "TP", nr, nr.upper(), 0, at) for at, nr in enumerate(["c", "a", "b"])]
    on_route = spark.createDataFrame(rows, "line_nr string, route_nr string, stop_nr string, StopName string, min_time int, pos int")
    before = {r.stop_nr: r.PrevCorrected for r in delays.routes_order(on_route).collect()}
    assert before == {"c": None, "a": "C", "b": "A"}
    assert {r.stop_nr: r.PrevCorrected for r in delays.routes_order(on_route.drop("pos")).collect()} == {"a": None, "b": "A", "c": "B"}
