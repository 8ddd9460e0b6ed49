"""Stream = batch on the same pings (T1-T5) and the idempotent state load."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import SF001
from tramflow.plans import delays
from tramflow.plans import driver_views as dv
from tramflow.streaming import dedupe_pings, load_snapshots, ping_stream, stream_delays, stream_nearest

FMT = "%Y-%m-%d %H:%M:%S"


def _write_snapshots(spark, folder, n_files=6):
    """Snapshot files from the sf0.001 pings; each file repeats the last 5
    pings of the previous one (a repeated ping), plus a final far-later ping
    that moves the watermark past every real ping."""
    pings = sorted((tuple(r) for r in dv.pings(spark, SF001).collect()), key=lambda r: (r[3], r[0]))
    size = len(pings) // n_files + 1
    chunks = [pings[i * size:(i + 1) * size] for i in range(n_files)]
    os.makedirs(folder, exist_ok=True)
    for i, chunk in enumerate(chunks):
        rows = (chunks[i - 1][-5:] if i else []) + chunk
        result = [{"VehicleNumber": v, "Lines": ln, "Brigade": b, "Time": t.strftime(FMT), "Lon": lon, "Lat": lat}
                  for v, ln, b, t, lon, lat in rows]
        with open(os.path.join(folder, f"snap_{i:03d}.json"), "w") as f:
            json.dump({"result": result}, f, indent=1)
    last = max(p[3] for p in pings) + dt.timedelta(days=2)
    with open(os.path.join(folder, f"snap_{n_files:03d}.json"), "w") as f:
        json.dump({"result": [{"VehicleNumber": "sentinel", "Lines": "0", "Brigade": "0", "Time": last.strftime(FMT),
                               "Lon": 21.0, "Lat": 52.2}]}, f)
    return pings, last


def _run(query):
    query.awaitTermination(300)
    assert query.exception() is None


def test_stream_equals_batch(spark, scratch):
    snaps = os.path.join(scratch, "in")
    archive = os.path.join(scratch, "archive")
    pings, last = _write_snapshots(spark, snaps)
    stream = dedupe_pings(ping_stream(spark, snaps, max_files_per_trigger=1, archive_dir=archive))
    cands = delays.stop_candidates(dv.route_stops(spark, SF001))
    near = stream_nearest(stream.drop("CurrTramTime", "DateText"), cands)
    out = os.path.join(scratch, "near")
    q = (near.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(scratch, "ck1")).outputMode("append")
         .trigger(availableNow=True).start())
    _run(q)
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    batch = delays.trams_stops(dv.pings(spark, SF001), dv.route_stops(spark, SF001))
    want = {tuple(r) for r in batch.select("Lines", "Brigade", "Time", "VehicleNumber", "Lat", "Lon",
                                           F.lit(None).cast("string").alias("stop_nr"), "StopName", "Unit",
                                           "distance").collect()}
    got_cmp = {r[:6] + (None,) + r[7:] for r in got}
    assert got_cmp == want
    # processed snapshot files were archived (files of the last batch stay until the next run)
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".json")]
    assert len(archived) >= 1
    assert len(archived) + len(os.listdir(snaps)) == 7


def test_stream_delays_match_batch(spark, scratch):
    snaps = os.path.join(scratch, "in")
    _write_snapshots(spark, snaps)
    stream = dedupe_pings(ping_stream(spark, snaps, max_files_per_trigger=2))
    cands = delays.stop_candidates(dv.route_stops(spark, SF001))
    res = stream_delays(stream_nearest(stream.drop("CurrTramTime", "DateText"), cands),
                        dv.timetable(spark, SF001), delays.calendar(dv.calendar_raw(spark, SF001)))
    out = os.path.join(scratch, "delays")
    q = (res.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(scratch, "ck2")).outputMode("append")
         .trigger(availableNow=True).start())
    _run(q)
    cols = ["Lines", "VehicleNumber", "Date", "CurrTramTime", "StopNo", "DepTime", "Route", "Order", "Delay"]
    got = {tuple(r) for r in spark.read.parquet(out).select(*cols).collect()}
    batch = delays.delay_matches(delays.trams_stops(dv.pings(spark, SF001), dv.route_stops(spark, SF001)),
                                 dv.timetable(spark, SF001), delays.calendar(dv.calendar_raw(spark, SF001)))
    want = {tuple(r) for r in batch.select(*cols).collect()}
    assert got == want and len(want) > 0


def test_state_load_idempotent(spark, scratch):
    snaps = os.path.join(scratch, "in")
    pings, _ = _write_snapshots(spark, snaps, n_files=3)
    target = os.path.join(scratch, "db")
    total = sum(len(json.load(open(os.path.join(snaps, f)))["result"]) for f in os.listdir(snaps))
    for run in range(2):  # a second run from a fresh checkpoint replays the same batches
        stream = ping_stream(spark, snaps, max_files_per_trigger=1).drop("CurrTramTime", "DateText")
        _run(load_snapshots(stream, target, os.path.join(scratch, f"ck{run}")))
        trams = spark.read.parquet(os.path.join(target, "trams"))
        states = spark.read.parquet(os.path.join(target, "tram_states"))
        assert trams.count() == total and states.count() == total
        assert sorted(r["id"] for r in trams.select("id").collect()) == list(range(1, total + 1))
        assert states.join(trams, states["tram_id"] == trams["id"], "left_anti").count() == 0
        assert states.filter("stop_state IS NOT NULL OR distance IS NOT NULL OR is_depot IS NOT NULL").count() == 0


def test_late_snapshot_is_dropped(spark, scratch):
    """A snapshot arriving after the watermark passed its pings adds nothing."""
    snaps = os.path.join(scratch, "in")
    os.makedirs(snaps)
    cands = delays.stop_candidates(dv.route_stops(spark, SF001))
    line = cands.select("line_nr").first()[0]

    def write(name, when, veh):
        with open(os.path.join(snaps, name), "w") as f:
            json.dump({"result": [{"VehicleNumber": veh, "Lines": line, "Brigade": "1", "Time": when,
                                   "Lon": 21.0, "Lat": 52.2}]}, f)

    out = os.path.join(scratch, "near")
    ck = os.path.join(scratch, "ck")

    def run_once():
        stream = dedupe_pings(ping_stream(spark, snaps, max_files_per_trigger=1))
        q = (stream_nearest(stream.drop("CurrTramTime", "DateText"), cands).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ck).outputMode("append")
             .trigger(availableNow=True).start())
        _run(q)

    write("a.json", "2024-01-01 08:00:00", "on-time")
    write("b.json", "2024-01-01 09:00:00", "advances-watermark")
    run_once()
    write("c.json", "2024-01-01 08:30:00", "late")  # 30 min behind the 09:00 ping, watermark 10 min
    write("d.json", "2024-01-01 10:00:00", "advances-again")
    run_once()
    got = sorted(r["VehicleNumber"] for r in spark.read.parquet(out).collect())
    assert got == ["advances-watermark", "on-time"]
