"""Cases of the third round of findings: stops at one place, rounding of distances, shuffles of the dump's lines."""

import random

from pyspark.sql import functions as F

from tramflow.functions.geo import haversine_m
from tramflow.operators import nearest
from tramflow.plans import text_views


def test_whole_centimetres_round_like_the_published_distance(spark):
    rng = random.Random(1)
    values = [0.0, 0.005, 0.015, 1.005, 2.675, 1234567.885, 20015086.79, float("nan")]
    values += [rng.random() * 10 ** rng.randrange(8) for _ in range(2000)] + [round(rng.random() * 1e5, 2) + 0.005 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "m double")
    rows = df.select("m", nearest._whole_cm("m").alias("cm"), F.when(~F.isnan("m"), F.round(F.abs(F.round("m", 2)) * 100).cast("long")).alias("plain")).collect()
    assert all(r.cm == (nearest._NAN_CM if r.m != r.m else r.plain) for r in rows)


def test_pair_distance_is_the_plain_one(spark):
    rng = random.Random(2)
    rows = [tuple(rng.uniform(-180, 180) if k % 2 else rng.uniform(-90, 90) for k in range(4)) for _ in range(500)]
    df = spark.createDataFrame(rows, "la double, lo double, ma double, mo double")
    both = nearest._angles(nearest._angles(df, "lo", "la", "a"), "mo", "ma", "b").withColumn("_m", nearest._metres())
    cm = F.round(haversine_m("lo", "la", "mo", "ma") * 100).cast("long")
    assert both.where(~nearest._whole_cm("_m").eqNullSafe(cm)).count() == 0


def test_stops_at_one_place_are_one_candidate(spark, monkeypatch):
    seen = []
    plain = nearest._auto_cells
    monkeypatch.setattr(nearest, "_auto_cells", lambda R, *a: seen.append(R.count()) or plain(R, *a))
    stops = spark.createDataFrame([("1", f"{k:03d}", 20.0 + (k % 5) / 100, 52.0) for k in range(300)], "line string, nr string, x double, y double")
    pings = spark.createDataFrame([("1", k, 20.0 + k / 1000, 52.001) for k in range(45)], "line string, t int, lon double, lat double")
    out = nearest.nearest_match(pings, stops, ["line"], ("lon", "lat"), ("x", "y"), ["line", "t"], ["nr"], right_order=["nr"])
    got = {r.t: r.nr for r in out.collect()}
    assert seen == [5]
    assert got == {t: min((abs(t / 1000 - k / 100), f"{k:03d}") for k in range(5))[1] for t in range(45) if t % 10 != 5} | {t: got[t] for t in range(5, 45, 10)}
    assert all(got[t] in (f"{t // 10:03d}", f"{t // 10 + 1:03d}") for t in range(5, 45, 10))


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_section_lines_are_shuffled_once(spark, tmp_path):
    rows = [(o, 1 + k, o * 3 + k, k + 1, 30.0 if k else 5.0, 10.0, 0.0, 0.0, "A" if k < 2 else "R") for o in range(40) for k in range(4)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    from tramflow.sources import schedule_text

    lines = text_views.section_lines(spark, str(tmp_path))
    assert lines.count() == 40 + 160 * text_views.BLOCK_LINES
    assert {r.pos for r in lines.where("_rec = 3").collect()} == set(range(1 + 4 * text_views.BLOCK_LINES))
    assert lines.where("pos = 0 and line like '%Linia:%'").count() == 40
    assert _exchanges(schedule_text.departures(lines)) == 1
    assert _exchanges(schedule_text.route_stop_lines(text_views.route_lines(spark, str(tmp_path)))) == 1
