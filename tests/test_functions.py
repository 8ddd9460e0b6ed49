import datetime as dt
import math

from pyspark.sql import functions as F

from tramflow.functions import (
    day_type,
    departure_seconds,
    haversine_m,
    hms_to_seconds,
    line_name,
    null_literal,
    numeric_stop_id,
    seconds_to_hms,
    split_stop_key,
    stop_key,
)
from tramflow.functions.geo import outside_block_bound_m


def py_haversine(lon_a, lat_a, lon_b, lat_b):
    lon_a, lat_a, lon_b, lat_b = map(math.radians, [lon_a, lat_a, lon_b, lat_b])
    a = math.sin((lat_b - lat_a) / 2) ** 2 + math.cos(lat_a) * math.cos(lat_b) * math.sin((lon_b - lon_a) / 2) ** 2
    return abs(round(2 * math.asin(math.sqrt(a)) * 6371000, 2))


def test_haversine_matches_python_formula(spark):
    pts = [(21.0, 52.2, 21.01, 52.21), (20.9, 52.1, 21.1, 52.3), (0.0, 0.0, 0.0, 0.0), (-179.9, 10.0, 179.9, 10.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_m("a", "b", "c", "d")).collect()]
    assert got == [py_haversine(*p) for p in pts]


def test_haversine_null_in_null_out(spark):
    df = spark.createDataFrame([(None, 52.0, 21.0, 52.0)], "a double, b double, c double, d double")
    assert df.select(haversine_m("a", "b", "c", "d")).first()[0] is None


def test_outside_bound_is_a_lower_bound(spark):
    # every point outside the 3x3 block is at least the bound away
    import random

    rnd = random.Random(7)
    c = 0.05
    rows = []
    for _ in range(300):
        lat = rnd.uniform(-80, 80)
        lon = rnd.uniform(-179.9, 179.9)
        cy, cx = math.floor(lat / c), math.floor(lon / c)
        # a point just outside the block on a random side
        side = rnd.choice(["n", "s", "e", "w"])
        lat2 = {"n": (cy + 2) * c + 1e-6, "s": (cy - 1) * c - 1e-6}.get(side, lat + rnd.uniform(-c, c))
        lon2 = {"e": (cx + 2) * c + 1e-6, "w": (cx - 1) * c - 1e-6}.get(side, lon + rnd.uniform(-c, c))
        rows.append((lon, lat, lon2, lat2))
    df = spark.createDataFrame(rows, "lon double, lat double, lon2 double, lat2 double")
    out = df.select(outside_block_bound_m("lon", "lat", c).alias("b"), haversine_m("lon", "lat", "lon2", "lat2").alias("d"))
    assert out.filter("d + 0.01 < b").count() == 0


def test_service_day_seconds_and_text(spark):
    df = spark.createDataFrame([("06.15",), ("24.05",), ("25.10",), ("bad",), ("7:03:09",)], "t string")
    got = df.select(departure_seconds("t").alias("s")).select("s", seconds_to_hms("s").alias("h")).collect()
    assert [tuple(r) for r in got] == [
        (22500, "06:15:00"), (86700, "00:05:00"), (90600, "01:10:00"), (None, None), (25389, "07:03:09"),
    ]
    assert df.select(hms_to_seconds(F.lit("23:59:59"))).first()[0] == 86399


def test_stop_keys(spark):
    df = spark.createDataFrame([("12", "1"), ("0123", "02"), ("R001", "01"), ("12345", "03")], "u string, p string")
    keys = [r[0] for r in df.select(stop_key("u", "p")).collect()]
    assert keys == ["001201", "012302", "R00101", "1234503"]
    unit, post = split_stop_key(F.lit("012302"))
    assert tuple(spark.range(1).select(unit, post).first()) == ("0123", "02")
    ids = [r[0] for r in df.select(numeric_stop_id("u", "p")).collect()]
    assert ids == [121, 12302, None, 1234503]
    assert spark.range(1).select(line_name(F.lit("17"), F.lit("TP-A"))).first()[0] == "17TP-A"


def test_day_type_priority(spark):
    rows = [(["D5", "N5", "DP"],), (["D7", "N7", "TS"],), (["D6", "SB"],), (["TS"],), (["DP", "SB"],), (None,)]
    df = spark.createDataFrame(rows, "t array<string>")
    assert [r[0] for r in df.select(day_type("t")).collect()] == ["DP", "DS", "SB", "Unknown", "DP", "Unknown"]


def test_null_literal(spark):
    df = spark.createDataFrame([("null",), ("12",), (None,)], "v string")
    assert [r[0] for r in df.select(null_literal("v").try_cast("int")).collect()] == [None, 12, None]


def test_band_bound_wraps_only_in_text(spark):
    from tramflow.functions.timeofday import band_bound

    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 0, 5, 0),)], "t timestamp_ntz")
    assert df.select(band_bound("t", -600), band_bound("t", 180)).first() == ("23:55:00", "00:08:00")
