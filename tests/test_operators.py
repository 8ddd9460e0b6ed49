import datetime as dt
import math
import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from tramflow.operators import (
    assemble,
    band_join,
    dedupe_keep_first,
    drop_nested,
    load_counts,
    max_id,
    nearest_match,
    previous_distinct,
    split_foreign_key,
    split_not_null,
    unwind,
    with_dense_ids,
)


def py_dist(lon_a, lat_a, lon_b, lat_b):
    lon_a, lat_a, lon_b, lat_b = map(math.radians, [lon_a, lat_a, lon_b, lat_b])
    a = math.sin((lat_b - lat_a) / 2) ** 2 + math.cos(lat_a) * math.cos(lat_b) * math.sin((lon_b - lon_a) / 2) ** 2
    return abs(round(2 * math.asin(math.sqrt(a)) * 6371000, 2))


T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def _nearest(spark, pings, stops, **kw):
    p = spark.createDataFrame(pings, "Lines string, Brigade string, Time timestamp_ntz, VehicleNumber string, Lon double, Lat double")
    s = spark.createDataFrame(stops, "line_nr string, stop_nr string, s_Lon double, s_Lat double")
    return nearest_match(
        p, s, on=[("Lines", "line_nr")], left_xy=("Lon", "Lat"), right_xy=("s_Lon", "s_Lat"),
        group_by=["Lines", "Brigade", "Time"], right_cols=["stop_nr"],
        left_cols=["Lines", "Brigade", "Time", "VehicleNumber", "Lat", "Lon"],
        right_order=["stop_nr"], left_order=["VehicleNumber", "Lat", "Lon"], **kw,
    )


def test_nearest_hand_computed(spark):
    stops = [("1", "A", 21.00, 52.20), ("1", "B", 21.01, 52.20), ("2", "C", 21.00, 52.20)]
    pings = [
        ("1", "1", T0, "v1", 21.009, 52.2),   # closer to B
        ("1", "2", T0, "v2", 21.001, 52.2),   # closer to A
        ("2", "1", T0, "v3", 21.5, 52.5),     # only C on line 2, far away -> fallback path
        ("3", "1", T0, "v4", 21.0, 52.2),     # no stops on line 3 -> dropped
        ("1", "3", T0, "v5", None, 52.2),     # NULL coordinate -> dropped
    ]
    got = {r["VehicleNumber"]: r["stop_nr"] for r in _nearest(spark, pings, stops, cell_deg=0.005).collect()}
    assert got == {"v1": "B", "v2": "A", "v3": "C"}


def test_nearest_tie_breaks_on_stop_then_vehicle(spark):
    stops = [("1", "B", 21.01, 52.20), ("1", "A", 20.99, 52.20)]  # equidistant from 21.00
    pings = [("1", "1", T0, "v9", 21.0, 52.2), ("1", "1", T0, "v1", 21.0, 52.2)]  # same group, two vehicles
    rows = _nearest(spark, pings, stops, cell_deg=0.02).collect()
    assert len(rows) == 1 and rows[0]["stop_nr"] == "A" and rows[0]["VehicleNumber"] == "v1"


def test_nearest_grid_equals_brute_force(spark):
    rnd = random.Random(3)
    stops = [(str(i % 3), f"s{i:03d}", 21 + rnd.random() * 0.3, 52.1 + rnd.random() * 0.2) for i in range(60)]
    pings = [(str(i % 3), str(i % 4), T0 + dt.timedelta(seconds=i // 7), f"v{i % 11}",
              20.9 + rnd.random() * 0.5, 52.0 + rnd.random() * 0.4) for i in range(400)]
    expect = {}
    for ln, br, t, v, lon, lat in pings:
        for sl, sn, slon, slat in stops:
            if sl != ln:
                continue
            key = (py_dist(lon, lat, slon, slat), sn, v, lat, lon)
            g = (ln, br, t)
            if g not in expect or key < expect[g]:
                expect[g] = key
    for cell in (None, "auto", 0.003, 0.02, 0.2):
        extra = {"grid_min_candidates": 0} if cell == "auto" else {}
        got = {(r["Lines"], r["Brigade"], r["Time"]): (r["distance"], r["stop_nr"], r["VehicleNumber"], r["Lat"], r["Lon"])
               for r in _nearest(spark, pings, stops, cell_deg=cell, **extra).collect()}
        assert got == expect, cell


def test_nearest_max_distance(spark):
    stops = [("1", "A", 21.0, 52.2)]
    pings = [("1", "1", T0, "near", 21.0001, 52.2), ("1", "2", T0, "far", 21.1, 52.2)]
    got = [r["VehicleNumber"] for r in _nearest(spark, pings, stops, max_distance=100.0).collect()]
    assert got == ["near"]


def test_band_join_strict_bounds_and_buckets(spark):
    left = spark.createDataFrame([("u", 1000)], "k string, t int")
    deps = [390, 400, 401, 999, 1000, 1179, 1180, 1181]
    right = spark.createDataFrame([("u", d) for d in deps] + [("x", 1000)], "k2 string, dt int")
    for bucket in (None, 800, 5000):
        got = sorted(r["dt"] for r in band_join(left, right, [("k", "k2")], "t", "dt", 600, 180, bucket).collect())
        assert got == [401, 999, 1000, 1179], bucket


def test_band_join_brute_force(spark):
    rnd = random.Random(5)
    left = [(str(rnd.randrange(3)), rnd.randrange(0, 100000)) for _ in range(300)]
    right = [(str(rnd.randrange(3)), rnd.randrange(0, 100000)) for _ in range(3000)]
    expect = sorted((a, t, b) for a, t in left for k, b in right if k == a and t - 600 < b < t + 180)
    ldf = spark.createDataFrame(left, "k string, t int")
    rdf = spark.createDataFrame(right, "k2 string, dt int")
    got = sorted((r["k"], r["t"], r["dt"]) for r in band_join(ldf, rdf, [("k", "k2")], "t", "dt").collect())
    assert got == expect


def _prev_py(values):
    out, prev_run, last = [], None, object()
    current = None
    for i, v in enumerate(values):
        if i > 0 and v is not None and values[i - 1] is not None and v != values[i - 1]:
            current = values[i - 1]
        out.append(current)
    return out


def test_previous_distinct_chunked_equals_plain(spark):
    rnd = random.Random(11)
    rows = []
    for g in range(5):
        vals = [rnd.choice(["A", "B", "C", None]) if rnd.random() < 0.1 else rnd.choice(["A", "B", "C"]) for _ in range(120)]
        # runs of equal values
        seq = []
        for v in vals:
            seq.extend([v] * rnd.randint(1, 3))
        for i, v in enumerate(seq):
            rows.append((f"g{g % 3}", g, i, v))
    df = spark.createDataFrame(rows, "p string, q int, t int, v string")
    plain = previous_distinct(df, "v", ["p", "q"], ["t"], out="pv")
    chunked = previous_distinct(df, "v", ["p", "q"], ["t"], out="pv", split_by=F.floor(F.col("t") / 7))
    a = sorted(tuple(r) for r in plain.select("p", "q", "t", "pv").collect())
    b = sorted(tuple(r) for r in chunked.select("p", "q", "t", "pv").collect())
    assert a == b
    by_group = {}
    for p, q, t, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_group.setdefault((p, q), []).append(v)
    expect = sorted((p, q, i, pv) for (p, q), vs in by_group.items() for i, pv in enumerate(_prev_py(vs)))
    assert a == expect


def test_previous_distinct_first_stop_null_and_group_boundary(spark):
    rows = [("v1", 1, "X"), ("v1", 2, "X"), ("v1", 3, "Y"), ("v1", 4, "Y"), ("v1", 5, "Z"), ("v2", 1, "Q"), ("v2", 2, "X")]
    df = spark.createDataFrame(rows, "veh string, t int, stop string")
    got = {(r["veh"], r["t"]): r["prev"] for r in previous_distinct(df, "stop", ["veh"], ["t"], out="prev").collect()}
    assert got == {("v1", 1): None, ("v1", 2): None, ("v1", 3): "X", ("v1", 4): "X", ("v1", 5): "Y",
                   ("v2", 1): None, ("v2", 2): "Q"}


def test_dedupe_invariants(spark):
    rows = [(1, "a", 5), (1, "b", 3), (2, "c", 1), (2, "c", 1), (3, "d", 0), (None, "e", 1), (None, "f", 0)]
    df = spark.createDataFrame(rows, "id int, name string, v int")
    split = dedupe_keep_first(df, ["id"], ["v", "name"])
    acc = sorted((tuple(r) for r in split.accepted.collect()), key=repr)
    rej = sorted((tuple(r) for r in split.rejected.collect()), key=repr)
    assert acc == sorted([(1, "b", 3), (2, "c", 1), (3, "d", 0), (None, "f", 0)], key=repr)
    assert rej == sorted([(1, "a", 5), (2, "c", 1), (None, "e", 1)], key=repr)
    c = load_counts(split).first()
    assert c["accepted"] + c["rejected"] == df.count()
    assert split.accepted.select("id").distinct().count() == split.accepted.count()


def test_not_null_and_foreign_key(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,), (12,)], "pk int")
    nn = split_not_null(child, ["fk"])
    assert sorted(r["id"] for r in nn.rejected.collect()) == [3]
    fk = split_foreign_key(child, parent, "fk", "pk")
    assert sorted(r["id"] for r in fk.accepted.collect()) == [1, 2, 3]
    assert sorted(r["id"] for r in fk.rejected.collect()) == [4]
    strict = split_foreign_key(child, parent, "fk", "pk", null_passes=False)
    assert sorted(r["id"] for r in strict.rejected.collect()) == [3, 4]


def test_dense_ids_continue_from_offset(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k")).repartition(13)
    out = with_dense_ids(df, ["k"], "id", start=41)
    rows = sorted((r["k"], r["id"]) for r in out.collect())
    assert [i for _, i in rows] == list(range(42, 5042))
    assert max_id(out, "id").first()[0] == 5041
    assert max_id(out.filter("id < 0"), "id").first()[0] == 0


def test_nested_roundtrip(spark):
    rows = [Row(o=1, r="A", pos=2, s="x"), Row(o=1, r="A", pos=1, s="y"), Row(o=1, r="B", pos=1, s="z"),
            Row(o=2, r="A", pos=1, s="w")]
    df = spark.createDataFrame(rows)
    routes = assemble(df, ["o", "r"], ["s", "pos"], ["pos"], "stops", count_col="n")
    docs = assemble(routes, ["o"], ["r", "n", "stops"], ["r"], "routes")
    d1 = docs.filter("o = 1").first()
    assert [x["r"] for x in d1["routes"]] == ["A", "B"]
    assert [s["s"] for s in d1["routes"][0]["stops"]] == ["y", "x"]
    flat = unwind(unwind(docs, "routes", "rt").select("o", F.col("rt.r").alias("r"), F.col("rt.stops").alias("stops")),
                  "stops", "st", position="seq")
    got = sorted((r["o"], r["r"], r["seq"], r["st"]["s"]) for r in flat.collect())
    assert got == [(1, "A", 1, "y"), (1, "A", 2, "x"), (1, "B", 1, "z"), (2, "A", 1, "w")]
    slim = drop_nested(routes, "stops", ["pos"])
    assert slim.schema["stops"].dataType.elementType.fieldNames() == ["s"]


def test_nearest_grid_on_stops_along_one_street(spark):
    # all stops on one parallel: the bounding box has no area
    stops = [("1", f"s{i:03d}", 21.0 + i * 0.002, 52.2) for i in range(100)]
    rnd = random.Random(9)
    pings = [("1", str(i % 3), T0 + dt.timedelta(seconds=i), f"v{i}", 21.0 + rnd.random() * 0.2,
              52.2 + (rnd.random() - 0.5) * 0.01) for i in range(200)]
    grid = _nearest(spark, pings, stops, cell_deg="auto", grid_min_candidates=0)
    plain = _nearest(spark, pings, stops, cell_deg=None)
    assert sorted(tuple(r) for r in grid.collect()) == sorted(tuple(r) for r in plain.collect())


def test_band_join_left_keeps_null_times(spark):
    left = spark.createDataFrame([("u", 1000), ("u", None)], "k string, t int")
    right = spark.createDataFrame([("u", 999)], "k2 string, dt int")
    got = sorted(((r["t"] is None, r["dt"]) for r in band_join(left, right, [("k", "k2")], "t", "dt", how="left").collect()), key=repr)
    assert got == sorted([(False, 999), (True, None)], key=repr)


def test_band_join_left_matches_brute_force(spark):
    rnd = random.Random(6)
    left = [(str(rnd.randrange(2)), rnd.randrange(0, 20000)) for _ in range(200)] + [("0", None)]
    right = [(str(rnd.randrange(2)), rnd.randrange(0, 20000)) for _ in range(300)]
    expect = []
    for a, t in left:
        hits = [b for k, b in right if t is not None and k == a and t - 600 < b < t + 180]
        expect += [(a, t, b) for b in hits] or [(a, t, None)]
    ldf = spark.createDataFrame(left, "k string, t int")
    rdf = spark.createDataFrame(right, "k2 string, dt int")
    got = [(r["k"], r["t"], r["dt"]) for r in band_join(ldf, rdf, [("k", "k2")], "t", "dt", how="left").collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr)
