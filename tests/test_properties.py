"""Property tests: load invariants on generated inputs, and results that must
not change when one key holds a large share of the rows."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tramflow.operators import (
    dedupe_keep_first,
    load_counts,
    nearest_match,
    previous_distinct,
    split_foreign_key,
    with_dense_ids,
)

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3), st.sampled_from(["a", "b", "c"])),
    min_size=0, max_size=30,
)


@SETTINGS
@given(rows_st)
def test_dedupe_conserves_rows_and_keeps_minimum(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int, s string")
    split = dedupe_keep_first(df, ["k"], ["v", "s"])
    c = load_counts(split).first()
    assert c["accepted"] + c["rejected"] == len(rows)
    acc = [tuple(r) for r in split.accepted.collect()]
    assert len({r[0] for r in acc}) == len(acc)
    for k in {r[0] for r in rows}:
        want = min((r[1], r[2]) for r in rows if r[0] == k)
        assert [(r[1], r[2]) for r in acc if r[0] == k] == [want]


@SETTINGS
@given(rows_st, st.sets(st.integers(0, 4), max_size=5))
def test_foreign_key_split_partitions_child(spark, rows, parents):
    child = spark.createDataFrame(rows, "k int, v int, s string")
    parent = spark.createDataFrame([(p,) for p in parents], "pk int")
    split = split_foreign_key(child, parent, "k", "pk")
    acc = sorted((tuple(r) for r in split.accepted.collect()), key=repr)
    rej = sorted((tuple(r) for r in split.rejected.collect()), key=repr)
    assert sorted(acc + rej, key=repr) == sorted(rows, key=repr)
    assert all(r[0] is None or r[0] in parents for r in acc)
    assert all(r[0] is not None and r[0] not in parents for r in rej)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 50)), min_size=1, max_size=60, unique=True),
       st.integers(0, 1000))
def test_dense_ids_follow_the_order(spark, rows, start):
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = sorted((r["a"], r["b"], r["id"]) for r in with_dense_ids(df, ["a", "b"], "id", start).collect())
    assert [i for _, _, i in got] == list(range(start + 1, start + len(rows) + 1))


def test_hot_vehicle_window_is_split_without_changing_results(spark):
    # one vehicle holds half of all rows; hourly chunks spread it
    rows = []
    for i in range(3000):
        veh = "hot" if i % 2 == 0 else f"v{i % 13}"
        rows.append((veh, i * 7, ["A", "B", "C", "D"][(i // 5) % 4]))
    df = spark.createDataFrame(rows, "veh string, t int, stop string")
    plain = previous_distinct(df, "stop", ["veh"], ["t"], out="p")
    split = previous_distinct(df, "stop", ["veh"], ["t"], out="p", split_by=F.floor(F.col("t") / 600))
    a = sorted(tuple(r) for r in plain.collect())
    b = sorted(tuple(r) for r in split.collect())
    assert a == b


def test_hot_line_nearest_matches_plain_join(spark):
    # one line holds most stops and pings; the grid result equals the plain join
    import random

    rnd = random.Random(1)
    t0 = dt.datetime(2024, 1, 1)
    stops = [("hot" if i < 150 else f"l{i % 3}", f"s{i:04d}", 21 + rnd.random() * 0.2, 52.1 + rnd.random() * 0.2)
             for i in range(200)]
    pings = [("hot" if i % 3 else f"l{i % 3}", "1", t0 + dt.timedelta(seconds=i), f"v{i % 5}",
              21 + rnd.random() * 0.2, 52.1 + rnd.random() * 0.2) for i in range(600)]
    p = spark.createDataFrame(pings, "Lines string, Brigade string, Time timestamp_ntz, VehicleNumber string, Lon double, Lat double")
    s = spark.createDataFrame(stops, "line_nr string, stop_nr string, s_Lon double, s_Lat double")
    kw = dict(on=[("Lines", "line_nr")], left_xy=("Lon", "Lat"), right_xy=("s_Lon", "s_Lat"),
              group_by=["Lines", "Brigade", "Time"], right_cols=["stop_nr"], right_order=["stop_nr"],
              left_order=["VehicleNumber", "Lat", "Lon"])
    grid = nearest_match(p, s, cell_deg="auto", grid_min_candidates=64, **kw)
    plain = nearest_match(p, s, cell_deg=None, **kw)
    assert sorted(tuple(r) for r in grid.collect()) == sorted(tuple(r) for r in plain.collect())
