"""Registry of queries on the driver tables: a Spark builder and the DuckDB
oracle SQL for each operator of the inventory.

Every builder reads whole tables under ``sf_dir`` (no id subsets, no row
caps) and every computed column carries the same alias on both sides.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramflow.functions.calendar import day_type
from tramflow.functions.geo import haversine_m, haversine_sql
from tramflow.functions.keys import line_name, numeric_stop_id, null_literal, split_stop_key
from tramflow.functions.timeofday import seconds_to_hms
from tramflow.operators.ids import with_dense_ids
from tramflow.operators.nested import drop_nested, unwind
from tramflow.operators.quality import max_id
from tramflow.operators.windows import LastValue, Number, Previous, segmented_scan
from tramflow.plans import delays, inputs, jobs, loads
from tramflow.plans import driver_views as dv
from tramflow.plans import oracle_delays as od
from tramflow.plans import text_views as tv
from tramflow.session import ensure_checkpoint_dir, session_option, shuffles_removed
from tramflow.sources import readers, schedule_text
from tramflow.sources.sinks import read_published, staged
from tramflow.streaming import dedupe_pings, load_snapshots, ping_stream, stream_delays, stream_nearest

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Builder
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, covers: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Query(name, tuple(covers.split()), fn, sql)
        return fn

    return deco


# ---------------------------------------------------------------- shared pieces

def _pings(spark, d):
    return dv.pings(spark, d)


def _trams(spark, d):
    return delays.trams_stops(dv.pings(spark, d), dv.route_stops(spark, d))


def _results(spark, d):
    res = delays.delay_matches(_trams(spark, d), dv.timetable(spark, d), delays.calendar(dv.calendar_raw(spark, d)))
    return delays.materialize(res)


def _direction(spark, d, keep_only_matched=False):
    prev = delays.previous_stops(_results(spark, d))
    return delays.direction(prev, delays.routes_order(dv.route_stops(spark, d)), keep_only_matched=keep_only_matched)


_DIRECTION_COLS = ["Lines", "VehicleNumber", "Date", "CurrTramTime", "StopName", "StopNo", "DepTime", "Delay",
                   "PrevStopCorrected", "Direction"]

# ---------------------------------------------------------------- C1 and its stages


def _scratch(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _delay_inputs(spark, d) -> jobs.DelayInputs:
    return jobs.DelayInputs(dv.route_stops(spark, d), dv.timetable(spark, d), dv.calendar_raw(spark, d))


@register("c1_delay_fact", "C1 S14 P7 P8", od.FACT_SQL)
def q_c1_delay_fact(spark, d):
    """The daily job over all days, and the fact read back from its date partitions."""
    pings, path = dv.pings(spark, d), _scratch(spark, "fact")
    bounds = jobs.day_bounds(pings)
    if bounds:
        jobs.delay_days(pings, _delay_inputs(spark, d), path, *bounds)
    return jobs.read_fact(spark, path) if bounds else spark.createDataFrame([], jobs.FACT_SCHEMA)


@register("c1_day_job", "C1 S14 S7", od.FACT_SQL)
def q_c1_day_job(spark, d):
    """The daily job run for two overlapping stretches of days, the second one twice: each run
    replaces its own days, so the fact holds every row once."""
    pings, given, path = dv.pings(spark, d), _delay_inputs(spark, d), _scratch(spark, "fact")
    bounds = jobs.day_bounds(pings)
    if not bounds:
        return spark.createDataFrame([], jobs.FACT_SCHEMA)
    first, last = bounds
    middle = first + (last - first) / 2
    jobs.delay_days(pings, given, path, first, middle)
    for _ in range(2):
        jobs.delay_days(pings, given, path, middle, last)
    return jobs.read_fact(spark, path)


@register("j9_nearest_stop", "J9 J3 P18 W1 F1 A1 U1", od.NEAREST_SQL)
def q_j9_nearest_stop(spark, d):
    cands = delays.stop_candidates(dv.route_stops(spark, d)).withColumnRenamed("Lat", "s_Lat").withColumnRenamed("Lon", "s_Lon")
    from tramflow.operators.nearest import nearest_match

    return nearest_match(
        dv.pings(spark, d), cands, on=[("Lines", "line_nr")], left_xy=("Lon", "Lat"), right_xy=("s_Lon", "s_Lat"),
        group_by=["Lines", "Brigade", "Time"], right_cols=["stop_nr", "StopName", "Unit"],
        left_cols=["Lines", "Brigade", "Time", "VehicleNumber", "Lat", "Lon"],
        right_order=["stop_nr"], left_order=["VehicleNumber", "Lat", "Lon"],
    ).select("Lines", "Brigade", "Time", "VehicleNumber", "Lat", "Lon", "stop_nr", "StopName", "Unit", "distance")


@register("j9_nearest_stop_grid", "J9 J3 P18 W1 F1", od.NEAREST_SQL)
def q_j9_nearest_stop_grid(spark, d):
    """The grid path forced on (per-line cell sizes, exact fallback)."""
    cands = delays.stop_candidates(dv.route_stops(spark, d)).withColumnRenamed("Lat", "s_Lat").withColumnRenamed("Lon", "s_Lon")
    from tramflow.operators.nearest import nearest_match

    return nearest_match(
        dv.pings(spark, d), cands, on=[("Lines", "line_nr")], left_xy=("Lon", "Lat"), right_xy=("s_Lon", "s_Lat"),
        group_by=["Lines", "Brigade", "Time"], right_cols=["stop_nr", "StopName", "Unit"],
        left_cols=["Lines", "Brigade", "Time", "VehicleNumber", "Lat", "Lon"],
        right_order=["stop_nr"], left_order=["VehicleNumber", "Lat", "Lon"], cell_deg="auto", grid_min_candidates=0,
    ).select("Lines", "Brigade", "Time", "VehicleNumber", "Lat", "Lon", "stop_nr", "StopName", "Unit", "distance")


@register("j9_nearest_stop_no_grid", "J9 J3 P18 W1 F1", od.NEAREST_SQL)
def q_j9_nearest_stop_no_grid(spark, d):
    cands = delays.stop_candidates(dv.route_stops(spark, d)).withColumnRenamed("Lat", "s_Lat").withColumnRenamed("Lon", "s_Lon")
    from tramflow.operators.nearest import nearest_match

    return nearest_match(
        dv.pings(spark, d), cands, on=[("Lines", "line_nr")], left_xy=("Lon", "Lat"), right_xy=("s_Lon", "s_Lat"),
        group_by=["Lines", "Brigade", "Time"], right_cols=["stop_nr", "StopName", "Unit"],
        left_cols=["Lines", "Brigade", "Time", "VehicleNumber", "Lat", "Lon"],
        right_order=["stop_nr"], left_order=["VehicleNumber", "Lat", "Lon"], cell_deg=None,
    ).select("Lines", "Brigade", "Time", "VehicleNumber", "Lat", "Lon", "stop_nr", "StopName", "Unit", "distance")


@register("p9_trams_stops", "P9 P11 P3",od.TRAMS_STOPS_SQL)
def q_p9_trams_stops(spark, d):
    return _trams(spark, d).select(*delays.TRAMS_STOPS_COLS)


@register("j4_band_join", "J4 J5 P10 X3 P3 A1", od.RESULTS_SQL)
def q_j4_band_join(spark, d):
    return _results(spark, d).select(
        "Lines", "VehicleNumber", "Date", "CurrTramTime", "StopName", "Unit", "distance", "TT_Lines", "DepTime",
        "StopNo", "DayType", "Route", "Order", "Delay",
    )


@register("w6_previous_stops", "W6 W2 W3", od.PREVIOUS_STOPS_SQL)
def q_w6_previous_stops(spark, d):
    return delays.previous_stops(_results(spark, d)).select(
        "Lines", "VehicleNumber", "Date", "CurrTramTime", "StopName", "StopNo", "DepTime", "Route", "Order", "Delay",
        "PrevStopCorrected",
    )


@register("w6_routes_order", "W6 A1", od.ROUTES_ORDER_SQL)
def q_w6_routes_order(spark, d):
    return delays.routes_order(dv.route_stops(spark, d))


@register("j6_direction", "J6 S9 S10", od.DIRECTION_SQL)
def q_j6_direction(spark, d):
    return _direction(spark, d).select(*_DIRECTION_COLS)


@register("s10_sql_direction", "S9 S10 J6", od.DIRECTION_SQL)
def q_s10_sql_direction(spark, d):
    """The direction join written as SQL text over registered views."""
    prev = delays.previous_stops(_results(spark, d))
    order = delays.routes_order(dv.route_stops(spark, d))
    prev.createOrReplaceTempView("tf_previous_stops")
    order.createOrReplaceTempView("tf_routes_order")
    return spark.sql(
        """
        WITH hops AS (
          SELECT line_nr AS Lines, stop_nr AS StopNo, PrevCorrected AS PrevStopCorrected, route_nr AS Direction
          FROM tf_routes_order)
        SELECT Lines, VehicleNumber, Date, CurrTramTime, StopName, StopNo, DepTime, Delay, PrevStopCorrected, Direction
        FROM tf_previous_stops LEFT JOIN hops USING (Lines, StopNo, PrevStopCorrected)
        """
    )


@register("f5_direction_matched", "F5", f"""WITH {od.CTE_DIRECTION}
SELECT {", ".join(_DIRECTION_COLS)} FROM dir WHERE Direction IS NOT NULL""")
def q_f5_direction_matched(spark, d):
    return _direction(spark, d, keep_only_matched=True).select(*_DIRECTION_COLS)


@register("o1_sorted_fact", "O1", od.FACT_SQL + " ORDER BY VehicleNumber, Date, DepTime, StopNo, Delay")
def q_o1_sorted_fact(spark, d):
    return delays.delay_fact(_direction(spark, d)).orderBy("VehicleNumber", "Date", "DepTime", "StopNo", "Delay")


PARTS = 4  # deliveries of snapshots in the streaming queries


def _delivered(spark, base, deliveries, start):
    """Run the query that ``start`` starts (until no file is left) after each delivery of snapshots."""
    # the state store keeps its partition count for the checkpoint's lifetime:
    # choose it for this stream instead of inheriting the batch setting
    with session_option(spark, "spark.sql.shuffle.partitions", str(_state_partitions(spark))), shuffles_removed(spark):
        for snapshots in deliveries:
            snapshots.write.mode("append").option("compression", "gzip").text(f"{base}/in")
            q = start()
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))


def _written(spark, base, frame, deliveries):
    """What ``frame`` of the snapshots' stream has written after all deliveries."""
    spark.createDataFrame([], "json string").write.mode("append").text(f"{base}/in")  # the folder must be there
    stream = frame(ping_stream(spark, f"{base}/in", multi_line=False, archive_dir=f"{base}/archive").drop("CurrTramTime", "DateText"))
    _delivered(spark, base, deliveries, lambda: (
        stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start()))
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def _timed_deliveries(spark, d):
    """All pings in deliveries that follow each other in time, the last five minutes of each repeated in the next, and a closing ping."""
    row = dv.pings(spark, d).agg(F.min("Time").alias("low"), F.max("Time").alias("high")).first()
    low, high = row["low"] or dt.datetime(2024, 1, 1), row["high"] or dt.datetime(2024, 1, 1)
    step = int((high - low).total_seconds()) // PARTS + 1
    sec = F.timestamp_diff("SECOND", F.lit(low).cast("timestamp_ntz"), F.col("Time"))
    part = F.floor(sec / step).cast("int")
    repeated = (sec % step >= step - 300) & (F.col("_part") < PARTS - 1)
    return [*tv.snapshot_parts(spark, d, part, PARTS, repeated), tv.closing_snapshot(spark, high)]


def _quarter_of_day():
    return F.floor(F.hour("Time") / 6).cast("int")


@register("t1_ping_stream", "T1 T2 S1", dv.PINGS_SQL)
def q_t1_ping_stream(spark, d):
    """Four deliveries of snapshot files, read as a stream and archived."""
    deliveries = tv.snapshot_parts(spark, d, _quarter_of_day(), PARTS)
    return _written(spark, _scratch(spark, "t1"), lambda pings: pings, deliveries).select(*dv.pings(spark, d).columns)


@register("t4_repeated_pings", "T1 T4", f"SELECT DISTINCT Lines, Brigade, Time, VehicleNumber FROM ({dv.PINGS_SQL}) p")
def q_t4_repeated_pings(spark, d):
    """Pings that come in two deliveries count once."""
    once = _written(spark, _scratch(spark, "t4"), dedupe_pings, _timed_deliveries(spark, d))
    return once.filter(F.col("VehicleNumber") != tv.CLOSING).select("Lines", "Brigade", "Time", "VehicleNumber")


@register("t5_stream_nearest", "T1 T4 T5", f"""WITH {od.CTE_TRAMS}
SELECT Lines, Brigade, Time, VehicleNumber, Lat, Lon, stop_nr, StopName, Unit, distance FROM trams""")
def q_t5_stream_nearest(spark, d):
    """The pings in several deliveries through the streaming nearest-stop operator. A closing ping moves the
    watermark past all of them; its own group stays open and is not emitted."""
    cands = delays.stop_candidates(dv.route_stops(spark, d))
    return _written(spark, _scratch(spark, "t5"), lambda pings: stream_nearest(dedupe_pings(pings), cands), _timed_deliveries(spark, d))


@register("t5_stream_delays", "T5 J4 J5", od.RESULTS_SQL)
def q_t5_stream_delays(spark, d):
    """Delays of the streamed pings against the static timetable and calendar."""
    base, cands = _scratch(spark, "t5d"), delays.stop_candidates(dv.route_stops(spark, d))
    with shuffles_removed(spark):
        timetable = staged(dv.timetable(spark, d), f"{base}/timetable")
    calendar = delays.calendar(dv.calendar_raw(spark, d))

    def found(pings):
        return stream_delays(stream_nearest(dedupe_pings(pings), cands), timetable, calendar)

    return _written(spark, base, found, _timed_deliveries(spark, d)).distinct()


def _state_partitions(spark) -> int:
    try:
        return max(2 * spark.sparkContext.defaultParallelism, 8)
    except Exception:  # noqa: BLE001
        return 16


# ---------------------------------------------------------------- dimensions


@register("s11_stops_dim", "S11 P7 A1", f"""
SELECT DISTINCT TRY_CAST(stop_nr AS INTEGER) AS stop_nr, StopName FROM ({dv.STOPS_SQL}) s""")
def q_s11_stops_dim(spark, d):
    s = dv.stops(spark, d).select("stop_nr", "StopName").distinct()
    return s.select(F.col("stop_nr").try_cast("int").alias("stop_nr"), "StopName")


@register("s12_vehicles_dim", "S12 P7 A1", f"""WITH {od.CTE_TRAMS}
SELECT DISTINCT TRY_CAST(Lines AS INTEGER) AS Lines, VehicleNumber, TRY_CAST(Brigade AS INTEGER) AS Brigade
FROM trams""")
def q_s12_vehicles_dim(spark, d):
    t = _trams(spark, d).select("Lines", "VehicleNumber", "Brigade").distinct()
    return t.select(F.col("Lines").try_cast("int").alias("Lines"), "VehicleNumber", F.col("Brigade").try_cast("int").alias("Brigade"))


@register("s13_calendar_dim", "S13 P6 P8 F6", f"""
SELECT DayType, CAST(strptime(CAST(day AS VARCHAR), '%Y-%m-%d') AS DATE) AS day,
       array_to_string(day_types, ',') AS codes
FROM ({dv.CALENDAR_SQL}) c""")
def q_s13_calendar_dim(spark, d):
    c = delays.calendar(dv.calendar_raw(spark, d))
    return c.select(
        "DayType", F.to_date(F.col("day").cast("string"), "yyyy-MM-dd").alias("day"),
        F.array_join("day_types", ",").alias("codes"),
    )


# ---------------------------------------------------------------- projections and scalar functions


@register("p1_stops_view", "P1 P2 P4",f"""
SELECT unit, unit_name AS StopName, street_id, direction, valid_from, longitude AS Lon, latitude AS Lat,
       unit || post AS stop_nr
FROM ({dv.STOPS_FEED_SQL}) f""")
def q_p1_stops_view(spark, d):
    return inputs.stops_view(dv.stops_feed(spark, d))


@register("j1_route_coordinates", "J1 P3 P4", f"""WITH rs AS ({dv.ROUTE_STOPS_SQL}), st AS ({dv.STOPS_SQL})
SELECT r.line_nr, r.route_nr, r.stop_nr, r.StopName, r.min_time, s.Lat, s.Lon, s.unit AS Unit
FROM rs r JOIN st s ON r.stop_nr = s.stop_nr""")
def q_j1_route_coordinates(spark, d):
    on_routes = dv.route_stops(spark, d).select("line_nr", "route_nr", "stop_nr", "StopName", "min_time")
    return inputs.route_coordinates(on_routes, dv.stops(spark, d))


@register("j2_timetable_stops", "J2 P2", f"""
SELECT Lines, Route, StopNo, dep_sec, "Order", DayType, Unit FROM ({dv.TIMETABLE_SQL}) t""")
def q_j2_timetable_stops(spark, d):
    return dv.timetable(spark, d)


@register("p12_split_key", "P12 P14 P2", f"""
SELECT stop_nr, substring(stop_nr, 1, 4) AS unit, substring(stop_nr, 5) AS post,
       TRY_CAST(stop_nr AS INTEGER) AS stop_id
FROM (SELECT unit || post AS stop_nr FROM ({dv.STOPS_FEED_SQL}) f) k""")
def q_p12_split_key(spark, d):
    k = dv.stops_feed(spark, d).select(F.concat("unit", "post").alias("stop_nr"))
    unit, post = split_stop_key("stop_nr")
    return k.select("stop_nr", unit.alias("unit"), post.alias("post"), numeric_stop_id(unit, post).alias("stop_id"))


@register("p13_line_name", "P13 A1", f"""
SELECT DISTINCT line_nr || route_nr AS line_name, line_nr, route_nr FROM ({dv.ROUTE_ITEMS_SQL}) i""")
def q_p13_line_name(spark, d):
    i = dv.route_items(spark, d).select("line_nr", "route_nr").distinct()
    return i.select(line_name("line_nr", "route_nr").alias("line_name"), "line_nr", "route_nr")


@register("p17_null_literal", "P17 P15", """
SELECT event_id,
       TRY_CAST(NULLIF(CASE WHEN event_id % 9 = 0 THEN 'null' ELSE CAST(user_id AS VARCHAR) END, 'null') AS INTEGER) AS vehicle_id,
       TRY_CAST(NULLIF(CASE WHEN event_id % 7 = 0 THEN 'null' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END, 'null') AS TIMESTAMP) AS seen_at,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at
FROM events""")
def q_p17_null_literal(spark, d):
    ev = dv.table(spark, d, "events", ["event_id", "user_id", "ts"])
    vid = F.when(F.col("event_id") % 9 == 0, F.lit("null")).otherwise(F.col("user_id").cast("string"))
    seen = F.when(F.col("event_id") % 7 == 0, F.lit("null")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return ev.select(
        "event_id",
        null_literal(vid).try_cast("int").alias("vehicle_id"),
        F.try_to_timestamp(null_literal(seen), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("seen_at"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )


# Fixed value: the depot all pings are measured from in the distance query.
DEPOT_LON, DEPOT_LAT = 21.0122, 52.2297


@register("p18_haversine", "P18 U1", f"""
SELECT VehicleNumber, Time,
       {haversine_sql('Lon', 'Lat', f'CAST({DEPOT_LON} AS DOUBLE)', f'CAST({DEPOT_LAT} AS DOUBLE)')} AS depot_distance
FROM ({dv.PINGS_SQL}) p""")
def q_p18_haversine(spark, d):
    p = dv.pings(spark, d)
    return p.select("VehicleNumber", "Time", haversine_m("Lon", "Lat", F.lit(DEPOT_LON), F.lit(DEPOT_LAT)).alias("depot_distance"))


@register("p6_day_type", "P6 F6", f"""SELECT day, DayType FROM ({dv.CALENDAR_SQL}) c""")
def q_p6_day_type(spark, d):
    return dv.calendar_raw(spark, d).select("day", day_type("day_types").alias("DayType"))


@register("x3_departure_text", "X3 P11", f"""
SELECT dep_sec, {od.hms_sql('dep_sec')} AS departure_time, dep_sec >= 86400 AS after_midnight
FROM (SELECT DISTINCT dep_sec FROM ({dv.TIMETABLE_SQL}) t) s""")
def q_x3_departure_text(spark, d):
    s = dv.timetable(spark, d).select("dep_sec").distinct()
    return s.select("dep_sec", seconds_to_hms("dep_sec").alias("departure_time"), (F.col("dep_sec") >= 86400).alias("after_midnight"))


# ---------------------------------------------------------------- windows on events


_EV_W = "PARTITION BY user_id ORDER BY ts, event_id"


@register("w2_change_detection", "W2", f"""
SELECT event_id, user_id, event_type,
       CASE WHEN event_type <> lag(event_type) OVER ({_EV_W}) THEN lag(event_type) OVER ({_EV_W}) END AS prev_type
FROM events""")
def q_w2_change_detection(spark, d):
    ev = dv.table(spark, d, "events", ["event_id", "user_id", "event_type", "ts"])
    # a busy user's events are cut by date
    seen = segmented_scan(ev, ["user_id"], ["ts", "event_id"], F.to_date("ts"), {"_prev": Previous("event_type")})
    return seen.select("event_id", "user_id", "event_type",
                       F.when(F.col("event_type") != F.col("_prev"), F.col("_prev")).alias("prev_type"))


@register("w3_forward_fill", "W3", f"""
SELECT event_id, user_id,
       last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER (
           {_EV_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_error_id
FROM events""")
def q_w3_forward_fill(spark, d):
    ev = dv.table(spark, d, "events", ["event_id", "user_id", "event_type", "ts"])
    mark = ev.withColumn("_e", F.when(F.col("event_type") == "error", F.col("event_id")))
    filled = segmented_scan(mark, ["user_id"], ["ts", "event_id"], F.to_date("ts"), {"last_error_id": LastValue("_e")})
    return filled.select("event_id", "user_id", "last_error_id")


@register("w4_sequence_number", "W4", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                                                          l_extendedprice, l_discount, l_tax, l_shipdate) AS INTEGER) AS seq_nr
FROM lineitem""")
def q_w4_sequence_number(spark, d):
    li = dv.table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                         "l_extendedprice", "l_discount", "l_tax", "l_shipdate"])
    # an order of very many items is cut by its leading sort column
    out = segmented_scan(
        li, ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"],
        F.floor(F.col("l_linenumber") / 4), {"seq_nr": Number()},
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("seq_nr").cast("int"))


@register("w5_dense_ids", "W5", """
SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 1000 AS BIGINT) AS id, o_orderkey, o_orderdate
FROM orders""")
def q_w5_dense_ids(spark, d):
    o = dv.table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    return with_dense_ids(o, ["o_orderdate", "o_orderkey"], "id", start=1000).select("id", "o_orderkey", "o_orderdate")


# ---------------------------------------------------------------- aggregations


@register("a2_distinct_keys", "A2", f"""
SELECT DISTINCT Lines AS line, Route AS route, DayType AS day_type, Unit AS unit, substring(StopNo, 5) AS post,
       {od.hms_sql('dep_sec')} AS departure_time, "Order" AS "order"
FROM ({dv.TIMETABLE_SQL}) t""")
def q_a2_distinct_keys(spark, d):
    return _timetable_doc(spark, d).select(*loads.TIMETABLE_KEYS).distinct()


def _timetable_doc(spark, d):
    t = dv.timetable(spark, d)
    return t.select(
        F.col("Lines").alias("line"), F.col("Route").alias("route"), F.col("DayType").alias("day_type"),
        F.col("Unit").alias("unit"), F.substr(F.col("StopNo"), F.lit(5)).alias("post"),
        seconds_to_hms("dep_sec").alias("departure_time"), F.col("Order").alias("order"),
    )


@register("a3_max_id", "A3", """
SELECT CAST(COALESCE(MAX(o_orderkey), 0) AS BIGINT) AS last_id,
       (SELECT CAST(COALESCE(MAX(o_orderkey), 0) AS BIGINT) FROM orders WHERE o_orderstatus = 'none') AS empty_last_id
FROM orders""")
def q_a3_max_id(spark, d):
    o = dv.table(spark, d, "orders", ["o_orderkey", "o_orderstatus"])
    full = max_id(o, "o_orderkey", "last_id")
    empty = max_id(o.filter(F.col("o_orderstatus") == "none"), "o_orderkey", "empty_last_id")
    return full.select("last_id", empty.select("empty_last_id").scalar().alias("empty_last_id"))


_C3_CLEAN = f"""
clean AS (
  SELECT TRY_CAST(unit || post AS INTEGER) AS id, unit_name AS full_name, longitude AS stop_longitude,
         latitude AS stop_latitude, direction AS street, unit, post, TIMESTAMP '2024-01-01 00:00:00' AS created_at
  FROM ({dv.STOPS_FEED_SQL}) f
  WHERE NOT coalesce(regexp_matches(unit, '^R'), false)),
clean_nn AS (SELECT * FROM clean WHERE id IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY unit NULLS FIRST, post NULLS FIRST, full_name NULLS FIRST,
                               stop_longitude NULLS FIRST, stop_latitude NULLS FIRST, street NULLS FIRST) AS rn
  FROM clean_nn)"""

_C3_COLS = "id, full_name, stop_longitude, stop_latitude, street, unit, post, created_at"


@register("c3_stops_load", "C3 A4 F2 P14 P15",f"""WITH {_C3_CLEAN}
SELECT {_C3_COLS} FROM ranked WHERE rn = 1""")
def q_c3_stops_load(spark, d):
    return loads.load_stops(dv.stops_feed(spark, d)).accepted


@register("c3_stops_counts", "A4 A6 A7", f"""WITH {_C3_CLEAN}
SELECT CAST(count(*) FILTER (WHERE rn = 1) AS BIGINT) AS accepted,
       CAST(count(*) FILTER (WHERE rn > 1) AS BIGINT)
         + (SELECT CAST(count(*) AS BIGINT) FROM clean WHERE id IS NULL) AS rejected,
       (SELECT CAST(count(*) AS BIGINT) FROM supplier) AS input_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT unit, post FROM ({dv.STOPS_FEED_SQL}) f) u) AS distinct_unit_post
FROM ranked""")
def q_c3_stops_counts(spark, d):
    """Both counts as observed by the one write of the marked rows."""
    feed = dv.stops_feed(spark, d)
    accepted, rejected = jobs.publish_marked(loads.mark_stops(feed), _scratch(spark, "stops"))
    counts = spark.createDataFrame([(accepted, rejected)], "accepted long, rejected long")
    n_in = feed.select(F.count(F.lit(1)).alias("n")).scalar()
    n_keys = feed.select(F.count_distinct("unit", "post").alias("n")).scalar()
    return counts.select("accepted", "rejected", n_in.alias("input_rows"), n_keys.alias("distinct_unit_post"))


@register("f2_r_units", "F2", f"""
SELECT unit, post, unit_name FROM ({dv.STOPS_FEED_SQL}) f WHERE regexp_matches(unit, '^R')""")
def q_f2_r_units(spark, d):
    return dv.stops_feed(spark, d).filter(F.col("unit").rlike("^R")).select("unit", "post", "unit_name")


_NESTED_SQL = f"""
items AS ({dv.ROUTE_ITEMS_SQL}),
routes AS (
  SELECT doc_id, line_nr, route_nr, CAST(count(*) AS INTEGER) AS number_of_stops,
         list(stop_nr ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS stop_nrs
  FROM items GROUP BY doc_id, line_nr, route_nr)"""


@register("a5_nested_routes", "A5", f"""WITH {_NESTED_SQL}
SELECT doc_id, line_nr, CAST(count(*) AS INTEGER) AS number_of_routes,
       string_agg(route_nr || ':' || CAST(number_of_stops AS VARCHAR) || ':' || array_to_string(stop_nrs, ','), ';'
                  ORDER BY route_nr) AS layout
FROM routes GROUP BY doc_id, line_nr""")
def q_a5_nested_routes(spark, d):
    docs = dv.routes_nested(spark, d)
    layout = F.array_join(
        F.transform(
            "routes",
            lambda r: F.concat_ws(":", r["route_nr"], r["number_of_stops"].cast("string"),
                                  F.array_join(r["stops"]["stop_nr"], ",")),
        ),
        ";",
    )
    return docs.select("doc_id", "line_nr", F.col("number_of_routes").cast("int"), layout.alias("layout"))


@register("e2_routes_unwind", "E2 P16", f"""WITH {_NESTED_SQL}
SELECT doc_id, line_nr, route_nr, number_of_stops FROM routes""")
def q_e2_routes_unwind(spark, d):
    return loads.route_rows(dv.routes_nested(spark, d)).select("doc_id", "line_nr", "route_nr", F.col("number_of_stops").cast("int"))


@register("e1_route_variants_flat", "E1 W4 P16", f"""
SELECT doc_id, line_nr, route_nr, stop_nr,
       CAST(row_number() OVER (PARTITION BY doc_id, route_nr ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                                                              l_extendedprice) AS INTEGER) AS stop_sequence_nr
FROM ({dv.ROUTE_ITEMS_SQL}) i""")
def q_e1_route_variants_flat(spark, d):
    return loads.variant_rows(dv.routes_nested(spark, d)).select(
        "doc_id", "line_nr", "route_nr", "stop_nr", F.col("stop_sequence_nr").cast("int")
    )


_C4_SQL = f"""{_NESTED_SQL},
numbered AS (
  SELECT *, row_number() OVER (ORDER BY line_nr, route_nr, doc_id, number_of_stops) AS id FROM routes),
t AS (
  SELECT CAST(id AS BIGINT) AS id, line_nr || route_nr AS line_name, line_nr, route_nr AS name,
         number_of_stops AS stops_cnt, TIMESTAMP '2024-01-01 00:00:00' AS created_at
  FROM numbered),
r AS (SELECT *, row_number() OVER (PARTITION BY line_name ORDER BY id) AS rn FROM t),
routes_ok AS (SELECT id, line_name, line_nr, name, stops_cnt, created_at FROM r WHERE rn = 1)"""


def _routes_doc(spark, d):
    """The nested routes collection, assembled once per load and materialized."""
    return delays.materialize(dv.routes_nested(spark, d))


@register("c4_routes_load", "C4 A4 W5 P13 P16 E2", f"""WITH {_C4_SQL} SELECT * FROM routes_ok""")
def q_c4_routes_load(spark, d):
    return loads.load_routes(dv.routes_nested(spark, d)).accepted


_C5_SQL = f"""{_C4_SQL},
{_C3_CLEAN.replace('clean AS', 'clean AS', 1)},
stops_ok AS (SELECT {_C3_COLS} FROM ranked WHERE rn = 1),
v AS (
  SELECT doc_id, line_nr, route_nr, stop_nr,
         row_number() OVER (PARTITION BY doc_id, route_nr ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                                                              l_extendedprice) AS stop_sequence_nr
  FROM items),
looked AS (
  SELECT v.*, s.id AS stop_id, ro.id AS route_id
  FROM v
  LEFT JOIN stops_ok s ON s.unit = substring(v.stop_nr, 1, 4) AND s.post = substring(v.stop_nr, 5)
  LEFT JOIN routes_ok ro ON ro.line_nr = v.line_nr AND ro.name = v.route_nr),
variants AS (
  SELECT CAST(row_number() OVER (ORDER BY line_nr, route_nr, doc_id, stop_sequence_nr, stop_nr) AS BIGINT) AS id,
         CAST(stop_id AS INTEGER) AS stop_id, CAST(route_id AS BIGINT) AS route_id,
         CAST(stop_sequence_nr AS INTEGER) AS stop_sequence_nr
  FROM looked)"""


@register("c5_route_variants_load", "C5 J7 F7 P12 W4 W5 E1",f"""WITH {_C5_SQL}
SELECT * FROM variants WHERE stop_id IS NOT NULL AND route_id IS NOT NULL""")
def q_c5_route_variants_load(spark, d):
    routes = _routes_doc(spark, d)
    stops_ok = delays.materialize(loads.load_stops(dv.stops_feed(spark, d)).accepted)
    routes_ok = delays.materialize(loads.load_routes(routes).accepted)
    return loads.load_route_variants(routes, stops_ok, routes_ok).accepted


@register("f7_not_null_rejects", "F7", f"""WITH {_C5_SQL}
SELECT * FROM variants WHERE stop_id IS NULL OR route_id IS NULL""")
def q_f7_not_null_rejects(spark, d):
    routes = _routes_doc(spark, d)
    stops_ok = delays.materialize(loads.load_stops(dv.stops_feed(spark, d)).accepted)
    routes_ok = delays.materialize(loads.load_routes(routes).accepted)
    return loads.load_route_variants(routes, stops_ok, routes_ok).rejected


_C6_TT = f"""
keys AS (
  SELECT DISTINCT Lines AS line, Route AS route, DayType AS day_type, Unit AS unit, substring(StopNo, 5) AS post,
         {od.hms_sql('dep_sec')} AS departure_time, "Order" AS "order"
  FROM ({dv.TIMETABLE_SQL}) t),
tt AS (
  SELECT CAST(row_number() OVER (ORDER BY line, route, day_type, unit, post, departure_time, "order") AS BIGINT) AS id,
         day_type, departure_time, CAST("order" AS INTEGER) AS departure_time_sequence_nr,
         TRY_CAST(unit || post AS INTEGER) AS stop_id, line AS line_nr,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at
  FROM keys)"""

_C6_SQL = f"""{_C3_CLEAN},
stops_ok AS (SELECT {_C3_COLS} FROM ranked WHERE rn = 1),
{_C6_TT}"""


@register("c6_timetables_load", "C6 A2 J8 P14 W5",f"""WITH {_C6_SQL}
SELECT * FROM tt WHERE stop_id IN (SELECT id FROM stops_ok)""")
def q_c6_timetables_load(spark, d):
    stops_ok = delays.materialize(loads.load_stops(dv.stops_feed(spark, d)).accepted)
    return loads.load_timetables(_timetable_doc(spark, d), stops_ok).accepted


@register("j8_fk_rejects", "J8", f"""WITH {_C6_SQL}
SELECT * FROM tt WHERE stop_id IS NULL OR stop_id NOT IN (SELECT id FROM stops_ok WHERE id IS NOT NULL)""")
def q_j8_fk_rejects(spark, d):
    stops_ok = delays.materialize(loads.load_stops(dv.stops_feed(spark, d)).accepted)
    return loads.load_timetables(_timetable_doc(spark, d), stops_ok).rejected


@register("s7_reload_counts", "S7 C3 C4 C5 C6 A6 A7", f"""WITH {_C5_SQL}, {_C6_TT},
found AS (
  SELECT 'stops' AS name, (SELECT count(*) FROM clean) AS n, (SELECT count(*) FROM stops_ok) AS ok
  UNION ALL SELECT 'routes', (SELECT count(*) FROM routes), (SELECT count(*) FROM routes_ok)
  UNION ALL SELECT 'route_variants', (SELECT count(*) FROM variants),
                   (SELECT count(*) FROM variants WHERE stop_id IS NOT NULL AND route_id IS NOT NULL)
  UNION ALL SELECT 'timetables', (SELECT count(*) FROM tt), (SELECT count(*) FROM tt WHERE stop_id IN (SELECT id FROM stops_ok)))
SELECT name, CAST(ok AS BIGINT) AS accepted, CAST(n - ok AS BIGINT) AS rejected FROM found""")
def q_s7_reload_counts(spark, d):
    """All tables loaded twice into one place, the second load replacing the first; the rows of its published tables counted."""
    db = _scratch(spark, "db")
    for _ in range(2):
        with shuffles_removed(spark):
            routes = staged(dv.routes_nested(spark, d), f"{db}/_routes")
        jobs.reload_tables(dv.stops_feed(spark, d), routes, _timetable_doc(spark, d), db, loads.DEFAULT_LOAD_TS)
    each = [read_published(spark, f"{db}/{name}").agg(
        F.lit(name).alias("name"), F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"),
    ) for name in jobs.TABLES]
    return each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3])


_C7_SQL = f"""
p AS ({dv.PINGS_SQL}),
trams AS (
  SELECT CAST(row_number() OVER (ORDER BY Time, VehicleNumber, Lines, Brigade, Lon, Lat) AS BIGINT) AS id,
         VehicleNumber AS vehicle_nr, Brigade AS brigade, Lines AS line_nr,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at, Time, Lon, Lat
  FROM p)"""


@register("c7_trams_load", "C7 S8 W5 A3", f"""WITH {_C7_SQL}
SELECT id, vehicle_nr, brigade, line_nr, created_at FROM trams""")
def q_c7_trams_load(spark, d):
    return loads.trams_rows(dv.pings(spark, d)).select("id", "vehicle_nr", "brigade", "line_nr", "created_at")


@register("t3_stream_state_load", "T1 T3 C7 S8 A3", f"""
SELECT CAST(row_number() OVER (ORDER BY hour(Time) // 6, Time, VehicleNumber, Lines, Brigade, Lon, Lat) AS BIGINT) AS id,
       VehicleNumber AS vehicle_nr, Brigade AS brigade, Lines AS line_nr, TIMESTAMP '2024-01-01 00:00:00' AS created_at
FROM ({dv.PINGS_SQL}) p""")
def q_t3_stream_state_load(spark, d):
    """Four deliveries through the idempotent state load: the ids of a batch go on after those of the one before."""
    base = _scratch(spark, "t3")
    spark.createDataFrame([], "json string").write.mode("append").text(f"{base}/in")
    pings = ping_stream(spark, f"{base}/in", multi_line=False).drop("CurrTramTime", "DateText")
    deliveries = tv.snapshot_parts(spark, d, _quarter_of_day(), PARTS)
    _delivered(spark, base, deliveries, lambda: load_snapshots(pings, f"{base}/db", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/db/trams").select("id", "vehicle_nr", "brigade", "line_nr", "created_at")


@register("p19_tram_states", "P19 C7", f"""WITH {_C7_SQL}
SELECT id, Time AS current_tram_time, CAST(NULL AS VARCHAR) AS stop_state, id AS tram_id,
       CAST(NULL AS BIGINT) AS route_variant_id, Lon AS tram_longitude, Lat AS tram_latitude,
       CAST(NULL AS INTEGER) AS distance, CAST(NULL AS BOOLEAN) AS is_depot
FROM trams""")
def q_p19_tram_states(spark, d):
    return loads.tram_states_rows(loads.trams_rows(dv.pings(spark, d)))


# ---------------------------------------------------------------- text core on documents

# Fixed value: a line this short (after trimming) heads a block in the text core.
HEADER_MAX_CHARS = 30

_DOC_LINES_SQL = f"""
lines AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) AS INTEGER) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents) d),
marked AS (
  SELECT *, length(trim(line)) > 0 AND length(trim(line)) <= {HEADER_MAX_CHARS} AS is_header FROM lines)"""


def _doc_lines(spark, d):
    docs = dv.table(spark, d, "documents", ["doc_id", "text"])
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("pos", (F.col("pos") + 1).cast("int"))
    n = F.length(F.trim("line"))
    return lines.withColumn("is_header", (n > 0) & (n <= HEADER_MAX_CHARS))


@register("x_text_blocks", "W3 W4",f"""WITH {_DOC_LINES_SQL}
SELECT doc_id, pos,
       last_value(CASE WHEN is_header THEN trim(line) END IGNORE NULLS) OVER w AS header,
       CAST(pos - last_value(CASE WHEN is_header THEN pos END IGNORE NULLS) OVER w AS INTEGER) AS line_in_block,
       CAST(sum(CASE WHEN is_header THEN 1 ELSE 0 END) OVER w AS INTEGER) AS block_nr,
       CAST(length(line) AS INTEGER) AS n_chars
FROM marked
WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_x_text_blocks(spark, d):
    m = _doc_lines(spark, d)
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hdr = F.col("is_header")
    return m.select(
        "doc_id", "pos",
        F.last(F.when(hdr, F.trim("line")), ignorenulls=True).over(w).alias("header"),
        (F.col("pos") - F.last(F.when(hdr, F.col("pos")), ignorenulls=True).over(w)).cast("int").alias("line_in_block"),
        F.sum(F.when(hdr, 1).otherwise(0)).over(w).cast("int").alias("block_nr"),
        F.length("line").cast("int").alias("n_chars"),
    )


@register("e3_e4_tokens", "E3 E4", f"""WITH {_DOC_LINES_SQL},
toks AS (SELECT doc_id, pos, string_split(trim(line), ' ') AS t FROM lines)
SELECT doc_id, pos, t[1] AS first_token, t[3] AS third_token,
       CAST(len(t[3:]) AS INTEGER) AS tail_len, array_to_string(t[3:], ' ') AS tail
FROM toks""")
def q_e3_e4_tokens(spark, d):
    t = _doc_lines(spark, d).select("doc_id", "pos", F.split(F.trim("line"), " ").alias("t"))
    tail = F.slice("t", 3, F.greatest(F.size("t") - 2, F.lit(0)))
    return t.select(
        "doc_id", "pos", F.try_element_at("t", F.lit(1)).alias("first_token"),
        F.try_element_at("t", F.lit(3)).alias("third_token"),
        F.size(tail).cast("int").alias("tail_len"), F.array_join(tail, " ").alias("tail"),
    )


@register("f3_f4_token_filters", "F3 F4", f"""WITH {_DOC_LINES_SQL}
SELECT doc_id, pos, split_part(trim(line), ' ', 1) AS first_token
FROM lines
WHERE (regexp_matches(split_part(trim(line), ' ', 1), '^[0-9]{{1,2}}$')
       OR (contains(line, 'the') AND split_part(trim(line), ' ', 1) NOT IN ('The', 'It')))""")
def q_f3_f4_token_filters(spark, d):
    ln = _doc_lines(spark, d)
    first = F.split(F.trim("line"), " ").getItem(0)
    keep = first.rlike("^[0-9]{1,2}$") | (F.col("line").contains("the") & ~first.isin("The", "It"))
    return ln.filter(keep).select("doc_id", "pos", first.alias("first_token"))


# ---------------------------------------------------------------- parsers on texts written from the tables


@register("x1_line_sections", "X1", tv.SECTIONS_SQL)
def q_x1_line_sections(spark, d):
    found = schedule_text.line_sections(tv.section_lines(spark, d))
    return found.groupBy("line_nr", F.col("_rec").alias("section")).agg(F.count(F.lit(1)).alias("n_lines"))


@register("x2_departures", "X2 X3", tv.DEPARTURES_SQL)
def q_x2_departures(spark, d):
    return schedule_text.departures(tv.section_lines(spark, d))


@register("x4_calendar_block", "X4 E3 E4", f"""
SELECT day, array_to_string(day_types, ',') AS codes FROM ({dv.CALENDAR_RAW_SQL}) c""")
def q_x4_calendar_block(spark, d):
    return schedule_text.calendar_days(tv.calendar_lines(spark, d)).select("day", F.array_join("day_types", ",").alias("codes"))


@register("x7_route_documents", "X5 X6 X7 A5 F3", tv.ROUTE_DOCUMENTS_SQL)
def q_x7_route_documents(spark, d):
    lines = tv.route_lines(spark, d)
    stops = schedule_text.tokenize_stops(schedule_text.route_stop_lines(lines))
    docs = schedule_text.routes_documents(stops, schedule_text.route_headers(lines))
    stop = lambda s: F.concat_ws(
        "~", s["stop_nr"], s["stop_name"], s["street"], F.when(s["r_flag"], "r").otherwise(""),
        s["min_time"].cast("string"), s["max_time"].cast("string"))
    layout = F.transform("routes", lambda r: F.concat_ws(
        ":", r["route_nr"], r["number_of_stops"].cast("string"), F.array_join(F.transform(r["stops"], stop), ",")))
    return docs.select("line_nr", "number_of_routes", F.array_join(layout, ";").alias("layout"))


@register("s4_stops_records", "S4 E3 P17", f"SELECT * FROM ({dv.STOPS_FEED_SQL}) f")
def q_s4_stops_records(spark, d):
    return readers.parse_stops(tv.stops_records(spark, d))


@register("t2_flatten_pings", "P5 P17 E2", tv.SNAPSHOT_PINGS_SQL)
def q_t2_flatten_pings(spark, d):
    return readers.flatten_pings(tv.snapshots(spark, d))


def queries() -> dict[str, Builder]:
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
