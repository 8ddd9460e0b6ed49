"""The delay job's inputs from the reference collections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramflow.functions.keys import stop_key
from tramflow.functions.timeofday import hms_to_seconds
from tramflow.operators.broadcast import broadcast_if_small
from tramflow.operators.nested import unwind


def stops_view(stops: DataFrame) -> DataFrame:
    """Stops collection under the names of the delay job, with the padded stop key."""
    return stops.select(
        "unit", F.col("unit_name").alias("StopName"), "street_id", "direction", "valid_from",
        F.col("longitude").alias("Lon"), F.col("latitude").alias("Lat"), stop_key("unit", "post").alias("stop_nr"),
    )


def route_stops(routes: DataFrame) -> DataFrame:
    """Routes collection -> one row per stop of a route, with its place ``pos`` on the route."""
    flat = unwind(routes.select("line_nr", "routes"), "routes", "r").select(
        "line_nr", F.col("r.route_nr").alias("route_nr"), F.col("r.stops").alias("stops")
    )
    return unwind(flat, "stops", "s", position="pos").select(
        "line_nr", "route_nr", F.col("s.stop_nr").alias("stop_nr"), F.col("s.stop_name").alias("StopName"),
        F.col("s.min_time").alias("min_time"), "pos",
    )


def route_coordinates(stops_of_routes: DataFrame, view: DataFrame) -> DataFrame:
    """Route stops with the coordinates and unit of their stop (J1); a stop the view lacks drops out."""
    s = broadcast_if_small(view.select(F.col("stop_nr").alias("_nr"), "Lat", "Lon", F.col("unit").alias("Unit")))
    return stops_of_routes.join(s, stops_of_routes["stop_nr"] == s["_nr"]).drop("_nr")


def timetable_stops(timetable: DataFrame) -> DataFrame:
    """Timetable collection under the names of the delay job, with the padded stop key.

    A collection that has the departure as text alone gets its second of the service day from it.
    """
    seconds = F.col("dep_sec") if "dep_sec" in timetable.columns else hms_to_seconds("departure_time").alias("dep_sec")
    return timetable.select(
        F.col("line").alias("Lines"), F.col("route").alias("Route"), stop_key("unit", "post").alias("StopNo"), seconds,
        F.col("order").alias("Order"), F.col("day_type").alias("DayType"), F.col("unit").alias("Unit"),
    )
