"""The daily delay batch, composed from the operators.

pings -> nearest stop of the line (J3, P18, W1, F1, A1 as ``nearest_match``)
      -> candidate service days -> calendar day type (J5)
      -> departures at the stop complex inside the time band (J4)
      -> delay seconds (P10) -> previous distinct stop (W6)
      -> direction from the route order (J6) -> fact (S14)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramflow.functions.calendar import day_type
from tramflow.functions.timeofday import band_bound, seconds_of_day, seconds_to_hms
from tramflow.operators.bandjoin import band_join
from tramflow.operators.broadcast import broadcast_if_small
from tramflow.operators.nearest import nearest_match
from tramflow.operators.windows import previous_distinct
from tramflow.session import ensure_checkpoint_dir

# The band keeps departures scheduled less than 10 minutes
# before and less than 3 minutes after the ping.
BAND_LOWER_SEC = 600
BAND_UPPER_SEC = 180
DAY_SEC = 86400

TRAMS_STOPS_COLS = [
    "Lines", "Lat", "Lon", "VehicleNumber", "CurrTramTime", "Date", "Brigade",
    "StopName", "Unit", "distance", "LowerTime", "UpperTime",
]
RESULT_ORDER = ["CurrTramTime", "distance", "DepTime", "Route", "Order", "StopNo", "DayType", "Delay"]


def calendar(calendar_raw: DataFrame) -> DataFrame:
    """(day, day_types) -> + DayType by the DP > N7 > SB > Unknown rule."""
    return calendar_raw.withColumn("DayType", day_type("day_types"))


def stop_candidates(route_stops: DataFrame) -> DataFrame:
    """Distinct (line, stop) pairs: a stop on several routes is measured once."""
    return route_stops.select("line_nr", "stop_nr", "StopName", "Unit", "Lat", "Lon").distinct()


def trams_stops(
    pings: DataFrame,
    route_stops: DataFrame,
    *,
    cell_deg: float | str | None = "auto",
    levels=(1, 8),
    max_distance: float | None = None,
    lower: int = BAND_LOWER_SEC,
    upper: int = BAND_UPPER_SEC,
) -> DataFrame:
    """Nearest stop of the ping's line, one row per (line, brigade, time).

    Ties: distance, then stop number, then vehicle and position.
    """
    cands = stop_candidates(route_stops).withColumnRenamed("Lat", "s_Lat").withColumnRenamed("Lon", "s_Lon")
    near = nearest_match(
        pings,
        cands,
        on=[("Lines", "line_nr")],
        left_xy=("Lon", "Lat"),
        right_xy=("s_Lon", "s_Lat"),
        group_by=["Lines", "Brigade", "Time"],
        right_cols=["stop_nr", "StopName", "Unit"],
        left_cols=["Lines", "Brigade", "Time", "VehicleNumber", "Lat", "Lon"],
        right_order=["stop_nr"],
        left_order=["VehicleNumber", "Lat", "Lon"],
        cell_deg=cell_deg,
        levels=levels,
        max_distance=max_distance,
    )
    return near.select(
        "Lines", "Lat", "Lon", "VehicleNumber", "Time",
        F.date_format("Time", "HH:mm:ss").alias("CurrTramTime"),
        F.to_date("Time").alias("Date"),
        "Brigade", "StopName", "Unit", "distance",
        band_bound("Time", -lower).alias("LowerTime"),
        band_bound("Time", upper).alias("UpperTime"),
    )


def delay_matches(
    trams: DataFrame,
    timetable: DataFrame,
    calendar_df: DataFrame,
    *,
    lower: int = BAND_LOWER_SEC,
    upper: int = BAND_UPPER_SEC,
    departure_range: tuple[int, int] | None = None,
    broadcast_calendar: bool = True,
    dedupe: bool = True,
) -> DataFrame:
    """Departures of the ping's line at its stop complex inside the band.

    A departure belongs to a service day and may be later than 24:00, so a
    ping is compared with every service day whose departures its band can
    reach: its own, the next one shortly before midnight, and as many earlier
    ones as the timetable's last departure runs on.  Bounds compare absolute
    seconds, so nothing wraps at midnight.  Delay = ping - departure seconds.

    ``departure_range`` is the timetable's first and last ``dep_sec``; unless
    given, one aggregate of the timetable finds it.
    """
    if departure_range is None:
        row = timetable.agg(F.min("dep_sec").alias("low"), F.max("dep_sec").alias("high")).first()
        departure_range = (row["low"] or 0, row["high"] or 0)
    first, last = departure_range
    sod = seconds_of_day("Time")
    # ping + off days - lower < last departure, and ping + off days + upper > first departure
    low = (F.floor((F.lit(first - upper) - sod) / DAY_SEC) + 1).cast("int")
    high = (F.ceil((F.lit(last + lower) - sod) / DAY_SEC) - 1).cast("int")
    cand = (
        trams.withColumn("_off", F.explode(F.when(low <= high, F.sequence(low, high))))
        .withColumn("_svc_day", F.date_sub(F.col("Date"), F.col("_off")))
        .withColumn("_svc_sec", sod + F.col("_off") * F.lit(DAY_SEC))
    )
    # grouped, so there is one row per date: its number bounds the broadcast
    cal = calendar_df.groupBy(F.col("day").alias("_svc_day")).agg(F.min("DayType").alias("_svc_type"))
    cand = cand.join(F.broadcast(cal) if broadcast_calendar else cal, "_svc_day")
    tt = timetable.select(
        F.col("Lines").alias("TT_Lines"), F.col("Unit").alias("_tt_unit"), F.col("DayType"),
        "Route", "StopNo", "Order", "dep_sec",
    )
    joined = band_join(
        cand, tt,
        on=[("Lines", "TT_Lines"), ("Unit", "_tt_unit"), ("_svc_type", "DayType")],
        left_t="_svc_sec", right_t="dep_sec", lower=lower, upper=upper,
    )
    out = joined.select(
        *TRAMS_STOPS_COLS, "Time",
        "TT_Lines",
        seconds_to_hms("dep_sec").alias("DepTime"),
        "StopNo", "DayType", "Route", "Order",
        (F.col("_svc_sec") - F.col("dep_sec")).cast("int").alias("Delay"),
    )
    return out.distinct() if dedupe else out


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the cluster's checkpoint folder and read it back.

    Used where one result feeds several branches (the chunked windows and the
    direction join read the matches twice): the matching pipeline runs once,
    and lineage is cut, so a lost executor does not replay it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# A vehicle-day of more matches is cut into chunks of tasks of their own.
SPLIT_ROWS = 100_000


def previous_stops(
    results: DataFrame, split_seconds: int | None = 3600, split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """Previous distinct stop of each vehicle on each date and line.

    ``split_seconds`` chunks each vehicle-day of more than ``split_rows`` matches
    (``None``: each one) by time of day so one busy vehicle is spread over tasks
    (``None``: one window per vehicle-day).
    """
    chunk = None
    if split_seconds:
        sod = F.hour("Time") * 3600 + F.minute("Time") * 60 + F.second("Time")
        chunk = F.floor(sod / F.lit(int(split_seconds)))
    return previous_distinct(
        results, "StopName", ["VehicleNumber", "Date", "Lines"], RESULT_ORDER,
        out="PrevStopCorrected", split_by=chunk, split_rows=split_rows,
    )


def routes_order(route_stops: DataFrame, chunk: int | None = 256) -> DataFrame:
    """Previous distinct stop along each route (W6 over line and route).

    Stops follow each other by their minute and, where minutes are equal (blank ones are 0), by
    their place ``pos`` on the route if the input has it, else by their number.
    """
    place = ["pos"] if "pos" in route_stops.columns else []
    base = route_stops.select("line_nr", "route_nr", "stop_nr", "StopName", "min_time", *place)
    return previous_distinct(
        base, "StopName", ["line_nr", "route_nr"], ["min_time", *place, "stop_nr"],
        out="PrevCorrected",
        split_by=F.floor(F.col("min_time") / F.lit(chunk)) if chunk else None,
    ).drop(*place).distinct()


def direction(
    prev: DataFrame, order: DataFrame, keep_only_matched: bool = False, route_order_rows: int | None = 2_000_000
) -> DataFrame:
    """Route direction: left join on (line, stop, previous stop) (J6, F5 opt-in).

    A (line, stop, previous stop) present in several routes yields one row per
    route, as in the original job.
    """
    ro = order.select(
        F.col("line_nr"), F.col("stop_nr"), F.col("StopName").alias("Stop_Name"),
        F.col("route_nr").alias("Direction"), F.col("PrevCorrected"),
    )
    ro = broadcast_if_small(ro, route_order_rows)
    cond = [
        prev["Lines"] == ro["line_nr"],
        prev["StopNo"] == ro["stop_nr"],
        prev["PrevStopCorrected"] == ro["PrevCorrected"],
    ]
    out = prev.join(ro, cond, "left").drop("PrevCorrected")
    if keep_only_matched:
        out = out.filter(F.col("Direction").isNotNull())
    return out


def delay_fact(direction_df: DataFrame) -> DataFrame:
    """Fact rows (StopNo int, VehicleNumber, Date date, DepTime, Delay)."""
    return direction_df.select(
        F.col("StopNo").try_cast("int").alias("StopNo"),
        "VehicleNumber",
        F.col("Date").cast("date").alias("Date"),
        "DepTime",
        F.col("Delay").cast("int").alias("Delay"),
    )


def run_delays(
    pings: DataFrame,
    route_stops: DataFrame,
    timetable: DataFrame,
    calendar_raw: DataFrame,
    *,
    cell_deg: float | str | None = "auto",
    lower: int = BAND_LOWER_SEC,
    upper: int = BAND_UPPER_SEC,
    keep_only_matched: bool = False,
) -> DataFrame:
    """The whole batch; returns the direction-enriched result rows."""
    trams = trams_stops(pings, route_stops, cell_deg=cell_deg, lower=lower, upper=upper)
    res = materialize(delay_matches(trams, timetable, calendar(calendar_raw), lower=lower, upper=upper))
    prev = previous_stops(res)
    return direction(prev, routes_order(route_stops), keep_only_matched=keep_only_matched)
