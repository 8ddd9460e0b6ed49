"""Transit roles played by the driver's TPC-H-like tables.

Both the Spark builders and the SQL text below derive the same rows with
integer arithmetic, so DuckDB can check every query on the same parquet files.

* pings      <- events   (vehicle = user_id, one ping per event)
* stops      <- supplier (one stop per supplier, line = nation)
* route stops<- supplier (two routes per line, different stop orders)
* timetable  <- lineitem JOIN supplier (one departure per line item)
* calendar   <- distinct event dates, day-type codes by ISO weekday
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the stand-in mapping (shared by Spark code and SQL oracles).
N_LINES = 25
N_BRIGADES = 7
LON0 = 20.85
LAT0 = 52.10
COORD_SCALE = 10000.0
PING_LON_MUL, PING_LON_SPAN = 7919, 4000
PING_LAT_MUL, PING_LAT_SPAN = 104729, 3000
STOP_LON_MUL, STOP_LON_SPAN = 6151, 4000
STOP_LAT_MUL, STOP_LAT_SPAN = 3571, 3000
DEP_ORDER_MUL, DEP_LINE_MUL = 37, 1301
SERVICE_DAY_SEC = 108000  # a service day runs until 30:00
ROUTE_B_MUL, ROUTE_B_MOD = 7, 1009


# tables small enough to stay one task (dimension-sized at every scale here)
_SMALL_TABLES = {"region", "nation", "supplier"}


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one driver table.  ``columns`` are projected before a small scan is
    spread over the cores, so the spreading shuffle carries only those."""
    from tramflow.sources.readers import ensure_partitions

    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return df if name in _SMALL_TABLES else ensure_partitions(df)


def _coord(key: str, base: float, mul: int, span: int) -> Column:
    return F.lit(base) + ((F.col(key) * F.lit(mul)) % F.lit(span)).cast("double") / F.lit(COORD_SCALE)


def _pad(c: Column, width: int) -> Column:
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def _whole_second(ts: str) -> Column:
    """Wall-clock time cut to whole seconds, without passing through the
    session time zone (so no shift inside daylight-saving gaps)."""
    t = F.col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t))


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(VehicleNumber, Lines, Brigade, Time, Lon, Lat) -- one ping per event."""
    return pings_from_events(table(spark, sf_dir, "events", ["event_id", "ts", "user_id"]))


def pings_from_events(ev: DataFrame) -> DataFrame:
    """The ping projection of an events frame (batch or stream)."""
    return ev.select(
        F.col("user_id").cast("string").alias("VehicleNumber"),
        (F.col("user_id") % N_LINES).cast("string").alias("Lines"),
        (F.col("user_id") % N_BRIGADES).cast("string").alias("Brigade"),
        _whole_second("ts").alias("Time"),
        _coord("event_id", LON0, PING_LON_MUL, PING_LON_SPAN).alias("Lon"),
        _coord("event_id", LAT0, PING_LAT_MUL, PING_LAT_SPAN).alias("Lat"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stop_nr, unit, post, StopName, Lon, Lat, line_nr, s_suppkey)."""
    s = table(spark, sf_dir, "supplier")
    unit = _pad(F.floor(F.col("s_suppkey") / 2).cast("long").cast("string"), 4)
    post = F.concat(F.lit("0"), (F.col("s_suppkey") % 2 + 1).cast("string"))
    return s.select(
        F.concat(unit, post).alias("stop_nr"),
        unit.alias("unit"),
        post.alias("post"),
        F.col("s_name").alias("StopName"),
        _coord("s_suppkey", LON0, STOP_LON_MUL, STOP_LON_SPAN).alias("Lon"),
        _coord("s_suppkey", LAT0, STOP_LAT_MUL, STOP_LAT_SPAN).alias("Lat"),
        F.col("s_nationkey").cast("string").alias("line_nr"),
        "s_suppkey",
    )


def route_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat route coordinates (line_nr, route_nr, stop_nr, StopName, min_time, Lat, Lon, Unit)."""
    st = stops(spark, sf_dir)
    a = st.select(
        "line_nr", F.lit("TP-A").alias("route_nr"), "stop_nr", "StopName",
        F.col("s_suppkey").cast("long").alias("min_time"), "Lat", "Lon", F.col("unit").alias("Unit"),
    )
    b = st.select(
        "line_nr", F.lit("TP-B").alias("route_nr"), "stop_nr", "StopName",
        ((F.col("s_suppkey") * ROUTE_B_MUL) % ROUTE_B_MOD).cast("long").alias("min_time"),
        "Lat", "Lon", F.col("unit").alias("Unit"),
    )
    return a.unionByName(b)


def timetable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Lines, Route, StopNo, dep_sec, Order, DayType, Unit) -- stop join on the supplier key."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    st = stops(spark, sf_dir).select("s_suppkey", "stop_nr", "unit", "line_nr")
    j = li.join(st, li["l_suppkey"] == st["s_suppkey"])
    return j.select(
        F.col("line_nr").alias("Lines"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("TP-A")).otherwise(F.lit("TP-B")).alias("Route"),
        F.col("stop_nr").alias("StopNo"),
        ((F.col("l_orderkey") * DEP_ORDER_MUL + F.col("l_linenumber") * DEP_LINE_MUL) % SERVICE_DAY_SEC)
        .cast("int").alias("dep_sec"),
        F.col("l_linenumber").alias("Order"),
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("DP"))
        .when(F.col("l_orderkey") % 3 == 1, F.lit("SB"))
        .otherwise(F.lit("DS")).alias("DayType"),
        F.col("unit").alias("Unit"),
    )


def calendar_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, day_types) for every date that has events."""
    days = table(spark, sf_dir, "events", ["ts"]).select(F.to_date("ts").alias("day")).distinct()
    dow = (F.weekday("day") + 1).cast("string")
    types = (
        F.when(F.dayofmonth("day") == 15, F.array(F.lit("TS"), F.lit("NO")))
        .when(F.weekday("day") < 5, F.array(F.concat(F.lit("D"), dow), F.concat(F.lit("N"), dow), F.lit("DP"), F.lit("NP")))
        .when(F.weekday("day") == 5, F.array(F.lit("D6"), F.lit("N6"), F.lit("SB"), F.lit("NS")))
        .otherwise(F.array(F.lit("D7"), F.lit("N7"), F.lit("TS"), F.lit("NS")))
    )
    return days.select("day", types.alias("day_types"))


# ---------------------------------------------------------------- SQL side

def _sql_coord(key: str, base: float, mul: int, span: int) -> str:
    return f"(CAST({base} AS DOUBLE) + CAST(({key} * {mul}) % {span} AS DOUBLE) / CAST({COORD_SCALE} AS DOUBLE))"


def _sql_pad(expr: str, width: int) -> str:
    return f"(CASE WHEN length({expr}) < {width} THEN lpad({expr}, {width}, '0') ELSE {expr} END)"


_UNIT = _sql_pad("CAST(s_suppkey // 2 AS VARCHAR)", 4)
_POST = "('0' || CAST(s_suppkey % 2 + 1 AS VARCHAR))"

PINGS_SQL = f"""
SELECT CAST(user_id AS VARCHAR) AS VehicleNumber,
       CAST(user_id % {N_LINES} AS VARCHAR) AS Lines,
       CAST(user_id % {N_BRIGADES} AS VARCHAR) AS Brigade,
       date_trunc('second', ts) AS Time,
       {_sql_coord('event_id', LON0, PING_LON_MUL, PING_LON_SPAN)} AS Lon,
       {_sql_coord('event_id', LAT0, PING_LAT_MUL, PING_LAT_SPAN)} AS Lat
FROM events"""

STOPS_SQL = f"""
SELECT {_UNIT} || {_POST} AS stop_nr, {_UNIT} AS unit, {_POST} AS post, s_name AS StopName,
       {_sql_coord('s_suppkey', LON0, STOP_LON_MUL, STOP_LON_SPAN)} AS Lon,
       {_sql_coord('s_suppkey', LAT0, STOP_LAT_MUL, STOP_LAT_SPAN)} AS Lat,
       CAST(s_nationkey AS VARCHAR) AS line_nr, s_suppkey
FROM supplier"""

ROUTE_STOPS_SQL = f"""
SELECT line_nr, 'TP-A' AS route_nr, stop_nr, StopName, CAST(s_suppkey AS BIGINT) AS min_time, Lat, Lon, unit AS Unit
FROM ({STOPS_SQL}) s_a
UNION ALL
SELECT line_nr, 'TP-B' AS route_nr, stop_nr, StopName,
       CAST((s_suppkey * {ROUTE_B_MUL}) % {ROUTE_B_MOD} AS BIGINT) AS min_time, Lat, Lon, unit AS Unit
FROM ({STOPS_SQL}) s_b"""

TIMETABLE_SQL = f"""
SELECT s.line_nr AS Lines,
       CASE WHEN l.l_linenumber % 2 = 0 THEN 'TP-A' ELSE 'TP-B' END AS Route,
       s.stop_nr AS StopNo,
       CAST((l.l_orderkey * {DEP_ORDER_MUL} + l.l_linenumber * {DEP_LINE_MUL}) % {SERVICE_DAY_SEC} AS INTEGER) AS dep_sec,
       l.l_linenumber AS "Order",
       CASE l.l_orderkey % 3 WHEN 0 THEN 'DP' WHEN 1 THEN 'SB' ELSE 'DS' END AS DayType,
       s.unit AS Unit
FROM lineitem l JOIN ({STOPS_SQL}) s ON l.l_suppkey = s.s_suppkey"""

CALENDAR_RAW_SQL = """
SELECT day,
       CASE WHEN dayofmonth(day) = 15 THEN ['TS', 'NO']
            WHEN isodow(day) <= 5 THEN ['D' || CAST(isodow(day) AS VARCHAR), 'N' || CAST(isodow(day) AS VARCHAR), 'DP', 'NP']
            WHEN isodow(day) = 6 THEN ['D6', 'N6', 'SB', 'NS']
            ELSE ['D7', 'N7', 'TS', 'NS'] END AS day_types
FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d"""

DAY_TYPE_SQL = """CASE WHEN list_contains(day_types, 'DP') THEN 'DP'
            WHEN list_contains(day_types, 'N7') THEN 'DS'
            WHEN list_contains(day_types, 'SB') THEN 'SB'
            ELSE 'Unknown' END"""

CALENDAR_SQL = f"SELECT day, day_types, {DAY_TYPE_SQL} AS DayType FROM ({CALENDAR_RAW_SQL}) cr"


# ---------------------------------------------------------------- load feeds

FEED_R_MOD, FEED_R_HIT = 17, 5      # every 17th supplier has an 'R' unit
FEED_NULL_MOD, FEED_NULL_HIT = 11, 3  # every 11th supplier has no coordinates
ROUTE_LINE_MOD = 997                  # orders share a line number


def _feed_unit(key: str = "s_suppkey") -> Column:
    base = F.floor(F.col(key) / 3).cast("long").cast("string")
    return F.when(F.col(key) % FEED_R_MOD == FEED_R_HIT, F.concat(F.lit("R"), _pad(base, 3))).otherwise(_pad(base, 4))


def _feed_post(key: str = "s_suppkey") -> Column:
    return F.concat(F.lit("0"), (F.col(key) % 2 + 1).cast("string"))


def stops_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops collection rows (unit, post, unit_name, street_id, latitude,
    longitude, direction, valid_from): duplicate (unit, post), R units and
    missing coordinates included."""
    s = table(spark, sf_dir, "supplier")
    no_xy = F.col("s_suppkey") % FEED_NULL_MOD == FEED_NULL_HIT
    return s.select(
        _feed_unit().alias("unit"),
        _feed_post().alias("post"),
        F.col("s_name").alias("unit_name"),
        F.col("s_nationkey").alias("street_id"),
        F.when(~no_xy, _coord("s_suppkey", LAT0, STOP_LAT_MUL, STOP_LAT_SPAN)).alias("latitude"),
        F.when(~no_xy, _coord("s_suppkey", LON0, STOP_LON_MUL, STOP_LON_SPAN)).alias("longitude"),
        F.concat(F.lit("dir-"), (F.col("s_suppkey") % 4).cast("string")).alias("direction"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("valid_from"),
    )


def route_items(spark: SparkSession, sf_dir: str, by_document: bool = False) -> DataFrame:
    """Flat route stops from line items: one line document per order, one route
    per return flag, stops in line-number order.

    ``by_document`` moves the items of a document into one task, before their texts are made.
    """
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_returnflag", "l_suppkey", "l_partkey", "l_quantity",
                                           "l_linenumber", "l_extendedprice"])
    if by_document:
        li = li.repartition("l_orderkey")
    return li.select(
        F.col("l_orderkey").alias("doc_id"),
        (F.col("l_orderkey") % ROUTE_LINE_MOD).cast("string").alias("line_nr"),
        F.col("l_returnflag").alias("route_nr"),
        F.concat(_feed_unit("l_suppkey"), _feed_post("l_suppkey")).alias("stop_nr"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("stop_name"),
        F.lit("").alias("street"),
        (F.col("l_quantity") > 25).alias("r_flag"),
        F.col("l_linenumber").alias("min_time"),
        (F.col("l_linenumber") + 1).alias("max_time"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    )


def routes_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes collection (doc_id, line_nr, number_of_routes, routes[stops[]]) (A5)."""
    from tramflow.operators.nested import assemble

    # one shuffle by document: both groupings and what follows by document keep to it
    items = route_items(spark, sf_dir, by_document=True)
    routes = assemble(
        items,
        ["doc_id", "line_nr", "route_nr"],
        ["stop_nr", "stop_name", "street", "r_flag", "min_time", "max_time"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
        "stops",
        count_col="number_of_stops",
    )
    docs = assemble(routes, ["doc_id", "line_nr"], ["route_nr", "number_of_stops", "stops"], ["route_nr"], "routes")
    return docs.select("doc_id", "line_nr", F.size("routes").alias("number_of_routes"), "routes")


def _sql_feed_unit(key: str) -> str:
    base = f"CAST({key} // 3 AS VARCHAR)"
    return (f"(CASE WHEN {key} % {FEED_R_MOD} = {FEED_R_HIT} THEN 'R' || {_sql_pad(base, 3)} "
            f"ELSE {_sql_pad(base, 4)} END)")


def _sql_feed_post(key: str) -> str:
    return f"('0' || CAST({key} % 2 + 1 AS VARCHAR))"


STOPS_FEED_SQL = f"""
SELECT {_sql_feed_unit('s_suppkey')} AS unit, {_sql_feed_post('s_suppkey')} AS post, s_name AS unit_name,
       s_nationkey AS street_id,
       CASE WHEN s_suppkey % {FEED_NULL_MOD} = {FEED_NULL_HIT} THEN NULL
            ELSE {_sql_coord('s_suppkey', LAT0, STOP_LAT_MUL, STOP_LAT_SPAN)} END AS latitude,
       CASE WHEN s_suppkey % {FEED_NULL_MOD} = {FEED_NULL_HIT} THEN NULL
            ELSE {_sql_coord('s_suppkey', LON0, STOP_LON_MUL, STOP_LON_SPAN)} END AS longitude,
       'dir-' || CAST(s_suppkey % 4 AS VARCHAR) AS direction,
       TIMESTAMP '2024-01-01 00:00:00' AS valid_from
FROM supplier"""

ROUTE_ITEMS_SQL = f"""
SELECT l_orderkey AS doc_id, CAST(l_orderkey % {ROUTE_LINE_MOD} AS VARCHAR) AS line_nr, l_returnflag AS route_nr,
       {_sql_feed_unit('l_suppkey')} || {_sql_feed_post('l_suppkey')} AS stop_nr,
       'Part ' || CAST(l_partkey AS VARCHAR) AS stop_name, '' AS street, l_quantity > 25 AS r_flag,
       l_linenumber AS min_time, l_linenumber + 1 AS max_time,
       l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM lineitem"""
