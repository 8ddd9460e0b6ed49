"""DuckDB SQL for the delay pipeline on the driver tables (the correctness oracle).

Written the plain way -- all-pairs nearest stop with ``row_number``, range
join, ``lag`` / ``last_value IGNORE NULLS`` windows -- so it checks the Spark
plan's grid pruning, time buckets and chunked windows.
"""

from __future__ import annotations

from tramflow.functions.geo import haversine_sql
from tramflow.plans.driver_views import CALENDAR_SQL, PINGS_SQL, ROUTE_STOPS_SQL, TIMETABLE_SQL


def hms_sql(sec: str) -> str:
    return (
        f"lpad(CAST(({sec} // 3600) % 24 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST(({sec} % 3600) // 60 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST({sec} % 60 AS VARCHAR), 2, '0')"
    )


RESULT_ORDER_SQL = 'CurrTramTime, distance, DepTime, Route, "Order", StopNo, DayType, Delay'

CTE_TRAMS = f"""
pings AS ({PINGS_SQL}),
rs AS ({ROUTE_STOPS_SQL}),
cands AS (SELECT DISTINCT line_nr, stop_nr, StopName, Unit, Lat AS s_Lat, Lon AS s_Lon FROM rs),
pairs AS (
  SELECT p.*, c.stop_nr, c.StopName, c.Unit,
         {haversine_sql('p.Lon', 'p.Lat', 'c.s_Lon', 'c.s_Lat')} AS distance
  FROM pings p JOIN cands c ON p.Lines = c.line_nr
  WHERE p.Lon IS NOT NULL AND p.Lat IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Lines, Brigade, Time
                               ORDER BY distance, stop_nr, VehicleNumber, Lat, Lon) AS rn
  FROM pairs),
trams AS (
  SELECT Lines, Lat, Lon, VehicleNumber, Time, strftime(Time, '%H:%M:%S') AS CurrTramTime,
         CAST(Time AS DATE) AS Date, Brigade, StopName, Unit, distance,
         strftime(Time - INTERVAL 600 SECOND, '%H:%M:%S') AS LowerTime,
         strftime(Time + INTERVAL 180 SECOND, '%H:%M:%S') AS UpperTime,
         stop_nr
  FROM ranked WHERE rn = 1)"""

CTE_RESULTS = f"""{CTE_TRAMS},
cal AS ({CALENDAR_SQL}),
tt AS ({TIMETABLE_SQL}),
dated AS (
  SELECT tt.*, epoch(CAST(c.day AS TIMESTAMP)) + tt.dep_sec AS departs
  FROM tt JOIN cal c ON c.DayType = tt.DayType),
res AS (
  SELECT DISTINCT s.Lines, s.Lat, s.Lon, s.VehicleNumber, s.CurrTramTime, s.Date, s.Brigade, s.StopName,
         s.Unit, s.distance, s.LowerTime, s.UpperTime, s.Time,
         d.Lines AS TT_Lines, {hms_sql('d.dep_sec')} AS DepTime, d.StopNo, d.DayType, d.Route,
         d."Order", CAST(epoch(s.Time) - d.departs AS INTEGER) AS Delay
  FROM trams s
  JOIN dated d ON d.Lines = s.Lines AND d.Unit = s.Unit
              AND d.departs > epoch(s.Time) - 600 AND d.departs < epoch(s.Time) + 180)"""

CTE_DIRECTION = f"""{CTE_RESULTS},
ps1 AS (
  SELECT *, CASE WHEN StopName <> lag(StopName) OVER w THEN lag(StopName) OVER w END AS chg
  FROM res WINDOW w AS (PARTITION BY Date, Lines, VehicleNumber ORDER BY {RESULT_ORDER_SQL})),
ps AS (
  SELECT *, last_value(chg IGNORE NULLS) OVER (
           PARTITION BY Date, Lines, VehicleNumber ORDER BY {RESULT_ORDER_SQL}
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS PrevStopCorrected
  FROM ps1),
ro1 AS (
  SELECT line_nr, route_nr, stop_nr, StopName, min_time,
         CASE WHEN StopName <> lag(StopName) OVER w2 THEN lag(StopName) OVER w2 END AS chg
  FROM rs WINDOW w2 AS (PARTITION BY line_nr, route_nr ORDER BY min_time, stop_nr)),
ro AS (
  SELECT DISTINCT line_nr, route_nr, stop_nr, StopName, min_time,
         last_value(chg IGNORE NULLS) OVER (PARTITION BY line_nr, route_nr ORDER BY min_time, stop_nr
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS PrevCorrected
  FROM ro1),
dir AS (
  SELECT ps.*, ro.line_nr, ro.stop_nr AS ro_stop_nr, ro.StopName AS Stop_Name, ro.route_nr AS Direction
  FROM ps LEFT JOIN ro
    ON ps.Lines = ro.line_nr AND ps.StopNo = ro.stop_nr AND ps.PrevStopCorrected = ro.PrevCorrected)"""

NEAREST_SQL = f"""WITH {CTE_TRAMS}
SELECT Lines, Brigade, Time, VehicleNumber, Lat, Lon, stop_nr, StopName, Unit, distance FROM trams"""

TRAMS_STOPS_SQL = f"""WITH {CTE_TRAMS}
SELECT Lines, Lat, Lon, VehicleNumber, CurrTramTime, Date, Brigade, StopName, Unit, distance,
       LowerTime, UpperTime FROM trams"""

RESULTS_SQL = f"""WITH {CTE_RESULTS}
SELECT Lines, VehicleNumber, Date, CurrTramTime, StopName, Unit, distance, TT_Lines, DepTime, StopNo,
       DayType, Route, "Order", Delay FROM res"""

PREVIOUS_STOPS_SQL = f"""WITH {CTE_DIRECTION}
SELECT Lines, VehicleNumber, Date, CurrTramTime, StopName, StopNo, DepTime, Route, "Order", Delay,
       PrevStopCorrected FROM ps"""

DIRECTION_SQL = f"""WITH {CTE_DIRECTION}
SELECT Lines, VehicleNumber, Date, CurrTramTime, StopName, StopNo, DepTime, Delay, PrevStopCorrected,
       Direction FROM dir"""

FACT_SQL = f"""WITH {CTE_DIRECTION}
SELECT TRY_CAST(StopNo AS INTEGER) AS StopNo, VehicleNumber, Date, DepTime, Delay FROM dir"""

ROUTES_ORDER_SQL = f"""WITH rs AS ({ROUTE_STOPS_SQL}),
ro1 AS (
  SELECT line_nr, route_nr, stop_nr, StopName, min_time,
         CASE WHEN StopName <> lag(StopName) OVER w2 THEN lag(StopName) OVER w2 END AS chg
  FROM rs WINDOW w2 AS (PARTITION BY line_nr, route_nr ORDER BY min_time, stop_nr))
SELECT DISTINCT line_nr, route_nr, stop_nr, StopName, min_time,
       last_value(chg IGNORE NULLS) OVER (PARTITION BY line_nr, route_nr ORDER BY min_time, stop_nr
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS PrevCorrected
FROM ro1"""
