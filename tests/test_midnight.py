"""Departures around midnight: the ping's own, the next and any earlier service day."""

import datetime as dt

import pytest

from tramflow.plans import delays


def matches(spark, time, dep_sec, days=("2024-03-01", "2024-03-02", "2024-03-03")):
    trams = spark.createDataFrame(
        [("7", 21.0, 52.0, "v1", time, time.strftime("%H:%M:%S"), time.date(), "1", "A", "1001", 5.0, "", "")],
        "Lines string, Lon double, Lat double, VehicleNumber string, Time timestamp_ntz, CurrTramTime string, Date date, "
        "Brigade string, StopName string, Unit string, distance double, LowerTime string, UpperTime string",
    )
    timetable = spark.createDataFrame([("7", "1001", "DP", "r", "100101", 1, dep_sec)], "Lines string, Unit string, DayType string, Route string, StopNo string, `Order` int, dep_sec int")
    rows = [(dt.date.fromisoformat(d), "DP") for d in days for _ in range(2)]  # a repeated calendar day must not multiply rows
    return [r.Delay for r in delays.delay_matches(trams, timetable, spark.createDataFrame(rows, "day date, DayType string"), dedupe=False).collect()]


@pytest.mark.parametrize(
    ("time", "dep_sec", "expected"),
    [
        (dt.datetime(2024, 3, 1, 23, 58, 30), 30, [-120]),  # next service day
        (dt.datetime(2024, 3, 2, 3, 5), 27 * 3600, [300]),  # 27:00 of the previous one
        (dt.datetime(2024, 3, 3, 3, 5), 51 * 3600, [300]),  # 51:00 of the one before
        (dt.datetime(2024, 3, 1, 12, 0), 12 * 3600 - 600, []),  # bounds are strict
        (dt.datetime(2024, 3, 1, 12, 0), 12 * 3600 - 599, [599]),
    ],
)
def test_service_days(spark, time, dep_sec, expected):
    assert matches(spark, time, dep_sec) == expected
