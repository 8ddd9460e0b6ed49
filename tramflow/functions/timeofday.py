"""Time of day without a TIME type: seconds of the service day.

A service day may run past midnight (departures at 24:05, 25:10), so a
departure is an integer number of seconds since the service day's midnight
and may exceed 86,399.  Wall-clock strings are derived with ``hour % 24``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramflow.functions._cols import as_col


def seconds_of_day(ts) -> Column:
    """Whole seconds since midnight of a timestamp's own date."""
    t = as_col(ts)
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("int")


def seconds_to_hms(sec) -> Column:
    """``HH:mm:ss`` wall-clock text of a service-day second (hour modulo 24)."""
    s = as_col(sec).cast("long")
    return F.concat(
        F.lpad(((s / 3600).cast("long") % 24).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(((s % 3600) / 60).cast("long").cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((s % 60).cast("string"), 2, "0"),
    )


def hms_to_seconds(text) -> Column:
    """``H:mm[:ss]`` or ``H.mm`` text to service-day seconds; hours >= 24 allowed.

    Malformed text gives NULL instead of failing the job.
    """
    parts = F.split(F.regexp_replace(F.trim(as_col(text)), r"\.", ":"), ":")
    h = F.try_element_at(parts, F.lit(1)).try_cast("int")
    m = F.try_element_at(parts, F.lit(2)).try_cast("int")
    s = F.coalesce(F.try_element_at(parts, F.lit(3)).try_cast("int"), F.lit(0))
    ok = h.isNotNull() & m.isNotNull() & (m < 60) & (s < 60)
    return F.when(ok, h * 3600 + m * 60 + s)


def departure_seconds(text) -> Column:
    """Schedule-dump departure ``HH.MM`` to service-day seconds (``24.05`` -> 86,700)."""
    return hms_to_seconds(text)


def split_timestamp_text(text) -> tuple[Column, Column]:
    """``yyyy-MM-dd HH:mm:ss`` text to (``HH:mm:ss`` time text, ``yyyy-MM-dd`` date text)."""
    parts = F.split(F.trim(as_col(text)), " ")
    return F.try_element_at(parts, F.lit(2)), F.try_element_at(parts, F.lit(1))


def band_bound(ts, offset_seconds: int) -> Column:
    """``HH:mm:ss`` text of ``ts`` shifted by ``offset_seconds`` (display only;
    band comparisons use absolute seconds so they do not wrap at midnight)."""
    return F.date_format(as_col(ts) + F.make_dt_interval(secs=F.lit(offset_seconds)), "HH:mm:ss")
