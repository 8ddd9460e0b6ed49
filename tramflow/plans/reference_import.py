"""Reference-data import -- schedule dump and stops feed to collections.

The dump's line sections are read and split into lines once (materialized),
then the timetable, the nested routes and the calendar (whose block lies in the
first section's record) are derived from them.  Each collection is replaced as a
whole (S6).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tramflow.plans.delays import materialize
from tramflow.sources.readers import read_stops_feed
from tramflow.sources.schedule_text import (
    DEFAULT_ENCODING,
    SECTION_END,
    calendar_days,
    departures,
    line_sections,
    read_records,
    record_lines,
    route_headers,
    route_stop_lines,
    routes_documents,
    tokenize_stops,
)
from tramflow.sources.sinks import replace_collection

COLLECTIONS = ("Timetable", "Calendar", "Stops", "Routes")


def run_import(
    spark: SparkSession,
    dump_path: str,
    stops_feed_path: str,
    out_dir: str,
    encoding: str = DEFAULT_ENCODING,
    fmt: str = "parquet",
) -> dict[str, str]:
    """Parse and replace the four reference collections; returns their paths."""
    lines = materialize(record_lines(read_records(spark, dump_path, SECTION_END, encoding)))
    outputs = {
        "Timetable": departures(line_sections(lines)),
        "Calendar": calendar_days(lines),
        "Stops": read_stops_feed(spark, stops_feed_path),
        "Routes": routes_documents(tokenize_stops(route_stop_lines(lines)), route_headers(lines)),
    }
    paths = {}
    for name, df in outputs.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        replace_collection(df, path, fmt)
        paths[name] = path
    return paths
