"""Scans and sinks: GPS snapshots, collections, stop feeds, schedule dumps."""

from tramflow.sources.readers import parse_stops, read_collection, read_pings, flatten_pings
from tramflow.sources.sinks import replace_collection, write_jdbc, write_table

__all__ = [
    "flatten_pings",
    "parse_stops",
    "read_collection",
    "read_pings",
    "replace_collection",
    "write_jdbc",
    "write_table",
]
