"""Scalar column functions (built-in Spark expressions only, no UDFs)."""

from tramflow.functions.geo import EARTH_RADIUS_M, grid_cell, haversine_m, outside_block_bound_m
from tramflow.functions.timeofday import (
    band_bound,
    departure_seconds,
    hms_to_seconds,
    seconds_of_day,
    seconds_to_hms,
    split_timestamp_text,
)
from tramflow.functions.keys import line_name, null_literal, numeric_stop_id, split_stop_key, stop_key
from tramflow.functions.calendar import day_type

__all__ = [
    "EARTH_RADIUS_M",
    "band_bound",
    "day_type",
    "departure_seconds",
    "grid_cell",
    "haversine_m",
    "hms_to_seconds",
    "line_name",
    "null_literal",
    "numeric_stop_id",
    "outside_block_bound_m",
    "seconds_of_day",
    "seconds_to_hms",
    "split_stop_key",
    "split_timestamp_text",
    "stop_key",
]
