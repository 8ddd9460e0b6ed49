"""Structured Streaming: GPS snapshot ingest, de-duplication, nearest stop
and delay on the stream, and the per-snapshot state load."""

from tramflow.streaming.gps_stream import (
    dedupe_pings,
    load_snapshots,
    ping_stream,
    stream_delays,
    stream_nearest,
)

__all__ = ["dedupe_pings", "load_snapshots", "ping_stream", "stream_delays", "stream_nearest"]
