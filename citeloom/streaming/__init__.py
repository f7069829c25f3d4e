"""Structured Streaming jobs."""

from citeloom.streaming.compaction import compact_readings, read_readings, remove_compacted
from citeloom.streaming.sensors import (dropped_late_rows, ingest_sensors, parse_sensor_messages,
                                        publish_readings, read_sensor_stream, reading_messages, stream_counts)

__all__ = ["compact_readings", "dropped_late_rows", "ingest_sensors", "parse_sensor_messages", "publish_readings",
           "read_readings", "read_sensor_stream", "reading_messages", "remove_compacted", "stream_counts"]
