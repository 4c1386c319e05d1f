"""Reuse on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame


def stream_dedup(
    stream: DataFrame, key: str = "variant_key", event_time: str = "ts", delay: str = "1 hour"
) -> DataFrame:
    """First row per key; the watermark bounds how long a key is remembered.

    The event time must be a TIMESTAMP: a watermark on TIMESTAMP_NTZ is refused.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
