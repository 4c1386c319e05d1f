"""Counts per window on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docmill.operators import metrics


def windowed_metrics(
    stream: DataFrame,
    width: str = "1 hour",
    delay: str = "10 minutes",
    event_time: str = "ts",
    by: str = "class",
) -> DataFrame:
    """As on a table. In append mode a window appears once the watermark passes it."""
    return metrics.windowed_metrics(stream.withWatermark(event_time, delay), width, event_time, by)
