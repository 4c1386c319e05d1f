"""Logs of conversion-service responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmill import schemas


def read_response_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with a fixed schema; the body stays text until it is needed."""
    return spark.read.schema(schemas.RESPONSE_LOG).json(path)
