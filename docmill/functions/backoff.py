"""Waiting times between tries, in milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill import rules


def backoff_ms(
    attempt: Column,
    max_attempts: int = rules.RETRY_MAX_ATTEMPTS,
    initial_ms: int = rules.RETRY_INITIAL_MS,
    multiplier: float = rules.RETRY_MULTIPLIER,
    cap_ms: int = rules.RETRY_CAP_MS,
) -> Column:
    """Exponential wait after the given failed try, before jitter."""
    if max_attempts <= 1 or initial_ms == 0:
        return F.lit(0).cast("long")
    grown = F.lit(float(initial_ms)) * F.pow(F.lit(multiplier), attempt - 1)
    return F.least(grown, F.lit(float(cap_ms))).cast("long")


def with_retry_after(wait_ms: Column, retry_after_s: Column) -> Column:
    """The longer of the wait and what the service asked for, if it did."""
    return F.greatest(
        wait_ms, F.when(retry_after_s > 0, retry_after_s * 1000).otherwise(0).cast("long")
    )
