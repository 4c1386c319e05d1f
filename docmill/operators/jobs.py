"""Long-running jobs from their event log.

Columns: job_id, ts, status (queued, running, succeeded, failed), format,
cache_hit, error_code, error_reason, retryable. One aggregation per job with
map-side combining; no window, so a job with any number of events is fine.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill import rules
from docmill.functions.text import flag

TERMINAL = ("succeeded", "failed")
# Later states win between events of equal time.
STATE_RANK = {"queued": 0, "running": 1, "succeeded": 2, "failed": 3}


def _rank(status: Column) -> Column:
    rank = F.lit(-1)
    for name, value in STATE_RANK.items():
        rank = F.when(status == name, value).otherwise(rank)
    return rank


def is_terminal(status: Column) -> Column:
    return status.isin(*TERMINAL)


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))


def _latest() -> Column:
    return F.max(
        F.struct(
            "ts",
            _rank(F.col("status")).alias("rank"),
            "status",
            "format",
            "error_code",
            "error_reason",
            flag(F.col("retryable")).alias("retryable"),
            flag(F.col("cache_hit")).alias("cache_hit"),
        )
    )


def job_latest(events: DataFrame) -> DataFrame:
    """Current status of every job, terminal or not."""
    return (
        events.groupBy("job_id")
        .agg(_latest().alias("_last"), F.count(F.lit(1)).alias("events"))
        .select(
            "job_id",
            F.col("_last.ts").alias("ts"),
            F.col("_last.status").alias("status"),
            is_terminal(F.col("_last.status")).alias("is_terminal"),
            F.col("_last.format").alias("format"),
            F.col("_last.error_code").alias("error_code"),
            F.col("_last.error_reason").alias("error_reason"),
            F.col("_last.retryable").alias("retryable"),
            F.col("_last.cache_hit").alias("cache_hit"),
            "events",
        )
    )


def job_durations(events: DataFrame) -> DataFrame:
    """First time in each state, time in queue and time running, in milliseconds."""

    def first(*states: str) -> Column:
        return F.min(F.when(F.col("status").isin(*states), F.col("ts")))

    return (
        events.groupBy("job_id")
        .agg(
            F.min("ts").alias("created_at"),
            first("running").alias("started_at"),
            first(*TERMINAL).alias("finished_at"),
        )
        .withColumns(
            {
                "queue_ms": millis_between(F.col("created_at"), F.col("started_at")),
                "run_ms": millis_between(F.col("started_at"), F.col("finished_at")),
                "total_ms": millis_between(F.col("created_at"), F.col("finished_at")),
            }
        )
    )


def job_deadlines(
    events: DataFrame,
    max_wait_ms: int,
    now: datetime | str,
    retention_ms: int = rules.JOB_RETENTION_MS,
) -> DataFrame:
    """What a caller asking at ``now`` would be told about each job.

    The status is looked at before the deadline, so a finished job never times
    out; a finished job older than the retention is no longer known.
    """
    # In the column's own type, so that the filter reaches the scan.
    at = F.lit(str(now)).cast(events.schema["ts"].dataType)
    per_job = (
        events.filter(F.col("ts") <= at)
        .groupBy("job_id")
        .agg(
            F.min("ts").alias("created_at"),
            _latest().alias("_last"),
        )
        .select(
            "job_id",
            F.col("_last.status").alias("status"),
            millis_between(F.col("created_at"), at).alias("waited_ms"),
            millis_between(F.col("_last.ts"), at).alias("since_last_ms"),
        )
    )
    done = is_terminal(F.col("status"))
    late = ~done & (F.col("waited_ms") >= max_wait_ms)
    return per_job.select(
        "job_id",
        "status",
        "waited_ms",
        F.when(done & (F.col("since_last_ms") > retention_ms), "unknown")
        .when(done, F.col("status"))
        .when(late, "timeout")
        .otherwise(F.col("status"))
        .alias("verdict"),
        F.when(late, 504).cast("long").alias("http_status"),
        F.lit(False).alias("retryable"),
        F.when(late, "deadline").alias("timeout_origin"),
    )
