import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException

from docmill.operators import jobs
from docmill.sources.sinks import run_to_table
from docmill.sources.documents import stream_table
from docmill.streaming.jobs import job_tracker, live_job_tracker

T0 = datetime(2024, 1, 1)
SCHEMA = (
    "job_id string, ts timestamp, status string, format string, cache_hit boolean, "
    "error_code string, error_reason string, retryable boolean"
)


def events(spark, rows):
    """rows of (job_id, minutes, status, error_code)"""
    full = [(j, T0 + timedelta(minutes=m), s, "docx", None, c, None, None) for j, m, s, c in rows]
    return spark.createDataFrame(full, SCHEMA)


ROWS = [
    ("done", 5, "succeeded", None), ("done", 0, "queued", None), ("done", 2, "running", None),
    ("bad", 0, "queued", None), ("bad", 3, "failed", "missing_part"),
    ("stuck", 0, "queued", None), ("stuck", 1, "running", None),
    ("cached", 0, "succeeded", None),
    ("tie", 4, "succeeded", None), ("tie", 4, "running", None), ("tie", 0, "queued", None),
]


def test_latest(spark):
    got = {r["job_id"]: (r["status"], r["is_terminal"], r["error_code"]) for r in jobs.job_latest(events(spark, ROWS)).collect()}
    assert got == {
        "done": ("succeeded", True, None), "bad": ("failed", True, "missing_part"),
        "stuck": ("running", False, None), "cached": ("succeeded", True, None),
        "tie": ("succeeded", True, None),
    }


def test_durations(spark):
    got = {r["job_id"]: (r["queue_ms"], r["run_ms"], r["total_ms"]) for r in jobs.job_durations(events(spark, ROWS)).collect()}
    minute = 60_000
    assert got["done"] == (2 * minute, 3 * minute, 5 * minute)
    assert got["bad"] == (None, None, 3 * minute)
    assert got["stuck"] == (minute, None, None)
    assert got["cached"] == (None, None, 0)


def test_deadlines(spark):
    now = T0 + timedelta(minutes=61)
    late = jobs.job_deadlines(events(spark, ROWS), max_wait_ms=10 * 60_000, now=now, retention_ms=58 * 60_000)
    got = {r["job_id"]: (r["verdict"], r["http_status"], r["timeout_origin"]) for r in late.collect()}
    assert got["stuck"] == ("timeout", 504, "deadline")
    assert got["done"] == ("succeeded", None, None)
    assert got["cached"] == ("unknown", None, None)
    soon = jobs.job_deadlines(events(spark, ROWS), 10 * 60_000, T0 + timedelta(minutes=4))
    got = {r["job_id"]: r["verdict"] for r in soon.collect()}
    assert (got["stuck"], got["done"], got["bad"]) == ("running", "running", "failed")


@pytest.mark.parametrize("files_per_trigger", [1, 100])
def test_tracker_does_not_depend_on_batches(spark, tmp_path, files_per_trigger):
    rows = ROWS + [
        ("late", 0, "queued", None), ("late", 30, "succeeded", None), ("clock", 600, "queued", None)
    ]
    path = str(tmp_path / "events")
    ordered = sorted(rows, key=lambda r: r[1])
    for start in range(0, len(ordered), 5):
        part = events(spark, ordered[start : start + 5]).select("job_id", "ts", "status")
        part.coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    stream = stream_table(spark, path, schema, max_files_per_trigger=files_per_trigger)
    out = run_to_table(job_tracker(stream, max_wait_ms=10 * 60_000, delay="1 minute"), "tracker-test")
    got = {r["job_id"]: (r["verdict"], r["waited_ms"], r["http_status"]) for r in out.collect()}
    minute = 60_000
    assert got == {
        "done": ("succeeded", 5 * minute, None), "bad": ("failed", 3 * minute, None),
        "stuck": ("timeout", 10 * minute, 504), "cached": ("succeeded", 0, None),
        "tie": ("succeeded", 4 * minute, None), "late": ("timeout", 10 * minute, 504),
    }
    assert out.count() == 6


@pytest.mark.parametrize("files_per_trigger", [1, 100])
def test_tracker_does_not_depend_on_the_order_of_arrival(spark, tmp_path, files_per_trigger):
    """The later end arrives first; both lie within the watermark."""
    path = str(tmp_path / "events")
    for row in [("x", 0, "queued", None), ("x", 5, "failed", None), ("x", 2, "succeeded", None), ("clock", 90, "queued", None)]:
        events(spark, [row]).select("job_id", "ts", "status").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken in the order of their times
    stream = stream_table(spark, path, spark.read.parquet(path).schema, max_files_per_trigger=files_per_trigger)
    out = run_to_table(job_tracker(stream, max_wait_ms=60 * 60_000, delay="20 minutes"), "tracker-order")
    assert [(r["job_id"], r["verdict"], r["waited_ms"]) for r in out.collect()] == [("x", "succeeded", 120_000)]


def test_tracker_goes_on_from_its_checkpoint(spark, tmp_path):
    """Stopped between triggers and started again, it tells what one run tells."""
    path, out, progress = (str(tmp_path / name) for name in ("events", "out", "progress"))
    rows = ROWS + [("late", 0, "queued", None), ("late", 30, "succeeded", None), ("clock", 600, "queued", None)]
    ordered = sorted(rows, key=lambda r: r[1])
    parts = [ordered[start : start + 4] for start in range(0, len(ordered), 4)]

    def tracked():
        stream = stream_table(spark, path, spark.read.parquet(path).schema, max_files_per_trigger=1)
        return job_tracker(stream, max_wait_ms=10 * 60_000, delay="1 minute")

    for part in parts:
        events(spark, part).select("job_id", "ts", "status").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken in the order of their times
    query = tracked().writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).start()
    until = time.time() + 60
    while time.time() < until and query.isActive and (query.lastProgress or {"batchId": 0})["batchId"] < 1:
        time.sleep(0.1)
    query.stop()
    resumed = run_to_table(tracked(), "resumed", path=out, progress_path=progress).collect()
    whole = run_to_table(tracked(), "whole").collect()
    assert sorted(map(tuple, resumed), key=str) == sorted(map(tuple, whole), key=str)
    assert {r["job_id"]: r["verdict"] for r in resumed} == {
        "done": "succeeded", "bad": "failed", "stuck": "timeout", "cached": "succeeded", "tie": "succeeded", "late": "timeout",
    }


def test_tracker_state_grows_with_shards_not_with_jobs(spark, tmp_path):
    """Jobs of a shard share one state and one timer; each is reported once, at its own time."""
    path, out, progress = (str(tmp_path / name) for name in ("events", "out", "progress"))
    early = [(f"j{n}", n % 7, "queued", None) for n in range(200)]
    ends = [(f"j{n}", n % 7 + 1 + n % 5, "failed" if n % 2 else "succeeded", None) for n in range(0, 200, 3)]
    for part in (early, ends, [("clock", 60, "queued", None)], [("clock", 61, "running", None)]):
        events(spark, part).select("job_id", "ts", "status").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken in the order of their times
    stream = stream_table(spark, path, spark.read.parquet(path).schema, max_files_per_trigger=1)
    tracked = job_tracker(stream, max_wait_ms=10 * 60_000, retention_ms=600 * 60_000, delay="20 minutes", shards=3)
    writer = tracked.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(out).collect()]
    expected = []
    for n in range(200):
        if n % 3 == 0:
            expected.append((f"j{n}", "failed" if n % 2 else "succeeded", (1 + n % 5) * 60_000, None))
        else:
            expected.append((f"j{n}", "timeout", 10 * 60_000, 504))
    assert sorted(got) == sorted(expected)
    # a shard has its value and its timer, which is kept by key and by time
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * 3


def test_live_tracker_forgets_after_the_retention(spark, tmp_path):
    path, out = str(tmp_path / "events"), str(tmp_path / "out")

    def arrive(*rows):
        part = events(spark, [(*row, None) for row in rows]).select("job_id", "ts", "status")
        part.coalesce(1).write.mode("append").parquet(path)

    def told(*expected):
        until = time.time() + 30
        while time.time() < until:
            try:
                found = sorted((r["job_id"], r["verdict"]) for r in spark.read.parquet(out).collect())
            except AnalysisException:  # nothing is written yet
                found = []
            if found == sorted(expected):
                return True
            time.sleep(0.5)
        return False

    arrive(("done", 1, "succeeded"), ("done", 0, "queued"), ("stuck", 0, "queued"))
    stream = stream_table(spark, path, spark.read.parquet(path).schema)
    tracked = live_job_tracker(stream, max_wait_ms=2_000, retention_ms=4_000)
    writer = tracked.writeStream.format("parquet").option("path", out)
    query = writer.option("checkpointLocation", str(tmp_path / "progress")).trigger(processingTime="1 second").start()
    try:
        first = [("done", "succeeded"), ("stuck", "timeout")]
        assert told(*first)
        arrive(("stuck", 2, "succeeded"))  # still known: not reported again
        time.sleep(8)
        assert told(*first)
        arrive(("done", 3, "failed"))  # forgotten: a new job
        assert told(*first, ("done", "failed"))
    finally:
        query.stop()
