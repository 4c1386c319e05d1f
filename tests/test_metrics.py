import bisect
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docmill.operators import metrics
from docmill.operators.ordering import with_positions
from docmill.sources.documents import stream_table
from docmill.sources.sinks import run_to_table
from docmill.streaming.metrics import windowed_metrics

T0 = datetime(2024, 1, 1)
NAMES = {"S": "success", "F": "service_failure", "B": "business_rejection"}


def calls(spark, rows):
    """rows of (client, seconds, call, letter)"""
    return spark.createDataFrame(
        [(c, T0 + timedelta(seconds=s), n, NAMES[o]) for c, s, n, o in rows],
        "client_id string, ts timestamp, call_id long, outcome string",
    )


def busy_log(seed, clients=5, rows=3000):
    """One client has a third of all calls."""
    rng = random.Random(seed)
    log = []
    for n in range(rows):
        client = "hot" if n % 3 == 0 else f"c{rng.randrange(clients)}"
        log.append((client, n // 2, n, rng.choice("SSFFB")))
    return log


@pytest.mark.parametrize("blocks,chunk", [(1, 1 << 18), (7, 25), (40, 20)])
def test_failure_rate_against_brute_force(spark, blocks, chunk):
    log = busy_log(11)
    want, recent = {}, defaultdict(list)
    for client, _, n, letter in sorted(log, key=lambda r: (r[1], r[2])):
        if letter == "B":
            continue
        recent[client] = (recent[client] + [letter == "F"])[-20:]
        want[n] = (sum(recent[client]), len(recent[client]))
    out = metrics.failure_rate(calls(spark, log), 20, blocks=blocks, chunk_rows=chunk)
    got = {r["call_id"]: (r["failures_in_window"], r["calls_in_window"]) for r in out.collect()}
    assert got == want
    assert out.filter("window_full").count() == sum(1 for _, n in want.values() if n == 20)


def test_positions_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("n"))
    rows = with_positions(df, ["k", "n"], blocks=9).orderBy("_position").collect()
    assert [r["_position"] for r in rows] == list(range(1000))
    assert [(r["k"], r["n"]) for r in rows] == sorted((r["k"], r["n"]) for r in rows)


def test_busy_client_fills_no_single_block(spark):
    from docmill.operators.ordering import in_blocks

    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("client"), "id"
    )
    largest = in_blocks(df, ["client", "id"], 30).groupBy("_block").count().agg(F.max("count")).first()[0]
    assert largest < 3_000


def test_latency(spark):
    rows = [("a", v) for v in range(1, 101)] + [("b", 7)]
    df = spark.createDataFrame(rows, "class string, elapsed_ms long")
    got = {r["class"]: r for r in metrics.latency_metrics(df).collect()}
    assert (got["a"]["p50_ms"], got["a"]["p95_ms"], got["a"]["p99_ms"]) == (50, 95, 99)
    assert (got["a"]["calls"], got["a"]["mean_ms"], got["a"]["min_ms"], got["a"]["max_ms"]) == (100, 50.5, 1, 100)
    assert (got["b"]["p50_ms"], got["b"]["p99_ms"]) == (7, 7)


def test_merged_sketches_stay_within_the_rank_error(spark, tmp_path):
    """Windows of very uneven size, stored in two parts, one of them empty of times."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("class"),
        F.timestamp_seconds(1_700_000_000 + F.pow(F.rand(3), 4) * 864_000).alias("ts"),
        (F.pow(F.rand(5), 3) * 30_000).cast("long").alias("elapsed_ms"),
    )
    nothing = spark.createDataFrame([("c", None, None)], rows.schema)
    rows = rows.unionByName(nothing.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000)))).persist()
    path = str(tmp_path / "sketches")
    for part in (F.col("elapsed_ms") < 100, F.coalesce(F.col("elapsed_ms") >= 100, F.lit(True))):
        metrics.latency_sketches(rows.filter(part)).write.mode("append").parquet(path)
    merged = {r["class"]: r for r in metrics.merged_latencies(spark.read.parquet(path)).collect()}
    for name in ("a", "b"):
        times = sorted(r[0] for r in rows.filter(F.col("class") == name).select("elapsed_ms").collect())
        assert (merged[name]["calls"], merged[name]["max_ms"]) == (len(times), times[-1])
        for rank, mark in ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms")):
            low, high = bisect.bisect_left(times, merged[name][mark]), bisect.bisect_right(times, merged[name][mark])
            slack = metrics.SKETCH_RANK_ERROR * len(times) + 1
            assert low - slack <= rank * len(times) <= high + slack
    assert (merged["c"]["calls"], merged["c"]["p50_ms"]) == (0, None)


def test_outcome_counts(spark):
    rows = [
        ("csv", "success", False, False, 5), ("csv", "success", True, False, 5), ("csv", "success", False, True, 5),
        (None, "unsupported", None, None, None),
    ]
    df = spark.createDataFrame(rows, "format string, class string, cache_hit boolean, shared boolean, input_bytes long")
    total = metrics.outcome_metrics(df).filter("level = 3").first()
    assert (total["outcomes"], total["successes"], total["failures"]) == (4, 3, 1)
    assert (total["cache_hits"], total["conversions"], total["shares"], total["input_bytes"]) == (1, 1, 1, 15)


def test_counters_read_each_input_once_and_report_zeros(spark, tmp_path):
    path = str(tmp_path / "outcomes")
    rows = [("success", False, True), ("success", None, False), ("encrypted", None, None)]
    spark.createDataFrame(rows, "class string, cache_hit boolean, shared boolean").write.parquet(path)
    rendered = spark.createDataFrame([("image/png",), (None,)], "media_type string")
    states = spark.createDataFrame([("failed",)], "status string")
    out = metrics.service_counters(spark.read.parquet(path), rendered, states)
    assert {tuple(r) for r in out.collect()} == {
        ("convert_total", "success", 2), ("convert_total", "encrypted", 1), ("cache_hits_total", "", 0),
        ("singleflight_shares_total", "", 1), ("render_pages_total", "image/png", 1), ("jobs_total", "failed", 1),
    }
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_windows_on_table_and_stream(spark, tmp_path):
    rows = [(T0 + timedelta(minutes=m), "success") for m in (0, 10, 61, 200)]
    path = str(tmp_path / "o")
    spark.createDataFrame(rows, "ts timestamp, class string").coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    batch = {(r["window_start"], r["outcomes"]) for r in metrics.windowed_metrics(table).collect()}
    assert batch == {(T0, 2), (T0 + timedelta(hours=1), 1), (T0 + timedelta(hours=3), 1)}
    stream = windowed_metrics(stream_table(spark, path, table.schema))
    got = {(r["window_start"], r["outcomes"]) for r in run_to_table(stream, "windows-test").collect()}
    assert got == batch - {(T0 + timedelta(hours=3), 1)}


def test_reconcile_stays_one_to_one(spark):
    client = spark.createDataFrame([("a",), ("a",), ("b",)], "request_id string")
    service = spark.createDataFrame([("a",), ("a",), ("a",), ("c",)], "request_id string")
    got = {tuple(r) for r in metrics.reconcile(client, service).collect()}
    assert got == {("a", 2, 3, "matched"), ("b", 1, 0, "client_only"), ("c", 0, 1, "service_only")}
