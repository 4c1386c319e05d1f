"""Counts, latencies, failure rates and log reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docmill import rules
from docmill.functions.text import flag
from docmill.operators.ordering import POSITION, with_positions

CHUNK_ROWS = 1 << 18

# Outcomes of calls as the log names them.
FAILURE, REJECTION = "service_failure", "business_rejection"


def outcome_metrics(outcomes: DataFrame) -> DataFrame:
    """Outcomes by format and class, with totals per format and over all.

    ``level`` is 0 for a class, 1 for a format's total, 3 for the grand total.
    """
    ok = F.col("class") == rules.SUCCESS
    return (
        outcomes.withColumn("format", F.coalesce("format", F.lit("unknown")))
        .rollup("format", "class")
        .agg(
            F.count(F.lit(1)).alias("outcomes"),
            F.count_if(ok).alias("successes"),
            F.count_if(~ok).alias("failures"),
            F.count_if(flag(F.col("cache_hit"))).alias("cache_hits"),
            F.count_if(ok & ~flag(F.col("cache_hit")) & ~flag(F.col("shared"))).alias(
                "conversions"
            ),
            F.count_if(flag(F.col("shared"))).alias("shares"),
            F.sum(F.coalesce("input_bytes", F.lit(0))).cast("long").alias("input_bytes"),
            F.grouping_id().cast("long").alias("level"),
        )
    )


#: Counters without a label; they are reported also when nothing was counted.
_PLAIN_COUNTERS = ("cache_hits_total", "singleflight_shares_total")


def service_counters(
    outcomes: DataFrame, rendered_pages: DataFrame, job_states: DataFrame
) -> DataFrame:
    """Running totals by name and label: conversions, reuse, rendered pages, jobs.

    ``rendered_pages`` has a row per page, ``job_states`` a row per job. Each input
    is read once: a row names all counters that it adds to.
    """

    def counter(name: str, label: Column) -> Column:
        return F.struct(F.lit(name).alias("counter"), label.alias("label"))

    none = F.lit("")
    adds = [
        counter("convert_total", F.col("class")),
        F.when(flag(F.col("cache_hit")), counter("cache_hits_total", none)),
        F.when(flag(F.col("shared")), counter("singleflight_shares_total", none)),
    ]
    converted = outcomes.select(F.explode(F.array_compact(F.array(*adds))).alias("_c"))
    rendered = rendered_pages.filter(F.col("media_type").isNotNull())
    rows = (
        converted.unionByName(rendered.select(counter("render_pages_total", F.col("media_type")).alias("_c")))
        .unionByName(job_states.select(counter("jobs_total", F.col("status")).alias("_c")))
        .select("_c.counter", "_c.label", F.lit(1).cast("long").alias("_n"))
    )
    zeros = outcomes.sparkSession.createDataFrame(
        [(name, "", 0) for name in _PLAIN_COUNTERS], "counter string, label string, _n long"
    )
    return rows.unionByName(zeros).groupBy("counter", "label").agg(F.sum("_n").alias("total"))


def _rank_name(rank: float) -> str:
    return f"p{rank * 100:g}_ms".replace(".", "_")


def latency_metrics(
    calls: DataFrame, by: tuple[str, ...] = ("class",), ranks: tuple[float, ...] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """Elapsed time per group: count, mean, extremes and exact nearest-rank percentiles.

    Times are whole milliseconds (``elapsed_ms``, long) and bounded by the
    request timeouts, so after counting equal values a group has a bounded
    number of rows, whatever the number of calls. Percentiles read that count.
    """
    histogram = calls.groupBy(*by, "elapsed_ms").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy(*by).orderBy("elapsed_ms")
    placed = histogram.withColumns(
        {
            "_upto": F.sum("_n").over(upto),
            "_all": F.sum("_n").over(W.partitionBy(*by)),
        }
    )

    def percentile(rank: float) -> Column:
        # In whole thousandths: 0.95 itself is not a binary fraction.
        reached = F.col("_upto") * 1000 >= F.col("_all") * round(rank * 1000)
        return F.min(F.when(reached, F.col("elapsed_ms"))).alias(_rank_name(rank))

    total_ms = F.sum(F.col("elapsed_ms") * F.col("_n"))
    return placed.groupBy(*by).agg(
        F.sum("_n").cast("long").alias("calls"),
        (total_ms / F.sum("_n")).alias("mean_ms"),
        F.min("elapsed_ms").alias("min_ms"),
        F.max("elapsed_ms").alias("max_ms"),
        *[percentile(r) for r in ranks],
    )


#: Size of a sketch, and how far the rank of what it answers may lie from the rank asked
#: for, as a share of the calls, with 99 % confidence.
SKETCH_SIZE, SKETCH_RANK_ERROR = 400, 0.01


def latency_sketches(
    calls: DataFrame,
    width: str = "1 day",
    event_time: str = "ts",
    by: tuple[str, ...] = ("class",),
    elapsed: str = "elapsed_ms",
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """A quantile sketch of elapsed times per window and group, a few kilobytes each.

    Sketches are stored and merged later, for any span of windows, without the calls.
    A sketch is built per task before anything is shuffled, so a busy group is no hot key.
    """
    return (
        calls.groupBy(F.window(event_time, width).alias("_window"), *by)
        .agg(
            F.count(elapsed).alias("calls"),
            F.min(elapsed).alias("min_ms"),
            F.max(elapsed).alias("max_ms"),
            F.kll_sketch_agg_bigint(F.col(elapsed).cast("long"), size).alias("sketch"),
        )
        .select(F.col("_window.start").alias("window_start"), *by, "calls", "min_ms", "max_ms", "sketch")
    )


def merged_latencies(
    sketches: DataFrame,
    by: tuple[str, ...] = ("class",),
    ranks: tuple[float, ...] = (0.5, 0.95, 0.99),
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """Percentiles over all windows of a table of sketches, within the sketches' rank error."""
    merged = sketches.groupBy(*by).agg(
        F.sum("calls").alias("calls"),
        F.count(F.lit(1)).alias("windows"),
        F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_bigint("sketch", size).alias("_sketch"),
    )
    marks = [
        F.when(F.col("calls") > 0, F.kll_sketch_get_quantile_bigint("_sketch", F.lit(rank))).alias(_rank_name(rank))
        for rank in ranks
    ]
    return merged.select(*by, "calls", "windows", "min_ms", "max_ms", *marks)


def windowed_metrics(
    outcomes: DataFrame, width: str = "1 hour", event_time: str = "ts", by: str = "class"
) -> DataFrame:
    """Outcome counts per tumbling window; the same on a table and on a stream."""
    return (
        outcomes.groupBy(F.window(event_time, width).alias("_window"), by)
        .agg(F.count(F.lit(1)).alias("outcomes"))
        .select(F.col("_window.start").alias("window_start"), by, "outcomes")
    )


def failure_rate(
    calls: DataFrame,
    window: int = rules.BREAKER_WINDOW,
    blocks: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Share of failures among each client's last ``window`` counted calls.

    Calls (client_id, ts, call_id, outcome) rejected for the document's sake are
    not counted. Rows get their position in the order (client, ts, call) and are
    cut into chunks by position; the last ``window - 1`` rows of a chunk are
    repeated in the next, so every frame is complete within its chunk and no
    client, however busy, fills one task.
    """
    counted = calls.filter(F.col("outcome") != REJECTION)
    order = ["client_id", "ts", "call_id"]
    placed = with_positions(counted.select(*order, "outcome"), order, blocks)
    size = max(chunk_rows, window)
    at, chunk = F.col(POSITION), F.floor(F.col(POSITION) / size)
    overlaps = F.pmod(at, F.lit(size)) >= size - (window - 1)
    spread = placed.withColumn(
        "_chunk", F.explode(F.when(overlaps, F.array(chunk, chunk + 1)).otherwise(F.array(chunk)))
    )
    frame = W.partitionBy("_chunk", "client_id").orderBy(POSITION).rowsBetween(1 - window, 0)
    failed = (F.col("outcome") == FAILURE).cast("long")
    return (
        spread.withColumns(
            {
                "calls_in_window": F.count(F.lit(1)).over(frame),
                "failures_in_window": F.sum(failed).over(frame),
            }
        )
        .filter(F.col("_chunk") == chunk)
        .withColumns(
            {
                "failure_rate": F.col("failures_in_window") / F.col("calls_in_window"),
                "window_full": F.col("calls_in_window") == window,
            }
        )
        .drop("_chunk", POSITION)
    )


def reconcile(client_log: DataFrame, service_log: DataFrame) -> DataFrame:
    """Request ids of both sides, one row each.

    Repeated ids are counted per side before the join, which keeps it one to one.
    """

    def counted(log: DataFrame, name: str) -> DataFrame:
        return log.groupBy("request_id").agg(F.count(F.lit(1)).alias(name))

    here, there = F.col("client_rows"), F.col("service_rows")
    return (
        counted(client_log, "client_rows")
        .join(counted(service_log, "service_rows"), "request_id", "full_outer")
        .withColumns(
            {
                "client_rows": F.coalesce(here, F.lit(0)),
                "service_rows": F.coalesce(there, F.lit(0)),
            }
        )
        .withColumn(
            "match",
            F.when(there == 0, "client_only").when(here == 0, "service_only").otherwise("matched"),
        )
    )
