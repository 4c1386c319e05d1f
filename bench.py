"""Time the headline queries and print one JSON line.

Each query runs once to warm up, then BENCH_RUNS times into a ``noop`` sink, so
that every row and column is produced; the median counts. The tables come as one file
of one row group each, which a single task reads; they are first copied into as many
files as there are cores, as a table on a cluster has many. The copy is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docmill.plans.registry import QUERIES  # noqa: E402
from docmill.session import local_session  # noqa: E402

HEADLINE = [
    "html_to_markdown",
    "csv_to_markdown",
    "convert_batch",
    "single_flight",
    "cache_lookup",
    "sniff_format",
    "parse_results",
    "classify_outcomes",
    "resolve_attempts",
    "markdown_blocks",
    "image_placements",
    "detect_repeated_lines",
    "strip_repeated_lines",
    "job_latest",
    "outcome_metrics",
    "latency_metrics",
    "failure_rate",
    "service_counters",
    "convert_stream",
    "reconcile",
]


def split_tables(spark, sf_dir: str, files: int) -> str:
    """A copy of the tables that the queries read, in several files each."""
    copy = tempfile.mkdtemp(prefix="bench-tables-")
    for name, key in (("documents", "doc_id"), ("pages", "page_id"), ("events", "event_id")):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        table.repartition(files, key).write.parquet(f"{copy}/{name}.parquet")
    return copy


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    tables = split_tables(spark, sf_dir, int(cores) if cores.isdigit() else 8)
    seconds, failed = {}, {}
    for name in names:
        taken = []
        try:
            for _ in range(runs + 1):
                start = time.perf_counter()
                QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
                taken.append(time.perf_counter() - start)
        except Exception as error:  # the others' times are still worth having
            failed[name] = str(error).splitlines()[0][:200]
            print(name, "failed:", failed[name], file=sys.stderr)
            continue
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(name, seconds[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "docmill_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cores": cores,
                **({"failed": failed} if failed else {}),
            }
        )
    )
    spark.stop()
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()
