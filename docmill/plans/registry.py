"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions.text import as_bytes
from docmill.operators import (
    assets,
    contract,
    convert,
    intake,
    jobs,
    metrics,
    pages,
    reuse,
    sections,
)
from docmill.plans import inputs
from docmill.plans.batch import convert_batch, outcome_summary, results_of
from docmill.schemas import OUTCOME
from docmill.session import cut, scratch_path, tune
from docmill.sources import documents as sources
from docmill.sources import responses, sinks
from docmill.streaming import convert as convert_stream
from docmill.streaming import dedup
from docmill.streaming import jobs as job_stream
from docmill.streaming import metrics as metric_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

MAX_WAIT_MS = 12 * 3_600_000
NOW = "2024-01-20 00:00:00"
NOW_MS = 1_705_708_800_000
RETENTION_MS = 5 * 86_400_000


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        return fn

    return register


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream, with the timestamp type that watermarks accept."""
    schema = _events(spark, sf_dir).schema
    return sources.stream_table(spark, f"{sf_dir}/events.parquet", schema).withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


# --- sources and sinks --------------------------------------------------------


@query("read_documents")
def _read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = intake.with_size(inputs.documents(spark, sf_dir))
    return docs.select("input_ordinal", "filename", "size_bytes")


@query("read_document_files")
def _read_document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as one file each, and read with one limit above which content stays unread.

    Tasks move their own files into place, and folders of folders are listed by tasks: the
    driver would take one page after the other.
    """
    path = scratch_path(spark, "files")
    pages = inputs.spread(inputs.table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    dealt = pages.withColumn("part", F.pmod(F.xxhash64("page_id"), F.lit(256)))
    writer = dealt.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy("part", "page_id").text(path)
    docs = intake.gate(sources.read_documents(spark, path, "*.txt", max_bytes=4000))
    return docs.select(
        F.regexp_extract("input_ordinal", r"page_id=(\d+)", 1).cast("long").alias("page_id"),
        "size_bytes",
        "class",
        F.sha2("content", 256).alias("content_sha256"),
    )


@query("read_response_log")
def _read_response_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "responses")
    inputs.response_log(spark, sf_dir).write.json(path)
    return responses.read_response_log(spark, path).select(
        "request_id",
        "endpoint",
        "attempt_no",
        "raw_status",
        "client_event",
        "retry_after",
        F.col("body").isNotNull().alias("has_body"),
    )


@query("stream_documents")
def _stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = inputs.table(spark, sf_dir, "documents").schema
    stream = sources.stream_documents(
        spark, f"{sf_dir}/documents.parquet", schema, "doc_id", "text", inputs.text_name()
    )
    rows = intake.fingerprint(stream).select("input_ordinal", "filename", "content_sha256")
    return sinks.run_to_table(rows, "documents-stream")


@query("write_routed")
def _write_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "routed")
    outcomes = outcome_summary(convert_batch(inputs.mixed_corpus(spark, sf_dir)))
    rows = outcomes.select("input_ordinal", "class", "route")
    even = F.col("input_ordinal") % 2 == 0
    sinks.write_routed(rows.filter(even), path, "first")
    sinks.write_routed(rows.filter(~even), path, "second")
    return sinks.read_routed(spark, path).select("input_ordinal", "class", "route")


@query("store_results")
def _store_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and documents stored in two rounds; the second finds some keys there."""
    path = scratch_path(spark, "store")
    corpus = intake.variant_key(inputs.optioned_documents(spark, sf_dir))
    rows = corpus.withColumn("markdown", F.col("content")).drop("content")
    sinks.store_results(rows.filter(F.col("filename") == "en.txt"), path)
    sinks.store_results(rows, path)
    return (
        sinks.read_store(spark, path)
        .groupBy("variant_key")
        .agg(
            F.count(F.lit(1)).alias("stored_rows"),
            F.max(F.length("markdown")).cast("long").alias("markdown_chars"),
        )
    )


@query("write_assets")
def _write_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "assets")
    sinks.write_assets(assets.assets(_results(spark, sf_dir)), path)
    return spark.read.parquet(path).select(
        "request_id",
        "asset_id",
        "media_type",
        "size",
        F.sha2("data", 256).alias("data_sha256"),
    )


# --- intake ---------------------------------------------------------------------


@query("normalise_documents")
def _normalise_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = intake.normalise_documents(inputs.named_documents(spark, sf_dir))
    return docs.select("input_ordinal", "filename", "safe_filename", "request_id")


@query("reject_empty")
def _reject_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = intake.reject_empty(inputs.documents_with_gaps(spark, sf_dir))
    return docs.select(
        "input_ordinal", F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"), "class"
    )


@query("size_gate")
def _size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = intake.size_gate(inputs.documents(spark, sf_dir), max_bytes=2000)
    return docs.select("input_ordinal", "size_bytes", "class", "http_status", "retryable")


@query("fingerprint")
def _fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.fingerprint(inputs.documents(spark, sf_dir)).select(
        "input_ordinal", "content_sha256"
    )


@query("variant_key")
def _variant_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.variant_key(inputs.optioned_documents(spark, sf_dir)).select(
        "input_ordinal", "variant_key"
    )


@query("sniff_format")
def _sniff_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.sniff_format(inputs.signed_documents(spark, sf_dir)).select(
        "input_ordinal", "filename", "format", "format_source"
    )


# --- deduplication and reuse -------------------------------------------------------


@query("single_flight")
def _single_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = intake.variant_key(intake.normalise_documents(inputs.documents(spark, sf_dir)))
    shared = reuse.single_flight(docs, lambda work: convert.html_to_markdown(work, "content"))
    return shared.select(
        "input_ordinal", "request_id", "variant_key", "shared", F.sha2("markdown", 256).alias("markdown_sha256")
    )


@query("single_flight_report")
def _single_flight_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reuse.single_flight_report(intake.variant_key(inputs.documents(spark, sf_dir)))


@query("cache_lookup")
def _cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against a store of those in English."""
    docs = intake.variant_key(inputs.optioned_documents(spark, sf_dir))
    earlier = docs.filter(F.col("filename") == "en.txt")
    store = earlier.groupBy("variant_key").agg(F.max(F.length("content")).cast("long").alias("stored_chars"))
    return reuse.cache_lookup(docs, store).select("input_ordinal", "cache_hit", "stored_chars")


@query("stream_dedup")
def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _event_stream(spark, sf_dir).withColumn(
        "variant_key", F.concat_ws(":", F.col("user_id").cast("string"), "event_type")
    )
    first = dedup.stream_dedup(stream.select("variant_key", "ts"))
    return sinks.run_to_table(first, "dedup").select("variant_key")


# --- conversion ------------------------------------------------------------------------


@query("html_to_markdown")
def _html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.html_to_markdown(inputs.table(spark, sf_dir, "pages")).select(
        "page_id", "markdown"
    )


@query("html_structures")
def _html_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists, tables, links, references and preformatted text made of each document's words."""
    return convert.html_to_markdown(inputs.structured_html(spark, sf_dir)).select("doc_id", "markdown")


@query("csv_to_markdown")
def _csv_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.csv_to_markdown(inputs.csv_documents(spark, sf_dir)).select(
        "doc_id", "markdown"
    )


@query("convert_batch")
def _batch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """convert_batch over pages and documents, with a store of the English ones."""
    corpus = inputs.mixed_corpus(spark, sf_dir)
    keyed = intake.variant_key(corpus.filter(F.col("filename") == "en.csv"))
    store = (
        convert.csv_to_markdown(keyed)
        .groupBy("variant_key")
        .agg(F.max("markdown").alias("markdown"))
    )
    outcomes = convert_batch(corpus, store)
    return outcome_summary(
        outcomes.withColumn("markdown_sha256", F.sha2(as_bytes(F.col("result.markdown")), 256))
    ).drop("options", "size_bytes")


@query("convert_batch_without_store")
def _convert_batch_without_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = convert_batch(inputs.mixed_corpus(spark, sf_dir))
    return outcome_summary(
        outcomes.withColumn("markdown_sha256", F.sha2(as_bytes(F.col("result.markdown")), 256))
    ).drop("options", "size_bytes")


@query("convert_stream")
def _stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """convert_stream over documents that arrive as CSV, plain and damaged files."""
    schema = inputs.table(spark, sf_dir, "documents").schema
    stream = sources.document_columns(
        sources.stream_table(spark, f"{sf_dir}/documents.parquet", schema).withColumn(
            "_content", inputs.mixed_content()
        ),
        "doc_id",
        "_content",
        inputs.mixed_name(),
    )
    path = scratch_path(spark, "outcomes")
    convert_stream.convert_stream(
        stream, path, scratch_path(spark, "outcomes-progress"), store_path=scratch_path(spark, "store")
    ).awaitTermination()
    return sinks.read_routed(spark, path, OUTCOME).select(
        "input_ordinal",
        "class",
        "route",
        "shared",
        F.sha2(as_bytes(F.col("result.markdown")), 256).alias("markdown_sha256"),
    )


@query("convert_batch_assets")
def _batch_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the images that documents hold themselves, for those that ask for assets."""
    # read by three steps, each of which would convert all documents again
    results = cut(results_of(convert_batch(inputs.illustrated_documents(spark, sf_dir))), "results")
    rows = assets.assets(results)
    placed = assets.placements(rows)
    data = rows.select(
        "request_id", "asset_id", "media_type", "size", "is_image", F.sha2("data", 256).alias("data_sha256")
    )
    counted = assets.enrichable_counts(results)
    return data.join(placed, ["request_id", "asset_id"]).join(counted, "request_id")


@query("convert_batch_headers_footers")
def _batch_headers_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers and footers of documents with pages, found and taken out where that is asked for."""
    outcomes = convert_batch(inputs.paged_documents(spark, sf_dir))
    entries = F.transform(
        "result.headers_footers",
        lambda e: F.concat_ws("|", e["kind"], e["location"], e["text"], e["pages_seen"].cast("string"),
                              F.format_number(e["page_frequency"], 3), e["page_number"].cast("string")),
    )
    return outcomes.select(
        "input_ordinal",
        F.array_join(entries, ";").alias("entries"),
        F.col("result.headers_footers_stripped").alias("stripped"),
        F.sha2(as_bytes(F.col("result.markdown")), 256).alias("markdown_sha256"),
    )


@query("empty_result_gate")
def _empty_result_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, a fifth of them without any text."""
    blank = F.lit("<html><body><p> &nbsp; </p>\n<br></body></html>")
    emptied = inputs.table(spark, sf_dir, "pages").withColumn(
        "html", F.when(F.col("page_id") % 5 == 0, blank).otherwise(F.col("html"))
    )
    gated = convert.empty_result_gate(convert.html_to_markdown(emptied))
    return gated.select("page_id", "is_empty", "route")


# --- responses --------------------------------------------------------------------------


@query("parse_results")
def _parse_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.parse_results(inputs.conversion_log(spark, sf_dir)).select(
        "request_id",
        F.sha2("markdown", 256).alias("markdown_sha256"),
        "format",
        "elapsed_ms",
        "input_bytes",
        F.array_size("assets").cast("long").alias("assets"),
        "cache_hit",
        F.array_size("headers_footers").cast("long").alias("headers_footers"),
        "headers_footers_stripped",
        "error_code",
    )


@query("parse_jobs")
def _parse_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = contract.parse_jobs(inputs.job_log(_events(spark, sf_dir)))
    times = {
        f"{name}_s": F.unix_seconds(name) for name in ("created_at", "started_at", "finished_at")
    }
    return (
        parsed.withColumns({**times, "ts_us": F.unix_micros("ts")})
        .drop("created_at", "started_at", "finished_at", "ts")
    )


@query("parse_errors")
def _parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.parse_errors(inputs.response_log(spark, sf_dir)).select(
        "request_id", "endpoint", "raw_status", "error_code", "reason"
    )


@query("classify_outcomes")
def _classify_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.classify_outcomes(inputs.response_log(spark, sf_dir)).select(
        "request_id",
        "endpoint",
        "raw_status",
        "class",
        "http_status",
        "error_code",
        "reason",
        "retryable",
        "retry_after_s",
    )


@query("classify_jobs")
def _classify_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.classify_jobs(inputs.job_events(_events(spark, sf_dir))).select(
        "event_id",
        "job_id",
        "class",
        "http_status",
        "error_code",
        "class_retryable",
        "retryable",
        "retry_after_s",
        "reason",
    )


@query("parse_retry_after")
def _parse_retry_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.parse_retry_after(inputs.response_log(spark, sf_dir)).select(
        "request_id", "retry_after", "retry_after_s"
    )


@query("route")
def _route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of classified responses; a third try was the last one."""
    outcomes = contract.classify_outcomes(inputs.response_log(spark, sf_dir))
    return contract.route(outcomes, exhausted=F.col("attempt_no") >= 3).select(
        "request_id", "class", "retryable", "route"
    )


@query("resolve_attempts")
def _resolve_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.resolve_attempts(inputs.attempts(_events(spark, sf_dir)))


@query("retry_plan")
def _retry_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.retry_plan(inputs.failures(_events(spark, sf_dir)), max_attempts=5).select(
        "request_id",
        "attempt_no",
        "backoff_ms",
        "wait_ms",
        "wait_min_ms",
        "wait_max_ms",
        "not_before_ms",
        "not_after_ms",
    )


@query("due_retries")
def _due_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the next batch run would take up at a given time."""
    plan = contract.retry_plan(inputs.failures(_events(spark, sf_dir)), max_attempts=5)
    return contract.due_retries(plan, NOW_MS).select("request_id", "attempt_no", "not_before_ms")


# --- assets and sections -------------------------------------------------------------------


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = contract.parse_results(inputs.conversion_log(spark, sf_dir))
    return parsed.filter(F.col("error_code").isNull())


@query("assets")
def _list_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assets.assets(_results(spark, sf_dir))
    return rows.withColumn("data_bytes", F.octet_length("data").cast("long")).drop(
        "data", "placements"
    )


@query("placements")
def _placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.placements(assets.assets(_results(spark, sf_dir)))


@query("enrichable_counts")
def _enrichable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.enrichable_counts(_results(spark, sf_dir))


@query("markdown_blocks")
def _markdown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = sections.markdown_blocks(inputs.structured_markdown(spark, sf_dir))
    return blocks.select(
        "doc_id",
        "block_index",
        F.col("heading_level").cast("long").alias("heading_level"),
        "heading_path",
        F.length("block").cast("long").alias("chars"),
    )


@query("image_placements")
def _image_placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.image_placements(inputs.structured_markdown(spark, sf_dir))


@query("section_summary")
def _section_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    markdown = convert.html_to_markdown(inputs.table(spark, sf_dir, "pages"))
    return sections.section_summary(sections.markdown_blocks(markdown, "page_id"), "page_id")


# --- headers, footers and pages ----------------------------------------------------------------


@query("headers_footers")
def _headers_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        assets.headers_footers(_results(spark, sf_dir))
        .withColumns(
            {
                "sections": F.array_join(F.col("sections").cast("array<string>"), ","),
                "image_sha256": F.sha2("image_data", 256),
            }
        )
        .drop("image_data")
    )


@query("header_footer_texts")
def _header_footer_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.header_footer_texts(_results(spark, sf_dir)).withColumn(
        "texts", F.array_join("texts", "|")
    )


@query("detect_repeated_lines")
def _detect_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.detect_repeated_lines(inputs.table(spark, sf_dir, "documents"), min_pages=5)


@query("strip_repeated_lines")
def _strip_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    found = pages.detect_repeated_lines(docs, min_pages=5)
    return pages.strip_repeated_lines(docs, found).select(
        "doc_id", "lines_stripped", F.sha2("stripped_text", 256).alias("stripped_sha256")
    )


@query("select_pages")
def _select_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    return pages.select_pages(docs, "0-40, 77,100-90,x,500-100000000", "doc_id").select(
        "doc_id", "source"
    )


@query("select_pages_by_row")
def _select_pages_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language has its own selection."""
    docs = inputs.table(spark, sf_dir, "documents")
    spec = (
        F.when(F.col("lang") == "en", "0,2, 10-500")
        .when(F.col("lang") == "fr", "7-3,x")
        .when(F.col("lang") == "de", " ")
    )
    return pages.select_pages(docs, spec, "doc_id").select("doc_id", "lang")


@query("cap_pages")
def _cap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources are documents; those whose name ends in an odd digit are not paged."""
    odd = F.col("source").rlike("[13579]$")
    docs = inputs.table(spark, sf_dir, "documents").withColumn("format", F.when(odd, "docx").otherwise("pdf"))
    return pages.cap_pages(docs, 20, "source", "doc_id").select("doc_id", "source")


@query("rendered_pages")
def _rendered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        assets.rendered_pages(inputs.render_log(spark, sf_dir))
        .withColumn("data_sha256", F.sha2("data", 256))
        .drop("data")
    )


# --- jobs ------------------------------------------------------------------------------------------


@query("job_latest")
def _job_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = jobs.job_latest(inputs.job_events(_events(spark, sf_dir)))
    return latest.withColumn("at_ms", F.unix_millis(F.col("ts").cast("timestamp"))).drop("ts")


@query("job_durations")
def _job_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.job_durations(inputs.job_events(_events(spark, sf_dir))).drop(
        "created_at", "started_at", "finished_at"
    )


@query("job_deadlines")
def _job_deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.job_events(_events(spark, sf_dir))
    return jobs.job_deadlines(events, MAX_WAIT_MS, NOW, RETENTION_MS)


@query("job_tracker")
def _job_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = inputs.job_events(_event_stream(spark, sf_dir))
    tracked = job_stream.job_tracker(stream.select("job_id", "ts", "status"), MAX_WAIT_MS)
    return sinks.run_to_table(tracked, "jobs")


# --- observability ---------------------------------------------------------------------------------


@query("outcome_metrics")
def _outcome_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = outcome_summary(convert_batch(inputs.mixed_corpus(spark, sf_dir)))
    return metrics.outcome_metrics(outcomes)


@query("service_counters")
def _service_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = outcome_summary(convert_batch(inputs.mixed_corpus(spark, sf_dir)))
    rendered = assets.rendered_pages(inputs.render_log(spark, sf_dir))
    latest = jobs.job_latest(inputs.job_events(_events(spark, sf_dir)))
    return metrics.service_counters(outcomes, rendered, latest)


@query("latency_metrics")
def _latency_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latency_metrics(inputs.timed_calls(_events(spark, sf_dir)))


@query("latency_sketches")
def _latency_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles from stored sketches of each day, held against the exact ranks of what
    they answer."""
    calls = inputs.timed_calls(_events(spark, sf_dir))
    path = scratch_path(spark, "sketches")
    metrics.latency_sketches(calls).write.parquet(path)
    merged = metrics.merged_latencies(spark.read.parquet(path))
    asked = merged.select(
        "class", "calls", "windows", "min_ms", "max_ms",
        F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), F.col(c).alias("answer"))
                            for r, c in ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms"))])).alias("_a"),
    ).select("class", "calls", "windows", "min_ms", "max_ms", "_a.rank", "_a.answer")
    counts = calls.groupBy("class", "elapsed_ms").agg(F.count(F.lit(1)).alias("_n"))
    below = F.sum(F.when(F.col("elapsed_ms") < F.col("answer"), F.col("_n")).otherwise(0))
    upto = F.sum(F.when(F.col("elapsed_ms") <= F.col("answer"), F.col("_n")).otherwise(0))
    ranked = asked.join(counts, "class").groupBy("class", "calls", "windows", "min_ms", "max_ms", "rank", "answer")
    error = metrics.SKETCH_RANK_ERROR * F.col("calls") + 1
    within = (below - error <= F.col("rank") * F.col("calls")) & (F.col("rank") * F.col("calls") <= upto + error)
    return ranked.agg(within.alias("within_error")).drop("answer")


@query("windowed_metrics")
def _windowed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = _events(spark, sf_dir).withColumnRenamed("event_type", "class")
    windows = metrics.windowed_metrics(outcomes)
    return windows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query("windowed_metrics_stream")
def _windowed_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _event_stream(spark, sf_dir).withColumnRenamed("event_type", "class")
    windows = sinks.run_to_table(metric_stream.windowed_metrics(stream), "windows")
    return windows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query("failure_rate")
def _failure_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.failure_rate(inputs.calls(_events(spark, sf_dir))).drop("ts")


@query("reconcile")
def _reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client saw all but signups, the service all but errors."""
    log = _events(spark, sf_dir).select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.floor("value").cast("string")).alias("request_id"),
        "event_type",
    )
    return metrics.reconcile(
        log.filter(F.col("event_type") != "signup"), log.filter(F.col("event_type") != "error")
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome counts of a whole batch over pages and documents."""
    return QUERIES["outcome_metrics"](spark, sf_dir)
