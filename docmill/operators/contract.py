"""Response logs: parsing, error classes, routes, tries and waits.

The rule tables have a fixed few dozen rows and are broadcast; everything else
is projection, or one aggregation per request with map-side combining.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill import rules, schemas
from docmill.functions.backoff import backoff_ms, with_retry_after
from docmill.functions.text import flag, is_blank, non_blank, trimmed

# Naming the corrupt column also keeps Spark from pruning the schema, which
# would let badly typed fields pass unnoticed.
_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}

_FALLBACK_REASONS = {
    name: f"no reason given ({name.replace('_', ' ')})"
    for name in (
        "unauthorized", "too_large", "unsupported", "encrypted", "corrupted",
        "unavailable", "timeout", "service", "generic", "circuit_open",
    )
}


def parsed_body(body: Column, schema) -> Column:
    return F.from_json(body, schemas.with_corrupt(schema), _JSON)


def unparsable(parsed: Column) -> Column:
    return parsed.isNull() | parsed[schemas.CORRUPT].isNotNull()


def _result_columns(parsed: Column) -> dict[str, Column]:
    return {
        "markdown": parsed["markdown"],
        "format": parsed["format"],
        "elapsed_ms": F.coalesce(parsed["elapsed_ms"], F.lit(0.0)),
        "input_bytes": F.coalesce(parsed["input_bytes"], F.lit(0).cast("long")),
        "assets": F.coalesce(parsed["assets"], F.array().cast(schemas.RESULT["assets"].dataType)),
        "cache_hit": flag(parsed["cache_hit"]),
        "headers_footers": F.coalesce(
            parsed["headers_footers"],
            F.array().cast(schemas.RESULT["headers_footers"].dataType),
        ),
        "headers_footers_stripped": parsed["headers_footers_stripped"],
    }


def parse_results(log: DataFrame) -> DataFrame:
    """Bodies of successful conversions as result columns.

    Unknown fields are ignored, missing ones take their defaults. A body that
    does not parse gives ``error_code`` ``bad_response`` and no result.
    """
    parsed = (
        log.filter((F.col("endpoint") == "convert") & (F.col("raw_status") == 200))
        .withColumn("_parsed", parsed_body(F.col("body"), schemas.RESULT))
        .drop("body")
    )
    bad = unparsable(F.col("_parsed"))
    return (
        parsed.withColumn("error_code", F.when(bad, "bad_response"))
        .withColumns(
            {
                name: F.when(F.col("error_code").isNull(), value)
                for name, value in _result_columns(F.col("_parsed")).items()
            }
        )
        .drop("_parsed")
    )


def parse_jobs(log: DataFrame) -> DataFrame:
    """Accepted submissions and status answers as job events.

    A submission that the store could answer is already ``succeeded``. Times the
    service sends as text become timestamps; ``ts`` is when the answer was seen. A body
    that does not parse gives a row with ``error_code`` ``bad_response``.
    """
    endpoint, status, body = F.col("endpoint"), F.col("raw_status"), F.col("body")
    submitted, asked = (endpoint == "submit") & (status == 202), (endpoint == "job_status") & (status == 200)
    parsed = (
        log.filter(submitted | asked)
        .withColumns(
            {
                "_ticket": parsed_body(F.when(submitted, body), schemas.JOB_SUBMIT),
                "_state": parsed_body(F.when(asked, body), schemas.JOB_STATUS),
            }
        )
        .drop("body")
        .withColumn(
            "_bad",
            F.when(submitted, unparsable(F.col("_ticket"))).otherwise(unparsable(F.col("_state"))),
        )
        .withColumns(
            {name: F.when(~F.col("_bad"), F.col(name)) for name in ("_ticket", "_state")}
        )
    )
    error = F.col("_state.error")
    return parsed.select(
        "request_id",
        F.coalesce("_ticket.job_id", "_state.job_id").alias("job_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.coalesce("_ticket.status", "_state.status").alias("status"),
        F.col("_state.format").alias("format"),
        F.coalesce("_ticket.cache_hit", "_state.result.cache_hit", F.lit(False)).alias("cache_hit"),
        F.when(F.col("_bad"), "bad_response").otherwise(error["code"]).alias("error_code"),
        error["reason"].alias("error_reason"),
        flag(error["retryable"]).alias("retryable"),
        *[
            F.col(f"_state.{name}").try_cast("timestamp").alias(name)
            for name in ("created_at", "started_at", "finished_at")
        ],
        F.col("_state.result.markdown").alias("markdown"),
    )


def _with_detail(log: DataFrame) -> DataFrame:
    """Add ``_code`` and ``_reason`` of error bodies, null for other rows.

    Success bodies, which may be megabytes long, are not parsed for this.
    """
    failed = F.col("raw_status").isNotNull() & ~F.col("raw_status").isin(200, 202)
    detail = F.from_json(F.when(failed, F.col("body")), schemas.ERROR_BODY)["detail"]
    return (
        log.withColumn("_detail", detail)
        .withColumns({"_code": F.col("_detail.code"), "_reason": F.col("_detail.reason")})
        .drop("_detail")
    )


def parse_errors(log: DataFrame) -> DataFrame:
    """Code and reason of error bodies; whatever does not parse is ``unknown``."""
    return (
        _with_detail(log.filter(~F.col("raw_status").isin(200, 202)))
        .withColumns(
            {
                "error_code": F.coalesce("_code", F.lit("unknown")),
                "reason": F.when(is_blank(F.col("_reason")), "no reason given").otherwise(
                    F.col("_reason")
                ),
            }
        )
        .drop("_code", "_reason", "body")
    )


def retry_after_seconds(header: Column) -> Column:
    """Whole seconds, or -1 when absent or not a number."""
    value = trimmed(header)
    return F.coalesce(
        F.when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast("int")), F.lit(-1)
    ).cast("long")


def parse_retry_after(log: DataFrame) -> DataFrame:
    return log.withColumn("retry_after_s", retry_after_seconds(F.col("retry_after")))


def _rule_match() -> Column:
    status, endpoint = F.col("raw_status"), F.col("endpoint")
    listed = F.lit(False)
    for name, statuses in rules.LISTED_STATUSES.items():
        listed = listed | ((endpoint == name) & status.isin(*statuses))
    encrypted = (
        (endpoint == "convert") & (status == 422) & (F.col("_code") == "encrypted")
    )
    return (
        F.when(F.col("client_event").isNotNull(), F.col("client_event"))
        .when(encrypted, "422:encrypted")
        .when(listed, status.cast("string"))
        .when(status >= 500, "5xx")
        .otherwise("other")
    )


def _bad_success_body() -> Column:
    """A success whose body is not what its endpoint answers with."""
    status, endpoint, body = F.col("raw_status"), F.col("endpoint"), F.col("body")

    def bad(name: str, ok: int, schema) -> Column:
        mine = (endpoint == name) & (status == ok)
        return mine & unparsable(parsed_body(F.when(mine, body), schema))

    return F.coalesce(
        bad("convert", 200, schemas.RESULT)
        | bad("submit", 202, schemas.JOB_SUBMIT)
        | bad("job_status", 200, schemas.JOB_STATUS)
        | bad("render", 200, schemas.RENDER),
        F.lit(False),
    )


def classify_outcomes(log: DataFrame) -> DataFrame:
    """Give each response its class, status, code, reason and retry decision."""
    matched = (
        _with_detail(log)
        .withColumn("_match", _rule_match())
        .withColumn("_bad", _bad_success_body())
        .drop("body")
        .join(
            rules.response_rules(log.sparkSession),
            (F.col("endpoint") == F.col("rule_endpoint")) & (F.col("_match") == F.col("rule_match")),
            "left",
        )
        .withColumn(
            "class", F.when(F.col("_bad"), "generic").otherwise(F.coalesce("class", F.lit("generic")))
        )
    )
    ok = F.col("class") == rules.SUCCESS
    from_rule = F.replace(
        F.col("rule_code"), F.lit("{n}"), F.coalesce(F.col("raw_status").cast("string"), F.lit(""))
    )
    no_rule = F.when(F.col("rule_match").isNull(), "unexpected")
    from_status = F.col("_match").isin("5xx", "other")
    return matched.withColumns(
        {
            "http_status": F.when(
                ~ok & ~F.col("_bad") & F.col("client_event").isNull(),
                F.coalesce("rule_status", "raw_status"),
            ),
            "error_code": F.when(F.col("_bad"), "bad_response").when(
                ~ok, F.coalesce(from_rule, no_rule, F.col("_code"), F.lit("unknown"))
            ),
            "reason": F.when(ok, F.lit(None).cast("string"))
            .when(F.col("_bad"), "response not parsable")
            .when(
                from_status, F.concat(F.lit("HTTP "), F.col("raw_status").cast("string"))
            )
            .when(non_blank(F.col("_reason")), F.col("_reason"))
            .otherwise(
                F.try_element_at(rules.literal_map(_FALLBACK_REASONS), F.col("class"))
            ),
            "retryable": flag(F.col("retryable")) & ~F.col("_bad"),
            "retry_after_s": F.when(
                F.col("class") == "unavailable", retry_after_seconds(F.col("retry_after"))
            ),
        }
    ).drop("_code", "_reason", "_match", "_bad", "rule_endpoint", "rule_match", "rule_status", "rule_code")


def classify_jobs(jobs: DataFrame) -> DataFrame:
    """Failed jobs in the same classes. The job's own ``retryable`` is kept as it is."""
    failed = jobs.filter(F.col("status") == "failed").withColumnRenamed(
        "error_code", "job_error_code"
    )
    code = F.coalesce("job_error_code", F.lit(rules.JOB_DEFAULT_CODE))
    return (
        failed.withColumn("_code", code)
        .join(rules.job_rules(jobs.sparkSession), F.col("_code") == F.col("rule_match"), "left")
        .withColumns(
            {
                "class": F.coalesce("class", F.lit("service")),
                "http_status": F.col("rule_status"),
                "error_code": F.coalesce("rule_code", "_code"),
                "class_retryable": F.coalesce("rule_retryable", F.lit(True)),
                "retry_after_s": F.col("rule_retry_after_s"),
                "reason": F.coalesce("error_reason", F.lit("job failed")),
            }
        )
        .drop("_code", "rule_match", "rule_status", "rule_code", "rule_retryable", "rule_retry_after_s")
    )


def route(
    outcomes: DataFrame, exhausted: Column | None = None, is_empty: Column | None = None
) -> DataFrame:
    """Add ``route``. ``exhausted`` marks rows with no tries left."""
    none_left = F.lit(False) if exhausted is None else flag(exhausted)
    empty = F.lit(False) if is_empty is None else flag(is_empty)
    return (
        outcomes.withColumn("_retryable", flag(F.col("retryable")))
        .join(
            rules.route_rules(outcomes.sparkSession),
            (F.col("class") == F.col("rule_class"))
            & (F.col("_retryable") == F.col("rule_retryable")),
            "left",
        )
        .withColumn(
            "route",
            F.when((F.col("class") == rules.SUCCESS) & empty, rules.FALLBACK_ROUTE)
            .when((F.col("rule_route") == "retry") & none_left, rules.FALLBACK_ROUTE)
            .otherwise(F.coalesce("rule_route", F.lit("dead_letter_alert"))),
        )
        .drop("_retryable", "rule_class", "rule_retryable", "rule_route")
    )


def resolve_attempts(
    attempts: DataFrame, max_attempts: int = rules.RETRY_MAX_ATTEMPTS
) -> DataFrame:
    """One outcome per request: its first success or final failure, else the last try.

    ``attempts`` has request_id, attempt_no (from 1), class and retryable. Tries
    logged after that point are counted in ``attempts_after_stop``; a log may have gaps.
    """
    allowed = F.col("attempt_no") <= max_attempts
    stops = allowed & ~flag(F.col("retryable"))
    row = F.struct("attempt_no", "class", flag(F.col("retryable")).alias("retryable"))
    numbered = attempts.groupBy("request_id", "attempt_no").agg(
        F.min(F.when(stops, row)).alias("_stop"),
        F.max(F.when(allowed, row)).alias("_last"),
        F.count(F.lit(1)).alias("_n"),
    )
    # one entry per number of a try, not per logged row
    return (
        numbered.groupBy("request_id")
        .agg(
            F.min("_stop").alias("_stop"),
            F.max("_last").alias("_last"),
            F.sum("_n").alias("attempts_logged"),
            F.collect_list(F.struct("attempt_no", "_n")).alias("_tries"),
        )
        .withColumn("_end", F.coalesce("_stop", "_last"))
        .select(
            "request_id",
            F.col("_end.class").alias("class"),
            F.col("_end.attempt_no").alias("attempts_used"),
            "attempts_logged",
            F.aggregate(
                "_tries",
                F.lit(0).cast("long"),
                lambda total, t: total
                + F.when(t["attempt_no"] > F.col("_end.attempt_no"), t["_n"]).otherwise(0),
            ).alias("attempts_after_stop"),
            (F.col("_end.retryable") & (F.col("_end.attempt_no") >= max_attempts)).alias(
                "exhausted"
            ),
        )
    )


def due_retries(plan: DataFrame, now_ms: int) -> DataFrame:
    """Planned retries whose earliest time has come; for the next batch run."""
    return plan.filter(F.col("not_before_ms") <= now_ms)


def retry_plan(
    failures: DataFrame,
    max_attempts: int = rules.RETRY_MAX_ATTEMPTS,
    initial_ms: int = rules.RETRY_INITIAL_MS,
    multiplier: float = rules.RETRY_MULTIPLIER,
    cap_ms: int = rules.RETRY_CAP_MS,
) -> DataFrame:
    """When each retryable failure is due again.

    Instead of a random draw, ``wait_min_ms`` and ``wait_max_ms`` bound the wait:
    the jitter is applied to the backoff, then the service's own request wins if
    longer. ``failed_at_ms`` plus these gives the due times.
    """
    percent = round(rules.RETRY_JITTER * 100)
    base = backoff_ms(F.col("attempt_no"), max_attempts, initial_ms, multiplier, cap_ms)
    due = flag(F.col("retryable")) & (F.col("attempt_no") < max_attempts)

    def jittered(share: int) -> Column:
        return F.floor(F.col("backoff_ms") * share / 100).cast("long")

    return (
        failures.filter(due)
        .withColumn("backoff_ms", base)
        .withColumns(
            {
                "wait_ms": with_retry_after(F.col("backoff_ms"), F.col("retry_after_s")),
                "wait_min_ms": with_retry_after(jittered(100 - percent), F.col("retry_after_s")),
                "wait_max_ms": with_retry_after(jittered(100 + percent), F.col("retry_after_s")),
            }
        )
        .withColumns(
            {
                "not_before_ms": F.col("failed_at_ms") + F.col("wait_min_ms"),
                "not_after_ms": F.col("failed_at_ms") + F.col("wait_max_ms"),
            }
        )
    )
