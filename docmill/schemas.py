"""Schemas of the data contract. Byte counts are LONG, so files over 2 GiB fit."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


STRING, LONG, DOUBLE, BOOL, BINARY = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.BinaryType(),
)

OPTIONS = _struct(
    include_assets=BOOL,
    timeout_seconds=LONG,
    use_cache=BOOL,
    pages=STRING,
    max_pages=LONG,
    headers_footers=BOOL,
)

PLACEMENT = _struct(
    heading_path=T.ArrayType(STRING),
    block_index=LONG,
    context_before=STRING,
    context_after=STRING,
)

ASSET = _struct(
    id=LONG,
    media_type=STRING,
    origin_part=STRING,
    size=LONG,
    truncated=BOOL,
    data_b64=BINARY,
    placements=T.ArrayType(PLACEMENT),
    floating=BOOL,
)

HEADER_FOOTER_IMAGE = _struct(
    origin_part=STRING,
    media_type=STRING,
    alt=STRING,
    size=LONG,
    data_b64=BINARY,
    truncated=BOOL,
)

HEADER_FOOTER = _struct(
    kind=STRING,
    scope=STRING,
    location=STRING,
    text=STRING,
    sections=T.ArrayType(LONG),
    pages_seen=LONG,
    page_frequency=DOUBLE,
    page_number=BOOL,
    source=STRING,
    image=HEADER_FOOTER_IMAGE,
)

RESULT = _struct(
    markdown=STRING,
    format=STRING,
    elapsed_ms=DOUBLE,
    input_bytes=LONG,
    assets=T.ArrayType(ASSET),
    cache_hit=BOOL,
    headers_footers=T.ArrayType(HEADER_FOOTER),
    headers_footers_stripped=LONG,
)

ERROR = _struct(**{"class": STRING, "http_status": LONG, "error_code": STRING, "retryable": BOOL})

#: A row's outcome as it is written: success has a result, all others an error.
OUTCOME = _struct(
    **{
        "input_ordinal": LONG,
        "request_id": STRING,
        "filename": STRING,
        "variant_key": STRING,
        "options": OPTIONS,
        "format": STRING,
        "size_bytes": LONG,
        "class": STRING,
        "cache_hit": BOOL,
        "shared": BOOL,
        "result": T.StructType([
            *[f for f in RESULT.fields if f.name in ("markdown", "format", "elapsed_ms", "input_bytes")],
            T.StructField("request_id", STRING, True),
            *[f for f in RESULT.fields if f.name not in ("markdown", "format", "elapsed_ms", "input_bytes")],
        ]),
        "error": ERROR,
        "run_id": STRING,
        "route": STRING,
    }
)

#: What a conversion gives besides the Markdown; the store keeps it as well.
EXTRAS = ("assets", "headers_footers", "headers_footers_stripped")

RENDERED_PAGE = _struct(
    page=LONG, width=LONG, height=LONG, media_type=STRING, data_b64=BINARY
)

RENDER = _struct(
    total_pages=LONG,
    rendered=LONG,
    scale=DOUBLE,
    pages=T.ArrayType(RENDERED_PAGE),
    input_bytes=LONG,
    elapsed_ms=DOUBLE,
)

ERROR_BODY = _struct(detail=_struct(code=STRING, reason=STRING))

JOB_SUBMIT = _struct(job_id=STRING, status=STRING, cache_hit=BOOL)

JOB_STATUS = _struct(
    job_id=STRING,
    status=STRING,
    format=STRING,
    created_at=STRING,
    started_at=STRING,
    finished_at=STRING,
    result=RESULT,
    error=_struct(code=STRING, reason=STRING, retryable=BOOL),
)

RESPONSE_LOG = _struct(
    request_id=STRING,
    endpoint=STRING,
    attempt_no=LONG,
    ts=STRING,
    raw_status=LONG,
    client_event=STRING,
    retry_after=STRING,
    body=STRING,
)

CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the column that receives unparsable text."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, STRING, True)])
