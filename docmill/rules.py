"""Fixed values of the contract: limits, error classes, routes, formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: limits and defaults --------------------------------------

DEFAULT_FILENAME = "document.bin"
MAX_BYTES = 52_428_800
DEFAULT_MAX_PAGES = 500
JOB_RETENTION_MS = 3_600_000

RETRY_MAX_ATTEMPTS = 3
RETRY_INITIAL_MS = 300
RETRY_MULTIPLIER = 2.0
RETRY_CAP_MS = 2_000
RETRY_JITTER = 0.2

BREAKER_WINDOW = 20
BREAKER_RATE = 0.5
BREAKER_OPEN_MS = 10_000

# --- fixed values: response classification ----------------------------------
# endpoint, match, class, http_status, error_code, retryable
# match: a status, a status with its body code, "5xx", "other", or a client event.
# http_status None with a status match means "as sent"; error_code None means
# "from the body"; {n} is the status.

SUCCESS = "success"

_CONVERT_ONLY = [
    ("convert", "200", "success", None, None, False),
    ("convert", "422:encrypted", "encrypted", 422, "encrypted", False),
    ("convert", "422", "corrupted", 422, None, False),
]

_SUBMIT_ONLY = [("submit", "202", "success", None, None, False)]

_RENDER_ONLY = [("render", "200", "success", None, None, False)]

_JOB_STATUS_ONLY = [
    ("job_status", "200", "success", None, None, False),
    ("job_status", "401", "unauthorized", 401, "unauthorized", False),
    ("job_status", "404", "generic", 404, "job_not_found", False),
]

_REQUEST_ENDPOINTS = [
    ("401", "unauthorized", 401, "unauthorized", False),
    ("413", "too_large", 413, "too_large", False),
    ("415", "unsupported", 415, None, False),
    ("429", "unavailable", 503, "overloaded", True),
    ("503", "unavailable", 503, "overloaded", True),
    ("504", "timeout", 504, "timeout", False),
]

_EVERY_ENDPOINT = [
    ("5xx", "service", None, "http_{n}", True),
    ("other", "generic", None, "unexpected", False),
    ("client_timeout", "timeout", None, "client_timeout", True),
    ("network", "service", None, "network", True),
    ("interrupted", "generic", None, "interrupted", False),
    ("circuit_open", "circuit_open", None, "circuit_open", False),
]

ENDPOINTS = ("convert", "submit", "job_status", "render")

RESPONSE_RULES = (
    _CONVERT_ONLY
    + _SUBMIT_ONLY
    + _RENDER_ONLY
    + _JOB_STATUS_ONLY
    + [(e, *rule) for e in ("convert", "submit", "render") for rule in _REQUEST_ENDPOINTS]
    + [(e, *rule) for e in ENDPOINTS for rule in _EVERY_ENDPOINT]
)

# Statuses with a rule of their own; every other one falls to "5xx" or "other".
LISTED_STATUSES = {
    "convert": (200, 401, 413, 415, 422, 429, 503, 504),
    "submit": (202, 401, 413, 415, 429, 503, 504),
    "render": (200, 401, 413, 415, 429, 503, 504),
    "job_status": (200, 401, 404),
}

# --- fixed values: codes of failed jobs -------------------------------------
# code, class, http_status, error_code (None: the job's own), retryable, retry_after_s

JOB_RULES = [
    ("unsupported", "unsupported", 415, None, False, None),
    ("encrypted", "encrypted", 422, "encrypted", False, None),
    ("malformed", "corrupted", 422, None, False, None),
    ("missing_part", "corrupted", 422, None, False, None),
    ("resource_limit", "corrupted", 422, None, False, None),
    ("timeout", "timeout", 504, "timeout", False, None),
    ("server_shutting_down", "unavailable", 503, "overloaded", True, 0),
    ("overloaded", "unavailable", 503, "overloaded", True, 0),
    ("rate_limited", "unavailable", 503, "overloaded", True, 0),
]
JOB_DEFAULT_CODE = "conversion_failed"

# --- fixed values: routes ----------------------------------------------------
# class, retryable, route. Retryable rows go to "fallback" once tries run out.

ROUTE_RULES = [
    ("success", False, "ok"),
    ("unauthorized", False, "config_alert"),
    ("too_large", False, "reject"),
    ("invalid_input", False, "reject"),
    ("unsupported", False, "dead_letter_review"),
    ("encrypted", False, "quarantine"),
    ("corrupted", False, "dead_letter_alert"),
    ("timeout", False, "async"),
    ("timeout", True, "retry"),
    ("unavailable", True, "retry"),
    ("service", True, "retry"),
    ("circuit_open", False, "fallback"),
    ("generic", False, "dead_letter_alert"),
]
FALLBACK_ROUTE = "fallback"

# Classes that count as failures for the breaker; all other failures are
# rejections of the document or the caller and are not counted.
COUNTED_CLASSES = ("timeout", "unavailable", "service")

# --- fixed values: formats ---------------------------------------------------

EXTENSIONS = {
    "docx": "docx",
    "xlsx": "xlsx",
    "pptx": "pptx",
    "doc": "doc",
    "xls": "xls",
    "ppt": "ppt",
    "pdf": "pdf",
    "rtf": "rtf",
    "odt": "odt",
    "ods": "ods",
    "odp": "odp",
    "epub": "epub",
    "csv": "csv",
    "html": "html",
    "htm": "html",
}

PDF_MAGIC = b"%PDF-"
RTF_MAGIC = b"{\\rtf"
ZIP_MAGIC = b"PK\x03\x04"
OLE_MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"

# Media types that a zip's first entry, "mimetype", holds as plain bytes.
ZIP_TYPES = {
    "epub": b"application/epub+zip",
    "odt": b"application/vnd.oasis.opendocument.text",
    "ods": b"application/vnd.oasis.opendocument.spreadsheet",
    "odp": b"application/vnd.oasis.opendocument.presentation",
}
# Entries of a zip's directory that tell the others apart.
ZIP_PARTS = {
    "docx": b"word/document.xml",
    "xlsx": b"xl/workbook.xml",
    "pptx": b"ppt/presentation.xml",
}
ZIP_ENTRY = b"PK\x01\x02"
ZIP_END = b"PK\x05\x06"
ZIP_TYPE_NAME = b"mimetype"
ZIP_FORMATS = (*ZIP_TYPES, *ZIP_PARTS)
OLE_FORMATS = ("doc", "xls", "ppt")

PAGED_FORMATS = ("pdf",)


# --- the tables as DataFrames; a few dozen fixed rows, hence broadcast -------


def response_rules(spark: SparkSession) -> DataFrame:
    return F.broadcast(
        spark.createDataFrame(
            RESPONSE_RULES,
            "rule_endpoint string, rule_match string, class string, rule_status long, "
            "rule_code string, retryable boolean",
        )
    )


def job_rules(spark: SparkSession) -> DataFrame:
    return F.broadcast(
        spark.createDataFrame(
            JOB_RULES,
            "rule_match string, class string, rule_status long, rule_code string, "
            "rule_retryable boolean, rule_retry_after_s long",
        )
    )


def route_rules(spark: SparkSession) -> DataFrame:
    return F.broadcast(
        spark.createDataFrame(
            ROUTE_RULES, "rule_class string, rule_retryable boolean, rule_route string"
        )
    )


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
