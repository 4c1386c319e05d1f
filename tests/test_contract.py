import json

import pytest
from pyspark.sql import functions as F

from docmill import rules, schemas
from docmill.operators import assets, contract
from docmill.sources.responses import read_response_log


def log(spark, rows):
    """rows of dicts; endpoint defaults to convert"""
    full = [
        tuple({"endpoint": "convert", "request_id": f"r{n}", **row}.get(f.name) for f in schemas.RESPONSE_LOG)
        for n, row in enumerate(rows)
    ]
    return spark.createDataFrame(full, schemas.RESPONSE_LOG)


def detail(code=None, reason=None):
    return json.dumps({"detail": {"code": code, "reason": reason}})


OK = '{"markdown":"# t","format":"csv","elapsed_ms":7.25,"input_bytes":31}'

CASES = [
    # endpoint, status, event, body, class, http_status, error_code, retryable
    ("convert", 200, None, OK, "success", None, None, False),
    ("convert", 200, None, '{"markdown":', "generic", None, "bad_response", False),
    ("convert", 200, None, "", "generic", None, "bad_response", False),
    ("convert", 200, None, '{"elapsed_ms":"4.4"}', "generic", None, "bad_response", False),
    ("convert", 401, None, detail("unauthorized"), "unauthorized", 401, "unauthorized", False),
    ("convert", 413, None, detail("too_large", "over"), "too_large", 413, "too_large", False),
    ("convert", 415, None, detail("unsupported", "no such kind"), "unsupported", 415, "unsupported", False),
    ("convert", 415, None, "oops", "unsupported", 415, "unknown", False),
    ("convert", 422, None, detail("encrypted"), "encrypted", 422, "encrypted", False),
    ("convert", 422, None, detail("resource_limit"), "corrupted", 422, "resource_limit", False),
    ("convert", 422, None, "[1]", "corrupted", 422, "unknown", False),
    ("convert", 429, None, detail("rate_limited"), "unavailable", 503, "overloaded", True),
    ("convert", 503, None, detail("overloaded"), "unavailable", 503, "overloaded", True),
    ("convert", 504, None, detail("timeout"), "timeout", 504, "timeout", False),
    ("convert", 500, None, detail("conversion_failed"), "service", 500, "http_500", True),
    ("convert", 418, None, detail("x"), "generic", 418, "unexpected", False),
    ("convert", 202, None, OK, "generic", 202, "unexpected", False),
    ("convert", None, "client_timeout", None, "timeout", None, "client_timeout", True),
    ("convert", None, "network", None, "service", None, "network", True),
    ("convert", None, "interrupted", None, "generic", None, "interrupted", False),
    ("convert", None, "circuit_open", None, "circuit_open", None, "circuit_open", False),
    ("submit", 202, None, '{"job_id":"j-1","status":"queued"}', "success", None, None, False),
    ("submit", 200, None, OK, "generic", 200, "unexpected", False),
    ("submit", 422, None, detail("encrypted"), "generic", 422, "unexpected", False),
    ("submit", 429, None, detail(), "unavailable", 503, "overloaded", True),
    ("render", 415, None, detail("unsupported"), "unsupported", 415, "unsupported", False),
    ("render", 422, None, detail("malformed"), "generic", 422, "unexpected", False),
    ("job_status", 404, None, detail("job_not_found", "expired"), "generic", 404, "job_not_found", False),
    ("job_status", 503, None, detail("overloaded"), "service", 503, "http_503", True),
    ("job_status", 504, None, detail("timeout"), "service", 504, "http_504", True),
    ("job_status", 429, None, detail("rate_limited"), "generic", 429, "unexpected", False),
    ("elsewhere", 200, None, OK, "generic", 200, "unexpected", False),
]


def test_classes_per_endpoint(spark):
    rows = [
        {"endpoint": e, "raw_status": s, "client_event": c, "body": b} for e, s, c, b, *_ in CASES
    ]
    out = contract.classify_outcomes(log(spark, rows)).collect()
    got = {r["request_id"]: (r["class"], r["http_status"], r["error_code"], r["retryable"]) for r in out}
    assert got == {f"r{n}": case[4:] for n, case in enumerate(CASES)}


def test_rule_tables_are_broadcast(spark):
    out = contract.route(contract.classify_outcomes(log(spark, [{"raw_status": 200, "body": OK}])))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_reasons_and_retry_after(spark):
    rows = [
        {"raw_status": 503, "retry_after": " 3 ", "body": detail("overloaded", "all slots taken")},
        {"raw_status": 413, "body": detail("too_large", " ")},
        {"raw_status": 500, "retry_after": "3", "body": detail("x", "not used")},
    ]
    got = contract.classify_outcomes(log(spark, rows)).orderBy("request_id").collect()
    assert [r["reason"] for r in got] == ["all slots taken", "no reason given (too large)", "HTTP 500"]
    assert [r["retry_after_s"] for r in got] == [3, None, None]
    assert got[0]["raw_status"] == 503


@pytest.mark.parametrize(
    "header,seconds",
    [("3", 3), (" 3 ", 3), ("+3", 3), ("-1", -1), ("Wed, 21", -1), ("1.5", -1), ("99999999999", -1), ("", -1), (None, -1)],
)
def test_retry_after(spark, header, seconds):
    df = log(spark, [{"raw_status": 503, "retry_after": header}])
    assert contract.parse_retry_after(df).first()["retry_after_s"] == seconds


@pytest.mark.parametrize("body", ["", "null", "[1]", "<html>", '{"detail":"text"}', '{"detail":{}}', None])
def test_unreadable_errors_are_unknown(spark, body):
    row = contract.parse_errors(log(spark, [{"raw_status": 415, "body": body}])).first()
    assert (row["error_code"], row["reason"]) == ("unknown", "no reason given")


def test_result_defaults_and_unknown_fields(spark):
    bodies = [
        '{"markdown":"## Orchard\\n\\npears","format":"html","elapsed_ms":81.5,"input_bytes":907}',
        '{"markdown":"y","cache_hit":true,"not_known_yet":[1],"assets":null}',
        '{"markdown":"y","assets":[{"id":',
    ]
    rows = log(spark, [{"raw_status": 200, "body": b} for b in bodies])
    first, second, bad = contract.parse_results(rows).orderBy("request_id").collect()
    assert (first["markdown"], first["format"], first["elapsed_ms"], first["input_bytes"]) == (
        "## Orchard\n\npears", "html", 81.5, 907
    )
    assert (first["assets"], first["headers_footers"], first["cache_hit"]) == ([], [], False)
    assert (second["elapsed_ms"], second["input_bytes"], second["cache_hit"]) == (0.0, 0, True)
    assert bad["error_code"] == "bad_response" and bad["markdown"] is None and bad["assets"] is None


def test_log_is_read_with_a_fixed_schema(spark, tmp_path):
    path = str(tmp_path / "log")
    log(spark, [{"raw_status": 200, "body": OK, "attempt_no": 1}]).write.json(path)
    assert read_response_log(spark, path).schema == schemas.RESPONSE_LOG
    assert read_response_log(spark, path).first()["body"] == OK


@pytest.mark.parametrize(
    "code,cls,status,error_code,retryable",
    [
        ("unsupported", "unsupported", 415, "unsupported", False),
        ("encrypted", "encrypted", 422, "encrypted", False),
        ("missing_part", "corrupted", 422, "missing_part", False),
        ("timeout", "timeout", 504, "timeout", False),
        ("rate_limited", "unavailable", 503, "overloaded", True),
        ("other", "service", None, "other", True),
        (None, "service", None, "conversion_failed", True),
    ],
)
def test_failed_jobs(spark, code, cls, status, error_code, retryable):
    jobs = spark.createDataFrame(
        [("j", "failed", code, None, False), ("k", "running", None, None, None)],
        "job_id string, status string, error_code string, error_reason string, retryable boolean",
    )
    (row,) = contract.classify_jobs(jobs).collect()
    assert (row["class"], row["http_status"], row["error_code"], row["class_retryable"]) == (
        cls, status, error_code, retryable
    )
    assert row["retryable"] is False


def test_job_answers(spark):
    def answer(**fields):
        return json.dumps(fields)

    rows = [
        {"endpoint": "submit", "raw_status": 202, "ts": "2031-05-06 07:08:09",
         "body": answer(job_id="kiln-4", status="succeeded", cache_hit=True)},
        {"endpoint": "job_status", "raw_status": 200, "ts": "2031-05-06 07:09:00",
         "body": answer(job_id="kiln-5", status="failed", format="odt", created_at="2031-05-06T07:08:30Z",
                        error={"code": "resource_limit", "reason": "nested too deep", "retryable": True})},
        {"endpoint": "job_status", "raw_status": 200, "ts": "2031-05-06 07:10:00",
         "body": answer(job_id="kiln-6", status="succeeded", result={"markdown": "glaze", "cache_hit": False})},
        {"endpoint": "job_status", "raw_status": 404, "body": detail("job_not_found")},
        {"endpoint": "job_status", "raw_status": 200, "body": "[kiln"},
    ]
    parsed = contract.parse_jobs(log(spark, rows))
    bad, cached, failed, done = parsed.orderBy(F.col("job_id").asc_nulls_first()).collect()
    assert (bad["job_id"], bad["status"], bad["error_code"]) == (None, None, "bad_response")
    assert (cached["status"], cached["cache_hit"]) == ("succeeded", True)
    assert (failed["error_code"], failed["retryable"]) == ("resource_limit", True)
    assert failed["created_at"] is not None and failed["finished_at"] is None
    assert (done["markdown"], done["cache_hit"]) == ("glaze", False)
    typed = contract.classify_jobs(parsed).first()
    assert (typed["class"], typed["reason"]) == ("corrupted", "nested too deep")


def test_due_retries(spark):
    df = spark.createDataFrame([(1, 100), (2, 200)], "request_id long, not_before_ms long")
    assert [r["request_id"] for r in contract.due_retries(df, 150).collect()] == [1]


def test_routes(spark):
    rows = [(name, retryable) for name, retryable, _ in rules.ROUTE_RULES]
    df = spark.createDataFrame(rows, "class string, retryable boolean")
    got = {(r["class"], r["retryable"]): r["route"] for r in contract.route(df).collect()}
    assert got == {(name, retryable): target for name, retryable, target in rules.ROUTE_RULES}
    tired = contract.route(df, exhausted=F.lit(True)).filter("retryable").collect()
    assert {r["route"] for r in tired} == {"fallback"}
    empty = contract.route(df, is_empty=F.lit(True)).filter("class = 'success'").first()
    assert empty["route"] == "fallback"


def test_attempts_with_gaps_in_the_log(spark):
    rows = [("only second", 2, "success", False), ("late", 3, "success", False), ("late", 9, "success", False)]
    df = spark.createDataFrame(rows, "request_id string, attempt_no long, class string, retryable boolean")
    got = {r["request_id"]: r["attempts_after_stop"] for r in contract.resolve_attempts(df, 3).collect()}
    assert got == {"only second": 0, "late": 1}


@pytest.mark.parametrize(
    "classes,max_attempts,expected",
    [
        (["unavailable", "unavailable", "success"], 3, ("success", 3, 0, False)),
        (["unavailable"] * 4, 4, ("unavailable", 4, 0, True)),
        (["unsupported"], 5, ("unsupported", 1, 0, False)),
        (["unavailable", "unsupported", "success"], 3, ("unsupported", 2, 1, False)),
        (["unavailable"] * 5, 3, ("unavailable", 3, 2, True)),
        (["unavailable"], 3, ("unavailable", 1, 0, False)),
    ],
)
def test_attempts(spark, classes, max_attempts, expected):
    rows = [("r", n + 1, c, c == "unavailable") for n, c in enumerate(classes)]
    df = spark.createDataFrame(rows, "request_id string, attempt_no long, class string, retryable boolean")
    (row,) = contract.resolve_attempts(df, max_attempts).collect()
    assert (row["class"], row["attempts_used"], row["attempts_after_stop"], row["exhausted"]) == expected


def plan(spark, rows, **policy):
    df = spark.createDataFrame(
        [(n, *r, 1000) for n, r in enumerate(rows)],
        "request_id long, attempt_no long, retryable boolean, retry_after_s long, failed_at_ms long",
    )
    return {r["request_id"]: r for r in contract.retry_plan(df, **policy).collect()}


def test_waits(spark):
    got = plan(spark, [(1, True, None), (2, True, -1), (3, True, 0), (1, False, 9), (4, True, 1)], max_attempts=5)
    assert {n: r["wait_ms"] for n, r in got.items()} == {0: 300, 1: 600, 2: 1200, 4: 2000}
    assert (got[0]["wait_min_ms"], got[0]["wait_max_ms"]) == (240, 360)
    assert (got[4]["not_before_ms"], got[4]["not_after_ms"]) == (2600, 3400)
    assert plan(spark, [(3, True, None)]) == {}


def test_the_service_may_ask_for_longer(spark):
    got = plan(spark, [(1, True, 1)], max_attempts=3, initial_ms=50)
    assert (got[0]["wait_ms"], got[0]["wait_min_ms"], got[0]["wait_max_ms"]) == (1000, 1000, 1000)


# --- nested parts of results --------------------------------------------------------

def image(number, **more):
    return {"id": number, "media_type": "image/png", **more}


ASSETS = json.dumps(
    {
        "markdown": "tour",
        "assets": [
            image(
                10, origin_part="media/harbour.png", size=4, truncated=False, data_b64="Ym9hdA==",
                placements=[
                    {"heading_path": ["Coast", "Harbour"], "block_index": 12,
                     "context_before": "Seen from the pier:", "context_after": "Boats at noon"},
                    {"heading_path": ["Coast", "Market"], "block_index": 30,
                     "context_before": "Fish stalls", "context_after": ""},
                ],
            ),
            {"id": 11, "media_type": "application/pdf", "floating": True},
            {"id": 12, "data_b64": ""},
        ],
    }
)


def results(spark, *bodies):
    return contract.parse_results(log(spark, [{"raw_status": 200, "body": b} for b in bodies]))


def test_assets(spark):
    got = assets.assets(results(spark, ASSETS)).orderBy("asset_id").collect()
    assert [(r["is_image"], r["has_data"], r["is_floating"]) for r in got] == [
        (True, True, False), (False, False, True), (False, False, False)
    ]
    assert bytes(got[0]["data"]) == b"boat"
    assert assets.enrichable_counts(results(spark, ASSETS, OK)).collect() == [("r0", 1), ("r1", 0)]


def test_placements(spark):
    got = assets.placements(assets.assets(results(spark, ASSETS))).orderBy("asset_id", "placement_no").collect()
    assert [(r["heading_path"], r["anchor_text"], r["is_primary"]) for r in got] == [
        ("Coast > Harbour", "Boats at noon", True),
        ("Coast > Market", "Fish stalls", False),
        ("", "", True),
        ("", "", True),
    ]


HEADERS = json.dumps(
    {
        "markdown": "minutes",
        "headers_footers": [
            {"kind": "footer", "scope": "even", "text": "Rowing club", "sections": [2, 5], "source": "odt"},
            {"kind": "footer", "text": "42 / 99", "pages_seen": 17, "page_frequency": 0.25, "page_number": True},
            {"kind": "header", "location": "image", "text": "oar",
             "image": {"origin_part": "media/oar.gif", "media_type": "image/gif", "alt": "two oars",
                       "size": 3, "data_b64": "b2Fy", "truncated": True}},
            {"kind": "header", "text": "\t"},
            {"kind": "header", "text": "Rowing club"},
        ],
        "headers_footers_stripped": 71,
    }
)


def test_headers_and_footers(spark):
    df = results(spark, HEADERS, OK)
    got = assets.headers_footers(df).orderBy("entry_no").collect()
    assert [r["is_header"] for r in got] == [False, False, True, True, True]
    assert bytes(got[2]["image_data"]) == b"oar" and got[2]["image_has_data"]
    assert got[2]["image_truncated"] and got[0]["sections"] == [2, 5]
    assert [r["is_page_number"] for r in got] == [False, True, False, False, False]
    assert (got[1]["pages_seen"], got[1]["page_frequency"]) == (17, 0.25)
    texts = {r["request_id"]: (r["has_headers_footers"], r["texts"]) for r in assets.header_footer_texts(df).collect()}
    assert texts == {"r0": (True, ["Rowing club", "42 / 99", "oar"]), "r1": (False, [])}
    assert df.filter("request_id = 'r0'").first()["headers_footers_stripped"] == 71


def test_rendered_pages(spark):
    page = {"page": 4, "width": 33, "height": 55, "media_type": "image/jpeg", "data_b64": "c2FuZA=="}
    bodies = [
        json.dumps({"total_pages": 8, "rendered": 1, "scale": 0.5, "pages": [page]}),
        '{"total_pages":2}',
        "{sand",
        json.dumps({"total_pages": 8, "pages": [page, {"page": "four"}]}),
    ]
    rows = [{"endpoint": "render", "raw_status": 200, "body": b} for b in bodies]
    row, cut, typed = assets.rendered_pages(log(spark, rows)).orderBy("request_id").collect()
    assert (row["total_pages"], row["rendered"], row["page"], row["is_png"]) == (8, 1, 4, False)
    assert bytes(row["data"]) == b"sand" and row["error_code"] is None
    assert [(r["request_id"], r["error_code"], r["page"]) for r in (cut, typed)] == [
        ("r2", "bad_response", None), ("r3", "bad_response", None)
    ]
