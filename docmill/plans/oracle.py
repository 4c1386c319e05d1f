r"""The registered queries in SQL, written separately from the Spark code.

Each text runs on the same tables (documents, pages, events) in an engine with
RE2 patterns and list functions.
"""

from __future__ import annotations

# --- shared pieces -----------------------------------------------------------

_BLANK = (
    r"'^[\t\n\x0B\f\r\x1C-\x1F \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}"
    r"\x{2028}\x{2029}\x{205F}\x{3000}]*$'"
)
_OFFSET = 1_000_000_000_000


def _html(source: str, key: str, column: str) -> str:
    """CTEs that end in ``md(<key>, markdown)`` for HTML without tables."""
    blocks = (
        "p|div|ul|ol|section|article|nav|header|footer|main|aside|blockquote|pre|form|table|hr|"
        "dl|dt|dd|figure|figcaption|address|body|html|h[1-6]"
    )
    steps = [
        (r"(?is)<!--.*?(?:-->|\z)", ""),
        (r"(?is)<script\b[^>]*>.*?(?:</script\s*>|\z)", ""),
        (r"(?is)<style\b[^>]*>.*?(?:</style\s*>|\z)", ""),
        (r"(?is)<head(?:\s[^>]*)?>.*?(?:</head\s*>|\z)", ""),
        (r"[ \t\n\x0B\f\r]+", " "),
        (r"(?i)<br\s*/?>", "\n"),
        (r"(?i)<(?:i|em)(?:\s[^>]*)?>([^<]+)</(?:i|em)\s*>", r"*\1*"),
        (r"(?i)<(?:b|strong)(?:\s[^>]*)?>([^<]+)</(?:b|strong)\s*>", r"**\1**"),
        (r"(?i)<(?:i|em)(?:\s[^>]*)?>([^<]+)</(?:i|em)\s*>", r"*\1*"),
        (r'(?i)<a\b[^>]*\bhref="([^"]*)"[^>]*>([^<]*)</a\s*>', r"[\2](\1)"),
        *[(rf"(?i)<h{n}(?:\s[^>]*)?>\s*", f"\n\n\u0001{n} ") for n in range(1, 7)],
        (r"(?i)<li(?:\s[^>]*)?>\s*", "\n\u0010"),
        (r"(?i)</li\s*>", ""),
        (rf"(?i)</?(?:{blocks})(?:\s[^>]*)?/?>", "\n\n"),
        (r"<[a-zA-Z/!?][^>]*>", ""),
    ]
    entities = [
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
        ("&apos;", "'"), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&ndash;", "–"),
        ("&mdash;", "—"), ("&hellip;", "…"), ("&amp;", "&"),
    ]
    spacing = [
        (r"[ \t]*\n[ \t]*", "\n"),
        (r"\n{3,}", "\n\n"),
        (r"^[ \n]+|[ \n]+$", ""),
        (r"(^|\n)([ \t]*)(#{1,6}[ \t]|[-+][ \t]|>)", r"\1\2\\\3"),
        *[(f"\u0001{n} ", "#" * n + " ") for n in range(1, 7)],
        ("\u0010", "- "),
    ]

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def rewrite(expr: str, rules: list[tuple[str, str]]) -> str:
        for pattern, replacement in rules:
            expr = f"regexp_replace({expr}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
        return expr

    decoded = "t"
    for name, char in entities:
        decoded = f"replace({decoded}, {quoted(name)}, {quoted(char)})"
    return f"""
h1 AS (SELECT {key}, {rewrite(column, steps)} AS t FROM {source}),
h2 AS (SELECT {key}, {decoded} AS t FROM h1),
md AS (SELECT {key}, {rewrite("t", spacing)} AS markdown FROM h2)"""


def _cell(text: str) -> str:
    one_line = rf"regexp_replace(trim({text}), '\r\n|\n|\r', '<br>', 'g')"
    return rf"replace({one_line}, '|', '\|')"


_OPTIONED = r"""
opts AS (
  SELECT doc_id, text, lang, lang || '.txt' AS filename, n_chars,
         doc_id % 5 = 0 AS bypass,
         sha256(text) || ':' || lang || '.txt:'
         || CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END || ':'
         || CASE WHEN doc_id % 3 = 0 THEN 't=600' ELSE '' END
         || CASE WHEN doc_id % 5 = 0 THEN ';c=false' ELSE '' END
         || CASE WHEN doc_id % 4 = 0 THEN ';p=0-2' ELSE '' END
         || CASE WHEN doc_id % 7 = 0 THEN ';mp=50' ELSE '' END
         || CASE WHEN doc_id % 6 = 0 THEN ';hf=false' ELSE '' END AS variant_key
  FROM documents)"""

_MIXED_CONTENT = r"""
CASE WHEN doc_id % 10 = 0 THEN ''
     WHEN doc_id % 10 >= 7 THEN text
     ELSE 'text' || chr(10) || '"' || replace(text, '"', '""') || '"' END"""

_MIXED_NAME = """
CASE WHEN doc_id % 10 = 9 THEN lang || '.docx'
     WHEN doc_id % 10 >= 7 THEN lang || '.txt'
     ELSE lang || '.csv' END"""

_MIXED_CLASS = """
CASE WHEN doc_id % 10 = 0 OR text = '' THEN 'invalid_input'
     WHEN doc_id % 10 = 9 THEN 'corrupted'
     WHEN doc_id % 10 >= 7 THEN 'unsupported'
     ELSE 'success' END"""

_MIXED_FORMAT = """
CASE WHEN doc_id % 10 = 9 THEN 'docx'
     WHEN doc_id % 10 >= 7 THEN NULL
     ELSE 'csv' END"""

_ROUTED = f"""
CASE WHEN class = 'success' AND (markdown IS NULL OR regexp_matches(markdown, {_BLANK})) THEN 'fallback'
     WHEN class = 'success' THEN 'ok'
     WHEN class = 'invalid_input' THEN 'reject'
     WHEN class = 'unsupported' THEN 'dead_letter_review'
     ELSE 'dead_letter_alert' END"""


def _batch(with_store: bool) -> str:
    """CTEs that end in ``outcomes`` of the mixed corpus."""
    hit = "(filename = 'en.csv' AND class = 'success')" if with_store else "false"
    table = f"'| text |' || chr(10) || '| --- |' || chr(10) || '| ' || {_cell('text')} || ' |'"
    return f"""
WITH {_html("pages", "page_id", "html")},
corpus AS (
  SELECT page_id AS input_ordinal, html AS content, 'page.html' AS filename, 'html' AS format,
         CASE WHEN html = '' THEN 'invalid_input' ELSE 'success' END AS class, markdown
  FROM pages JOIN md USING (page_id)
  UNION ALL
  SELECT doc_id + {_OFFSET}, {_MIXED_CONTENT}, {_MIXED_NAME}, {_MIXED_FORMAT}, {_MIXED_CLASS},
         CASE WHEN {_MIXED_CLASS} = 'success' THEN {table} END
  FROM documents),
keyed AS (
  SELECT *, sha256(content) || ':' || filename || ':false:' AS variant_key, {hit} AS cache_hit FROM corpus),
owned AS (
  SELECT *, min(CASE WHEN class = 'success' THEN input_ordinal END) OVER (PARTITION BY variant_key) AS owner
  FROM keyed),
outcomes AS (
  SELECT input_ordinal, md5('document:' || input_ordinal) AS request_id, filename, variant_key,
         format, class, {_ROUTED} AS route, cache_hit,
         class = 'success' AND NOT cache_hit AND owner <> input_ordinal AS shared,
         CASE WHEN class = 'success' THEN sha256(markdown) END AS markdown_sha256,
         CASE WHEN class = 'success' THEN length(markdown) END AS markdown_chars,
         CASE class WHEN 'unsupported' THEN 415 WHEN 'corrupted' THEN 422 END::BIGINT AS http_status,
         CASE class WHEN 'invalid_input' THEN 'invalid_input' WHEN 'unsupported' THEN 'unsupported'
                    WHEN 'corrupted' THEN 'malformed' END AS error_code,
         strlen(content)::BIGINT AS input_bytes
  FROM owned)"""


_RESPONSES = r"""
WITH numbered AS (SELECT *, event_id AS n, (event_id // 4) % 16 AS c FROM events),
log AS (
  SELECT n, c, event_type, 'r' || n AS request_id,
         ['convert', 'submit', 'job_status', 'render'][n % 4 + 1] AS endpoint,
         n % 3 + 1 AS attempt_no,
         [200, 202, 401, 404, 413, 415, 422, 429, 500, 503, 504, 422, 200, NULL, NULL, 418][c + 1]::BIGINT
           AS raw_status,
         CASE WHEN c = 13 THEN ['client_timeout', 'circuit_open'][n % 2 + 1]
              WHEN c = 14 THEN ['network', 'interrupted'][n % 2 + 1] END AS client_event,
         ['3', ' 3 ', 'Wed, 21', NULL, '-1', '1.5', '99999999999'][n % 7 + 1] AS retry_after,
         CASE WHEN n % 7 IN (0, 1) THEN 3 ELSE -1 END::BIGINT AS retry_seconds,
         raw_status NOT IN (200, 202) AND n % 11 <> 0 AND n % 7 <> 0 AS readable,
         CASE WHEN readable THEN CASE WHEN c = 11 THEN 'encrypted' ELSE event_type END END AS code,
         CASE WHEN readable AND n % 3 <> 0 THEN 'why ' || event_type END AS said
  FROM numbered)"""

_CLASSED = (
    _RESPONSES
    + r""",
matched AS (
  SELECT *, endpoint <> 'job_status' AS request,
         c = 12 AND endpoint <> 'submit' AS bad,
         CASE WHEN client_event = 'client_timeout' THEN 'timeout'
              WHEN client_event = 'network' THEN 'service'
              WHEN client_event = 'interrupted' THEN 'generic'
              WHEN client_event = 'circuit_open' THEN 'circuit_open'
              WHEN bad THEN 'generic'
              WHEN raw_status = 200 AND endpoint <> 'submit' THEN 'success'
              WHEN raw_status = 202 AND endpoint = 'submit' THEN 'success'
              WHEN raw_status = 401 THEN 'unauthorized'
              WHEN raw_status = 413 AND request THEN 'too_large'
              WHEN raw_status = 415 AND request THEN 'unsupported'
              WHEN raw_status = 422 AND endpoint = 'convert' AND code = 'encrypted' THEN 'encrypted'
              WHEN raw_status = 422 AND endpoint = 'convert' THEN 'corrupted'
              WHEN raw_status IN (429, 503) AND request THEN 'unavailable'
              WHEN raw_status = 504 AND request THEN 'timeout'
              WHEN raw_status >= 500 THEN 'service'
              ELSE 'generic' END AS class,
         CASE WHEN class = 'success' THEN NULL
              WHEN client_event IS NOT NULL THEN client_event
              WHEN bad THEN 'bad_response'
              WHEN class = 'unauthorized' THEN 'unauthorized'
              WHEN class = 'too_large' THEN 'too_large'
              WHEN class = 'encrypted' THEN 'encrypted'
              WHEN class IN ('unsupported', 'corrupted') THEN coalesce(code, 'unknown')
              WHEN class = 'unavailable' THEN 'overloaded'
              WHEN class = 'timeout' THEN 'timeout'
              WHEN raw_status = 404 AND NOT request THEN 'job_not_found'
              WHEN class = 'service' THEN 'http_' || raw_status
              ELSE 'unexpected' END AS error_code
  FROM log),
classed AS (
  SELECT *,
         CASE WHEN class = 'success' OR bad OR client_event IS NOT NULL THEN NULL
              WHEN class = 'unavailable' THEN 503 ELSE raw_status END::BIGINT AS http_status,
         CASE WHEN class = 'success' THEN NULL
              WHEN bad THEN 'response not parsable'
              WHEN client_event IS NULL AND (class = 'service' OR error_code = 'unexpected')
                THEN 'HTTP ' || raw_status
              WHEN said IS NOT NULL THEN said
              ELSE 'no reason given (' || replace(class, '_', ' ') || ')' END AS reason,
         class IN ('unavailable', 'service') OR coalesce(client_event = 'client_timeout', false)
           AS retryable,
         CASE WHEN class = 'unavailable' THEN retry_seconds END AS retry_after_s
  FROM matched)"""
)

_LINES = r"""
WITH lines AS (
  SELECT doc_id, lang, source, text, n_chars, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents)"""

_ASSETS = (
    _LINES
    + r""",
asset AS (
  SELECT *, 'r' || doc_id AS request_id, i % 5 = 4 AS truncated,
         CASE WHEN i % 3 = 2 THEN 'application/octet-stream' ELSE 'image/png' END AS media_type,
         i % 5 <> 4 AND strlen(line) > 0 AS has_data
  FROM lines WHERE doc_id % 10 < 8)"""
)

_STRUCTURED = r"""
WITH structured AS (
  SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda line, k:
           CASE WHEN (k - 1) % 4 = 0 THEN repeat('#', ((length(line) + k - 1) % 4 + 1)::INT) || ' ' || line
                WHEN (k - 1) % 5 = 2 THEN line || ' ![fig](img-' || (k - 1) || '.png)'
                WHEN (k - 1) % 7 = 3 THEN '![](' || (k - 1) || '.jpg)'
                ELSE line END), chr(10) || chr(10)) AS markdown
  FROM documents),"""


def _blocks(source: str, key: str) -> str:
    """CTEs that end in ``chained`` with level and heading path per block."""
    heading = r"'^(#{1,6})[ \t]+([^\n]*)'"
    last = "\n".join(
        f"""
         last_value(CASE WHEN heading_level = {n} THEN block_index END IGNORE NULLS) OVER w AS p{n},
         last_value(CASE WHEN heading_level = {n} THEN title END IGNORE NULLS) OVER w AS t{n},"""
        for n in range(1, 7)
    )
    path = ",\n".join(
        f"CASE WHEN p{n} > "
        + ("-1" if n == 1 else "greatest(" + ", ".join(f"coalesce(p{m}, -1)" for m in range(1, n)) + ")")
        + f" THEN t{n} END"
        for n in range(1, 7)
    )
    return rf"""
pieces AS (
  SELECT {key}, unnest(string_split_regex(markdown, '\n{{2,}}')) AS block,
         generate_subscripts(string_split_regex(markdown, '\n{{2,}}'), 1) - 1 AS block_index
  FROM {source}),
titled AS (
  SELECT *, length(regexp_extract(block, {heading}, 1)) AS heading_level,
         trim(regexp_extract(block, {heading}, 2)) AS title
  FROM pieces),
latest AS (
  SELECT *, {last}
         1 AS one
  FROM titled
  WINDOW w AS (PARTITION BY {key} ORDER BY block_index ROWS UNBOUNDED PRECEDING)),
chained AS (
  SELECT *, concat_ws(' > ', {path}) AS heading_path FROM latest)"""


_NORMALISED = r"trim(regexp_replace(regexp_replace(line, '[ \t\x0B\f\r]+', ' ', 'g'), '[0-9]+', '#', 'g'))"

_REPEATED = rf"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i,
         len(string_split(text, chr(10))) AS n
  FROM documents),
norm AS (SELECT *, {_NORMALISED} AS normalised FROM lines),
used AS (SELECT * FROM norm WHERE NOT regexp_matches(normalised, {_BLANK})),
seen AS (
  SELECT source, normalised, count(DISTINCT doc_id) AS pages_seen, count(*) AS occurrences,
         count(*) FILTER (WHERE i * 2 < n) AS upper_half
  FROM used GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5),
wording AS (
  SELECT source, normalised, line,
         row_number() OVER (PARTITION BY source, normalised ORDER BY count(*) DESC, line) AS pick
  FROM used GROUP BY source, normalised, line),
total AS (SELECT source, count(DISTINCT doc_id) AS pages FROM documents GROUP BY source)"""

# Lines from their first letter on, with single spaces; those without a letter are left out.
_CLEAN = r"""
WITH trimmed AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS raw,
         list_transform(string_split(text, chr(10)), lambda x:
           regexp_replace(trim(regexp_replace(x, '[ \t\x0B\f\r]+', ' ', 'g')), '^[^\pL]+', '')) AS lines
  FROM documents),
cleaned AS (
  SELECT doc_id, source, list_filter(lines, lambda x: x <> '') AS lines,
         list_filter(raw, lambda x, i: lines[i] <> '') AS raw
  FROM trimmed)"""

_JOBS = r"""
WITH jobs AS (
  SELECT user_id || ':' || strftime(ts, '%Y-%m-%d') AS job_id, ts, event_id AS n,
         CASE event_type WHEN 'signup' THEN 'queued' WHEN 'purchase' THEN 'succeeded'
                         WHEN 'error' THEN 'failed' ELSE 'running' END AS status,
         CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 2
                         WHEN 'error' THEN 3 ELSE 1 END AS state_rank,
         event_type = 'error' AS is_failed,
         CASE WHEN is_failed THEN
           ['unsupported', 'encrypted', 'malformed', 'missing_part', 'resource_limit', 'timeout',
            'server_shutting_down', 'overloaded', 'rate_limited', NULL, 'engine_crash'][n % 11 + 1]
         END AS error_code,
         CASE WHEN is_failed AND n % 2 = 0 THEN 'reason ' || n END AS error_reason,
         coalesce(is_failed AND n % 2 = 0, false) AS retryable,
         event_type = 'purchase' AS cache_hit
  FROM events)"""

_LATEST = (
    _JOBS
    + r""",
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, state_rank DESC, n DESC) AS pick,
         count(*) OVER (PARTITION BY job_id) AS events
  FROM jobs)"""
)

_CALLS = r"""
calls AS (
  SELECT user_id AS client_id, event_id AS call_id, ts, (epoch_us(ts) // 1000) AS at_ms,
         CASE event_type WHEN 'error' THEN 'service_failure' WHEN 'signup' THEN 'business_rejection'
                         ELSE 'success' END AS outcome
  FROM events)"""

_WINDOWS = """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, event_type AS class,
       count(*) AS outcomes
FROM events"""

ORACLE_SQL: dict[str, str] = {
    # --- sources and sinks ---------------------------------------------------
    "read_documents": """
SELECT doc_id AS input_ordinal, lang || '.txt' AS filename, strlen(text)::BIGINT AS size_bytes
FROM documents""",
    "read_document_files": """
SELECT page_id, strlen(html)::BIGINT + 1 AS size_bytes,
       CASE WHEN strlen(html) + 1 > 4000 THEN 'too_large' END AS class,
       CASE WHEN strlen(html) + 1 <= 4000 THEN sha256(html || chr(10)) END AS content_sha256
FROM pages""",
    "read_response_log": _RESPONSES
    + """
SELECT request_id, endpoint, attempt_no, raw_status, client_event, retry_after,
       raw_status IS NOT NULL AS has_body
FROM log""",
    "stream_documents": """
SELECT doc_id AS input_ordinal, lang || '.txt' AS filename, sha256(text) AS content_sha256
FROM documents""",
    "write_routed": _batch(False) + "\nSELECT input_ordinal, class, route FROM outcomes",
    "store_results": f"""
WITH {_OPTIONED}
SELECT variant_key, 1::BIGINT AS stored_rows, max(length(text)) AS markdown_chars
FROM opts WHERE NOT bypass GROUP BY variant_key""",
    "write_assets": _ASSETS
    + """
SELECT request_id, i::BIGINT AS asset_id, media_type, strlen(line)::BIGINT AS size,
       sha256(line) AS data_sha256
FROM asset WHERE has_data""",
    # --- intake --------------------------------------------------------------
    "normalise_documents": r"""
WITH named AS (
  SELECT doc_id,
         CASE doc_id % 6 WHEN 2 THEN lang || '.txt' WHEN 3 THEN 'a"b' || lang || chr(13) || chr(10) || '.csv'
                         WHEN 5 THEN lang || '.txt' ELSE 'document.bin' END AS filename
  FROM documents)
SELECT doc_id AS input_ordinal, filename, translate(filename, chr(13) || chr(10) || '"', '___') AS safe_filename,
       CASE WHEN doc_id % 3 = 1 THEN 'req-' || doc_id ELSE md5('document:' || doc_id) END AS request_id
FROM named""",
    "reject_empty": """
SELECT doc_id AS input_ordinal, 0::BIGINT AS size_bytes, 'invalid_input' AS class
FROM documents WHERE doc_id % 7 = 0 OR doc_id % 11 = 0 OR strlen(text) = 0""",
    "size_gate": """
SELECT doc_id AS input_ordinal, strlen(text)::BIGINT AS size_bytes,
       CASE WHEN strlen(text) > 2000 THEN 'too_large' ELSE 'accepted' END AS class,
       CASE WHEN strlen(text) > 2000 THEN 413 END::BIGINT AS http_status, false AS retryable
FROM documents""",
    "fingerprint": "SELECT doc_id AS input_ordinal, sha256(text) AS content_sha256 FROM documents",
    "variant_key": f"WITH {_OPTIONED} SELECT doc_id AS input_ordinal, variant_key FROM opts",
    "sniff_format": rf"""
WITH named AS (
  SELECT doc_id, text, lang || ['.txt', '.doc', '.zip', '', '.csv', '.CSV', '.docx', '.md'][doc_id % 8 + 1]
           AS filename
  FROM documents)
SELECT page_id AS input_ordinal, 'page.docx' AS filename, 'html' AS format, 'content' AS format_source
FROM pages
UNION ALL
SELECT doc_id + {_OFFSET}, filename,
       ['pdf', 'rtf', 'docx', 'epub', 'html', 'csv', 'docx', NULL,
        'pdf', 'rtf', 'xlsx', 'odt', 'html', 'csv', 'docx', NULL][doc_id % 16 + 1],
       CASE WHEN doc_id % 8 < 5 THEN 'content' WHEN doc_id % 8 < 7 THEN 'extension' ELSE 'unknown' END
FROM named""",
    # --- reuse ---------------------------------------------------------------
    "single_flight": f"""
WITH {_html("documents", "doc_id", "text")},
keyed AS (
  SELECT doc_id, sha256(text) || ':' || lang || '.txt:false:' AS variant_key, markdown
  FROM documents JOIN md USING (doc_id))
SELECT doc_id AS input_ordinal, md5('document:' || doc_id) AS request_id, variant_key,
       doc_id <> min(doc_id) OVER (PARTITION BY variant_key) AS shared, sha256(markdown) AS markdown_sha256
FROM keyed""",
    "single_flight_report": """
SELECT sha256(text) || ':' || lang || '.txt:false:' AS variant_key, count(*) AS calls, count(*) - 1 AS shares
FROM documents GROUP BY 1""",
    "cache_lookup": f"""
WITH {_OPTIONED},
store AS (SELECT variant_key, max(length(text)) AS stored_chars FROM opts
          WHERE lang = 'en' GROUP BY variant_key)
SELECT doc_id AS input_ordinal, stored_chars IS NOT NULL AND NOT bypass AS cache_hit,
       CASE WHEN NOT bypass THEN stored_chars END AS stored_chars
FROM opts LEFT JOIN store USING (variant_key)""",
    "stream_dedup": "SELECT DISTINCT user_id || ':' || event_type AS variant_key FROM events",
    # --- conversion ----------------------------------------------------------
    "html_to_markdown": f"WITH {_html('pages', 'page_id', 'html')} SELECT page_id, markdown FROM md",
    "html_structures": _CLEAN
    + r"""
SELECT doc_id, concat('## ', source, chr(10), chr(10),
       CASE WHEN len(lines) > 0 THEN concat(array_to_string(list_transform(lines, lambda x, i:
         CASE WHEN (i - 1) % 3 = 1 THEN concat('- ', x, chr(10), '  1. ', x, chr(10), '  2. **x**')
              ELSE '- ' || x END), chr(10)), chr(10), chr(10)) ELSE '' END,
       '| no | a\|b |', chr(10), '| --- | --- |',
       array_to_string(list_transform(lines, lambda x, i: concat(chr(10), '| ', i - 1, ' | ',
         replace(x, '|', '\|'), CASE WHEN (i - 1) % 3 = 2 THEN ' y<br>z' ELSE '' END, ' |')), ''),
       chr(10), chr(10), '[see ', doc_id, '](/d/', doc_id, ')![', doc_id, '](i', doc_id, '.png)', chr(10), chr(10),
       'é''é&lt;', chr(10), chr(10), '```', chr(10), array_to_string(lines, chr(10) || '  '), chr(10), '```',
       chr(10), chr(10), '\# ', doc_id) AS markdown
FROM cleaned""",
    "csv_to_markdown": rf"""
SELECT doc_id, '| doc_id | lang | source | text |' || chr(10) || '| --- | --- | --- | --- |' || chr(10)
       || '| ' || doc_id || ' | ' || lang || ' | ' || source || ' | ' || {_cell("text")} || ' |' AS markdown
FROM documents""",
    "convert_batch": _batch(True) + "\nSELECT * FROM outcomes",
    "convert_batch_without_store": _batch(False) + "\nSELECT * FROM outcomes",
    "convert_batch_assets": _CLEAN
    + r""",
placed AS (
  SELECT doc_id, source, unnest(lines) AS line, unnest(raw) AS raw,
         unnest(list_concat(lines[2:], [''])) AS following, generate_subscripts(lines, 1) - 1 AS i
  FROM cleaned WHERE doc_id % 2 = 0),
counted AS (
  SELECT *, count(*) FILTER (WHERE i % 3 = 0 OR i % 5 = 4)
              OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS images
  FROM placed),
held AS (
  SELECT *, min(i) OVER (PARTITION BY doc_id, raw) AS first_i,
         row_number() OVER (PARTITION BY doc_id, raw ORDER BY i) - 1 AS placement_no
  FROM counted WHERE i % 3 = 0),
numbered AS (
  SELECT *, dense_rank() OVER (PARTITION BY doc_id ORDER BY first_i) - 1 AS asset_id FROM held)
SELECT md5('document:' || doc_id) AS request_id, asset_id, 'image/png' AS media_type,
       strlen(raw)::BIGINT AS size, true AS is_image, sha256(raw) AS data_sha256, placement_no,
       placement_no = 0 AS is_primary, source AS heading_path, 1 + i + images AS block_index,
       CASE WHEN following <> '' THEN following ELSE line END AS anchor_text,
       max(asset_id) OVER (PARTITION BY doc_id) + 1 AS enrichable_assets
FROM numbered""",
    "convert_batch_headers_footers": _CLEAN
    + r""",
paged AS (
  SELECT doc_id, source, (len(lines) + 2) // 3 AS n,
         list_transform(lines, lambda x, i: translate((i - 1)::VARCHAR, '0123456789', 'abcdefghij') || ' ' || x) AS lines
  FROM cleaned),
asked AS (SELECT *, doc_id % 3 = 0 AS wanted, doc_id % 3 = 0 AND n > 1 AS stripped_here FROM paged),
whole AS (
  SELECT *, array_to_string(CASE WHEN stripped_here THEN lines ELSE flatten(list_transform(generate_series(1, n),
           lambda k: list_concat([source || ' report'], lines[k * 3 - 2:k * 3], [concat('Page ', k, ' of ', n)]))) END,
           chr(10) || chr(10)) AS markdown
  FROM asked)
SELECT doc_id AS input_ordinal,
       CASE WHEN stripped_here THEN concat('header|top|', source, ' report|', n, '|1.000|false;footer|bottom|Page 1 of ',
                                           n, '|', n, '|1.000|true')
            WHEN wanted THEN '' END AS entries,
       CASE WHEN stripped_here THEN n * 2 END AS stripped, sha256(markdown) AS markdown_sha256
FROM whole""",
    "convert_stream": rf"""
WITH rows AS (
  SELECT doc_id, sha256({_MIXED_CONTENT}) || {_MIXED_NAME} AS k, {_MIXED_CLASS} AS class,
         CASE WHEN {_MIXED_CLASS} = 'success' THEN
           '| text |' || chr(10) || '| --- |' || chr(10) || '| ' || {_cell("text")} || ' |' END AS markdown
  FROM documents)
SELECT doc_id AS input_ordinal, class, {_ROUTED} AS route,
       class = 'success' AND doc_id <> min(doc_id) OVER (PARTITION BY k) AS shared,
       sha256(markdown) AS markdown_sha256
FROM rows""",
    "empty_result_gate": f"""
WITH {_html("pages", "page_id", "html")}
SELECT page_id, page_id % 5 = 0 OR regexp_matches(markdown, {_BLANK}) AS is_empty,
       CASE WHEN page_id % 5 = 0 OR regexp_matches(markdown, {_BLANK}) THEN 'fallback' ELSE 'ok' END AS route
FROM md""",
    # --- responses -----------------------------------------------------------
    "parse_results": """
WITH d AS (SELECT *, doc_id % 10 = 9 AS bad, doc_id % 10 = 8 AS bare FROM documents)
SELECT 'r' || doc_id AS request_id,
       CASE WHEN NOT bad THEN sha256(text) END AS markdown_sha256,
       CASE WHEN NOT bad THEN 'docx' END AS format,
       CASE WHEN NOT bad THEN n_chars / 4 END AS elapsed_ms,
       CASE WHEN NOT bad THEN strlen(text) END::BIGINT AS input_bytes,
       CASE WHEN bare THEN 0 WHEN NOT bad THEN len(string_split(text, chr(10))) END::BIGINT AS assets,
       CASE WHEN bare THEN false WHEN NOT bad THEN doc_id % 4 = 0 END AS cache_hit,
       CASE WHEN bare THEN 0 WHEN NOT bad THEN 5 END::BIGINT AS headers_footers,
       CASE WHEN NOT bad AND doc_id % 2 = 0 THEN doc_id END AS headers_footers_stripped,
       CASE WHEN bad THEN 'bad_response' END AS error_code
FROM d""",
    "parse_jobs": _JOBS
    + """
SELECT 'r' || n AS request_id, job_id, epoch_us(ts) AS ts_us, status,
       CASE WHEN status <> 'queued' THEN 'docx' END AS format,
       CASE status WHEN 'queued' THEN n % 3 = 0 WHEN 'succeeded' THEN n % 2 = 0 ELSE false END AS cache_hit,
       error_code, error_reason, retryable,
       CASE WHEN status <> 'queued' THEN epoch_us(ts) // 1000000 END AS created_at_s,
       CASE WHEN status <> 'queued' THEN epoch_us(ts) // 1000000 END AS started_at_s,
       NULL::BIGINT AS finished_at_s,
       CASE WHEN status = 'succeeded' THEN job_id END AS markdown
FROM jobs WHERE n % 13 <> 0
UNION ALL
SELECT 'r' || n, NULL, epoch_us(ts), NULL, NULL, false, 'bad_response', NULL, false, NULL, NULL, NULL, NULL
FROM jobs WHERE n % 13 = 0""",
    "parse_errors": _RESPONSES
    + """
SELECT request_id, endpoint, raw_status, coalesce(code, 'unknown') AS error_code,
       coalesce(said, 'no reason given') AS reason
FROM log WHERE raw_status NOT IN (200, 202)""",
    "classify_outcomes": _CLASSED
    + """
SELECT request_id, endpoint, raw_status, class, http_status, error_code, reason, retryable, retry_after_s
FROM classed""",
    "classify_jobs": _JOBS
    + """
SELECT n AS event_id, job_id,
       CASE WHEN error_code IN ('malformed', 'missing_part', 'resource_limit') THEN 'corrupted'
            WHEN error_code IN ('server_shutting_down', 'overloaded', 'rate_limited') THEN 'unavailable'
            WHEN error_code IN ('unsupported', 'encrypted', 'timeout') THEN error_code
            ELSE 'service' END AS class,
       CASE class WHEN 'unsupported' THEN 415 WHEN 'encrypted' THEN 422 WHEN 'corrupted' THEN 422
                  WHEN 'timeout' THEN 504 WHEN 'unavailable' THEN 503 END::BIGINT AS http_status,
       CASE WHEN class = 'unavailable' THEN 'overloaded'
            ELSE coalesce(jobs.error_code, 'conversion_failed') END AS error_code,
       class IN ('unavailable', 'service') AS class_retryable, retryable,
       CASE WHEN class = 'unavailable' THEN 0 END::BIGINT AS retry_after_s,
       coalesce(error_reason, 'job failed') AS reason
FROM jobs WHERE is_failed""",
    "parse_retry_after": _RESPONSES
    + "\nSELECT request_id, retry_after, retry_seconds AS retry_after_s FROM log",
    "route": _CLASSED
    + """
SELECT request_id, class, retryable,
       CASE WHEN retryable AND attempt_no >= 3 THEN 'fallback'
            WHEN retryable THEN 'retry'
            WHEN class = 'success' THEN 'ok'
            WHEN class = 'unauthorized' THEN 'config_alert'
            WHEN class = 'too_large' THEN 'reject'
            WHEN class = 'unsupported' THEN 'dead_letter_review'
            WHEN class = 'encrypted' THEN 'quarantine'
            WHEN class = 'timeout' THEN 'async'
            WHEN class = 'circuit_open' THEN 'fallback'
            ELSE 'dead_letter_alert' END AS route
FROM classed""",
    "resolve_attempts": """
WITH tries AS (
  SELECT event_id // 4 AS request_id, event_id % 4 + 1 AS attempt_no,
         CASE event_type WHEN 'error' THEN 'unavailable' WHEN 'signup' THEN 'unsupported'
                         ELSE 'success' END AS class
  FROM events),
ended AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY
             CASE WHEN class = 'unavailable' THEN 1 ELSE 0 END,
             CASE WHEN class = 'unavailable' THEN -attempt_no ELSE attempt_no END) AS pick
  FROM tries WHERE attempt_no <= 3),
logged AS (SELECT request_id, count(*) AS attempts_logged FROM tries GROUP BY request_id)
SELECT request_id, class, attempt_no AS attempts_used, attempts_logged,
       (SELECT count(*) FROM tries t WHERE t.request_id = ended.request_id AND t.attempt_no > ended.attempt_no)
         AS attempts_after_stop,
       class = 'unavailable' AND attempt_no >= 3 AS exhausted
FROM ended JOIN logged USING (request_id) WHERE pick = 1""",
    "due_retries": """
WITH due AS (
  SELECT event_id AS request_id, event_id % 4 + 1 AS attempt_no,
         (epoch_us(ts) // 1000) + greatest([240, 480, 960, 1600][event_id % 4 + 1],
                                           [0, 0, 0, 1000, 3000][event_id % 5 + 1])::BIGINT AS not_before_ms
  FROM events WHERE event_type = 'error')
SELECT * FROM due WHERE not_before_ms <= 1705708800000""",
    "retry_plan": """
WITH due AS (
  SELECT event_id AS request_id, event_id % 4 + 1 AS attempt_no, (epoch_us(ts) // 1000) AS failed_at_ms,
         [0, 0, 0, 1000, 3000][event_id % 5 + 1] AS asked_ms,
         [300, 600, 1200, 2000][event_id % 4 + 1]::BIGINT AS backoff_ms
  FROM events WHERE event_type = 'error')
SELECT request_id, attempt_no, backoff_ms,
       greatest(backoff_ms, asked_ms)::BIGINT AS wait_ms,
       greatest(backoff_ms * 80 // 100, asked_ms)::BIGINT AS wait_min_ms,
       greatest(backoff_ms * 120 // 100, asked_ms)::BIGINT AS wait_max_ms,
       failed_at_ms + wait_min_ms AS not_before_ms, failed_at_ms + wait_max_ms AS not_after_ms
FROM due""",
    # --- assets and sections -------------------------------------------------
    "assets": _ASSETS
    + """
SELECT request_id, i::BIGINT AS asset_id, media_type, 'word/media/image' || i AS origin_part,
       strlen(line)::BIGINT AS size, truncated, media_type = 'image/png' AS is_image, has_data,
       i % 4 = 0 AS is_floating, CASE WHEN NOT truncated THEN strlen(line) END::BIGINT AS data_bytes
FROM asset""",
    "placements": _ASSETS
    + rf"""
SELECT request_id, i::BIGINT AS asset_id, 0::BIGINT AS placement_no, true AS is_primary,
       CASE WHEN i % 3 = 0 THEN '' ELSE lang || ' > ' || source END AS heading_path,
       CASE WHEN i % 3 <> 0 THEN i + 1 END::BIGINT AS block_index,
       CASE WHEN i % 3 = 0 THEN '' ELSE 'figure ' || i END AS anchor_text
FROM asset
UNION ALL
SELECT request_id, i::BIGINT, 1, false, lang || ' > ' || source, i + 2, line FROM asset WHERE i % 3 = 2""",
    "enrichable_counts": _ASSETS
    + """
SELECT request_id, count(*) FILTER (WHERE has_data) AS enrichable_assets FROM asset GROUP BY request_id
UNION ALL
SELECT 'r' || doc_id, 0 FROM documents WHERE doc_id % 10 = 8""",
    "markdown_blocks": _STRUCTURED
    + _blocks("structured", "doc_id")
    + """
SELECT doc_id, block_index::BIGINT AS block_index, heading_level::BIGINT AS heading_level, heading_path,
       length(block) AS chars
FROM chained""",
    "image_placements": _STRUCTURED
    + _blocks("structured", "doc_id")
    + rf""",
plain AS (
  SELECT *, trim(regexp_replace(block, '!\[[^\]]*\]\([^)\s]*[^)]*\)', '', 'g')) AS words FROM chained),
worded AS (
  SELECT *, CASE WHEN NOT regexp_matches(words, {_BLANK}) THEN words END AS said FROM plain),
around AS (
  SELECT *,
         last_value(said IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY block_index
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_block,
         first_value(said IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY block_index
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after_block,
         regexp_extract_all(block, '!\[[^\]]*\]\(([^)\s]*)', 1) AS targets,
         list_transform(string_split_regex(block, '!\[[^\]]*\]\([^)\s]*[^)]*\)'), lambda p: trim(p)) AS parts
  FROM worded),
images AS (
  SELECT *, unnest(targets) AS target, generate_subscripts(targets, 1) AS k FROM around WHERE len(targets) > 0)
SELECT doc_id, block_index::BIGINT AS block_index, (k - 1)::BIGINT AS image_no, target, heading_path,
       coalesce(list_filter(parts[:k], lambda p: NOT regexp_matches(p, {_BLANK}))[-1], before_block, '')
         AS context_before,
       coalesce(list_filter(parts[k + 1:], lambda p: NOT regexp_matches(p, {_BLANK}))[1], after_block, '')
         AS context_after
FROM images""",
    "section_summary": f"WITH {_html('pages', 'page_id', 'html')},"
    + _blocks("md", "page_id")
    + """
SELECT page_id, heading_path, count(*) AS blocks, sum(length(block))::BIGINT AS chars,
       min(block_index)::BIGINT AS first_block
FROM chained GROUP BY page_id, heading_path""",
    # --- headers, footers and pages ------------------------------------------
    "headers_footers": """
WITH e AS (
  SELECT *, unnest([0, 1, 2, 3, 4]) AS k FROM documents WHERE doc_id % 10 < 8)
SELECT 'r' || doc_id AS request_id, k::BIGINT AS entry_no,
       CASE WHEN k < 2 THEN 'header' ELSE 'footer' END AS kind, k < 2 AS is_header, k >= 2 AS is_footer,
       CASE k WHEN 0 THEN 'default' WHEN 3 THEN 'all' END AS scope,
       CASE k WHEN 1 THEN 'image' WHEN 3 THEN 'bottom' END AS location,
       CASE WHEN k < 2 THEN source WHEN k = 2 THEN '  ' WHEN k = 3 THEN 'Page 1 of ' || n_chars ELSE lang END AS text,
       CASE WHEN k = 0 THEN '0,1' END AS sections,
       CASE WHEN k = 3 THEN n_chars END AS pages_seen, CASE WHEN k = 3 THEN 1.0 END::DOUBLE AS page_frequency,
       k = 3 AS is_page_number, CASE WHEN k = 3 THEN 'pdf' END AS source,
       CASE WHEN k = 1 THEN 'word/media/logo.png' END AS image_part,
       CASE WHEN k = 1 THEN 'image/png' END AS image_media_type,
       CASE WHEN k = 1 THEN e.source END AS image_alt,
       CASE WHEN k = 1 THEN strlen(e.source) END::BIGINT AS image_size,
       k = 1 AND strlen(e.source) > 0 AS image_has_data, false AS image_truncated,
       CASE WHEN k = 1 THEN sha256(e.source) END AS image_sha256
FROM e""",
    "header_footer_texts": """
SELECT 'r' || doc_id AS request_id, doc_id % 10 < 8 AS has_headers_footers,
       CASE WHEN doc_id % 10 < 8 THEN source || '|Page 1 of ' || n_chars || '|' || lang ELSE '' END AS texts
FROM documents WHERE doc_id % 10 <> 9""",
    "detect_repeated_lines": _REPEATED
    + r"""
SELECT source, normalised, line AS text, pages_seen, pages_seen / pages AS page_frequency, occurrences,
       CASE WHEN upper_half * 2 >= occurrences THEN 'header' ELSE 'footer' END AS kind,
       CASE WHEN upper_half * 2 >= occurrences THEN 'top' ELSE 'bottom' END AS location,
       regexp_matches(regexp_replace(lower(normalised), 'page|of|第|页|共|[\s/|.:·–—()\[\]-]', '', 'g'), '^#+$')
         AS page_number
FROM seen JOIN wording USING (source, normalised) JOIN total USING (source) WHERE pick = 1""",
    "strip_repeated_lines": _REPEATED
    + """,
marked AS (
  SELECT norm.*, seen.normalised IS NOT NULL AS found
  FROM norm LEFT JOIN seen ON seen.source = norm.source AND seen.normalised = norm.normalised)
SELECT doc_id, nullif(count(*) FILTER (WHERE found), 0) AS lines_stripped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT found), '')) AS stripped_sha256
FROM marked GROUP BY doc_id""",
    "select_pages": """
SELECT doc_id, source FROM documents
WHERE doc_id BETWEEN 0 AND 40 OR doc_id = 77 OR doc_id BETWEEN 500 AND 100000000""",
    "select_pages_by_row": """
SELECT doc_id, lang FROM documents
WHERE (lang = 'en' AND (doc_id IN (0, 2) OR doc_id BETWEEN 10 AND 500)) OR lang NOT IN ('en', 'fr')""",
    "cap_pages": """
SELECT doc_id, source FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20
        OR regexp_matches(source, '[13579]$')""",
    "rendered_pages": _LINES
    + """
SELECT 'r' || doc_id AS request_id, NULL AS error_code, count(*) OVER (PARTITION BY doc_id) AS total_pages,
       count(*) OVER (PARTITION BY doc_id) AS rendered, 1.5::DOUBLE AS scale, i::BIGINT AS page,
       length(line) AS width, (i * 2)::BIGINT AS height,
       CASE WHEN i % 2 = 0 THEN 'image/png' ELSE 'image/jpeg' END AS media_type, i % 2 = 0 AS is_png,
       sha256(line) AS data_sha256
FROM lines WHERE doc_id % 9 <> 0
UNION ALL
SELECT 'r' || doc_id, 'bad_response', NULL, NULL, NULL, NULL, NULL, NULL, NULL, false, NULL
FROM documents WHERE doc_id % 18 = 0""",
    # --- jobs ----------------------------------------------------------------
    "job_latest": _LATEST
    + """
SELECT job_id, status, status IN ('succeeded', 'failed') AS is_terminal, 'docx' AS format, error_code,
       error_reason, retryable, cache_hit, events, (epoch_us(ts) // 1000) AS at_ms
FROM ranked WHERE pick = 1""",
    "job_durations": _JOBS
    + """,
marks AS (
  SELECT job_id, (epoch_us(min(ts)) // 1000) AS created, (epoch_us(min(ts) FILTER (WHERE status = 'running')) // 1000) AS started,
         (epoch_us(min(ts) FILTER (WHERE status IN ('succeeded', 'failed'))) // 1000) AS finished
  FROM jobs GROUP BY job_id)
SELECT job_id, started - created AS queue_ms, finished - started AS run_ms, finished - created AS total_ms
FROM marks""",
    "job_deadlines": _JOBS
    + """,
known AS (SELECT * FROM jobs WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, state_rank DESC, n DESC) AS pick,
         min(ts) OVER (PARTITION BY job_id) AS created
  FROM known),
asked AS (
  SELECT job_id, status, status IN ('succeeded', 'failed') AS done,
         (epoch_us(TIMESTAMP '2024-01-20 00:00:00') // 1000) - (epoch_us(created) // 1000) AS waited_ms,
         (epoch_us(TIMESTAMP '2024-01-20 00:00:00') // 1000) - (epoch_us(ts) // 1000) AS since_ms
  FROM ranked WHERE pick = 1)
SELECT job_id, status, waited_ms,
       CASE WHEN done AND since_ms > 432000000 THEN 'unknown' WHEN done THEN status
            WHEN waited_ms >= 43200000 THEN 'timeout' ELSE status END AS verdict,
       CASE WHEN NOT done AND waited_ms >= 43200000 THEN 504 END::BIGINT AS http_status, false AS retryable,
       CASE WHEN NOT done AND waited_ms >= 43200000 THEN 'deadline' END AS timeout_origin
FROM asked""",
    "job_tracker": _JOBS
    + """,
marks AS (
  SELECT job_id, min((epoch_us(ts) // 1000)) AS created,
         min((epoch_us(ts) // 1000)) FILTER (WHERE status IN ('succeeded', 'failed')) AS ended,
         arg_min(status, (epoch_us(ts) // 1000) * 4 + state_rank) FILTER (WHERE status IN ('succeeded', 'failed')) AS outcome
  FROM jobs GROUP BY job_id)
SELECT job_id, CASE WHEN ended <= created + 43200000 THEN outcome ELSE 'timeout' END AS verdict,
       least(coalesce(ended, created + 43200000), created + 43200000) - created AS waited_ms,
       CASE WHEN ended <= created + 43200000 THEN NULL ELSE 504 END::BIGINT AS http_status
FROM marks
WHERE least(coalesce(ended, created + 43200000), created + 43200000)
      <= (SELECT max((epoch_us(ts) // 1000)) - 600000 FROM events)""",
    # --- observability -------------------------------------------------------
    "outcome_metrics": _batch(False)
    + """
SELECT coalesce_format AS format, class, count(*) AS outcomes,
       count(*) FILTER (WHERE class0 = 'success') AS successes,
       count(*) FILTER (WHERE class0 <> 'success') AS failures,
       count(*) FILTER (WHERE cache_hit) AS cache_hits,
       count(*) FILTER (WHERE class0 = 'success' AND NOT cache_hit AND NOT shared) AS conversions,
       count(*) FILTER (WHERE shared) AS shares, sum(input_bytes)::BIGINT AS input_bytes,
       GROUPING(coalesce_format, class)::BIGINT AS level
FROM (SELECT *, coalesce(format, 'unknown') AS coalesce_format, class AS class0 FROM outcomes)
GROUP BY ROLLUP (coalesce_format, class)""",
    "service_counters": _batch(False)
    + ",\n"
    + _LATEST.strip().removeprefix("WITH")
    + ",\n"
    + _LINES.strip().removeprefix("WITH")
    + """
SELECT 'convert_total' AS counter, class AS label, count(*) AS total FROM outcomes GROUP BY class
UNION ALL
SELECT 'singleflight_shares_total', '', count(*) FROM outcomes WHERE shared
UNION ALL
SELECT 'cache_hits_total', '', count(*) FROM outcomes WHERE cache_hit
UNION ALL
SELECT 'render_pages_total', CASE WHEN i % 2 = 0 THEN 'image/png' ELSE 'image/jpeg' END, count(*)
FROM lines WHERE doc_id % 9 <> 0 GROUP BY 2
UNION ALL
SELECT 'jobs_total', status, count(*) FROM ranked WHERE pick = 1 GROUP BY status""",
    "latency_sketches": """
WITH timed AS (
  SELECT event_type AS class, round(value * 100)::BIGINT AS elapsed_ms, ts::DATE AS day FROM events)
SELECT class, count(*) AS calls, count(DISTINCT day) AS windows, min(elapsed_ms) AS min_ms,
       max(elapsed_ms) AS max_ms, rank::DOUBLE AS rank, true AS within_error
FROM timed, (VALUES (0.5), (0.95), (0.99)) r(rank) GROUP BY class, rank""",
    "latency_metrics": """
WITH timed AS (SELECT event_type AS class, round(value * 100)::BIGINT AS elapsed_ms FROM events),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY class ORDER BY elapsed_ms) AS rn,
         count(*) OVER (PARTITION BY class) AS n
  FROM timed)
SELECT class, count(*) AS calls, sum(elapsed_ms)::BIGINT / count(*) AS mean_ms, min(elapsed_ms) AS min_ms,
       max(elapsed_ms) AS max_ms,
       min(elapsed_ms) FILTER (WHERE rn >= n * 0.5) AS p50_ms,
       min(elapsed_ms) FILTER (WHERE rn >= n * 0.95) AS p95_ms,
       min(elapsed_ms) FILTER (WHERE rn >= n * 0.99) AS p99_ms
FROM ranked GROUP BY class""",
    "windowed_metrics": _WINDOWS + "\nGROUP BY 1, 2",
    "windowed_metrics_stream": _WINDOWS
    + """
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
GROUP BY 1, 2""",
    "failure_rate": f"""
WITH {_CALLS},
counted AS (
  SELECT client_id, call_id, outcome, count(*) OVER w AS calls_in_window,
         (count(*) FILTER (WHERE outcome = 'service_failure') OVER w)::BIGINT AS failures_in_window
  FROM calls WHERE outcome <> 'business_rejection'
  WINDOW w AS (PARTITION BY client_id ORDER BY ts, call_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT *, failures_in_window / calls_in_window AS failure_rate, calls_in_window = 20 AS window_full
FROM counted""",
    "reconcile": """
WITH log AS (SELECT user_id || '-' || floor(value)::BIGINT AS request_id, event_type FROM events),
seen AS (
  SELECT request_id, count(*) FILTER (WHERE event_type <> 'signup') AS client_rows,
         count(*) FILTER (WHERE event_type <> 'error') AS service_rows
  FROM log GROUP BY request_id)
SELECT request_id, client_rows, service_rows,
       CASE WHEN service_rows = 0 THEN 'client_only' WHEN client_rows = 0 THEN 'service_only'
            ELSE 'matched' END AS match
FROM seen""",
}
