"""Corpora and logs that Spark derives from the given tables.

The tables hold texts, pages and events; these functions read them as document
corpora, response logs, job events, tries and calls. Every row of a table is
used, so the inputs grow with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill import schemas
from docmill.functions.options import options
from docmill.sources.documents import document_columns, read_document_table

DOCUMENT_OFFSET = 1_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt over all tasks by their key, before work that is much dearer than a
    shuffle: a row group is read by one task, and a table may come in few of them."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, key)


def kind_of(number: Column, values: list) -> Column:
    """The value at ``number`` modulo the list's length."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


# --- corpora -----------------------------------------------------------------


def text_name() -> Column:
    return F.concat(F.col("lang"), F.lit(".txt"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_document_table(
        spark, f"{sf_dir}/documents.parquet", "doc_id", "text", text_name()
    )


def named_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, blank, padded and unsafe names; missing and padded request ids."""
    n, lang = F.col("doc_id"), F.col("lang")
    name = (
        F.when(n % 6 == 0, F.lit(None).cast("string"))
        .when(n % 6 == 1, F.lit("   "))
        .when(n % 6 == 2, F.concat(F.lit(" \t"), lang, F.lit(".txt ")))
        .when(n % 6 == 3, F.concat(F.lit('a"b'), lang, F.lit("\r\n.csv")))
        .when(n % 6 == 4, F.lit("　"))
        .otherwise(text_name())
    )
    rid = F.when(n % 3 == 1, F.concat(F.lit(" req-"), n.cast("string"), F.lit(" "))).when(
        n % 3 == 2, F.lit("")
    )
    return document_columns(table(spark, sf_dir, "documents"), "doc_id", "text", name, None, rid)


def optioned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with every option set on some and left out on others."""
    n = F.col("doc_id")
    opts = options(
        include_assets=F.when(n % 2 == 0, True),
        timeout_seconds=F.when(n % 3 == 0, 600),
        use_cache=F.when(n % 5 == 0, False),
        pages=F.when(n % 4 == 0, " 0-2 ").when(n % 4 == 1, "  "),
        max_pages=F.when(n % 7 == 0, 50),
        headers_footers=F.when(n % 6 == 0, False),
    )
    return document_columns(
        table(spark, sf_dir, "documents"), "doc_id", "text", text_name(), opts
    )


def documents_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which some are empty and some have no content."""
    n = F.col("input_ordinal")
    return documents(spark, sf_dir).withColumn(
        "content",
        F.when(n % 7 == 0, F.lit(""))
        .when(n % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("content")),
    )


def _little_endian(number: Column, size: int) -> Column:
    digits = F.lpad(F.hex(number.cast("long")), 2 * size, "0")
    return F.unhex(F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size))]))


def with_zip(df: DataFrame, out: str, entries: list[tuple[str, str]], comment: str = "") -> DataFrame:
    """Add a zip file of entries (name, binary column) that are stored as they are."""
    facts = {f"_crc{k}": F.crc32(F.col(c)) for k, (_, c) in enumerate(entries)}
    facts |= {f"_size{k}": F.octet_length(F.col(c)) for k, (_, c) in enumerate(entries)}
    df = df.withColumns(facts).withColumns(
        {
            f"_shared{k}": F.concat(
                F.unhex(F.lit("00" * 8)),
                _little_endian(F.col(f"_crc{k}"), 4),
                _little_endian(F.col(f"_size{k}"), 4),
                _little_endian(F.col(f"_size{k}"), 4),
                F.lit(len(name).to_bytes(2, "little") + bytes(2)),
            )
            for k, (name, _) in enumerate(entries)
        }
    )
    local, listed, at = [], [], F.lit(0)
    for k, (name, data) in enumerate(entries):
        shared = F.col(f"_shared{k}")
        local += [F.lit(b"PK\x03\x04\x14\x00"), shared, F.lit(name.encode()), F.col(data)]
        listed += [
            F.lit(b"PK\x01\x02\x14\x00\x14\x00"), shared, F.lit(bytes(10)), _little_endian(at, 4), F.lit(name.encode())
        ]
        at = at + F.col(f"_size{k}") + 30 + len(name)
    size = sum(46 + len(name) for name, _ in entries)
    count = len(entries).to_bytes(2, "little")
    head = F.lit(b"PK\x05\x06\x00\x00\x00\x00" + count + count + size.to_bytes(4, "little"))
    end = [head, _little_endian(at, 4), F.lit(len(comment).to_bytes(2, "little") + comment.encode())]
    helpers = [f"_{kind}{k}" for kind in ("crc", "size", "shared") for k in range(len(entries))]
    return df.withColumn(out, F.concat(*local, *listed, *end)).drop(*helpers)


def signed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts behind the signatures of several formats, under right and wrong names.

    Zip files hold whole texts, and one of another format next to their own parts.
    """
    n, text = F.col("doc_id"), F.col("text")
    parts = table(spark, sf_dir, "documents").withColumns(
        {
            "_text": text.cast("binary"),
            "_epub": F.lit(b"application/epub+zip"),
            "_odt": F.lit(b"application/vnd.oasis.opendocument.text"),
        }
    )
    for out, entries in {
        "_sheet": [("xl/workbook.xml", "_text")],
        "_letter": [("word/document.xml", "_text")],
        "_letter_with_sheet": [("word/embeddings/sheet.xlsx", "_sheet"), ("word/document.xml", "_text")],
        "_sheet_with_letter": [("xl/embeddings/text.docx", "_letter"), ("xl/workbook.xml", "_text")],
        "_book": [("mimetype", "_epub"), ("word/document.xml", "_text")],
        "_open_text": [("mimetype", "_odt"), ("content.xml", "_text")],
        "_no_format": [("notes/word/document.xml", "_text")],
    }.items():
        parts = with_zip(parts, out, entries, "a comment" if out == "_sheet_with_letter" else "")
    content = (
        F.when(n % 8 == 0, F.concat(F.lit(b"%PDF-1.7\n"), F.col("_text")))
        .when(n % 8 == 1, F.concat(F.lit(b"{\\rtf1 "), F.col("_text")))
        .when(n % 16 == 2, F.col("_letter_with_sheet"))
        .when(n % 16 == 10, F.col("_sheet_with_letter"))
        .when(n % 16 == 3, F.col("_book"))
        .when(n % 16 == 11, F.col("_open_text"))
        .when(n % 8 == 4, F.concat(F.lit(b" <!DOCTYPE html>"), F.col("_text")))
        .when(n % 16 == 7, F.col("_no_format"))
        # one that was cut off has no directory
        .when(n % 16 == 6, F.substring("_sheet", F.lit(1), F.octet_length("_sheet") - 30))
        .otherwise(F.col("_text"))
    )
    name = F.concat(F.col("lang"), kind_of(n, [".txt", ".doc", ".zip", "", ".csv", ".CSV", ".docx", ".md"]))
    signed = parts.withColumn("content", content)
    # what may stand before a page's first tag, also much of it
    before = kind_of(
        F.col("page_id"),
        ["", " \n" * 400, "<!-- first > -->\n<!-- second -->", '<?xml version="1.0"?>\n', "<head></head>", "\ufeff"],
    )
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("input_ordinal"),
        F.concat(before, F.col("html")).cast("binary").alias("content"),
        F.lit("page.docx").alias("filename"),
    )
    return pages.unionByName(
        signed.select(
            (F.col("doc_id") + DOCUMENT_OFFSET).alias("input_ordinal"),
            "content",
            name.alias("filename"),
        )
    )


_REFERENCES = (("&", "&amp;"), ("<", "&lt;"), (">", "&#62;"))


def _as_markup(line: Column) -> Column:
    """A line as markup has it: single spaces, from its first letter on, with references."""
    text = F.trim(F.regexp_replace(line, r"[ \t\x0B\f\r]+", " "))
    text = F.regexp_replace(text, r"^[^\p{L}]+", "")
    for char, name in _REFERENCES:
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def structured_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of each document in the kinds of markup that are hard to convert: items of
    nested lists, cells of a table and of one inside it, links, images and plain lines."""

    number = F.col("doc_id").cast("string")

    def around(before: str, line: Column, after: str) -> Column:
        return F.concat(F.lit(before), line, F.lit(after))

    def item(line: Column, i: Column) -> Column:
        nested = F.concat(around("<li><p>", line, "</p>"), around("<ol><li>", line, "<li><b>x</b></ol>"))
        return F.when(i % 3 == 1, nested).otherwise(around("<li>", line, "</li>"))

    def row(line: Column, i: Column) -> Column:
        inner = around("<table><tr><td>", line, "<td>y<tr><td>z</table>")
        cell = F.when(i % 3 == 2, inner).otherwise(line)
        return F.concat(F.lit("<tr><td>"), i.cast("string"), F.lit("<td>"), cell)

    html = F.concat(
        F.lit("<h2 class='k'>"), F.col("source"), F.lit("</h2><ul>"), F.array_join(F.transform("_lines", item), "\n"),
        F.lit("</ul><table border=1><tr><th>no<th>a|b"), F.array_join(F.transform("_lines", row), ""),
        F.lit("</table><a class=x href=/d/"), number, F.lit(">see <span>"), number, F.lit("</span></a>"),
        F.lit('<img alt="'), number, F.lit('" src="i'), number, F.lit('.png"><p>&#233;&#x27;&eacute;&amp;lt;</p><pre>'),
        F.array_join("_lines", "\n  "), F.lit("</pre><p># "), number, F.lit("</p>"),
    )
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id")
    return docs.withColumn("_lines", _lines()).select("doc_id", html.alias("html"))


def as_csv() -> Column:
    """A document's row as a CSV file with a header and one quoted field."""
    return F.concat(
        F.lit("doc_id,lang,source,text\n"),
        F.concat_ws(",", F.col("doc_id").cast("string"), "lang", "source"),
        F.lit(',"'),
        F.replace(F.col("text"), F.lit('"'), F.lit('""')),
        F.lit('"\n'),
    )


def csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", as_csv().alias("content"))


def mixed_content() -> Column:
    """Mostly the text as one quoted CSV field; some plain text, some empty."""
    n = F.col("doc_id")
    quoted = F.concat(F.lit('text\n"'), F.replace(F.col("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(n % 10 == 0, F.lit("")).when(n % 10 >= 7, F.col("text")).otherwise(quoted)


def mixed_name() -> Column:
    n = F.col("doc_id")
    return (
        F.when(n % 10 == 9, F.concat("lang", F.lit(".docx")))
        .when(n % 10 >= 7, text_name())
        .otherwise(F.concat("lang", F.lit(".csv")))
    )


def mixed_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as HTML files and documents as CSV, plain, damaged or empty files."""
    pages = document_columns(table(spark, sf_dir, "pages"), "page_id", "html", F.lit("page.html"))
    docs = table(spark, sf_dir, "documents").withColumns(
        {"_content": mixed_content(), "_ordinal": F.col("doc_id") + DOCUMENT_OFFSET}
    )
    return pages.unionByName(document_columns(docs, "_ordinal", "_content", mixed_name()))


def _lines(text: str = "text") -> Column:
    """The lines that hold letters, each as ``_as_markup`` has it; the text is passed over as a whole."""
    clean = F.regexp_replace(text, r"[ \t\x0B\f\r](?:[ \t\x0B\f\r]++|(?<=[\t\x0B\f\r]))", " ")
    clean = F.regexp_replace(F.concat(F.lit("\n"), clean), r"\n[^\p{L}]*+", "\n")
    for char, name in _REFERENCES:
        clean = F.array_join(F.split(clean, char), name)
    return F.filter(F.transform(F.split(clean, "\n"), lambda line: F.rtrim(line)), lambda line: line != "")


def illustrated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as HTML, a paragraph for each line; behind some lines is an image that
    holds the line, behind others one whose data is damaged. Even ones ask for assets."""
    lines = F.filter(F.split("text", "\n"), lambda line: _as_markup(line) != "")

    def paragraph(line: Column, i: Column) -> Column:
        text = F.concat(F.lit("<p>"), _as_markup(line), F.lit("</p>"))
        image = F.concat(F.lit('<img alt=f src="data:image/png;base64,'), F.base64(line.cast("binary")), F.lit('">'))
        damaged = F.lit("<img src='data:image/png;base64,!'>")
        return F.concat(text, F.when(i % 3 == 0, image).when(i % 5 == 4, damaged).otherwise(F.lit("")))

    html = F.concat(
        F.lit("<html><h1>"), F.col("source"), F.lit("</h1>"),
        F.array_join(F.transform(lines, paragraph), ""), F.lit("</html>"),
    )
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id").withColumn("_html", html)
    opts = options(include_assets=F.col("doc_id") % 2 == 0)
    return document_columns(docs, "doc_id", "_html", F.lit("doc.html"), opts)


def paged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as HTML of pages of three lines between a header and a footer. Each
    line begins with letters of its own. A third asks for headers and footers."""

    def paragraph(text: Column) -> Column:
        return F.concat(F.lit("<p>"), text, F.lit("</p>"))

    def told_apart(line: Column, i: Column) -> Column:
        return F.concat(F.translate(i.cast("string"), "0123456789", "abcdefghij"), F.lit(" "), line)

    n = F.size("_lines")
    pages = F.ceil(n / 3).cast("int")

    def page(k: Column) -> Column:
        body = F.transform(F.slice("_lines", k * 3 - 2, 3), paragraph)
        header = paragraph(F.concat("source", F.lit(" report")))
        footer = paragraph(F.concat(F.lit("Page "), k.cast("string"), F.lit(" of "), pages.cast("string")))
        return F.concat(header, F.array_join(body, ""), footer)

    text = F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), pages), page), "\f")).otherwise("")
    docs = (
        spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id")
        .withColumn("_lines", F.transform(_lines(), told_apart))
        .withColumn("_html", F.concat(F.lit("<html>"), text, F.lit("</html>")))
    )
    asked = options(headers_footers=F.when(F.col("doc_id") % 3 < 2, F.col("doc_id") % 3 == 0))
    return document_columns(docs, "doc_id", "_html", F.lit("doc.html"), asked)


def structured_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Markdown: lines become nested headings, text and images."""

    def block(line: Column, i: Column) -> Column:
        level = F.pmod(F.length(line) + i, F.lit(4)).cast("int") + 1
        return (
            F.when(i % 4 == 0, F.concat(F.repeat(F.lit("#"), level), F.lit(" "), line))
            .when(i % 5 == 2, F.concat(line, F.lit(" ![fig](img-"), i.cast("string"), F.lit(".png)")))
            .when(i % 7 == 3, F.concat(F.lit("![]("), i.cast("string"), F.lit(".jpg)")))
            .otherwise(line)
        )

    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.array_join(F.transform(F.split("text", "\n"), block), "\n\n").alias("markdown"),
    )


# --- logs derived from documents ---------------------------------------------


def _result_assets() -> Column:
    lines = F.split("text", "\n")

    def asset(line: Column, i: Column) -> Column:
        truncated = i % 5 == 4
        place = F.transform(
            F.sequence(F.lit(1), F.greatest(i % 3, F.lit(1))),
            lambda j: F.struct(
                F.array("lang", "source").alias("heading_path"),
                (i + j).cast("long").alias("block_index"),
                line.alias("context_before"),
                F.when(j == 1, F.concat(F.lit("figure "), i.cast("string")))
                .otherwise(" ")
                .alias("context_after"),
            ),
        )
        return F.struct(
            i.cast("long").alias("id"),
            F.when(i % 3 == 2, "application/octet-stream").otherwise("image/png").alias("media_type"),
            F.concat(F.lit("word/media/image"), i.cast("string")).alias("origin_part"),
            F.octet_length(line).cast("long").alias("size"),
            truncated.alias("truncated"),
            F.when(~truncated, line.cast("binary")).alias("data_b64"),
            F.when(i % 3 != 0, place).alias("placements"),
            F.when(i % 4 == 0, True).when(i % 4 == 1, False).alias("floating"),
        )

    return F.transform(lines, asset).cast(schemas.RESULT["assets"].dataType)


def _result_headers_footers() -> Column:
    def entry(kind: str, text: Column, **more: Column) -> Column:
        fields = {"kind": F.lit(kind), "text": text, **more}
        return F.struct(
            *[
                fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schemas.HEADER_FOOTER.fields
            ]
        )

    image = F.struct(
        F.lit("word/media/logo.png").alias("origin_part"),
        F.lit("image/png").alias("media_type"),
        F.col("source").alias("alt"),
        F.octet_length("source").cast("long").alias("size"),
        F.col("source").cast("binary").alias("data_b64"),
        F.lit(None).cast("boolean").alias("truncated"),
    )
    return F.array(
        entry("header", F.col("source"), scope=F.lit("default"), sections=F.array(F.lit(0), F.lit(1))),
        entry("header", F.col("source"), location=F.lit("image"), image=image),
        entry("footer", F.lit("  ")),
        entry("footer", F.concat(F.lit("Page 1 of "), F.col("n_chars").cast("string")), scope=F.lit("all"),
              location=F.lit("bottom"), pages_seen=F.col("n_chars"), page_frequency=F.lit(1.0),
              page_number=F.lit(True), source=F.lit("pdf")),
        entry("footer", F.col("lang")),
    )


def conversion_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A successful conversion of every document, as the service answers it.

    Of ten bodies, one is cut off, one has neither lists nor a cache flag.
    """
    n = F.col("doc_id")
    bare = n % 10 == 8
    body = F.to_json(
        F.struct(
            F.col("text").alias("markdown"),
            F.lit("docx").alias("format"),
            (F.col("n_chars") / 4).alias("elapsed_ms"),
            F.octet_length("text").cast("long").alias("input_bytes"),
            F.when(~bare, _result_assets()).alias("assets"),
            F.when(~bare, n % 4 == 0).alias("cache_hit"),
            F.when(~bare, _result_headers_footers()).alias("headers_footers"),
            F.when(n % 2 == 0, n).alias("headers_footers_stripped"),
            F.lit("ignored").alias("added_later"),
        )
    )
    cut_off = F.substring(body, F.lit(1), F.length(body) - 1)
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("r"), n.cast("string")).alias("request_id"),
        F.lit("convert").alias("endpoint"),
        F.lit(200).cast("long").alias("raw_status"),
        F.when(n % 10 == 9, cut_off).otherwise(body).alias("body"),
    )


def render_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rendering of every document, one page per line; some bodies have no list,
    some are cut off."""
    lines = F.split("text", "\n")

    def page(line: Column, i: Column) -> Column:
        return F.struct(
            i.cast("long").alias("page"),
            F.length(line).cast("long").alias("width"),
            (i * 2).cast("long").alias("height"),
            F.when(i % 2 == 0, "image/png").otherwise("image/jpeg").alias("media_type"),
            line.cast("binary").alias("data_b64"),
        )

    n = F.col("doc_id")
    body = F.to_json(
        F.struct(
            F.size(lines).cast("long").alias("total_pages"),
            F.size(lines).cast("long").alias("rendered"),
            F.lit(1.5).alias("scale"),
            F.when(n % 9 != 0, F.transform(lines, page)).alias("pages"),
            F.octet_length("text").cast("long").alias("input_bytes"),
            F.lit(12.5).alias("elapsed_ms"),
        )
    )
    cut_off = F.when(n % 18 == 0, F.substring(body, 1, 20)).otherwise(body)
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("r"), n.cast("string")).alias("request_id"),
        F.lit("render").alias("endpoint"),
        F.lit(200).cast("long").alias("raw_status"),
        cut_off.alias("body"),
    )


# --- logs derived from events ------------------------------------------------

STATUSES = [200, 202, 401, 404, 413, 415, 422, 429, 500, 503, 504, 422, 200, None, None, 418]


def response_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a response: all endpoints, statuses and client faults."""
    n = F.col("event_id")
    case = F.pmod(F.floor(n / 4), F.lit(16))
    status = kind_of(case, STATUSES).cast("long")
    event = F.when(case == 13, kind_of(n, ["client_timeout", "circuit_open"])).when(
        case == 14, kind_of(n, ["network", "interrupted"])
    )
    success = F.to_json(
        F.struct(
            F.col("event_type").alias("markdown"),
            F.lit("csv").alias("format"),
            F.col("value").alias("elapsed_ms"),
            n.alias("input_bytes"),
            F.concat(F.lit("j-"), n.cast("string")).alias("job_id"),
            F.lit("queued").alias("status"),
            n.alias("total_pages"),
        )
    )
    code = F.when(case == 11, F.lit("encrypted")).otherwise(F.col("event_type"))
    reason = F.when(n % 3 == 0, F.lit(" ")).otherwise(F.concat(F.lit("why "), "event_type"))
    failure = F.when(n % 7 == 0, F.lit('{"detail":"text"}')).otherwise(
        F.to_json(F.struct(F.struct(code.alias("code"), reason.alias("reason")).alias("detail")))
    )
    body = (
        F.when(case == 12, F.lit('{"markdown": '))
        .when(status.isin(200, 202), success)
        .when(status.isNotNull() & (n % 11 == 0), F.lit("<html>not json</html>"))
        .when(status.isNotNull(), failure)
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), n.cast("string")).alias("request_id"),
        kind_of(n, ["convert", "submit", "job_status", "render"]).alias("endpoint"),
        (n % 3 + 1).alias("attempt_no"),
        F.col("ts").cast("string").alias("ts"),
        status.alias("raw_status"),
        event.alias("client_event"),
        kind_of(n, ["3", " 3 ", "Wed, 21", None, "-1", "1.5", "99999999999"]).alias("retry_after"),
        body.alias("body"),
    )


JOB_CODES = [
    "unsupported", "encrypted", "malformed", "missing_part", "resource_limit", "timeout",
    "server_shutting_down", "overloaded", "rate_limited", None, "engine_crash",
]


def job_events(events: DataFrame) -> DataFrame:
    """A job is one user's day; the event type tells its state."""
    n = F.col("event_id")
    status = (
        F.when(F.col("event_type") == "signup", "queued")
        .when(F.col("event_type") == "purchase", "succeeded")
        .when(F.col("event_type") == "error", "failed")
        .otherwise("running")
    )
    failed = F.col("event_type") == "error"
    return events.select(
        F.concat_ws(":", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("job_id"),
        F.col("ts"),
        status.alias("status"),
        F.lit("docx").alias("format"),
        (F.col("event_type") == "purchase").alias("cache_hit"),
        F.when(failed, kind_of(n, JOB_CODES)).alias("error_code"),
        F.when(failed & (n % 2 == 0), F.concat(F.lit("reason "), n.cast("string"))).alias("error_reason"),
        F.when(failed, n % 2 == 0).alias("retryable"),
        n.alias("event_id"),
    )


def job_log(events: DataFrame) -> DataFrame:
    """The same jobs as submissions and status answers, as the service sends them."""
    state = job_events(events)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ticket = F.to_json(F.struct("job_id", "status", F.when(F.col("event_id") % 3 == 0, True).alias("cache_hit")))
    failed = F.col("status") == "failed"
    answer = F.to_json(
        F.struct(
            "job_id",
            "status",
            "format",
            stamp.alias("created_at"),
            F.when(F.col("status") != "queued", stamp).alias("started_at"),
            F.when(failed, F.lit("not a time")).alias("finished_at"),
            F.when(
                F.col("status") == "succeeded",
                F.struct(F.col("job_id").alias("markdown"), (F.col("event_id") % 2 == 0).alias("cache_hit")),
            ).alias("result"),
            F.when(
                failed,
                F.struct(
                    F.col("error_code").alias("code"),
                    F.col("error_reason").alias("reason"),
                    F.col("retryable").alias("retryable"),
                ),
            ).alias("error"),
        )
    )
    submitted = F.col("status") == "queued"
    return state.select(
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("request_id"),
        F.when(submitted, "submit").otherwise("job_status").alias("endpoint"),
        F.when(submitted, 202).otherwise(200).cast("long").alias("raw_status"),
        F.col("ts").cast("string").alias("ts"),
        F.when(F.col("event_id") % 13 == 0, F.lit("{cut")).when(submitted, ticket).otherwise(answer).alias("body"),
    )


def attempts(events: DataFrame) -> DataFrame:
    """Four consecutive events are the tries of one request."""
    kind = F.col("event_type")
    return events.select(
        F.floor(F.col("event_id") / 4).alias("request_id"),
        (F.col("event_id") % 4 + 1).alias("attempt_no"),
        F.when(kind == "error", "unavailable")
        .when(kind == "signup", "unsupported")
        .otherwise("success")
        .alias("class"),
        (kind == "error").alias("retryable"),
    )


def failures(events: DataFrame) -> DataFrame:
    """Errors as overload failures, all others as rejections, which are not tried again."""
    n = F.col("event_id")
    return events.select(
        n.alias("request_id"),
        (n % 4 + 1).alias("attempt_no"),
        (F.col("event_type") == "error").alias("retryable"),
        kind_of(n, [None, -1, 0, 1, 3]).cast("long").alias("retry_after_s"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("failed_at_ms"),
    )


def calls(events: DataFrame) -> DataFrame:
    """Each user is a client; errors are service failures, signups rejections."""
    kind = F.col("event_type")
    return events.select(
        F.col("user_id").alias("client_id"),
        "ts",
        F.col("event_id").alias("call_id"),
        F.when(kind == "error", "service_failure")
        .when(kind == "signup", "business_rejection")
        .otherwise("success")
        .alias("outcome"),
    )


def timed_calls(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("class"),
        F.round(F.col("value") * 100).cast("long").alias("elapsed_ms"),
        "ts",
    )
