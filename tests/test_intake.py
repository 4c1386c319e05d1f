import io
import zipfile

import pytest
from pyspark.sql import functions as F

from docmill import rules
from docmill.functions.options import options, variant_fingerprint
from docmill.functions.text import is_blank
from docmill.operators import intake
from docmill.sources.documents import read_documents


def zipped(*names, data=b"text", comment=b"", packed=False):
    out = io.BytesIO()
    kind = zipfile.ZIP_DEFLATED if packed else zipfile.ZIP_STORED
    with zipfile.ZipFile(out, "w", kind) as archive:
        for name in names:
            archive.writestr(name, data)
        archive.comment = comment
    return out.getvalue()


def docs(spark, rows):
    """rows of (ordinal, content, filename, request_id)"""
    return spark.createDataFrame(
        rows, "input_ordinal long, content binary, filename string, request_id string"
    ).withColumn("options", options())


@pytest.mark.parametrize(
    "text,blank",
    [(None, True), ("", True), (" \t\n", True), ("　", True), (" ", False), (" x ", False)],
)
def test_blank(spark, text, blank):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(is_blank(F.col("t"))).first()[0] is blank


def test_names_and_request_ids(spark):
    rows = [
        (0, b"x", None, None),
        (1, b"x", "  ", " r-1 "),
        (2, b"x", " report.docx\t", ""),
        (3, b"x", 'a"b\r\nc.csv', "r-3"),
    ]
    got = intake.normalise_documents(docs(spark, rows)).orderBy("input_ordinal").collect()
    assert [r["filename"] for r in got] == [
        rules.DEFAULT_FILENAME,
        rules.DEFAULT_FILENAME,
        "report.docx",
        'a"b\r\nc.csv',
    ]
    assert got[3]["safe_filename"] == "a_b__c.csv"
    assert [r["request_id"] for r in got[1::2]] == ["r-1", "r-3"]
    assert len({r["request_id"] for r in got}) == 4 and len(got[0]["request_id"]) == 32


def test_request_ids_are_the_same_on_a_rerun(spark):
    df = docs(spark, [(7, b"x", None, None)])
    ids = [intake.normalise_documents(df).first()["request_id"] for _ in range(2)]
    assert ids[0] == ids[1]


def test_gates(spark):
    df = docs(spark, [(0, b"", "a", None), (1, None, "a", None), (2, b"12345", "a", None), (3, b"123", "a", None)])
    got = {r["input_ordinal"]: r["class"] for r in intake.gate(df, max_bytes=4).collect()}
    assert got == {0: "invalid_input", 1: "invalid_input", 2: "too_large", 3: None}
    assert intake.reject_empty(df).count() == 2
    row = intake.size_gate(df, 4).filter("class = 'too_large'").first()
    assert (row["http_status"], row["retryable"]) == (413, False)


def test_fingerprint_is_lower_case_hex(spark):
    got = intake.fingerprint(docs(spark, [(0, b"some bytes", "a", None)])).first()["content_sha256"]
    import hashlib

    assert got == hashlib.sha256(b"some bytes").hexdigest()


@pytest.mark.parametrize(
    "given,text",
    [
        ({}, ""),
        ({"timeout_seconds": 600}, "t=600"),
        ({"use_cache": False, "pages": " 0-2 "}, ";c=false;p=0-2"),
        ({"pages": "  ", "max_pages": 0, "headers_footers": False}, ";mp=0;hf=false"),
        ({"timeout_seconds": 1, "max_pages": 50}, "t=1;mp=50"),
    ],
)
def test_option_fingerprint(spark, given, text):
    assert spark.range(1).select(variant_fingerprint(options(**given))).first()[0] == text


def test_request_id_is_not_in_the_key(spark):
    df = docs(spark, [(0, b"x", "a.csv", "r1"), (1, b"x", "a.csv", "r2"), (2, b"x", "b.csv", "r3")])
    keys = [r["variant_key"] for r in intake.variant_key(df).orderBy("input_ordinal").collect()]
    assert keys[0] == keys[1] != keys[2]
    assert keys[0].endswith(":a.csv:false:")


@pytest.mark.parametrize(
    "content,name,fmt,source",
    [
        (b"%PDF-1.4", "x.docx", "pdf", "content"),
        (b"{\\rtf1", "x", "rtf", "content"),
        (zipped("word/document.xml"), "x.zip", "docx", "content"),
        (zipped("[Content_Types].xml", "xl/workbook.xml", comment=b"made by hand"), "x", "xlsx", "content"),
        (zipped("ppt/presentation.xml", packed=True), "x.docx", "pptx", "content"),
        (zipped("mimetype", data=b"application/epub+zip"), "x", "epub", "content"),
        (zipped("mimetype", "content.xml", data=b"application/vnd.oasis.opendocument.text"), "x", "odt", "content"),
        (zipped("word/embeddings/a.xlsx", "word/document.xml", data=zipped("xl/workbook.xml")), "x", "docx", "content"),
        (zipped("xl/embeddings/a.docx", "xl/workbook.xml", data=zipped("word/document.xml")), "x", "xlsx", "content"),
        (zipped("a.docx", data=zipped("word/document.xml")), "x.bin", None, "unknown"),
        (zipped("my/word/document.xml", "word/document.xml.bak"), "x.bin", None, "unknown"),
        (zipped("word/document.xml", comment=b"PK\x05\x06 in a comment"), "x.bin", None, "unknown"),
        (zipped("word/document.xml")[:-30], "x.docx", "docx", "extension"),
        (b"PK\x03\x04..word/document.xml..", "x.bin", None, "unknown"),
        (b"PK\x03\x04", "x.bin", None, "unknown"),
        (b"PK\x03\x04" + b"PK\x05\x06" + b"\xff" * 18, "x.bin", None, "unknown"),
        (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1..", "x.xls", "xls", "content"),
        (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1..", "x.csv", "doc", "content"),
        (b"\n <!doctype HTML><p>", "x.csv", "html", "content"),
        (b"a,b\n", "budget.CSV", "csv", "extension"),
        (b"\x89PNG\r\n\x1a\n\x00\x00", "picture.docx", "docx", "extension"),
        (b"text", "readme", None, "unknown"),
    ],
)
def test_sniffing(spark, content, name, fmt, source):
    row = intake.sniff_format(docs(spark, [(0, content, name, None)])).first()
    assert (row["format"], row["format_source"]) == (fmt, source)


def test_files_over_the_limit_come_without_content(spark, tmp_path):
    (tmp_path / "small.csv").write_bytes(b"a,b\n")
    (tmp_path / "large.csv").write_bytes(b"x" * 100)
    (tmp_path / "other.txt").write_bytes(b"t")
    df = read_documents(spark, str(tmp_path), "*.csv", max_bytes=10)
    got = {r["filename"]: (r["size_bytes"], r["content"]) for r in df.collect()}
    assert got["small.csv"] == (4, bytearray(b"a,b\n"))
    assert got["large.csv"] == (100, None)
    assert len(got) == 2
    plan = df.select("filename", "size_bytes")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,10)" in plan and "content" not in plan.split("ReadSchema")[1]
