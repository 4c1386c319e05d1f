import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docmill.functions.pagespec import in_spec, parse_spec
from docmill.operators import pages, sections


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "source string, doc_id long, text string")


def test_repeated_lines(spark):
    rows = [("d", n, f"ACME  Corp\nbody {'abc'[n]}\nPage {n} of 3") for n in range(3)] + [("e", 9, "ACME Corp\nother")]
    got = {r["normalised"]: r for r in pages.detect_repeated_lines(pages_of(spark, rows), 2).collect()}
    assert set(got) == {"ACME Corp", "Page # of #"}
    acme, number = got["ACME Corp"], got["Page # of #"]
    assert (acme["pages_seen"], acme["page_frequency"], acme["text"], acme["kind"]) == (3, 1.0, "ACME  Corp", "header")
    assert (number["page_number"], number["kind"], number["text"]) == (True, "footer", "Page 0 of 3")
    assert not acme["page_number"]


def test_stripping_keeps_blank_lines_and_empty_pages(spark):
    rows = [("d", 0, "H\n\nbody\n\nH"), ("d", 1, "H"), ("d", 2, "other"), ("d", 3, ""), ("d", 4, None), ("e", 5, "H")]
    df = pages_of(spark, rows)
    found = pages.detect_repeated_lines(df, 2)
    got = {r["doc_id"]: (r["stripped_text"], r["lines_stripped"]) for r in pages.strip_repeated_lines(df, found).collect()}
    assert got == {
        0: ("\nbody\n", 2), 1: ("", 1), 2: ("other", None), 3: ("", None), 4: (None, None), 5: ("H", None)
    }


@pytest.mark.parametrize("salts", [1, 5, 256])
def test_repeated_lines_against_brute_force(spark, salts):
    rng = random.Random(3)
    rows = []
    for n in range(200):
        lines = ["hot line"] + [f"{rng.choice('ab')} {rng.randint(0, 9)}" for _ in range(3)] + [f"only {'x' * n}"]
        rng.shuffle(lines)
        rows.append((f"s{n % 3 if n % 2 else 0}", n, "\n".join(lines)))
    df = pages_of(spark, rows)
    seen, wording = defaultdict(set), defaultdict(Counter)
    for source, n, text in rows:
        for line in text.split("\n"):
            key = (source, "".join("#" if c.isdigit() else c for c in line))
            seen[key].add(n)
            wording[key][line] += 1
    want = {
        key: (len(on), min(wording[key].items(), key=lambda kv: (-kv[1], kv[0]))[0])
        for key, on in seen.items()
        if len(on) >= 4
    }
    found = pages.detect_repeated_lines(df, 4, salts=salts)
    got = {(r["source"], r["normalised"]): (r["pages_seen"], r["text"]) for r in found.collect()}
    assert got == want
    stripped = {r["doc_id"]: r["stripped_text"] for r in pages.strip_repeated_lines(df, found, salts=salts).collect()}
    for source, n, text in rows:
        kept = [l for l in text.split("\n") if (source, "".join("#" if c.isdigit() else c for c in l)) not in want]
        assert stripped[n] == "\n".join(kept)


SPECS = [
    ("0,2", {0, 2}), ("1-3", {1, 2, 3}), ("0, 2-4 ,7", {0, 2, 3, 4, 7}), ("3-1", set()), ("x,5", {5}),
    ("2-", set()), ("-2", set()), (" ", set(range(10))), ("5-999999999999", set(range(5, 10))), ("", set(range(10))),
]


@pytest.mark.parametrize("spec,wanted", SPECS)
def test_page_specs(spark, spec, wanted):
    df = spark.range(10).select(F.col("id").alias("page_no"), F.lit(spec).alias("spec"))
    assert {r["page_no"] for r in pages.select_pages(df, spec).collect()} == wanted
    assert {r["page_no"] for r in df.filter(in_spec(F.col("page_no"), F.col("spec"))).collect()} == wanted


def test_no_spec_means_all_pages(spark):
    df = spark.range(3).withColumnRenamed("id", "page_no")
    assert pages.select_pages(df, None).count() == 3
    assert parse_spec("0,2-4,9-7") == [(0, 0), (2, 4)]


def test_a_fixed_spec_reaches_the_scan(spark, sf_dir):
    df = pages.select_pages(spark.read.parquet(f"{sf_dir}/documents.parquet"), "3-9", "doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,3)" in plan and "LessThanOrEqual(doc_id,9)" in plan


def test_page_cap(spark):
    df = spark.range(1200).select(F.lit("d").alias("doc"), F.col("id").alias("page_no"), F.lit("pdf").alias("format"))
    paged = df.withColumn("format", F.lit("pdf"))
    assert pages.cap_pages(paged).agg(F.count("*"), F.max("page_no")).first() == (500, 499)
    assert pages.cap_pages(paged, 0).count() == 1200
    assert pages.cap_pages(paged, 3).count() == 3
    assert pages.cap_pages(df.withColumn("format", F.lit(None).cast("string")), 3).count() == 1200
    mixed = df.withColumn("format", F.when(F.col("page_no") % 2 == 0, "pdf").otherwise("docx"))
    assert pages.cap_pages(mixed, 10, fmt="format").count() == 610
    many = paged.withColumn("doc", F.col("page_no") % 7)
    plan = pages.cap_pages(many, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


MARKDOWN = "\n\n".join(
    ["intro", "# A", "text a", "## B", "### C", "deep", "## D", "d text ![x](d.png) tail", "# E", "![](e.png)", "", "end"]
)


def test_heading_chain(spark):
    df = spark.createDataFrame([(1, MARKDOWN), (2, "## only\n\nx")], "doc_id long, markdown string")
    got = sections.markdown_blocks(df).orderBy("doc_id", "block_index").collect()
    assert [r["heading_path"] for r in got if r["doc_id"] == 1] == [
        "", "A", "A", "A > B", "A > B > C", "A > B > C", "A > D", "A > D", "E", "E", "E"
    ]
    assert [r["heading_level"] for r in got if r["doc_id"] == 2] == [2, 0]
    summary = {r["heading_path"]: r["blocks"] for r in sections.section_summary(sections.markdown_blocks(df.filter("doc_id = 1"))).collect()}
    assert summary == {"": 1, "A": 2, "A > B": 1, "A > B > C": 2, "A > D": 2, "E": 3}


def test_image_placements(spark):
    df = spark.createDataFrame([(1, MARKDOWN), (2, "no image")], "doc_id long, markdown string")
    got = sections.image_placements(df).orderBy("block_index").collect()
    assert [(r["target"], r["heading_path"], r["context_before"], r["context_after"]) for r in got] == [
        ("d.png", "A > D", "d text", "tail"),
        ("e.png", "E", "# E", "end"),
    ]
