import pytest
from pyspark.sql import functions as F

from docmill.functions import html as convert_html
from docmill.functions.options import options
from docmill.operators import convert, intake, reuse
from docmill.plans.batch import convert_batch


def html(spark, text):
    return convert.html_to_markdown(spark.createDataFrame([(text,)], "html string")).first()["markdown"]


def csv(spark, text):
    return convert.csv_to_markdown(spark.createDataFrame([(text,)], "content string")).first()["markdown"]


@pytest.mark.parametrize(
    "source,markdown",
    [
        ("<h1>A</h1><p>x</p><h3 class='k'> B </h3>y", "# A\n\nx\n\n### B\n\ny"),
        ("<ul><li>one</li><li>two</li></ul>", "- one\n- two"),
        ("<p>a<br>b<br/>c</p>", "a\nb\nc"),
        ("<b>bo</b> <em>it</em> <strong><i>both</i></strong>", "**bo** *it* ***both***"),
        ('<a class=x href="/u">t</a>', "[t](/u)"),
        ('<img alt="A" src="i.png"><img src="j.png">', "![A](i.png)![](j.png)"),
        ("<script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> -->yes", "yes"),
        ("<head><title>no</title></head><header>yes</header>", "yes"),
        ("&lt;b&gt; &amp;amp; &quot;q&quot;&nbsp;&#39;", "<b> &amp; \"q\" '"),
        ("a < b and c > d", "a < b and c > d"),
        ("<ol><li>one<li>two</ol><ul><li>x</ul>", "1. one\n2. two\n\n- x"),
        ("<a title='t' href=/u>see <span>this</span></a>", "[see this](/u)"),
        ("<img src=i.png alt='an eye'>", "![an eye](i.png)"),
        ("<pre>if x:\n    y &lt; 1</pre>", "```\nif x:\n    y < 1\n```"),
        ("use <code>f(x)</code>", "use `f(x)`"),
        ("<blockquote>said</blockquote>", "> said"),
        ("&eacute; &#233; &#x27; &nosuch; &#0; AT&T &amp;lt;", "é é ' &nosuch; &#0; AT&T &lt;"),
        ("<p># not a heading</p><p>- no item</p>", "\\# not a heading\n\n\\- no item"),
        ("<script>never closed", ""),
        ("<p> \n </p>", ""),
        (None, None),
    ],
)
def test_html(spark, source, markdown):
    assert html(spark, source) == markdown


@pytest.mark.parametrize(
    "source,markdown",
    [
        ("<ul><li>a<ul><li>b</li><li>c</li></ul></li><li>d</li></ul>", "- a\n  - b\n  - c\n- d"),
        ("<ol><li>a<ul><li>b<ol><li>c</ol></ul><li>d</ol>", "1. a\n   - b\n     1. c\n2. d"),
        ("<ul><li>a<ul><li>b</ul>tail<li>c</ul>end", "- a\n  - b\n  tail\n- c\n\nend"),
        ("<ul><li>a<ul><li>b</ul> <ol><li>c</ol></ul>", "- a\n  - b\n  1. c"),
        ("<ul><li><p>a</p><li> <p>b</p> </ul><ul><li>c</ul>", "- a\n- b\n\n- c"),
        ("<ol>" + "<li>x" * 10 + "<ul><li>deep</ul></ol>", "\n".join(f"{n}. x" for n in range(1, 11)) + "\n    - deep"),
        ("<ul><li>a<ul><li>never closed", "- a\n  - never closed"),
        (
            "<table><tr><th>a<th>b<tr><td><table><tr><td>1<td>x|y<tr><td>3</table>after<td>c</table>z",
            "| a | b |\n| --- | --- |\n| 1 x\\|y<br>3<br>after | c |\n\nz",
        ),
        (
            "<table><tr><td>p<table><tr><td>q<table><tr><td>r</table></table></td></tr><tr><td>s</table>",
            "| p<br>q<br>r |\n| --- |\n| s |",
        ),
        ("<table><tr><td><ul><li>i<li>j</ul></table>", "| i<br>j |\n| --- |"),
        ("one\ftwo<div style='page-break-before: always'>three</div>", "one\n\ntwo\n\nthree"),
    ],
)
def test_nested_html_and_pages(spark, source, markdown):
    assert html(spark, source) == markdown


def test_nesting_of_any_depth_keeps_all_text(spark):
    for n in (3, 9, 200):
        got = html(spark, "".join(f"<ul><li>i{k}." for k in range(n)) + "</ul>" * n)
        assert [f"i{k}." in got for k in range(n)] == [True] * n
        got = html(spark, "".join(f"<table><tr><td>i{k}." for k in range(n)) + "</table>" * n)
        assert [f"i{k}." in got for k in range(n)] == [True] * n


LONG = "words that no pattern looks into"


@pytest.mark.parametrize(
    "source,markdown",
    [
        (f"<p>{LONG}</p><pre>{LONG}  and\n  {LONG}</pre>", f"{LONG}\n\n```\n{LONG}  and\n  {LONG}\n```"),
        (f"<p>{LONG} \n {LONG}</p><p># {LONG}</p>", f"{LONG} {LONG}\n\n\\# {LONG}"),
        (f"<a href=/u title='{LONG}'>{LONG}</a><ul><li>{LONG}<ol><li>{LONG}</ol></ul>",
         f"[{LONG}](/u)\n\n- {LONG}\n  1. {LONG}"),
        (f"<table><tr><td>{LONG}|{LONG}<tr><td>{LONG}<br>{LONG}</table>",
         f"| {LONG}\\|{LONG} |\n| --- |\n| {LONG}<br>{LONG} |"),
        (f"{LONG}\u0005{LONG}&#5;{LONG}&lt;{LONG}", f"{LONG}\u0005{LONG}\u0005{LONG}<{LONG}"),
        (f"{LONG}\u2028# {LONG}", f"{LONG}\u2028\\# {LONG}"),
        (f"<p>\u00013 {LONG}</p>", f"### {LONG}"),
        # what is dropped behind a "<" that is not closed makes a tag of the text
        (f"x <img <!-- > {LONG} -->src=i.png alt='{LONG}'> y", f"x ![{LONG}](i.png) y"),
        (f"<img src=i.png>](data:x;base64,{LONG})", f"![](i.png)](data:x;base64,{LONG.replace(' ', '')})"),
        (f"<!-- a > {LONG} --><script>a > {LONG}</script>{LONG}", LONG),
    ],
)
def test_words_stay_where_they_were(spark, source, markdown):
    assert html(spark, source) == markdown


def test_patterns_pass_over_few_words(spark):
    """Runs of words are taken out once; the patterns see numbers for them."""
    source = "".join(f"<ul><li>{LONG}, {LONG} &amp; {LONG}</ul><p title='{LONG}'>{LONG}</p>" for _ in range(50))
    df = spark.createDataFrame([(source,)], "html string").select(convert_html._runs(F.col("html"), F.lit(True)).alias("r"))
    seen = df.select(convert_html._numbered(F.col("r")).alias("t"), F.size("r").alias("n")).first()
    assert seen["n"] == 2 * 150 + 1
    assert seen["t"].count("words") == 50 and len(seen["t"]) < len(source) / 2


def test_html_table(spark):
    source = (
        "<p>before</p><table border=1><thead><tr><th>a</th><th> b </th></tr></thead>"
        "<tr><td>1</td><td>2</td></tr>\n<tr> <td>3</td> <td>4</td> </tr></table><p>after</p>"
    )
    assert html(spark, source) == (
        "before\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n| 3 | 4 |\n\nafter"
    )


@pytest.mark.parametrize(
    "source,markdown",
    [
        ("fruit,Größe\nplum,3\nquince,9\n", "| fruit | Größe |\n| --- | --- |\n| plum | 3 |\n| quince | 9 |"),
        ('a,"b ""q"" | x\ny",c\r\n1,2,3\r\n', '| a | b "q" \\| x<br>y | c |\n| --- | --- | --- |\n| 1 | 2 | 3 |'),
        (",x\n1,2", "|  | x |\n| --- | --- |\n| 1 | 2 |"),
        ("a\n1,2,3", "| a |  |  |\n| --- | --- | --- |\n| 1 | 2 | 3 |"),
        ('a,b\n"never closed,2', '| a | b |\n| --- | --- |\n| "never closed | 2 |'),
        ('a\n"x" tail', "| a |\n| --- |\n| x tail |"),
        ("one", "| one |\n| --- |"),
        ("﻿a,b", "| a | b |\n| --- | --- |"),
        ("", ""),
        (None, None),
    ],
)
def test_csv(spark, source, markdown):
    assert csv(spark, source) == markdown


def test_cells_without_end_tags_and_with_breaks(spark):
    source = "<table><tr><th>x|y<th>z<tr><td><p>a</p><p>b</p><td>c<br>d</table>"
    assert html(spark, source) == "| x\\|y | z |\n| --- | --- |\n| a<br>b | c<br>d |"


@pytest.mark.parametrize(
    "piece", ["<a ", "<img ", "<a href=", "<i>", "<h1 ", "<!--", "<table ", "<li>", "&", "<a href=x>", "<pre>", " \n", "<ul><li>",
     "<ol>", "<table><tr><td>", "</ul>", "<ul><li>x</ul>", "<div style=break-before"]
)
def test_time_is_linear(spark, piece):
    import time

    html(spark, "<p>warm</p>")
    start = time.perf_counter()
    html(spark, piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 5


def test_long_texts_do_not_exhaust_the_stack(spark):
    field = "x" + '""y' * 200_000
    assert len(csv(spark, f'a,b\n1,"{field}"\n')) > 400_000
    assert len(html(spark, "<p>" + "word <b>x</b> &amp; <br>" * 100_000)) > 1_000_000


def test_conversion_has_no_python_step(spark):
    df = spark.createDataFrame([("x", "html")], "content string, format string")
    plan = convert.to_markdown(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_empty_result_goes_to_fallback(spark):
    df = spark.createDataFrame([("",), ("　\n",), (None,), ("x",)], "markdown string")
    assert [r["route"] for r in convert.empty_result_gate(df).collect()] == ["fallback"] * 3 + ["ok"]


def corpus(spark, rows):
    return spark.createDataFrame(
        rows, "input_ordinal long, content binary, filename string, request_id string"
    ).withColumn("options", options())


def test_batch_gives_one_outcome_each_and_isolates_failures(spark):
    rows = [
        (0, b"a,b\n1,2", "a.csv", None),
        (1, b"\x89PNG\r\n\x1a\n", "picture.docx", "r-1"),
        (2, b"a,b\n1,2", "a.csv", "r-2"),
        (3, b"", "e.csv", None),
        (4, b"plain", "notes.txt", None),
        (5, b"<html><body><p> </p></body></html>", "blank.html", None),
        (6, b"x" * 50, "big.csv", None),
    ]
    out = {r["input_ordinal"]: r for r in convert_batch(corpus(spark, rows), max_bytes=40).collect()}
    assert sorted(out) == list(range(7))
    assert {n: r["class"] for n, r in out.items()} == {
        0: "success", 1: "corrupted", 2: "success", 3: "invalid_input", 4: "unsupported",
        5: "success", 6: "too_large",
    }
    assert {n: r["route"] for n, r in out.items()} == {
        0: "ok", 1: "dead_letter_alert", 2: "ok", 3: "reject", 4: "dead_letter_review",
        5: "fallback", 6: "reject",
    }
    assert out[0]["result"]["markdown"] == out[2]["result"]["markdown"]
    assert [out[n]["shared"] for n in (0, 2)] == [False, True]
    assert out[2]["request_id"] == "r-2"
    assert out[1]["error"].asDict() == {
        "class": "corrupted", "http_status": 422, "error_code": "malformed", "retryable": False
    }
    assert out[1]["result"] is None and out[0]["error"] is None


def test_store_is_read_unless_bypassed(spark):
    rows = [(0, b"a\n1", "a.csv", None), (1, b"a\n1", "a.csv", None), (2, b"b\n1", "b.csv", None)]
    docs = corpus(spark, rows).withColumn(
        "options", F.when(F.col("input_ordinal") == 1, options(use_cache=False)).otherwise(options())
    )
    key = intake.variant_key(docs).filter("input_ordinal = 0").first()["variant_key"]
    store = spark.createDataFrame([(key, "stored")], "variant_key string, markdown string")
    out = {r["input_ordinal"]: r for r in convert_batch(docs, store).collect()}
    assert [out[n]["cache_hit"] for n in range(3)] == [True, False, False]
    assert out[0]["result"]["markdown"] == "stored"
    assert out[1]["result"]["markdown"].startswith("| a |")
    looked = {r["input_ordinal"]: r["cache_hit"] for r in
              reuse.cache_lookup(intake.variant_key(docs), store).collect()}
    assert looked == {0: True, 1: False, 2: False}
    left = reuse.cache_misses(intake.variant_key(docs), store)
    assert sorted(r["input_ordinal"] for r in left.collect()) == [1, 2]


def test_five_equal_calls_make_one_conversion(spark):
    docs = intake.variant_key(corpus(spark, [(n, b"single-flight", "same.csv", f"r{n}") for n in range(5)]))
    ran = spark.sparkContext.accumulator(0)

    def convert_once(work):
        def count(batches):
            for batch in batches:
                ran.add(len(batch))
                yield batch.assign(markdown="ok")

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in work.schema)
        return work.mapInPandas(count, f"{schema}, markdown string")

    out = reuse.single_flight(docs, convert_once).collect()
    assert ran.value == 1
    assert [r["markdown"] for r in out] == ["ok"] * 5
    assert sorted(r["request_id"] for r in out) == [f"r{n}" for n in range(5)]
    assert sum(r["shared"] for r in out) == 4


@pytest.mark.parametrize("salts", [1, 7, 256])
def test_a_key_with_a_third_of_all_rows(spark, salts):
    docs = spark.range(30_000).select(
        F.col("id").alias("input_ordinal"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("content"),
        F.lit("a.csv").alias("filename"),
        F.lit(None).cast("string").alias("request_id"),
        options().alias("options"),
    )
    keyed = intake.variant_key(docs)
    out = reuse.single_flight(keyed, lambda w: w.withColumn("n", F.length("content")), salts=salts)
    row = out.agg(F.count("n"), F.count_if("shared"), F.sum("n")).first()
    assert row[0] == 30_000 and row[1] == 9_999
    assert row[2] == sum(3 if n % 3 == 0 else len(str(n)) for n in range(30_000))


def test_refused_content_is_not_moved(spark, tmp_path):
    corpus(spark, [(0, b"a,b", "a.csv", None), (1, b"%PDF-", "b.pdf", None)]).write.parquet(str(tmp_path / "c"))
    out = convert_batch(spark.read.parquet(str(tmp_path / "c")))
    out.collect()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    scans = [x for x in plan.split("\n") if "Relation" in x and "content#" in x]
    assert len(scans) == 1  # the other one was written as narrow rows
    assert "ShuffledHashJoin" not in plan


def test_unread_content_is_too_large(spark):
    rows = [(0, None, "big.csv", None), (1, None, "big.csv", None)]
    docs = corpus(spark, rows).withColumn("size_bytes", F.lit(10).cast("long"))
    out = convert_batch(docs).collect()
    assert {(r["class"], r["route"], r["shared"], r["variant_key"]) for r in out} == {
        ("too_large", "reject", False, None)
    }


@pytest.mark.parametrize(
    "before", ["", " " * 600, "<!-- c -->", '<?xml version="1.0"?>\n', "\ufeff\n<!-- a --> <!-- b -->", "<head>", "<body>"]
)
def test_html_is_told_wherever_it_begins(spark, before):
    text = before + "<!doctype   html><p>x"
    df = spark.createDataFrame([(text, "x.docx")], "content string, filename string")
    assert intake.sniff_format(df).first()["format"] == "html"
