import pytest
from pyspark.sql import functions as F

from docmill.plans import inputs, registry

PAGES = 20


@pytest.fixture
def tables(spark, tmp_path):
    """Tables of one file with one row group each."""
    texts = [(n, f"first line {n}\nsecond line & <more>", "en", f"source-{n % 3}", 30) for n in range(60)]
    documents = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    documents.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    pages = spark.createDataFrame([(n, f"u{n}", f"<p>{n}</p>") for n in range(PAGES)], "page_id long, url string, html string")
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    return tmp_path


@pytest.mark.parametrize("derived", [inputs.structured_html, inputs.paged_documents, inputs.illustrated_documents])
def test_one_row_group_is_worked_on_by_many_tasks(spark, tables, derived):
    rows = derived(spark, str(tables)).withColumn("_task", F.spark_partition_id())
    assert rows.count() == 60
    assert rows.select("_task").distinct().count() > 4


def test_page_files_lie_in_folders_of_folders(spark, tables, monkeypatch):
    path = tables / "files"
    monkeypatch.setattr(registry, "scratch_path", lambda *_: str(path))
    rows = registry.QUERIES["read_document_files"](spark, str(tables)).collect()
    assert sorted(r["page_id"] for r in rows) == list(range(PAGES))
    assert len(list(path.glob("part=*/page_id=*/*.txt"))) == PAGES
    assert not list(path.glob("page_id=*"))


def test_assets_convert_once(spark, tables, monkeypatch):
    """What three steps read is written once; none of them converts again."""
    df = registry.QUERIES["convert_batch_assets"](spark, str(tables))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "base64,!" not in plan and "regexp_replace" not in plan
    assert df.select("request_id").distinct().count() == 30


def test_lines_of_a_whole_text_equal_those_one_by_one(spark):
    texts = ["", "\n", "a", " 1. a \t b & <c> \r\n\n  \x0b\f\n- 5\n\td  e\t", "no letters: 5\n...", "12\n\u00e9 \u65e5\n \u2028x \n", None]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    one_by_one = F.filter(F.transform(F.split("text", "\n"), inputs._as_markup), lambda line: line != "")
    rows = df.select("text", inputs._lines().alias("whole"), one_by_one.alias("each")).collect()
    assert [r["whole"] for r in rows] == [r["each"] for r in rows]
    assert rows[3]["whole"] == ["a b &amp; &lt;c&#62;", "d e"]
    plan = df.select(inputs._lines())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("transform(split(") < plan.index("regexp_replace")  # patterns run before the split
