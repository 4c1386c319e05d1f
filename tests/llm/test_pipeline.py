from collections import Counter

import corpus_pipeline
from docmill.llm.quality_rules import quality_rules
from docmill.llm.token_groups import jaccard_components


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", "'x' AS _id", "1 AS key")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, sf_dir)
        after = out.collect()
        if name == "quality_rules":
            kept = {r.doc_id for r in quality_rules(docs).filter("kept").collect()}
            assert {r.doc_id for r in after} == kept and len(after) < len(before)
        if name == "jaccard_join":
            first = {r.component_id for r in jaccard_components(docs).collect()}
            assert {r.doc_id for r in after} == first
        if name == "substring_dedup":
            assert {r.doc_id for r in after} == {r.doc_id for r in before}
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "source_mixing":
            assert max(Counter(r.doc_id for r in after).values()) <= 3
        if name == "byte_bpe":
            assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
            assert all(r.n_tokens == len(r.ids) for r in after)
        else:
            assert out.columns == columns
        docs = spark.createDataFrame(after, out.schema)


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []


def test_repeated_rows_and_nulls(spark, sf_dir):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, None, None, None), (1, text, None, None, None), (2, text + " x", "en", "s", 3), (None, text, "en", "s", 1), (3, None, None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "None"]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs.collect()


def test_a_linked_row_leaves_other_texts_of_its_id(spark, sf_dir):
    one, other = (" ".join(f"{x}{i}" for i in range(40)) for x in "vw")
    rows = [(1, one), (2, one), (2, other), (2, other), (3, other + " x"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, one), (2, ""), (2, other)]
