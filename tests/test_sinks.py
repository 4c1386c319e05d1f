import base64

import pytest
from pyspark.sql import functions as F

from docmill import schemas, session
from docmill.functions.options import options
from docmill.operators import intake, reuse
from docmill.plans.batch import convert_batch
from docmill.sources import documents, sinks
from docmill.streaming.convert import convert_stream
from docmill.streaming.dedup import stream_dedup


def keyed(spark, contents, use_cache=None):
    rows = [(n, c, "a.csv", None) for n, c in enumerate(contents)]
    df = spark.createDataFrame(
        rows, "input_ordinal long, content string, filename string, request_id string"
    ).withColumn("options", options(use_cache=use_cache))
    return intake.variant_key(df).withColumn("markdown", F.upper("content"))


def test_store_keeps_one_row_per_key(spark, tmp_path):
    path = str(tmp_path / "store")
    sinks.store_results(keyed(spark, ["a", "a", "b"]), path)
    sinks.store_results(keyed(spark, ["b", "c", "c"]), path)
    sinks.store_results(keyed(spark, ["d"], use_cache=False), path)
    assert sorted(r["markdown"] for r in sinks.read_store(spark, path).collect()) == ["A", "B", "C"]


def test_nothing_moves_above_the_store(spark, tmp_path):
    """Whoever asks is dealt into the store's buckets; what is stored stays where it is."""
    path = str(tmp_path / "it's a store")
    assert sinks.read_store(spark, path) is None
    asking = keyed(spark, [f"text {n % 700}" for n in range(1000)])
    sinks.store_results(asking.filter("input_ordinal < 300"), path, buckets=8)
    sinks.store_results(asking, path, buckets=64)  # the first number stays
    store = sinks.read_store(spark, path).select("variant_key", F.col("markdown").alias("stored"))
    assert store.count() == 700
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = reuse.cache_lookup(asking, store)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.filter("cache_hit AND stored = markdown").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    above = []
    for line in reversed(lines[:scan]):  # the scan's ancestors up to the join
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            above.append(line)
            depth = here
            if "Join" in line:
                break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above)


def test_a_stream_without_input_leaves_an_empty_table(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    schema = spark.createDataFrame([], "n long, text string").schema
    stream = documents.stream_documents(spark, source, schema, "n", "text", F.lit("x.csv"))
    convert_stream(stream, path, str(tmp_path / "progress")).awaitTermination()
    assert sinks.read_routed(spark, path, schemas.OUTCOME).collect() == []


def test_outcomes_have_the_stated_columns(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_routed(convert_batch(keyed(spark, ["a\n1"]).drop("markdown", "variant_key", "content_sha256")), path, "x")
    assert set(sinks.read_routed(spark, path).columns) == set(schemas.OUTCOME.names)
    found = {f.name: f.dataType.simpleString() for f in sinks.read_routed(spark, path).schema}
    assert all(found[f.name] == f.dataType.simpleString() for f in schemas.OUTCOME.fields)


@pytest.mark.parametrize("admission", [{}, {"max_bytes_per_trigger": 2000}, {"max_files_per_trigger": 1}])
def test_a_table_streams_alike_as_one_file_and_as_a_folder(spark, tmp_path, admission):
    rows = spark.range(500).select("id", F.concat(F.lit("text "), "id").alias("text"))
    rows.repartition(5).write.parquet(str(tmp_path / "folder.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "made"))
    (file,) = (tmp_path / "made").glob("*.parquet")
    file.rename(tmp_path / "file.parquet")
    for name in ("folder.parquet", "file.parquet"):
        stream = documents.stream_table(spark, str(tmp_path / name), rows.schema, **admission)
        out = sinks.run_to_table(stream, "alike")
        assert sorted(r["id"] for r in out.collect()) == list(range(500))


def test_finished_files_can_go(spark, tmp_path):
    source, done = tmp_path / "in", tmp_path / "done"
    for n in range(4):
        spark.range(n, n + 1).coalesce(1).write.mode("append").parquet(str(source))
    stream = documents.stream_table(
        spark, str(source), spark.range(1).schema, max_files_per_trigger=1, finished="archive", archive=str(done)
    )
    assert sinks.run_to_table(stream, "archived").count() == 4
    left, moved = len(list(source.glob("*.parquet"))), len(list(done.rglob("*.parquet")))
    assert left + moved == 4 and moved >= 1
    with pytest.raises(ValueError):
        documents.stream_table(spark, str(source), spark.range(1).schema, None, None)


def test_a_batch_fills_assets_and_headers_where_asked(spark):
    png = base64.encodebytes(b"\x89PNG" + bytes(range(200))).decode()
    words = ("one", "two", "three")
    pages = "\f".join(f"<p>Corp</p><p>{w}</p><p>Page {n} of 3</p>" for n, w in enumerate(words, 1))
    rows = [
        (0, f"<html><h1>A > B</h1><p>see</p><img src='data:image/png;base64,{png}'><p>so</p>", True, None),
        (1, "<html><img src='data:image/gif;base64,!'><img src=x.png><img src='data:,hi%20there'>", True, None),
        (2, f"<html>{pages}", None, True),
        (3, f"<html>{pages}", None, False),
        (4, "<html><p>one page</p>", None, True),
    ]
    df = spark.createDataFrame(rows, "input_ordinal long, content string, a boolean, h boolean").select(
        "input_ordinal", "content", F.lit("x.html").alias("filename"), F.lit(None).cast("string").alias("request_id"),
        options(include_assets=F.col("a"), headers_footers=F.col("h")).alias("options"),
    )
    got = {r["input_ordinal"]: r["result"] for r in convert_batch(df).collect()}
    (image,) = got[0]["assets"]
    assert (image["media_type"], image["size"], bytes(image["data_b64"][:4])) == ("image/png", 204, b"\x89PNG")
    assert image["placements"][0]["heading_path"] == ["A > B"]
    assert (image["placements"][0]["context_before"], image["placements"][0]["context_after"]) == ("see", "so")
    assert [(a["media_type"], bytes(a["data_b64"])) for a in got[1]["assets"]] == [("text/plain", b"hi there")]
    assert [(e["kind"], e["text"], e["page_number"]) for e in got[2]["headers_footers"]] == [
        ("header", "Corp", False), ("footer", "Page 1 of 3", True)
    ]
    assert (got[2]["markdown"], got[2]["headers_footers_stripped"]) == ("one\n\ntwo\n\nthree", 6)
    assert (got[3]["headers_footers"], got[3]["headers_footers_stripped"], got[3]["assets"]) == (None, None, [])
    assert got[3]["markdown"].startswith("Corp\n\none\n\nPage 1 of 3\n\nCorp")
    assert (got[4]["headers_footers"], got[4]["headers_footers_stripped"]) == ([], None)


def test_routed_folders(spark, tmp_path):
    path = str(tmp_path / "routed")
    df = spark.createDataFrame([(1, "ok"), (2, "reject"), (3, "ok")], "id long, route string")
    sinks.write_routed(df, path, "monday")
    folder = tmp_path / "routed" / "run_id=monday"
    assert sorted(p.name for p in folder.iterdir() if p.is_dir()) == ["route=ok", "route=reject"]
    sinks.write_routed(df.filter("id = 1"), path, "tuesday")
    sinks.write_routed(df, path, "monday")
    got = sinks.read_routed(spark, path).select("run_id", "id", "route").collect()
    assert {tuple(r) for r in got} == {
        ("monday", 1, "ok"), ("monday", 2, "reject"), ("monday", 3, "ok"), ("tuesday", 1, "ok")
    }


def test_a_repeated_batch_replaces_its_output(spark, tmp_path):
    path = str(tmp_path / "routed")
    df = spark.createDataFrame([(1, "ok")], "id long, route string")
    for batch_id in (0, 1, 1):
        sinks.write_routed_batch(df, batch_id, path)
    assert sinks.read_routed(spark, path).count() == 2


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    texts = ["a\n1", "", "a\n1", "b\n2", "x"]
    names = ["a.csv", "a.csv", "a.csv", "b.csv", "x.txt"]
    source = str(tmp_path / "in")
    spark.createDataFrame(list(zip(range(5), texts, names)), "n long, text string, name string").coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema
    stream = documents.stream_documents(spark, source, schema, "n", "text", F.col("name"))
    path = str(tmp_path / "out")
    convert_stream(stream, path, str(tmp_path / "progress")).awaitTermination()
    batch = convert_batch(documents.read_document_table(spark, source, "n", "text", F.col("name")))
    columns = ["input_ordinal", "class", "route", "shared", "result.markdown", "error.error_code"]
    rows = [{tuple(r) for r in df.select(columns).collect()} for df in (batch, sinks.read_routed(spark, path))]
    assert rows[0] == rows[1] and len(rows[0]) == 5


def test_stream_reuses_what_it_has_stored(spark, tmp_path):
    source, path, store = (str(tmp_path / name) for name in ("in", "out", "store"))
    for n, text in enumerate(["a\n1", "a\n1", "b\n2"]):
        spark.createDataFrame([(n, text)], "n long, text string").coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    stream = documents.stream_documents(
        spark, source, schema, "n", "text", F.lit("x.csv"), max_files_per_trigger=1
    )
    convert_stream(stream, path, str(tmp_path / "progress"), store_path=store).awaitTermination()
    got = sinks.read_routed(spark, path).collect()
    assert sorted(r["cache_hit"] for r in got) == [False, False, True]
    assert sinks.read_store(spark, store).count() == 2


def test_dedup_over_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", "2024-01-01 00:00"), ("b", "2024-01-01 00:01"), ("a", "2024-01-01 00:02")]
    for row in rows:
        spark.createDataFrame([row], "variant_key string, t string").select(
            "variant_key", F.col("t").cast("timestamp").alias("ts")
        ).coalesce(1).write.mode("append").parquet(source)
    stream = documents.stream_table(spark, source, spark.read.parquet(source).schema, max_files_per_trigger=1)
    out = sinks.run_to_table(stream_dedup(stream), "dedup-test")
    assert sorted(r["variant_key"] for r in out.collect()) == ["a", "b"]


def test_checkpoint_folder_comes_from_the_session(spark):
    assert session.checkpoint_dir(spark) == session.checkpoint_dir(spark)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
