"""Sinks: routed outcomes, the result store, asset bytes."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from docmill.functions.options import bypasses_cache
from docmill.operators.reuse import distinct_keys
from docmill.session import names_in, scratch_path


def write_routed(outcomes: DataFrame, path: str, run_id: str) -> None:
    """One folder per run and route; a run that is repeated replaces only its own rows.
    Rows are written where they are: routes are few and very uneven, so shuffling by
    route would only pile up the largest one."""
    outcomes.write.mode("overwrite").partitionBy("route").parquet(f"{path}/run_id={run_id}")


def write_routed_batch(outcomes: DataFrame, batch_id: int, path: str) -> None:
    """For ``foreachBatch``: a batch that is run again replaces its own output."""
    write_routed(outcomes, path, f"batch-{batch_id}")


def read_routed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All runs' outcomes. With ``schema``, runs that wrote nothing give no rows."""
    if schema is not None and not names_in(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


# --- the store of results -------------------------------------------------------
#
# A store is a Parquet table in buckets of its key, each sorted by key. Their number is
# part of the folder's name, so that whoever opens the store reads it as buckets: a join
# on the key then moves the asking rows alone, never what is stored.

_BUCKETS = "buckets-"


def _store_layout(spark: SparkSession, path: str) -> int | None:
    found = [name for name in names_in(spark, path) if name.startswith(_BUCKETS)]
    return int(found[0].removeprefix(_BUCKETS)) if found else None


def _store_table(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> str:
    """The store as a table of the session's catalog, known by its folder."""
    folder = f"{path.rstrip('/')}/{_BUCKETS}{buckets}"
    name = f"docmill_store_{hashlib.md5(folder.encode()).hexdigest()}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        escaped = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
            f"SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{escaped}'"
        )
    return name


def store_results(
    results: DataFrame,
    store_path: str,
    key: str = "variant_key",
    id_col: str = "input_ordinal",
    buckets: int | None = None,
) -> None:
    """Append results whose key is not stored yet, one row per key.

    Rows with use_cache=false stay out. Only keys and ids are compared; result
    text is then picked by row id, which spreads evenly, and moves to its bucket.
    ``buckets`` counts for a new store alone; by default it has as many as a shuffle
    has partitions.
    """
    spark = results.sparkSession
    storable = results.filter(~bypasses_cache(F.col("options")))
    fresh = distinct_keys(storable, key, id_col).select(key, id_col)
    stored = read_store(spark, store_path, F.col(key), key=key)
    if stored is not None:
        fresh = fresh.join(stored, key, "left_anti")
    number = _store_layout(spark, store_path) or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = _store_table(spark, store_path, storable.schema, key, number)
    (
        storable.join(fresh.select(id_col), id_col, "left_semi")
        .select(spark.table(table).columns)
        .repartition(number, key)
        .write.insertInto(table)
    )


def read_store(spark: SparkSession, path: str, *columns: Column, key: str = "variant_key") -> DataFrame | None:
    """The store's columns, all if none are named; None where nothing was stored yet."""
    number = _store_layout(spark, path)
    if number is None:
        return None
    try:
        schema = spark.read.parquet(f"{path.rstrip('/')}/{_BUCKETS}{number}").schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    table = _store_table(spark, path, schema, key, number)
    spark.catalog.refreshTable(table)  # another session may have added to it
    stored = spark.table(table)
    return stored.select(*columns) if columns else stored


def write_assets(asset_rows: DataFrame, path: str) -> None:
    """Assets that carry bytes, as binary columns, without a shuffle."""
    (
        asset_rows.filter("has_data")
        .select("request_id", "asset_id", "media_type", "origin_part", "size", "data")
        .write.mode("overwrite")
        .parquet(path)
    )


def run_to_table(
    stream: DataFrame,
    name: str,
    output_mode: str = "append",
    path: str | None = None,
    progress_path: str | None = None,
) -> DataFrame:
    """Run a stream over what is there now into a Parquet table and read that.

    With ``path`` and ``progress_path`` a later run goes on where this one ended.
    """
    spark = stream.sparkSession
    out = path or scratch_path(spark, name)
    query: StreamingQuery = (
        stream.writeStream.outputMode(output_mode)
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", progress_path or scratch_path(spark, f"{name}-progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
