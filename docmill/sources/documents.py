"""Document sources: files, tables and streams of either."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill import rules
from docmill.functions.options import options


def _file_columns(content: Column) -> list[Column]:
    return [
        F.col("path").alias("input_ordinal"),
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        content.alias("content"),
        F.col("length").alias("size_bytes"),
        F.lit(None).cast("string").alias("request_id"),
        options().alias("options"),
    ]


def read_documents(
    spark: SparkSession, path: str, glob: str = "*", max_bytes: int = rules.MAX_BYTES
) -> DataFrame:
    """Files below ``path``, one row each; the path identifies the row.

    Files over ``max_bytes`` come with their size and no content: the size filter
    reaches the scan, and what is not selected is never read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    small = files.filter(F.col("length") <= max_bytes).select(_file_columns(F.col("content")))
    large = files.filter(F.col("length") > max_bytes).select(
        _file_columns(F.lit(None).cast("binary"))
    )
    return small.unionByName(large)


def read_document_table(
    spark: SparkSession,
    path: str,
    ordinal: str,
    content: str,
    filename: Column,
    opts: Column | None = None,
    request_id: Column | None = None,
) -> DataFrame:
    """Documents kept in a Parquet table; only the named columns are read."""
    return document_columns(spark.read.parquet(path), ordinal, content, filename, opts, request_id)


def document_columns(
    table: DataFrame,
    ordinal: str,
    content: str,
    filename: Column,
    opts: Column | None = None,
    request_id: Column | None = None,
) -> DataFrame:
    return table.select(
        F.col(ordinal).alias("input_ordinal"),
        F.col(content).alias("content"),
        filename.alias("filename"),
        (F.lit(None) if request_id is None else request_id).cast("string").alias("request_id"),
        (options() if opts is None else opts).alias("options"),
    )


#: What a trigger takes of a stream of files, unless told otherwise.
MAX_BYTES_PER_TRIGGER = 64 * 1024**3


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER,
    max_files_per_trigger: int | None = None,
    finished: str = "keep",
    archive: str | None = None,
) -> DataFrame:
    """A Parquet table as a stream: a folder in which files keep arriving, or one file.

    A trigger takes a bounded number of bytes, or of files where that is given; one
    file is taken whole, whatever its size. Files that are done can be moved below
    ``archive`` (``finished="archive"``) or deleted (``finished="delete"``), so that the
    folder that each trigger lists does not grow for ever.
    """
    if max_bytes_per_trigger is None and max_files_per_trigger is None:
        raise ValueError("a trigger needs a bound: bytes or files")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    else:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if finished == "archive":
        if archive is None:
            raise ValueError("an archive needs a folder")
        reader = reader.option("sourceArchiveDir", archive)
    elif finished not in ("keep", "delete"):
        raise ValueError(f"unknown way to treat finished files: {finished}")
    if finished != "keep":
        reader = reader.option("cleanSource", finished)
    return reader.parquet(_listed(path))


def _listed(path: str) -> str:
    """A pattern that matches the path alone: what it matches may be a folder, whose files
    are listed, or a file, while a plain path may only be a folder."""
    path = path.rstrip("/")
    head, last = path[:-1], path[-1]
    escaped = "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in head)
    return f"{escaped}[{last}]"


def stream_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    ordinal: str,
    content: str,
    filename: Column,
    **admission,
) -> DataFrame:
    """Documents that keep arriving in a folder; ``admission`` as in ``stream_table``."""
    return document_columns(stream_table(spark, path, schema, **admission), ordinal, content, filename)
