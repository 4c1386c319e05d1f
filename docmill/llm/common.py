"""What the operators of this subpackage share: words, tables, and ways to write once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.session import discard, scratch_path

# Fixed value: a word is a run of characters other than these six.
WORD = r"[^\x20\x09-\x0D]+"


def small_batches(
    batches: Iterator[pd.DataFrame], column: str, chars: int = 1_000_000
) -> Iterator[pd.DataFrame]:
    """The same rows in batches of about ``chars`` characters of a text column, so that
    what is computed from a batch stays small whatever texts are long."""
    for batch in batches:
        done = batch[column].str.len().fillna(0).cumsum().to_numpy() // chars
        cut = np.concatenate([[0], np.flatnonzero(np.diff(done)) + 1, [len(batch)]])
        for begin, end in zip(cut[:-1], cut[1:], strict=True):
            yield batch.iloc[begin:end].reset_index(drop=True)


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8. ``bytes.split`` parts at exactly the six
    characters of ``WORD``; null has none."""
    return utf8(text).split()


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased and nothing else (``bytes.lower`` is ASCII only)."""
    return utf8(text).lower()


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Whether Spark deletes the shuffle files of a query once it has ended.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, free_shuffles: bool = False) -> DataFrame:
    """The rows, written once to the shared folder and read from there: what
    several later steps read is computed once, and survives lost executors.
    With ``free_shuffles`` the shuffle files of the write go when it has ended."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_FREE, "false")
    if free_shuffles:
        spark.conf.set(_FREE, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if free_shuffles:
            spark.conf.set(_FREE, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def done_with(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote, once no later step reads it."""
    for table_ in tables:
        discard(table_.sparkSession, table_._written_at)


def crc32_of_id(id_col: str = "doc_id") -> Column:
    """crc32 of an id written as text, as a long; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
