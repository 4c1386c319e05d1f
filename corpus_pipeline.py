"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept.
All but the last return the columns of ``docs``. Rows without a doc_id are judged
like others where an operator can do without it, and otherwise kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.byte_bpe import encode_decode
from docmill.llm.common import table, written
from docmill.llm.cube import mixed_documents
from docmill.llm.debruijn import remove_repeats
from docmill.llm.quality_rules import sound_documents
from docmill.llm.queries import RANKS
from docmill.llm.token_groups import jaccard_components, set_ids
from docmill.session import tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier rule reject go."""
    return sound_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays; rows that repeat both
    its id and its text stay once."""
    judged = written(jaccard_components(docs).select("doc_id", "component_id", "set_id"), "judged")
    dropped = judged.filter("doc_id <> component_id").select("doc_id", "set_id").distinct()
    repeated = judged.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    # Read back, their sizes are known: where they are small, texts are not moved.
    repeated = written(repeated.select("doc_id"), "repeated-ids")
    gone = written(dropped.select("doc_id").unionByName(repeated), "dropped-ids")
    once = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    if not repeated.take(1):
        return once
    # Rows that share an id may have different texts: each goes or stays by its own.
    linked = written(dropped.join(repeated, "doc_id", "left_semi"), "dropped-sets")
    linked = linked.select(F.col("doc_id").alias("_gone"), F.col("set_id").alias("_set_id"))
    several = docs.join(repeated, "doc_id", "left_semi").withColumn("_own_set", set_ids(F.col("text")))
    here = (F.col("doc_id") == F.col("_gone")) & (F.col("_own_set") == F.col("_set_id"))
    several = several.join(linked, here, "left_anti").dropDuplicates(["doc_id", "text"])
    return once.unionByName(several.select(docs.columns))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated windows of words go; a document of which nothing stays is an empty one."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = remove_repeats(docs, carried=others, with_text=True)
    changed = F.col("n_removed") > 0
    if "n_chars" in others:
        n_chars = F.when(changed, F.length("kept_text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col("kept_text").alias("text") if c == "text" else out[c] for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the round trip."""
    return encode_decode(
        docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=True
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _tuned(stage: Stage) -> Stage:
    return lambda spark, docs, sf_dir: stage(tune(spark), docs, sf_dir)


STAGES = [
    ("quality_rules", _tuned(quality_rules)),
    ("jaccard_join", _tuned(near_duplicates)),
    ("substring_dedup", _tuned(substring_dedup)),
    ("source_mixing", _tuned(source_mixing)),
    ("byte_bpe", _tuned(byte_bpe)),
]

#: The outlier rule and the tokens cannot be stated in SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
