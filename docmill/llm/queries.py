"""The registered queries of this subpackage: each applies one operator, with its
production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docmill.llm.byte_bpe import encode_decode
from docmill.llm.common import crc32_of_id, table
from docmill.llm.cube import mix
from docmill.llm.debruijn import remove_repeats
from docmill.llm.int8_dedup import near_duplicates
from docmill.llm.lexical_packing import pack
from docmill.llm.neighbours import vote_quality
from docmill.llm.ngram_lm import score_texts
from docmill.llm.oracle import ORACLE_SQL
from docmill.llm.prefix_trie import conversation_trie
from docmill.llm.quality_rules import quality_rules
from docmill.llm.token_groups import jaccard_components
from docmill.llm.url_cascade import Rule, judge_urls
from docmill.llm.warc import archive_round_trip
from docmill.llm.whitening import whiten
from docmill.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"
WORDS = "word_bpe_49k.json"


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        return fn

    return register


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


@query("op4_warc")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


#: The rules of the registered query.
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


@query("op6_url_filters")
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op9_embedding_near_dedup")
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = vote_quality(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        learn_from="crc32(cast(coalesce(cast(_id AS string), '') AS binary)) % 5 <> 0",
    )
    held_out = (crc32_of_id() % 5 == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("distance")


@query("op8_source_mixing")
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@query("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("set_id")


@query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_texts(
        table(spark, sf_dir, "documents"),
        learn_from="crc32(cast(coalesce(cast(_id AS string), '') AS binary)) % 7 <> 2",
    )
    held_out = (crc32_of_id() % 7 == 2).alias("held_out")
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select("doc_id", held_out, *names)


@query("op11_prefix_trie")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query("op12_lexical_packing")
def op12_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
