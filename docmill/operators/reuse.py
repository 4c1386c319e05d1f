"""One conversion per distinct variant key, shared by every row that has it.

A key may belong to any share of all rows, so nothing here gathers the rows of
a key. Keys are counted with map-side aggregation. Content is fetched for one
row per key by joining on the unique row id, which spreads evenly. Results go
back to the rows over (key, salt): the salt comes from the row id, and each
result is repeated for the salts its own rows use, at most ``SALTS`` times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions.options import bypasses_cache
from docmill.functions.salts import SALTS, salt, salt_list, used_salts


def distinct_keys(
    df: DataFrame,
    key: str = "variant_key",
    id_col: str = "input_ordinal",
    salts: int = SALTS,
    same: tuple[str, ...] = (),
) -> DataFrame:
    """One row per key: its first row's id, its number of rows, its salts.

    ``same`` names columns that are equal in all rows of a key; they are kept.
    """
    noted = used_salts("_salt", salts)
    return (
        df.select(key, id_col, *same, salt(id_col, salts).alias("_salt"))
        .groupBy(key)
        .agg(
            F.min(id_col).alias(id_col),
            F.count(F.lit(1)).alias("calls"),
            *[F.max(name).alias(name) for name in same],
            *[bits.alias(name) for name, bits in noted.items()],
        )
        .withColumn("_salts", salt_list(salts))
        .drop(*noted)
    )


def with_content(docs: DataFrame, keys: DataFrame, id_col: str) -> DataFrame:
    """The chosen rows with their content.

    Ids are unique and spread evenly; how to join is left to Spark, which knows sizes.
    """
    return docs.join(keys, id_col)


def hand_back(
    rows: DataFrame,
    per_key: DataFrame,
    key: str = "variant_key",
    id_col: str = "input_ordinal",
    salts: int = SALTS,
    how: str = "left",
) -> DataFrame:
    """Join one row per key (with ``_salts``) back to all rows of the key."""
    spread = per_key.withColumn("_salt", F.explode("_salts")).drop("_salts")
    return (
        rows.withColumn("_salt", salt(id_col, salts))
        .join(spread, [key, "_salt"], how)
        .drop("_salt")
    )


def single_flight(
    docs: DataFrame,
    convert: Callable[[DataFrame], DataFrame],
    content_cols: tuple[str, ...] = ("content",),
    key: str = "variant_key",
    id_col: str = "input_ordinal",
    salts: int = SALTS,
) -> DataFrame:
    """Run ``convert`` on one row per key and give its columns to every row.

    ``convert`` sees the id, the key and ``content_cols`` and adds columns. Each
    row keeps its own request id; ``shared`` marks rows that did no work.
    """
    keys = distinct_keys(docs, key, id_col, salts)
    work = with_content(docs.select(id_col, *content_cols), keys, id_col)
    done = (
        convert(work)
        .drop(*content_cols, "calls")
        .withColumnRenamed(id_col, "_owner")
    )
    calls = docs.drop(*content_cols)
    return (
        hand_back(calls, done, key, id_col, salts)
        .withColumn("shared", F.col("_owner") != F.col(id_col))
        .drop("_owner")
    )


def single_flight_report(df: DataFrame, key: str = "variant_key") -> DataFrame:
    """Calls and shares (calls that needed no conversion) per key."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("calls"))
        .withColumn("shares", F.col("calls") - 1)
    )


def _stored(
    docs: DataFrame, store: DataFrame, how: str, key: str, id_col: str, salts: int
) -> DataFrame:
    asking = docs.filter(~bypasses_cache(F.col("options")))
    return distinct_keys(asking, key, id_col, salts).drop(id_col, "calls").join(store, key, how)


def cache_lookup(
    docs: DataFrame,
    store: DataFrame,
    key: str = "variant_key",
    id_col: str = "input_ordinal",
    salts: int = SALTS,
) -> DataFrame:
    """Add the stored columns and ``cache_hit``. ``store`` has one row per key.

    Rows with use_cache=false are never hits. Their key differs from that of the
    same document without the option, so they cannot match by accident either.
    """
    hits = _stored(docs, store, "inner", key, id_col, salts).withColumn("_hit", F.lit(True))
    return (
        hand_back(docs, hits, key, id_col, salts)
        .withColumn("cache_hit", F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )


def cache_misses(
    docs: DataFrame,
    store: DataFrame,
    key: str = "variant_key",
    id_col: str = "input_ordinal",
    salts: int = SALTS,
) -> DataFrame:
    """Rows still to be converted: not stored, or not allowed to use the store.

    Keys and ids alone decide; whole rows are then picked by id.
    """
    narrow = docs.select(id_col, key, "options")
    looked_up = cache_lookup(narrow, store.select(key), key, id_col, salts)
    missing = looked_up.filter(~F.col("cache_hit")).select(id_col)
    return docs.join(missing, id_col, "left_semi")
