"""Mixing sources to target weights by the cube method.

Each source takes its target by whole copies of all its documents and, for the
fraction that is left, a balanced sample: every document starts with that
fraction as its inclusion probability, and the flight moves probabilities within
the null space of two constraints (the source's documents and its words) until
they are 0 or 1. Flights run in blocks of bounded size; the few documents that a
block leaves undecided form the blocks of the next round, until one block a
source is left and its last one or two documents are landed.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.llm.common import word_count, written

WEIGHTS = (5, 2, 1)
MAX_TIMES = 3
#: Documents in one flight.
BLOCK = 5_000
#: Sources a mix may have; their totals are held on the driver.
MAX_SOURCES = 1_000_000
SEED = 17
_CLOSE = 1e-9


def targets(sizes: Sequence[int], weights: Sequence[float], times: float = MAX_TIMES) -> list[float]:
    """Targets that share the sum of all sizes by weight; none exceeds ``times`` its
    source's size, and what is above is shared among the others by weight."""
    out = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), list(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > times * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = float(times * sizes[i])
        left -= sum(out[i] for i in full)
        held = set(full)
        open_ = [i for i in open_ if i not in held]
    return out


def _direction(sizes: np.ndarray, p: np.ndarray) -> np.ndarray | None:
    """A vector that keeps the number and the words, and moves the first document most.

    The others answer in proportion to the room that they have, so that a large document
    is decided while many small ones share what it changes. None if it cannot move: all
    others are of one size, and it is of another.
    """
    room = p[1:] * (1 - p[1:])
    own = sizes[1:]
    count, words, squares = room.sum(), (room * own).sum(), (room * own * own).sum()
    det = count * squares - words * words
    if det > 1e-9 * count * squares:
        a = (squares - words * sizes[0]) / det
        b = (count * sizes[0] - words) / det
        return np.concatenate([[1.0], -room * (a + b * own)])
    if own.min() == own.max() == sizes[0]:
        return np.concatenate([[1.0], -room / count])
    return None


def _move(p: np.ndarray, u: np.ndarray, rng: random.Random) -> np.ndarray:
    """Move along u or against it to a face of the cube; the expectation stays."""
    moving = u != 0
    x, d = p[moving], u[moving]
    up = np.where(d > 0, (1 - x) / d, -x / d).min()
    down = np.where(d > 0, x / d, (x - 1) / d).min()
    step = up if rng.random() * (up + down) < down else -down
    return _settled(p + step * u)


def _settled(p: np.ndarray) -> np.ndarray:
    return np.where(p < _CLOSE, 0.0, np.where(p > 1 - _CLOSE, 1.0, p))


def flight(sizes: list[int], p: list[float], rng: random.Random, land: bool = False) -> list[float]:
    """Probabilities after the flight, in which documents are decided in the given order.
    At most two are left between 0 and 1; with ``land`` none: first the words are let
    go, then the number."""
    s, p = np.array(sizes, dtype=np.float64), _settled(np.array(p, dtype=np.float64))
    active = np.flatnonzero((p > 0) & (p < 1))
    stuck: list[int] = []
    while len(active) > 1:
        u = _direction(s[active], p[active])
        if u is None:
            stuck.append(int(active[0]))
            active = active[1:]
            continue
        p[active] = _move(p[active], u, rng)
        active = active[(p[active] > 0) & (p[active] < 1)]
    if land:
        left = [*stuck, *active.tolist()]
        while len(left) > 1:
            p[left[:2]] = _move(p[left[:2]], np.array([1.0, -1.0]), rng)
            left = [i for i in left if 0 < p[i] < 1]
        for i in left:
            p[i] = float(rng.random() < p[i])
    return p.tolist()


def _small_table(spark: SparkSession, rows: list[tuple], types: dict[str, pa.DataType]) -> DataFrame:
    """A table of rows that the driver holds. It goes as Arrow: tasks turn rows of Python into
    Spark's in workers of another kind, which stay in memory beside those of the other steps."""
    columns = [[row[k] for row in rows] for k in range(len(types))]
    return spark.createDataFrame(pa.table(columns, schema=pa.schema(list(types.items()))))


def source_table(sizes: DataFrame, weights: Sequence[float], times: float) -> DataFrame:
    """One row per source: _source, _k (its rank by code point, null last), size, target."""
    spark = sizes.sparkSession
    totals = sizes.groupBy("_source").agg(F.sum("_size").alias("s"))
    found = [tuple(x) for x in totals.limit(MAX_SOURCES + 1).collect()]
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda x: (x[0] is None, x[0] or ""))
    own = [weights[k % len(weights)] for k in range(len(found))]
    goals = targets([s for _, s in found], own, times)
    rows = [(name, k, int(s), goal) for k, ((name, s), goal) in enumerate(zip(found, goals, strict=True))]
    types = {"_source": pa.string(), "_k": pa.int32(), "_total": pa.int64(), "_target": pa.float64()}
    return _small_table(spark, rows, types)


def _flights(units: DataFrame, blocks: dict[int, int], turn: int) -> DataFrame:
    """One round of flights; a source with one block lands."""
    spark = units.sparkSession
    schema = units.schema
    counts = _small_table(spark, sorted(blocks.items()), {"_k": pa.int32(), "_blocks": pa.int32()})
    dealt = units.join(F.broadcast(counts), "_k").withColumn(
        "_block", F.expr(f"pmod(xxhash64(_id, _size, _text, {turn}), _blocks)").cast("int")
    )

    def fly(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        # the largest first: what stays undecided are small documents
        block = block.sort_values(["_size", "_id", "_text"], ascending=[False, True, True])
        rng = random.Random(f"{SEED}/{turn}/{key[0]}/{key[1]}")
        land = bool(block["_blocks"].iloc[0] == 1)
        p = flight(block["_size"].tolist(), block["_p"].tolist(), rng, land)
        return block.assign(_p=p)[[f.name for f in schema]]

    return dealt.groupBy("_k", "_block").applyInPandas(fly, schema)


def mixed_units(sizes: DataFrame, weights: Sequence[float], times: float, block: int) -> DataFrame:
    """Equal rows (_source, _id, _size, _text) as one unit of ``_n`` rows, with ``_copies`` of
    the unit that the mix takes in all."""
    sources = source_table(sizes, weights, times)
    factor = F.when(F.col("_total") > 0, F.col("_target") / F.col("_total")).otherwise(0.0)
    want = F.col("_n") * F.least(factor, F.lit(float(times)))
    units = written(
        sizes.groupBy("_source", "_id", "_size", "_text")
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(F.broadcast(sources.withColumnRenamed("_source", "_name")), F.expr("_source <=> _name"))
        .withColumn("_whole", F.floor(want + _CLOSE))
        .withColumn("_p", F.greatest(want - F.col("_whole"), F.lit(0.0)))
        .select("_source", "_k", "_id", "_size", "_text", "_n", "_total", "_target", "_whole", "_p"),
        "mix-units",
    )
    done, turn = None, 0
    open_ = units
    while True:
        counted = open_.groupBy("_k").count().collect()  # one row per source
        blocks = {r["_k"]: -(-r["count"] // block) for r in counted}
        if not blocks:
            break
        moved = written(_flights(open_, blocks, turn), "mix-flight")
        open_ = moved.filter("_p > 0 AND _p < 1")
        settled = moved.filter("NOT (_p > 0 AND _p < 1)")
        done = settled if done is None else done.unionByName(settled)
        turn += 1
    done = units if done is None else done
    return done.withColumn("_copies", (F.col("_whole") + F.round("_p").cast("long")))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(source_col).alias("_source"),
        F.col(id_col).alias("_id"),
        word_count(F.col(text_col)).alias("_size"),
        F.xxhash64(text_col).alias("_text"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    times: float = MAX_TIMES,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words, repeats counted).

    Size is the number of words; null texts have none. Sources rank by code point,
    null last, and take ``weights`` in turn. Equal rows are one unit whose copies are
    dealt as evenly as they go. Null ids are documents like others. The result is
    the same in every run. Other columns are not read.
    """
    sizes = written(_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    units = mixed_units(sizes, weights, times, block)
    rows = units.withColumn("_j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_total").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * _copies_of_row()).cast("long").alias("taken"),
    )


def _copies_of_row() -> Column:
    """Of a unit's copies, those of its row number ``_j``."""
    even = F.floor(F.col("_copies") / F.col("_n"))
    return even + (F.col("_j") <= F.col("_copies") - even * F.col("_n")).cast("long")


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    times: float = MAX_TIMES,
    block: int = BLOCK,
) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it; same columns."""
    sizes = written(_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    units = written(mixed_units(sizes, weights, times, block), "mix-taken").select(
        "_source", "_id", "_size", "_text", "_n", "_copies"
    )
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_doc"),
        *[F.col(source_col).alias("_s"), F.col(id_col).alias("_i"), F.xxhash64(text_col).alias("_t")],
    )
    same = F.expr("_source <=> _s AND _id <=> _i AND _text <=> _t")
    taken = keyed.join(units.filter("_n = 1 AND _copies > 0"), same).select("_doc", F.col("_copies").alias("_times"))
    repeats = units.filter("_n > 1 AND _copies > 0")
    if not repeats.take(1):
        return _repeated(taken)
    # Only rows that repeat another one in id, source and text are numbered.
    several = keyed.join(repeats, same)
    number = F.row_number().over(Window.partitionBy("_source", "_id", "_text").orderBy("_size"))
    several = several.withColumn("_j", number.cast("long")).withColumn("_times", _copies_of_row())
    return _repeated(taken.unionByName(several.select("_doc", "_times")))


def _repeated(taken: DataFrame) -> DataFrame:
    """Each document as often as it is taken."""
    times = F.explode(F.expr("sequence(1L, _times)"))
    return taken.filter("_times > 0").withColumn("_j", times).select("_doc.*")
