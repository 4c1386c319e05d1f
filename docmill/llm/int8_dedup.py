"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Equal vectors are one class first. Classes are dealt into cells around pivots, and
cells into tiles. Pairs of cells whose centres are too far apart for any pair of
their members are skipped; of the rest every pair of tiles is multiplied in int8.
For unit vectors u = s*p + d and v = t*q + e, with p and q whole numbers,
|u.v - s*t*(p.q)| <= |d| + (1 + |d|) * |e|, so only pairs whose product plus that
bound reaches the threshold are computed again in double precision. A tile pair
returns counts and a spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import written
from docmill.llm.components import connected_components, with_least

THRESHOLD = 0.95
TILE = 4096
MAX_PIVOTS = 4096
#: Covers the rounding of the int8 path (exact products, double scales).
SLACK = 1e-9
#: Pairs computed in double precision at a time.
EXACT_PAIRS = 65_536
_STRIP = 512


def usable(vector: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
    )
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision at length one; scaled first, so that no square
    overflows or vanishes."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales, and for each vector the length of what is lost."""
    scale = np.abs(units).max(axis=1) / 127
    values = np.rint(units / scale[:, None])
    lost = np.linalg.norm(units - values * scale[:, None], axis=1)
    return values.astype(np.int8), scale, lost


def linked_pairs(
    left: np.ndarray, right: np.ndarray, threshold: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs with cosine >= threshold; with ``same`` only i < j."""
    a, b = unit(left), unit(right)
    (p, s, d), (q, t, e) = quantise(a), quantise(b)
    whole = q.astype(np.float32).T
    # |p.q| <= dim * 127 * 127 must stay below 2**24 for float32 to be exact
    exact = p.shape[1] * 127 * 127 < 1 << 24
    for start in range(0, len(p), _STRIP):
        strip = p[start : start + _STRIP]
        if exact:
            product = (strip.astype(np.float32) @ whole).astype(np.float64)
        else:
            product = strip.astype(np.float64) @ q.astype(np.float64).T
        product *= s[start : start + _STRIP, None]
        product *= t
        ds = d[start : start + _STRIP, None]
        i, j = np.nonzero(product + (ds + (1 + ds) * e) + SLACK >= threshold)
        i += start
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), EXACT_PAIRS):
            x, y = i[at : at + EXACT_PAIRS], j[at : at + EXACT_PAIRS]
            found = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
            yield x[found], y[found]


def forest(n: int, x: np.ndarray, y: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The smallest node that each of n nodes reaches over the edges (x, y)."""
    root = np.arange(n) if root is None else root
    while True:
        a, b = root[x], root[y]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low < high
        if not open_.any():
            return root
        np.minimum.at(root, high[open_], low[open_])
        while not np.array_equal(root, root[root]):
            root = root[root]


def _cells(units: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector, and the angle to it."""
    cosines = units @ pivots.T
    cell = cosines.argmax(axis=1)
    return cell, np.arccos(np.clip(cosines[np.arange(len(cell)), cell], -1, 1))


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept (id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing and are components of their own; so do vectors of different
    lengths with one another. Each repeated row counts as a vector of its own. Null
    ids count as links but never name a component. Other columns are not read.
    """
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = "float" if element == "float" else "double"
    stored = np.dtype("<f4" if kind == "float" else "<f8")
    rows = vectors.select(
        F.col(id_col).alias("_id"), F.col(vector_col).cast(f"array<{kind}>").alias("_v")
    )
    good = rows.filter(usable(F.col("_v"))).withColumn("_class", _fingerprint(F.col("_v")))
    classes = written(
        good.groupBy("_class").agg(
            F.any_value("_v").alias("_v"), F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_least")
        ),
        "vector-classes",
    )
    dims = classes.select(F.size("_v").alias("d")).groupBy("d").count()
    links = None
    for dim, n in sorted(tuple(x) for x in dims.collect()):  # one row per length in use
        part = _links_of(classes.filter(F.size("_v") == dim), n, dim, stored, threshold, tile)
        links = part if links is None else links.unionByName(part)
    alone = rows.filter(~usable(F.col("_v"))).select(
        "_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id")
    )
    if links is None:
        return _named(alone, id_col)
    links = written(links, "vector-links")
    roots = connected_components(
        links.filter("_class <> _root").select(F.col("_class").alias("a"), F.col("_root").alias("b"))
    )
    counted = links.groupBy("_class").agg(F.sum("_links").alias("_links"))
    known = (
        classes.drop("_v")
        .join(counted, "_class", "left")
        .join(roots.withColumnRenamed("node", "_class"), "_class", "left")
        .withColumn("root", F.coalesce("root", "_class"))
    )
    known = with_least(known, "root", "_class", "_least", "component_id").select(
        "_class",
        (F.coalesce("_links", F.lit(0)) + F.col("_n") - 1).cast("long").alias("n_links"),
        "component_id",
    )
    return _named(good.select("_id", "_class").join(known, "_class").drop("_class").unionByName(alone), id_col)


def _fingerprint(vector: Column) -> Column:
    """128 bits of a vector, as text. Adding 0 makes -0.0 equal 0.0."""
    plain = F.transform(vector, lambda x: x + F.lit(0).cast("float"))
    return F.concat(F.lpad(F.hex(F.xxhash64(plain)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(1), plain)), 16, "0"))


def _named(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(
        F.col("_id").alias(id_col),
        "n_links",
        F.col("component_id").cast("long").alias("component_id"),
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _links_of(
    classes: DataFrame, n: int, dim: int, stored: np.dtype, threshold: float, tile: int
) -> DataFrame:
    """(_class, _root, _links): partial results of all tile pairs."""
    spark = classes.sparkSession
    chosen = classes.orderBy("_class").limit(max(1, min(MAX_PIVOTS, round(n / tile)))).select("_v")
    pivots = unit(np.array([x[0] for x in chosen.collect()], dtype=np.float64).reshape(-1, dim))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                values = np.stack([np.asarray(v) for v in batch["_v"]]).astype(stored)
                cell, angle = _cells(unit(values), pivots)
                blobs = [v.tobytes() for v in values]
                yield pd.DataFrame(
                    {"_class": batch["_class"], "_n": batch["_n"], "_b": blobs, "_cell": cell, "_angle": angle}
                )

    dealt = written(
        classes.select("_class", "_n", "_v").mapInPandas(
            deal, "_class string, _n long, _b binary, _cell int, _angle double"
        ),
        "vector-cells",
    )
    sizes = dealt.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"), F.max("_angle").alias("_radius"))
    found = {r["_cell"]: (r["_size"], r["_radius"]) for r in sizes.collect()}  # one row per pivot
    cells = sorted(found)
    radius = np.array([found[c][1] for c in cells])
    between = np.arccos(np.clip(pivots[cells] @ pivots[cells].T, -1, 1))
    reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-6
    near = between - radius[:, None] - radius[None, :] <= reach
    parts = {c: -(-found[c][0] // tile) for c in cells}
    tiles = spark.createDataFrame(
        [(c, p) for c, p in parts.items()], "_cell int, _parts int"
    )
    packed = written(
        dealt.join(F.broadcast(tiles), "_cell")
        .withColumn("_part", F.expr("pmod(xxhash64(_class), _parts)").cast("int"))
        .groupBy("_cell", "_part")
        .applyInPandas(
            lambda g: pd.DataFrame(
                {
                    "_cell": [int(g["_cell"].iloc[0])],
                    "_part": [int(g["_part"].iloc[0])],
                    "_names": [list(g["_class"])],
                    "_counts": [list(g["_n"])],
                    "_blob": [b"".join(g["_b"])],
                }
            ),
            "_cell int, _part int, _names array<string>, _counts array<long>, _blob binary",
        ),
        "vector-tiles",
    )
    neighbours = spark.createDataFrame(
        [(cells[i], [cells[j] for j in np.nonzero(near[i])[0]]) for i in range(len(cells))],
        "_cell int, _others array<int>",
    )
    keys = packed.select("_cell", "_part")
    ahead = (
        keys.join(neighbours, "_cell")
        .select("_cell", "_part", F.explode("_others").alias("_cell2"))
        .join(keys.select(F.col("_cell").alias("_cell2"), F.col("_part").alias("_part2")), "_cell2")
        .filter("struct(_cell, _part) <= struct(_cell2, _part2)")
    )
    right = packed.select(*[F.col(c).alias(f"{c}2") for c in packed.columns])
    # Keys first, then tiles; many small partitions keep few tiles in a task.
    pairs = ahead.repartition("_cell", "_part", "_cell2", "_part2")
    pairs = pairs.join(packed, ["_cell", "_part"]).join(right, ["_cell2", "_part2"])

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                same = (row["_cell"], row["_part"]) == (row["_cell2"], row["_part2"])
                left = np.frombuffer(row["_blob"], stored).reshape(-1, dim)
                other = np.frombuffer(row["_blob2"], stored).reshape(-1, dim)
                names = np.array([*row["_names"], *([] if same else row["_names2"])], dtype=object)
                counts = np.array([*row["_counts"], *([] if same else row["_counts2"])])
                shift = 0 if same else len(left)
                root, links = np.arange(len(names)), np.zeros(len(names), dtype=np.int64)
                for x, y in linked_pairs(left, other, threshold, same):
                    y = y + shift
                    np.add.at(links, x, counts[y])
                    np.add.at(links, y, counts[x])
                    root = forest(len(names), x, y, root)
                linked = np.nonzero(links)[0]
                yield pd.DataFrame(
                    {"_class": names[linked], "_root": names[root[linked]], "_links": links[linked]}
                )

    return pairs.select(
        "_cell", "_part", "_cell2", "_part2", "_names", "_counts", "_blob", "_names2", "_counts2", "_blob2"
    ).mapInPandas(multiply, "_class string, _root string, _links long")
