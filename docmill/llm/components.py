"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions.salts import salt, salt_list, used_salts
from docmill.llm.common import done_with, written

#: Tasks that the rows of one group are spread over.
SALTS = 64


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of an edge, root the smallest node it reaches.

    Each round hangs the larger neighbours of a node under its smallest neighbour,
    then the smaller ones; all of it as aggregations and joins, so neither a hub nor
    a large component meets in one task. The number of rounds grows with the
    logarithm of the longest path. Both halves of a round are written to the shared
    folder: in one plan, each step would hold the step before it twice, and the driver
    plans all of it anew after each stage.
    """
    stars = written(_canonical(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    n = stars.count()
    while True:
        least = with_least(_pairs(stars, ("u", "v"), ("v", "u")), "u", "v", "v", "m")
        least = least.withColumn("m", F.least("m", "u"))
        large = least.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(_canonical(large), "large-stars")
        small = _pairs(with_least(large, "u", "v", "v", "m"), ("u", "m"), ("v", "m"))
        following = written(_canonical(small), "edges")
        done_with(large)
        before, n = n, following.count()
        if n == before and not following.exceptAll(stars).take(1):
            break
        stars = following
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )


def with_least(rows: DataFrame, group: str, by: str, value: str, out: str, salts: int = SALTS) -> DataFrame:
    """Add the least ``value`` of each row's group, which may hold any share of all rows.

    Rows are told apart by ``by``. A group's one result goes to each salt that its rows
    use, so the group's rows meet it in as many tasks.
    """
    salted = rows.withColumn("_salt", salt(by, salts))
    noted = used_salts("_salt", salts)
    least = salted.groupBy(group).agg(
        F.min(value).alias(out), *[bits.alias(name) for name, bits in noted.items()]
    )
    least = least.select(group, out, F.explode(salt_list(salts)).alias("_salt"))
    return salted.join(least, [group, "_salt"]).drop("_salt")


def _pairs(rows: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """(u, v) for each of the pairs of columns, from one reading of the rows."""
    pairs = [F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in columns]
    return rows.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*")


def _canonical(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, each once, without loops."""
    return (
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
