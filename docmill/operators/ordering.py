"""A total order over rows, held in blocks of even size.

Windows and replays that need the rows of a key in order must not put all rows
of one key into one task. Rows are range-partitioned by key and order together,
so a large key spans many blocks, and written once: the blocks then stay the
same for every job that reads them, also after an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docmill.session import cut

BLOCK, ROW, POSITION = "_block", "_row", "_position"


def in_blocks(df: DataFrame, by: list[str], blocks: int | None = None) -> DataFrame:
    """Sort by ``by`` and add the block number; one partition is one block.

    ``by`` must tell rows apart, so that no value of it can outgrow a block.
    """
    sizing = [] if blocks is None else [blocks]
    return cut(
        df.repartitionByRange(*sizing, *by)
        .sortWithinPartitions(*by)
        .withColumns(
            {
                BLOCK: F.spark_partition_id(),
                ROW: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
    )


def with_positions(df: DataFrame, by: list[str], blocks: int | None = None) -> DataFrame:
    """Add each row's position in the total order.

    The only thing joined is one row per block, the number of rows before it.
    """
    rows = in_blocks(df, by, blocks)
    before = W.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(BLOCK)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(BLOCK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        rows.join(F.broadcast(offsets), BLOCK)
        .withColumn(POSITION, F.col("_before") + F.col(ROW))
        .drop("_before", BLOCK, ROW)
    )
