"""Conversion of documents that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from docmill import rules, schemas
from docmill.plans.batch import convert_batch
from docmill.sources.sinks import read_store, store_results, write_routed_batch


def convert_stream(
    stream: DataFrame,
    path: str,
    progress_path: str,
    id_col: str = "input_ordinal",
    max_bytes: int = rules.MAX_BYTES,
    store_path: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch's outcomes by route, once.

    A micro-batch is converted like a batch, so its equal documents share one
    conversion while they are in flight and results and errors are the same. With
    ``store_path`` conversions are kept there and reused by later micro-batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store = None if store_path is None else read_store(batch.sparkSession, store_path)
        outcomes = convert_batch(batch, store, id_col, max_bytes)
        write_routed_batch(outcomes, batch_id, path)
        if store_path is not None:
            # from what was written: a micro-batch is converted once
            written = batch.sparkSession.read.parquet(f"{path}/run_id=batch-{batch_id}")
            extras = [F.col(f"result.{name}").alias(name) for name in schemas.EXTRAS]
            fresh = written.filter("result IS NOT NULL AND NOT cache_hit").select(
                id_col, "variant_key", "options", F.col("result.markdown").alias("markdown"), *extras
            )
            store_results(fresh, store_path, id_col=id_col)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
