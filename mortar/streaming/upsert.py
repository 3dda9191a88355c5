"""Tapes as a file stream, merged by key.

Each micro-batch lands in its own ``batch`` partition of a delivery log, so a replayed batch
overwrites itself; readers take the newest delivery per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from mortar.operators.history import keep_last


def land_batches(
    stream: DataFrame, log: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df
) -> None:
    """Run the stream over everything available and append each batch to the log."""

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch).withColumn("batch", F.lit(batch_id).cast("long"))
        rows.write.partitionBy("batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(log)

    query = (
        stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def current_rows(spark: SparkSession, log: str, keys: Sequence[str], *ordinal: str, by_batch: bool = True) -> DataFrame:
    """Newest delivery per key: of the last batch, or, where rows of one key may overtake, by ``ordinal`` first."""
    order = ("batch", *ordinal) if by_batch else (*ordinal, "batch")
    return keep_last(spark.read.parquet(log), keys, *order).drop("batch")
