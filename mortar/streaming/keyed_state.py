"""The newest delivery of every key as streaming state.

A streaming aggregation holds one row a key in the state store and gives out, batch by batch, the keys whose newest row
has changed.  They land in a change log (a folder a batch, so a replayed batch overwrites itself), which is folded into
the stored table from time to time.  What is read is the table and the few batches since; no delivery is reduced again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from mortar.operators.history import keep_last
from mortar.sources import history_table

BATCH = "_batch"


@dataclass(frozen=True)
class KeyedState:
    """Where the state of a stream is kept: folder, key columns (``DealID`` among them), and what orders a key's deliveries.

    ``retire_on`` names a timestamp among the keys: once the stream is past it by more than ``delay``, its keys leave the
    state store, and deliveries for them that come later still are left out.  Without it every key stays.
    """

    path: str
    keys: Sequence[str]
    ordinal: Sequence[str]
    retire_on: str | None = None
    delay: str = "0 seconds"

    def newest(self, stream: DataFrame) -> DataFrame:
        """One row a key: the delivery of the greatest ordinal, of equal ones that of the greatest values."""
        values = [c for c in stream.columns if c not in self.keys]
        order = [*self.ordinal, *(c for c in values if c not in self.ordinal)]
        if self.retire_on:
            stream = stream.withWatermark(self.retire_on, self.delay)
        best = F.max_by(F.struct(*values), F.struct(*order)).alias("_best")
        return stream.groupBy(*self.keys).agg(best).select(*self.keys, *[F.col(f"_best.{c}").alias(c) for c in values])

    def run(self, stream: DataFrame) -> list[dict]:
        """Take in everything that has arrived; returns the progress of the batches."""

        def land(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.path}/changes/{BATCH}={number}")

        query = (
            self.newest(stream).writeStream.outputMode("update").foreachBatch(land)
            .option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query.recentProgress

    def _changes(self, spark: SparkSession, schema: T.StructType) -> tuple[DataFrame, list[str]]:
        """Changes that are not folded in yet, newest batch last, and their folders."""
        system, make = history_table._files(spark, self.path)
        log = make(f"{self.path}/changes")
        found = [f.getPath().toString() for f in system.listStatus(log)] if system.exists(log) else []
        # a folder counts once its job has been committed
        found = [f for f in found if system.exists(make(f"{f}/_SUCCESS"))]
        wide = T.StructType([*schema, T.StructField(BATCH, T.LongType())])
        if not found:
            return spark.createDataFrame([], wide), []
        return spark.read.schema(wide).option("basePath", f"{self.path}/changes").parquet(*found), found

    def fold(self, spark: SparkSession, schema: T.StructType) -> None:
        """Put the changes into the stored table and remove them.  A fold that is cut short is repeated without harm."""
        changes, folders = self._changes(spark, schema)
        if not folders:
            return
        history_table.merge_into(keep_last(changes, self.keys, BATCH).drop(BATCH), f"{self.path}/table", self.keys)
        system, make = history_table._files(spark, self.path)
        for folder in folders:
            system.delete(make(folder), True)
        history_table.remove_old(spark, f"{self.path}/table")

    def current(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The newest row of every key."""
        changes, folders = self._changes(spark, schema)
        stored = history_table.read_history(spark, f"{self.path}/table")
        if stored is not None:
            if not folders:
                return stored
            changes = changes.unionByName(stored.withColumn(BATCH, F.lit(-1).cast("long")))
        return keep_last(changes, self.keys, BATCH).drop(BATCH)
