"""Group operators that stay even when one key holds a large part of all rows.

A window over a hot key sorts the whole group in one task.  These operators get the same answer
from partial aggregates plus a join, which AQE turns into a broadcast where the aggregate is small and
splits where a key is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given total order.

    Filtering ``row_number() = 1`` lets Spark keep one row per key and task before the
    shuffle, so a hot key costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """Rows dealt by key once, over so many tasks or, without a number, over the session's shuffle partitions."""
    return df.repartition(parts, *keys) if parts else df.repartition(*keys)


def with_totals(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Add per-key aggregates to every row: aggregate map-side first, then join back."""
    return df.join(df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()]), list(keys), "left")
