"""Rows dealt into buckets of ascending ids, each bucket a bounded share of the rows."""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a bucket to aim at, and most buckets (their bounds are literals of the plan).
ROWS, MOST_BUCKETS = 4096, 2000


def cut_points(df: DataFrame, column: str, rows: int = ROWS, most: int = MOST_BUCKETS) -> list[int]:
    """Ascending values that cut a numeric column into buckets of about ``rows`` rows, from approximate quantiles."""
    n = df.count()
    buckets = min(most, -(-n // rows))
    if buckets < 2:
        return []
    shares = [k / buckets for k in range(1, buckets)]
    values = df.filter(F.col(column).isNotNull()).approxQuantile(column, shares, 0.2 / buckets)
    return sorted({int(v) for v in values})


def bucket(column: Column, cuts: list[int]) -> Column:
    """Number of cut points below a value (0 for null): a balanced tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(column <= cuts[mid], tree(low, mid)).otherwise(tree(mid + 1, high))

    if not cuts:
        return F.when(column.isNull(), F.lit(0)).otherwise(F.lit(0))
    return F.when(column.isNull(), F.lit(0)).otherwise(tree(0, len(cuts)))


def bucket_of(value: int | None, cuts: list[int]) -> int:
    """The same for a value on the driver."""
    return 0 if value is None else bisect_left(cuts, value)
