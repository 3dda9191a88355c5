"""Exports in one order over all their part files.

Bounds are sampled, rows are dealt by range and sorted within, so part 1 ends before part 2 begins whatever the size of the
table; no task sees more than its range.  Rows that agree in all sort columns meet in one part, so the order should end in
a column that tells them apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mortar.sources.history_table import _files


def write_ordered(df: DataFrame, path: str, order: Sequence[str | Column], kind: str = "parquet", ranges: int | None = None) -> None:
    """Replace an export: numbered part files that follow each other in the order of the given columns.

    ``ranges`` is the number of parts; without it they are as many as the session's shuffle partitions, or fewer.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = df.repartitionByRange(*([ranges] if ranges else []), *columns).sortWithinPartitions(*columns)
    rows.write.mode("overwrite").option("header", True).format(kind).save(path)


def part_files(spark: SparkSession, path: str) -> list[str]:
    """Part files in the order of their rows: the number is in the name."""
    system, make = _files(spark, path)
    found = [f.getPath() for f in system.listStatus(make(path)) if f.getPath().getName().startswith("part-")]
    return [p.toString() for p in sorted(found, key=lambda p: int(p.getName().split("-")[1].split(".")[0]))]


def parts(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet") -> Iterator[DataFrame]:
    """The export part by part, in order."""
    for file in part_files(spark, path):
        yield spark.read.schema(schema).option("header", True).format(kind).load(file)


def read_ordered(spark: SparkSession, path: str, schema: T.StructType, place: str) -> DataFrame:
    """A Parquet export with the place of every row in it, from 1: rows of the parts before, and the row's own in its part."""
    rows = spark.read.schema(schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    counts = {r["_file"]: r["n"] for r in rows.groupBy("_file").agg(F.count("*").alias("n")).collect()}  # one row a part
    before, known = 0, []
    for file in part_files(spark, path):
        name = file.rsplit("/", 1)[-1]
        known.append((name, before))
        before += counts.get(name, 0)
    if not known:
        return rows.withColumn(place, F.lit(None).cast("long")).drop("_file", "_row")
    starts = spark.createDataFrame(known, "_file string, _before long")
    return rows.join(starts, "_file").withColumn(place, F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")
