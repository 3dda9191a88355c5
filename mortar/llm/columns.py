"""Columns shared by the operators: row keys that do not clash with the caller's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name the table does not have yet (names compare without case in Spark)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def row_key(*columns: str) -> Column:
    """128-bit key of a row from its id and text.  Rows that agree in all of these share the key."""
    parts = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[F.when(p.isNull(), F.lit("1")).otherwise(F.lit("0")) for p in parts])
    return F.struct(F.xxhash64(nulls, *parts).alias("a"), F.xxhash64(F.lit(7), *parts, nulls).alias("b"))


def text_key(text: Column) -> Column:
    """128-bit key of a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))
