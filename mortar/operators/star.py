"""The star: ``dim_loan``, ``fact_loan_period`` and their join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mortar.operators.conform import FORMATS, conform_dim_loan, conform_fact_loan_period
from mortar.sources.seeds import deals


def dim_loan(tape: DataFrame, formats=FORMATS) -> DataFrame:
    return conform_dim_loan(tape, *formats)


def fact_loan_period(tape: DataFrame, formats=FORMATS) -> DataFrame:
    return conform_fact_loan_period(tape, *formats)


def keyed_facts(fact: DataFrame) -> DataFrame:
    """Facts with the key ``_loan``; those without a loan id are spread over 1,024 keys that no loan has."""
    salt = F.pmod(F.xxhash64("CutoffDate", "CurrentBalance", "ArrearsBalance"), F.lit(1024)).cast("string")
    return fact.withColumn("_loan", F.coalesce(F.col("LoanID"), F.concat(F.lit("no loan id "), salt)))


def attributes(dim: DataFrame, columns: list[str]) -> DataFrame:
    """Loan attributes by the same key."""
    return dim.filter(F.col("LoanID").isNotNull()).select("DealID", F.col("LoanID").alias("_loan"), *columns)


def star_join(fact: DataFrame, dim: DataFrame, columns: list[str], parts: int | None = None) -> DataFrame:
    """Facts with the given loan attributes; facts without a loan keep NULL attributes.

    A missing loan id matches nothing, so such facts get a spread-out join key: however many
    there are, they do not meet in one task.  A hot loan is split by AQE.

    ``parts`` deals both sides over that many tasks, for tables whose share of the session's shuffle partitions is too
    large for a task.  AQE does not split what is dealt by number.
    """
    sides, keys = [keyed_facts(fact), attributes(dim, columns)], ["DealID", "_loan"]
    if parts:
        sides = [side.repartition(parts, *keys) for side in sides]
    return sides[0].join(sides[1], keys, "left").drop("_loan")


def dim_deal(spark) -> DataFrame:
    """Deal hub from the registry (a handful of rows)."""
    return deals(spark).select("DealID", "name", "asset_class", "status")


def deal_rollup(pool: DataFrame, tranches: DataFrame) -> DataFrame:
    """Latest pool figures and note totals side by side for every registered deal."""
    latest = pool.groupBy("DealID").agg(
        F.max("CutoffDate").alias("LatestCutoff"),
        F.max_by("TotalBalance", "CutoffDate").alias("PoolBalance"),
        F.max_by("LoanCount", "CutoffDate").alias("LoanCount"),
    )
    # note positions are summed per cut-off first: only a few rows per deal remain
    notes = (
        tranches.groupBy("DealID", "CutoffDate")
        .agg(F.sum("CurrentBalance").alias("NoteBalance"), F.count("*").alias("NoteCount"))
        .groupBy("DealID")
        .agg(F.max_by("NoteBalance", "CutoffDate").alias("NoteBalance"), F.max_by("NoteCount", "CutoffDate").alias("NoteCount"))
    )
    hub = dim_deal(pool.sparkSession)
    return hub.join(latest, "DealID", "left").join(notes, "DealID", "left")
