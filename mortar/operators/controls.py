"""Exception reports: a row is a failed check, no row means passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

KEY = ["DealID", "LoanID"]


def _exception(df: DataFrame, check: str, expected: Column, actual: Column, difference: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"),
        "DealID",
        expected.cast("string").alias("expected"),
        actual.cast("string").alias("actual"),
        difference.cast("string").alias("difference"),
    )


def _count_exception(bad: DataFrame, check: str, message: str) -> DataFrame:
    n = bad.groupBy("DealID").agg(F.count("*").alias("n"))
    return _exception(n, check, F.lit("0"), F.col("n"), F.lit(message))


def control_row_count(tape: DataFrame, dim: DataFrame, distinct_loans: bool = True) -> DataFrame:
    """Staged loans against dimension rows.

    ``distinct_loans=False`` compares raw tape rows, which fails by design once a second
    period is loaded.
    """
    staged = tape.select("DealID", "AR3")
    staged = (staged.distinct() if distinct_loans else staged).groupBy("DealID").agg(F.count("*").alias("s"))
    conformed = dim.groupBy("DealID").agg(F.count("*").alias("c"))
    both = staged.join(conformed, "DealID", "left").filter(F.col("s") != F.coalesce("c", F.lit(0)))
    return _exception(both, "ROW_COUNT_MISMATCH", F.col("s"), F.col("c"), F.col("s") - F.col("c"))


def control_balance(tape: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged balance against mart balance, tolerance 0.01; a deal that one side lacks has 0 there."""
    staged = tape.groupBy("DealID").agg(F.sum(F.col("AR67").try_cast("decimal(18,2)")).alias("s"))
    mart = fact.groupBy("DealID").agg(F.sum("CurrentBalance").alias("m"))
    both = staged.join(mart, "DealID", "full").na.fill(0, ["s", "m"]).filter(F.abs(F.col("s") - F.col("m")) > 0.01)
    return _exception(both, "BALANCE_MISMATCH", F.col("s"), F.col("m"), (F.col("s") - F.col("m")).cast("decimal(38,2)"))


def control_null_loan_id(dim: DataFrame) -> DataFrame:
    return _count_exception(dim.filter(F.col("LoanID").isNull()), "NULL_LOAN_ID", "LoanID should not be NULL")


def control_null_balance(fact: DataFrame) -> DataFrame:
    bad = fact.filter(F.col("CurrentBalance").isNull())
    return _count_exception(bad, "NULL_BALANCE", "CurrentBalance should not be NULL")


def control_orphans(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts without a loan: counted per loan first, so the anti join sees each loan once."""
    per_loan = fact.groupBy(*KEY).agg(F.count("*").alias("rows"))
    lost = per_loan.join(dim.filter(F.col("LoanID").isNotNull()).select(*KEY), KEY, "left_anti")
    n = lost.groupBy("DealID").agg(F.sum("rows").alias("n"))
    return _exception(n, "ORPHAN_FACT_ROWS", F.lit("0"), F.col("n"), F.lit("fact rows with no matching dim"))


def control_negative_balance(fact: DataFrame) -> DataFrame:
    return _count_exception(fact.filter("CurrentBalance < 0"), "NEGATIVE_BALANCE", "Loans with negative balance")


def control_unique_keys(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Duplicate keys of a table that must be unique on ``keys``."""
    dup = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    n = dup.groupBy("DealID").agg(F.count("*").alias("n"))
    return _exception(n, "DUPLICATE_KEY", F.lit("0"), F.col("n"), F.lit(f"duplicate {', '.join(keys)} in {table}"))


def control_tape_vs_report(pool: DataFrame, report: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Pool balance of the tape against the investor report of the same cut-off (relative tolerance)."""
    both = pool.select("DealID", "CutoffDate", F.col("TotalBalance").cast("double").alias("tape")).join(
        report.select("DealID", "CutoffDate", F.col("PoolBalance").alias("report")), ["DealID", "CutoffDate"]
    )
    gap = F.abs(F.col("tape") - F.col("report"))
    return both.filter(gap > tolerance * F.abs(F.col("tape"))).select(
        F.lit("TAPE_VS_REPORT").alias("check_name"), "DealID", "CutoffDate", "tape", "report",
        (F.col("tape") - F.col("report")).alias("difference"),
    )


def controls_all(tape: DataFrame, dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Every reconciliation check in one result, from one pass over each of the three tables.

    Their rows are counted per loan together, which tells staged loans and orphans, and then per deal.
    """
    amount = "decimal(18,2)"
    staged = tape.select(
        "DealID", F.col("AR3").alias("LoanID"), F.lit(1).alias("staged"), F.col("AR67").try_cast(amount).alias("s")
    )
    loans = dim.select(*KEY, F.lit(1).alias("loans"))
    balance = F.col("CurrentBalance")
    facts = fact.select(
        *KEY, F.lit(1).alias("facts"), balance.cast(amount).alias("m"),
        balance.isNull().cast("int").alias("unknown"), F.coalesce(balance < 0, F.lit(False)).cast("int").alias("negative"),
    )
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [staged, loans, facts])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    names = ["staged", "loans", "facts", "s", "m", "unknown", "negative"]
    deal = rows.groupBy(*KEY).agg(*[total(c) for c in names]).groupBy("DealID").agg(
        F.count_if(F.col("staged") > 0).alias("staged"),
        F.nullif(F.sum("loans"), F.lit(0)).alias("conformed"),
        F.sum(F.when(F.col("LoanID").isNull(), F.col("loans")).otherwise(0)).alias("no_id"),
        F.sum(F.when(F.col("LoanID").isNull() | (F.col("loans") == 0), F.col("facts")).otherwise(0)).alias("orphans"),
        F.sum("s").cast("decimal(28,2)").alias("s"), F.sum("m").cast("decimal(28,2)").alias("m"),
        F.sum("unknown").alias("unknown"), F.sum("negative").alias("negative"),
    )
    c = F.col
    count = lambda name, n, text: (name, c(n) > 0, F.lit("0"), c(n), F.lit(text))
    checks = [
        ("ROW_COUNT_MISMATCH", (c("staged") > 0) & (c("staged") != F.coalesce("conformed", F.lit(0))), c("staged"), c("conformed"), c("staged") - c("conformed")),
        ("BALANCE_MISMATCH", F.abs(c("s") - c("m")) > 0.01, c("s"), c("m"), (c("s") - c("m")).cast("decimal(38,2)")),
        count("NULL_LOAN_ID", "no_id", "LoanID should not be NULL"),
        count("NULL_BALANCE", "unknown", "CurrentBalance should not be NULL"),
        count("ORPHAN_FACT_ROWS", "orphans", "fact rows with no matching dim"),
        count("NEGATIVE_BALANCE", "negative", "Loans with negative balance"),
    ]
    failed = [
        F.struct(
            F.lit(name).alias("check_name"), bad.alias("bad"), expected.cast("string").alias("expected"),
            actual.cast("string").alias("actual"), difference.cast("string").alias("difference"),
        )
        for name, bad, expected, actual, difference in checks
    ]
    each = deal.select("DealID", F.explode(F.array(*failed)).alias("x")).filter("x.bad")
    return each.select("x.check_name", "DealID", "x.expected", "x.actual", "x.difference")
