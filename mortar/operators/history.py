"""Keyed history tables and comparisons between periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from mortar.functions.averages import divide
from mortar.functions.bands import arrears_bucket
from mortar.operators.grouping import dealt, pick_one


def keep_last(df: DataFrame, keys: Sequence[str], *ordinal: str) -> DataFrame:
    """Last delivery per key; ``ordinal`` must order the rows of a key totally."""
    return pick_one(df, keys, [F.col(c).desc() for c in ordinal])


def keep_first(df: DataFrame, keys: Sequence[str], *ordinal: str) -> DataFrame:
    return pick_one(df, keys, [F.col(c).asc() for c in ordinal])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], ordinal: Sequence[str] = ()) -> DataFrame:
    """New rows after old ones, the last row per key wins.  Repeating a delivery changes nothing."""
    stacked = old.withColumn("_turn", F.lit(0)).unionByName(new.withColumn("_turn", F.lit(1)), allowMissingColumns=True)
    return keep_last(stacked, keys, "_turn", *ordinal).drop("_turn")


def seed(reported: DataFrame, rows: DataFrame) -> DataFrame:
    """Reported rows put before the tape rows; columns one side lacks become NULL."""
    return reported.unionByName(rows, allowMissingColumns=True)


def replace_slice(existing: DataFrame, new: DataFrame, deal_id: str) -> DataFrame:
    """Everything but the deal's rows, plus the new rows of the deal; stored rows without a deal stay."""
    return existing.filter(~F.col("DealID").eqNullSafe(F.lit(deal_id))).unionByName(new, allowMissingColumns=True)


def _cpr(smm: Column) -> Column:
    return 1 - F.pow(1 - smm, F.lit(12.0))


def roll_forward_cpr(history: DataFrame, series: Sequence[str] = ("DealID", "Source")) -> DataFrame:
    """CPR from the balance of one cut-off to the next of each series (scheduled principal taken as 0).

    Balances are summed per cut-off first, so a series has one row per month.
    """
    monthly = history.groupBy(*series, "CutoffDate").agg(F.sum("CurrentBalance").alias("Balance"))
    window = Window.partitionBy(*series).orderBy("CutoffDate")
    rows = monthly.withColumn("PreviousBalance", F.lag("Balance").over(window))
    smm = divide(F.col("PreviousBalance") - F.col("Balance"), F.col("PreviousBalance"))
    return rows.withColumn("SMM", smm).withColumn("RollForwardCPR", _cpr(F.col("SMM")) * 100)


def period_on_period(fact: DataFrame) -> DataFrame:
    """Pool-level prepayment and default speed against the balance of the previous cut-off."""
    new_default = F.date_trunc("month", "DateOfDefault") == F.date_trunc("month", "CutoffDate")
    monthly = fact.groupBy("DealID", "CutoffDate").agg(
        F.sum("CurrentBalance").alias("Balance"),
        F.sum("PrepaymentAmount").alias("Prepayment"),
        F.sum(F.when(new_default, F.col("DefaultAmount"))).alias("NewDefaults"),
    )
    window = Window.partitionBy("DealID").orderBy("CutoffDate")
    previous = F.lag("Balance").over(window)
    return monthly.withColumn("PreviousBalance", previous).withColumns(
        {
            "BalanceChange": F.col("Balance") - F.col("PreviousBalance"),
            "CPR": _cpr(divide(F.col("Prepayment"), F.col("PreviousBalance"))) * 100,
            "CDR": _cpr(divide(F.coalesce("NewDefaults", F.lit(0)), F.col("PreviousBalance"))) * 100,
        }
    )


def _migration(pairs: DataFrame, group: Sequence[str]) -> DataFrame:
    cells = pairs.groupBy(*group, "FromBucket", "ToBucket").agg(
        F.count("*").alias("Loans"), F.sum("CurrentBalance").alias("Balance")
    )
    row = F.sum("Loans").over(Window.partitionBy(*group, "FromBucket"))
    return cells.withColumn("RowShare", divide(F.col("Loans"), row))


def arrears_migration(fact: DataFrame, months_ago: int = 1) -> DataFrame:
    """Movement between arrears buckets from the figures one tape carries (1 or 2 months ago)."""
    before = {1: "Arrears1MonthAgo", 2: "Arrears2MonthsAgo"}[months_ago]
    pairs = fact.select(
        "DealID", "CutoffDate", "CurrentBalance",
        arrears_bucket(F.col(before)).alias("FromBucket"),
        arrears_bucket(F.col("MonthsInArrears")).alias("ToBucket"),
    )
    return _migration(pairs, ["DealID", "CutoffDate"])


def arrears_migration_periods(fact: DataFrame, parts: int | None = None) -> DataFrame:
    """Movement between arrears buckets from each loan's previous period.

    A loan is reduced to one row per cut-off before the window, which bounds the window's groups
    by the number of cut-offs; rows without a loan id have no previous period.  Rows are dealt by loan
    once, over ``parts`` tasks: grouping and window both find theirs together.
    """
    newest = F.max(F.struct("MonthsInArrears", "CurrentBalance"))
    rows = fact.filter(F.col("LoanID").isNotNull()).select("DealID", "LoanID", "CutoffDate", "MonthsInArrears", "CurrentBalance")
    per_period = (
        dealt(rows, parts, "LoanID", "DealID")
        .groupBy("DealID", "LoanID", "CutoffDate")
        .agg(newest.alias("x"))
        .select("DealID", "LoanID", "CutoffDate", "x.CurrentBalance", arrears_bucket(F.col("x.MonthsInArrears")).alias("ToBucket"))
    )
    window = Window.partitionBy("LoanID", "DealID").orderBy("CutoffDate")
    pairs = per_period.withColumn("FromBucket", F.lag("ToBucket").over(window)).filter("FromBucket IS NOT NULL")
    return _migration(pairs, ["DealID", "CutoffDate"])


def _month(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def time_intelligence(monthly: DataFrame, value: str) -> DataFrame:
    """Prior period, same month a year ago and year to date of a monthly figure per deal."""
    series = Window.partitionBy("DealID").orderBy("CutoffDate")
    year = Window.partitionBy("DealID", F.year("CutoffDate")).orderBy("CutoffDate").rowsBetween(Window.unboundedPreceding, 0)
    # the same month whatever the day; of several cut-offs in it the last
    year_ago = monthly.groupBy("DealID", _month(F.add_months("CutoffDate", 12)).alias("_month")).agg(
        F.max_by(value, "CutoffDate").alias("YearAgo")
    )
    return (
        monthly.select(
            "DealID", "CutoffDate", value,
            F.first(value).over(series).alias("FirstPeriod"),
            F.lag(value).over(series).alias("PriorPeriod"),
            F.sum(value).over(year).alias("YearToDate"),
        )
        .withColumn("_month", _month(F.col("CutoffDate")))
        .join(year_ago, ["DealID", "_month"], "left")
        .drop("_month")
    )
