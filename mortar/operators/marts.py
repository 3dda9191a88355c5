"""Pool summary, stratifications and portfolio insights per deal and cut-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mortar.functions import bands
from mortar.functions.averages import divide, wavg_total
from mortar.functions.dates import month_steps

GROUP = ("DealID", "CutoffDate")

# fixed values: the default label as the reports test it, and as the code list spells it
DEFAULT_LABEL_CODED = "Defaulted"
DEFAULT_LABEL_INTENDED = "Default or Foreclosure"


def _seasoning() -> Column:
    return month_steps(F.col("CutoffDate"), F.col("LoanOriginationDate"))


def _metrics() -> dict[str, Column]:
    balance = F.col("CurrentBalance")
    return {
        "WA_LTV": wavg_total(F.col("CurrentLTV"), balance),
        "WA_Rate": wavg_total(F.col("CurrentInterestRate"), balance),
        "LoansInArrears": F.count_if(F.col("MonthsInArrears") > 0),
        "ArrearsBalance": F.sum("ArrearsBalance"),
        "ArrearsRate": divide(F.sum("ArrearsBalance"), F.sum(balance)),
        "Avg_Seasoning_Months": F.avg(_seasoning()),
    }


def pool_summary(star: DataFrame) -> DataFrame:
    """Thirteen pool metrics; weighted averages divide by the whole balance."""
    balance = F.col("CurrentBalance")
    return star.groupBy(*GROUP).agg(
        F.count("*").alias("LoanCount"),
        F.sum(balance).alias("TotalBalance"),
        divide(F.sum(balance), F.count(balance)).alias("AvgBalance"),
        wavg_total(F.col("CurrentInterestRate"), balance).alias("WA_InterestRate"),
        wavg_total(F.col("CurrentLTV"), balance).alias("WA_LTV"),
        wavg_total(_seasoning(), balance).alias("WA_Seasoning_Months"),
        F.sum("ArrearsBalance").alias("TotalArrearsBalance"),
        divide(F.sum("ArrearsBalance"), F.sum(balance)).alias("ArrearsRate"),
        F.count_if(F.col("MonthsInArrears") > 0).alias("LoansInArrears"),
        F.sum("PrepaymentAmount").alias("TotalPrepayment"),
        F.sum("CumulativePrepayments").alias("TotalCumulativePrepayments"),
    )


def stratify(df: DataFrame, band: dict[str, Column], metrics: list[str]) -> DataFrame:
    """One row per group and band with count, balance, share of the group's balance and the metrics.

    The bands become columns before grouping, so a band may carry the name of the column it is
    made from.  The share is a window over the few aggregated rows of a group.
    """
    table = _metrics()
    rows = df.withColumns(band).groupBy(*GROUP, *band).agg(
        F.count("*").alias("LoanCount"),
        F.sum("CurrentBalance").alias("Balance"),
        *[table[m].alias(m) for m in metrics],
    )
    whole = F.sum("Balance").over(Window.partitionBy(*GROUP))
    return rows.withColumn("Balance_Pct", divide(F.col("Balance"), whole))


def strat_ltv(fact: DataFrame) -> DataFrame:
    ltv = F.col("CurrentLTV")
    band = {"LTV_Band": bands.mart_ltv_band(ltv), "Band_Order": bands.mart_ltv_order(ltv)}
    return stratify(fact, band, ["WA_LTV", "WA_Rate", "LoansInArrears", "ArrearsBalance"])


def strat_delinquency(fact: DataFrame, default_label: str = DEFAULT_LABEL_CODED) -> DataFrame:
    months, status = F.col("MonthsInArrears"), F.col("AccountStatus")
    band = {
        "Delinquency_Bucket": bands.mart_delinquency_bucket(months, status, default_label),
        "Bucket_Order": bands.mart_delinquency_order(months, status, default_label),
    }
    return stratify(fact, band, ["ArrearsBalance", "WA_LTV"])


def strat_seasoning(star: DataFrame) -> DataFrame:
    band = {
        "Seasoning_Band": bands.mart_seasoning_band(_seasoning()),
        "Band_Order": bands.mart_seasoning_order(_seasoning()),
    }
    return stratify(star, band, ["Avg_Seasoning_Months", "LoansInArrears", "ArrearsRate"])


def strat_label(star: DataFrame, column: str) -> DataFrame:
    """Strat over a decoded attribute: ``Region``, ``OccupancyType`` or ``RepaymentMethod``."""
    band = {column: F.coalesce(F.col(column), F.lit(bands.UNKNOWN))}
    return stratify(star, band, ["WA_LTV", "WA_Rate", "LoansInArrears", "ArrearsBalance"])


STAR_COLUMNS = ["Region", "OccupancyType", "RepaymentMethod", "LoanOriginationDate"]


def strat_all(star: DataFrame) -> DataFrame:
    """All six strats in one pass: ``(DealID, CutoffDate, Dimension, Band)`` with count, balance and share.

    Loans are first counted per combination of all bands; the grouping sets then expand only those
    combinations, not the loans.
    """
    label = lambda c: F.coalesce(F.col(c), F.lit(bands.UNKNOWN))
    band = {
        "LTV": bands.mart_ltv_band(F.col("CurrentLTV")),
        "Delinquency": bands.mart_delinquency_bucket(
            F.col("MonthsInArrears"), F.col("AccountStatus"), DEFAULT_LABEL_CODED
        ),
        "Region": label("Region"),
        "Seasoning": bands.mart_seasoning_band(_seasoning()),
        "Occupancy": label("OccupancyType"),
        "Repayment": label("RepaymentMethod"),
    }
    names = list(band)
    cells = (
        star.select(*GROUP, "CurrentBalance", *[c.alias(n) for n, c in band.items()])
        .groupBy(*GROUP, *names)
        .agg(F.count("*").alias("n"), F.sum("CurrentBalance").alias("b"))
    )
    sets = [[F.col(g) for g in GROUP] + [F.col(n)] for n in names]
    rolled = cells.groupingSets(sets, *[F.col(g) for g in GROUP], *[F.col(n) for n in names]).agg(
        F.sum("n").alias("LoanCount"), F.sum("b").alias("Balance")
    )
    dimension = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in names])
    whole = F.sum("Balance").over(Window.partitionBy(*GROUP, "Dimension"))
    return (
        rolled.select(
            *GROUP, dimension.alias("Dimension"), F.coalesce(*[F.col(n) for n in names]).alias("Band"), "LoanCount", "Balance"
        )
        .withColumn("Balance_Pct", divide(F.col("Balance"), whole))
    )


def portfolio_insights(star: DataFrame) -> DataFrame:
    """Interest-only share and its LTV, pre-2010 share, share at 90% LTV or more, two largest regions."""
    balance = F.col("CurrentBalance")
    io = F.col("RepaymentMethod") == "Interest Only"
    per_region = star.groupBy(*GROUP, "Region").agg(
        F.sum(balance).alias("bal"),
        F.sum(F.when(io, balance)).alias("io_bal"),
        F.sum(F.when(io, balance.cast("double") * F.col("CurrentLTV").cast("double"))).alias("io_ltv"),
        F.sum(F.when(F.col("LoanOriginationDate") < "2010-01-01", balance)).alias("old_bal"),
        F.sum(F.when(F.col("CurrentLTV") >= 0.9, balance)).alias("high_bal"),
    )
    # at most one value per code-list region is collected
    top = F.slice(F.sort_array(F.collect_list(F.when(F.col("Region").isNotNull(), F.col("bal"))), False), 1, 2)
    top_two = F.aggregate(top, F.lit(0).cast("decimal(38,2)"), lambda a, x: (a + x).cast("decimal(38,2)"))
    return per_region.groupBy(*GROUP).agg(
        divide(F.sum("io_bal"), F.sum("bal")).alias("IO_Share"),
        divide(F.sum("io_ltv"), F.sum("io_bal")).alias("IO_WA_LTV"),
        divide(F.sum("old_bal"), F.sum("bal")).alias("Pre2010_Share"),
        divide(F.sum("high_bal"), F.sum("bal")).alias("LTV90_Share"),
        divide(top_two, F.sum("bal")).alias("Top2_Region_Share"),
    )
