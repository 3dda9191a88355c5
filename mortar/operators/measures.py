"""Report measures: named aggregate expressions evaluated under any grouping and filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from mortar.functions.averages import divide, wavg_total
from mortar.operators.prep import BUY_TO_LET, INTEREST_ONLY

# fixed values: account states that count as default or possession
DEFAULT_STATES = ("Default / Foreclosure", "Repossessed")


def loan_measures() -> dict[str, Column]:
    """Measures over curated loans."""
    c = F.col
    bal = c("CurrentBalance")
    where = lambda pred: F.sum(F.when(pred, bal))
    part = lambda pred: divide(where(pred), F.sum(bal))
    arrears = c("MonthsInArrears")
    return {
        "CurrentBalance": F.sum(bal),
        "OriginalBalance": F.sum("OrigBalance"),
        "LoanCount": F.countDistinct("LoanID"),
        "AvgLoanSize": divide(F.sum(bal), F.countDistinct("LoanID")),
        "PoolFactor": divide(F.sum(bal), F.sum("OrigBalance")),
        "WA_Coupon": wavg_total(c("CurrentRate"), bal),
        "WA_Margin": wavg_total(c("Margin"), bal),
        "WA_CurrentLTV": wavg_total(c("CurrentLTV_pct"), bal),
        "WA_OriginalLTV": wavg_total(c("OrigLTV_pct"), bal),
        "WA_Seasoning": wavg_total(c("SeasoningMonths"), bal),
        "WA_RemainingTerm": wavg_total(c("RemainingTermMonths"), bal),
        "Pct_InterestOnly": part(c("IsInterestOnly") == INTEREST_ONLY),
        "Pct_BuyToLet": part(c("IsBTL") == BUY_TO_LET),
        "ArrearsBalance": F.sum("ArrearsBalance"),
        "DelinquentBalance_1m": where(arrears >= 1),
        "Pct_Delinquent_1m": part(arrears >= 1),
        "SeriousArrearsBalance_3m": where(arrears > 3),
        "Pct_SeriousArrears_3m": part(arrears > 3),
        "Pct_Default": part(c("AccountStatus").isin(*DEFAULT_STATES)),
        "Pct_90DPD": part(arrears >= 3),
        "SMM_PartialPrepay": divide(F.sum("PrepayAmountMonth"), F.sum(bal)) * 100,
    }


def exit_measures() -> dict[str, Column]:
    """Measures over curated exits."""
    c = F.col
    return {
        "DefaultBalance": F.sum("DefaultBalance"),
        "LossOnSale": F.sum("LossOnSale"),
        "Recoveries": F.sum("SalePrice"),
        "LossSeverity": divide(F.sum("LossOnSale"), F.sum("DefaultBalance")),
        "RecoveryRate": divide(F.sum("SalePrice"), F.sum("DefaultBalance")),
        "DefaultsCount": F.count_if(c("IsDefault") == 1),
        "RedemptionsCount": F.count_if(c("IsRedemption") == 1),
    }


def history_measures() -> dict[str, Column]:
    """Measures over pool history and delinquency history."""
    cpr = divide(F.avg("CPR_1m"), F.lit(100))
    return {
        "CPR_1M": F.avg("CPR_1m"),
        "CPR_3M": F.avg("CPR_3m"),
        "CPR_12M": F.avg("CPR_12m"),
        "SMM": 1 - F.pow(1 - cpr, F.lit(1 / 12)),
        "CDR_1M": F.avg("CDR_1m"),
        "CDR_Lifetime": F.avg("CDR_Lifetime"),
        "CumulativeLossSeverity": F.avg("CumLossSeverity"),
        "HistoryBalance": F.sum("CurrentBalance"),
        "HistoryWACoupon": F.avg("WA_Coupon"),
        "HistoryWALTV": F.avg("WA_CurrentLTV"),
        "HistoryPctDelinquent": F.avg("Pct_Delinquent_1m_plus"),
        "BucketBalance": F.sum("Balance"),
        "BucketPct": F.avg("PctBalance"),
    }


def evaluate(
    df: DataFrame, measures: dict[str, Column], names: Sequence[str], by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """The named measures per ``by`` under the filter ``where`` (one row without ``by``)."""
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*by).agg(*[measures[n].alias(n) for n in names])


def bucket_share(loans: DataFrame, by: Sequence[str], bucket: str = "DelinquencyBucket") -> DataFrame:
    """Balance per bucket and its part of the total that ignores the bucket."""
    rows = loans.groupBy(*by, bucket).agg(F.sum("CurrentBalance").alias("Balance"))
    return rows.withColumn("BucketPct", divide(F.col("Balance"), F.sum("Balance").over(Window.partitionBy(*by))))


def psa_equivalent(history: DataFrame, loans: DataFrame, by: Sequence[str]) -> DataFrame:
    """Reported one-month CPR against the standard ramp at the pool's seasoning."""
    cpr = evaluate(history, history_measures(), ["CPR_1M"], by)
    age = evaluate(loans, loan_measures(), ["WA_Seasoning"], by)
    ramp = F.when(F.col("WA_Seasoning").isNotNull(), F.least(F.lit(0.2) * F.col("WA_Seasoning"), F.lit(6.0)))
    return cpr.join(age, list(by), "left").withColumn("PSA", divide(F.col("CPR_1M"), ramp) * 100)


def kpi_latest_period(pool: DataFrame, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Pool figures at the latest cut-off that the filter leaves."""
    rows = pool if where is None else pool.filter(where)
    per_date = rows.groupBy(*by, "CutoffDate").agg(
        F.sum("TotalBalance").alias("PoolBalance"),
        F.sum("LoanCount").alias("TotalLoans"),
        F.avg("WA_LTV").alias("WA_LTV"),
        F.avg("WA_InterestRate").alias("WA_IntRate"),
    )
    names = ["PoolBalance", "TotalLoans", "WA_LTV", "WA_IntRate"]
    return per_date.groupBy(*by).agg(
        F.max("CutoffDate").alias("LatestCutoff"), *[F.max_by(n, "CutoffDate").alias(n) for n in names]
    )
