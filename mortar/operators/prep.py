"""Monthly preparation path: curated loan and exit tables and the pool history row of each tape.

Labels, bands and weighted averages differ from the marts on purpose; see the README.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mortar.functions import bands
from mortar.functions.averages import divide, wavg_strict
from mortar.functions.casts import decode, decode_number, money, number
from mortar.functions.dates import month_steps, parse_date, parse_origination, period
from mortar.sources.seeds import DQ_BUCKETS, PREP_LABELS
from mortar.sources.tape import with_fields

TAPE_SOURCE = "Tape (loan-level)"
GROUP = ("DealID", "CutoffDate")
INTEREST_ONLY, BUY_TO_LET = "Interest Only", "Buy-to-Let"

# fixed values: curated column -> (tape field, label set, label of an unknown code)
DECODED = {
    "IncomeVerification": ("AR27", "income_verification", "No Data"),
    "OrigChannel": ("AR58", "channel", "No Data"),
    "Purpose": ("AR59", "purpose", "No Data"),
    "RepaymentMethod": ("AR69", "repayment", "Other"),
    "RateType": ("AR107", "rate_type", "Other"),
    "RateIndex": ("AR108", "rate_index", "Other"),
    "Occupancy": ("AR130", "occupancy", "No Data"),
    "PropertyType": ("AR131", "property_type", "No Data"),
    "AccountStatus": ("AR166", "account_status", "Performing"),
}


# fixed values: tape fields of loans and of exits; one that no file delivers is NULL
LOAN_FIELDS = (
    "AR1 AR2 AR3 AR4 AR5 AR17 AR22 AR26 AR27 AR55 AR56 AR58 AR59 AR61 AR66 AR67 AR69 AR71 AR97 AR100 AR107 AR108 AR109 AR110"
    " AR128 AR130 AR131 AR135 AR136 AR141 AR143 AR166 AR169 AR170 AR174"
).split()
EXIT_FIELDS = "AR1 AR2 AR8 AR166 AR175 AR177 AR178 AR179 AR180".split()


def _label(name: str, default: str | None = None) -> Column:
    field, labels, fallback = DECODED[name]
    return F.coalesce(decode_number(F.col(field), PREP_LABELS[labels]), F.lit(default or fallback))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def _cutoff(tape: DataFrame, tape_keys: Sequence[str] | None) -> DataFrame:
    own = parse_date(F.col("AR1"))
    if tape_keys is None:
        return tape.withColumn("CutoffDate", own)
    latest = tape.groupBy(*tape_keys).agg(F.max(own).alias("CutoffDate"))
    # one row a tape is broadcast: joined by tape, all rows would meet in as many tasks as there are tapes
    return tape.join(F.broadcast(latest), list(tape_keys))


def prep_loans(tape: DataFrame, tape_keys: Sequence[str] | None = None) -> DataFrame:
    """Curated loans (51 columns and ``DealID``); rows without a loan id are dropped.

    ``tape_keys`` name the columns that identify a tape: its cut-off is the latest ``AR1`` on it.
    Without them every row's own ``AR1`` is taken, which is the same wherever a tape has one cut-off.
    """
    tape = with_fields(tape, LOAN_FIELDS)
    balance = money(F.col("AR67"))
    region = F.coalesce(decode(F.col("AR128"), PREP_LABELS["region"]), F.col("AR128"), F.lit(bands.UNKNOWN))
    base = _cutoff(tape.filter(F.col("AR3").isNotNull()), tape_keys).select(
        "DealID",
        F.col("AR3").alias("LoanID"),
        F.col("AR2").alias("Pool"),
        "CutoffDate",
        F.col("AR5").alias("Originator"),
        F.coalesce(decode(F.col("AR4"), PREP_LABELS["regulated"]), F.lit(bands.UNKNOWN)).alias("Regulated"),
        F.coalesce("AR17", F.lit("No Data")).alias("CreditQuality"),
        F.col("AR22").alias("FirstTimeBuyer"),
        _label("IncomeVerification").alias("IncomeVerification"),
        money(F.col("AR26")).alias("PrimaryIncome"),
        _label("OrigChannel").alias("OrigChannel"),
        _label("Purpose").alias("Purpose"),
        parse_origination(F.col("AR55")).alias("OrigDate"),
        parse_date(F.col("AR56")).alias("MaturityDate"),
        number(F.col("AR61")).alias("OrigTermMonths"),
        money(F.col("AR66")).alias("OrigBalance"),
        F.when(balance < 0, 0).otherwise(balance).cast("decimal(18,2)").alias("CurrentBalance"),
        _label("RepaymentMethod").alias("RepaymentMethod"),
        money(F.col("AR71")).alias("PaymentDue"),
        _label("RateType").alias("RateType"),
        _label("RateIndex").alias("RateIndex"),
        number(F.col("AR109")).alias("CurrentRate"),
        number(F.col("AR110")).alias("Margin"),
        region.alias("Region"),
        _label("Occupancy").alias("Occupancy"),
        _label("PropertyType").alias("PropertyType"),
        number(F.col("AR135")).alias("OrigLTV"),
        money(F.col("AR136")).alias("OrigValuation"),
        number(F.col("AR141")).alias("CurrentLTV"),
        money(F.col("AR143")).alias("CurrentValuation"),
        _label("AccountStatus").alias("AccountStatus"),
        _zero(money(F.col("AR169"))).alias("ArrearsBalance"),
        _zero(number(F.col("AR170"))).alias("MonthsInArrears"),
        _zero(money(F.col("AR97"))).alias("PrepayAmountMonth"),
        _zero(money(F.col("AR100"))).alias("CumulativePrepay"),
        F.col("AR174").alias("Litigation"),
    )
    c = F.col
    derived = base.withColumns(
        {
            "SeasoningMonths": month_steps(c("CutoffDate"), c("OrigDate")),
            "RemainingTermMonths": month_steps(c("MaturityDate"), c("CutoffDate")),
            "VintageYear": F.year("OrigDate"),
            "IsInterestOnly": F.when(c("RepaymentMethod").isin("Interest Only", "Part & Part"), INTEREST_ONLY).otherwise("Repayment"),
            "IsBTL": F.when(c("Occupancy").contains("Buy-to-Let"), BUY_TO_LET).otherwise("Owner-Occupied"),
            "Underwater": F.when(c("CurrentLTV") > 1.0, "Underwater (LTV>100%)").otherwise("In Equity"),
            "IsDelinquent": F.when(c("MonthsInArrears") >= 1, 1).otherwise(0),
            "IsSeriousArrears": F.when(c("MonthsInArrears") > 3, 1).otherwise(0),
        }
    )
    return derived.withColumns(
        {
            "LTVBand": bands.ltv_band(c("CurrentLTV")),
            "OrigLTVBand": bands.ltv_band(c("OrigLTV")),
            "SeasoningBand": bands.seasoning_band(c("SeasoningMonths")),
            "RateBand": bands.rate_band(c("CurrentRate")),
            "BalanceBand": bands.balance_band(c("CurrentBalance")),
            "DelinquencyBucket": bands.arrears_bucket(c("MonthsInArrears")),
            "CurrentLTV_pct": c("CurrentLTV") * 100,
            "OrigLTV_pct": c("OrigLTV") * 100,
        }
    )


def prep_exits(exits: DataFrame) -> DataFrame:
    """Curated exits (13 columns and ``DealID``) from the sales, redemptions and repurchases rows."""
    blank = F.col("PropertyID").isNull() | F.col("PropertyID").isin("nan", "None", "")
    base = with_fields(exits, EXIT_FIELDS).select(
        "DealID",
        F.col("AR2").alias("Pool"),
        F.col("AR8").alias("PropertyID"),
        _label("AccountStatus", "Other").alias("ExitStatus"),
        parse_date(F.col("AR175")).alias("RedemptionDate"),
        money(F.col("AR177")).alias("DefaultBalance"),
        parse_date(F.col("AR178")).alias("DefaultDate"),
        money(F.col("AR179")).alias("SalePrice"),
        money(F.col("AR180")).alias("LossOnSale"),
        parse_date(F.col("AR1")).alias("CutoffDate"),
    ).filter(~blank)
    defaulted = F.col("DefaultBalance") > 0
    return base.withColumns(
        {
            "LossSeverity": F.when(defaulted, divide(F.col("LossOnSale"), F.col("DefaultBalance"))),
            "RecoveryRate": F.when(defaulted, divide(F.col("SalePrice"), F.col("DefaultBalance"))),
            "IsDefault": F.when(defaulted, 1).otherwise(0),
            "IsRedemption": F.when(F.col("ExitStatus") == "Redeemed", 1).otherwise(0),
        }
    )


def exits_sheet(tape: DataFrame) -> DataFrame:
    """Tape rows of loans that left the pool: default, redeemed, repurchased."""
    return with_fields(tape, EXIT_FIELDS).filter(F.col("AR166").isin("3", "4", "5"))


def exits_view(fact: DataFrame) -> DataFrame:
    """Exits from the star: a default amount or a redemption; loss is net of recoveries."""
    loss = F.col("LossOnSale") - F.col("CumulativeRecoveries")
    return fact.filter((F.col("DefaultAmount") > 0) | F.col("RedemptionDate").isNotNull()).select(
        "DealID", "LoanID", "CutoffDate", "AccountStatus", "DefaultAmount", "DateOfDefault", "RedemptionDate",
        "SalePrice", "LossOnSale", "CumulativeRecoveries",
        loss.alias("NetLoss"),
        F.when(F.col("DefaultAmount") > 0, divide(loss, F.col("DefaultAmount"))).alias("LossSeverity"),
    )


def _percent(pred: Column, weight: Column) -> Column:
    return divide(_zero(F.sum(F.when(pred, weight))), F.sum(weight)) * 100


def prep_pool_summary(loans: DataFrame, exits: DataFrame) -> DataFrame:
    """The 26 history metrics of each tape."""
    c = F.col
    bal = c("CurrentBalance")
    pool = loans.groupBy(*GROUP).agg(
        F.count("*").alias("NumLoans"),
        F.sum(bal).alias("CurrentBalance"),
        F.sum("OrigBalance").alias("OriginalBalance"),
        divide(F.sum(bal), F.count(bal)).alias("AvgLoanSize"),
        divide(F.sum(bal), F.sum("OrigBalance")).alias("PoolFactor"),
        wavg_strict(c("CurrentRate"), bal).alias("WA_Coupon"),
        wavg_strict(c("Margin"), bal).alias("WA_Margin"),
        (wavg_strict(c("CurrentLTV"), bal) * 100).alias("WA_CurrentLTV"),
        (wavg_strict(c("OrigLTV"), bal) * 100).alias("WA_OrigLTV"),
        wavg_strict(c("SeasoningMonths"), bal).alias("WA_Seasoning_Months"),
        wavg_strict(c("RemainingTermMonths"), bal).alias("WA_RemainingTerm_Months"),
        F.sum("ArrearsBalance").alias("ArrearsBalance"),
        _percent(c("MonthsInArrears") >= 1, bal).alias("Pct_Delinquent_1m_plus"),
        _percent(c("MonthsInArrears") > 3, bal).alias("Pct_SeriousArrears_3m_plus"),
        _percent(c("CurrentLTV") > 1, bal).alias("Pct_Underwater"),
        _percent(c("IsInterestOnly") == INTEREST_ONLY, bal).alias("Pct_InterestOnly"),
        _percent(c("IsBTL") == BUY_TO_LET, bal).alias("Pct_BTL"),
        (divide(F.sum("PrepayAmountMonth"), F.sum(bal)) * 100).alias("SMM_PartialPrepay_proxy"),
    )
    bad = c("IsDefault") == 1
    left = exits.groupBy(*GROUP).agg(
        F.sum("IsRedemption").alias("r"),
        F.sum("IsDefault").alias("d"),
        F.sum(F.when(bad, c("DefaultBalance"))).alias("b"),
        F.sum(F.when(bad, c("LossOnSale"))).alias("l"),
    )
    return (
        pool.join(left, list(GROUP), "left")
        .withColumns(
            {
                "Period": period(c("CutoffDate")),
                "Source": F.lit(TAPE_SOURCE),
                "Redemptions_Count": _zero(c("r")),
                "Defaults_Count": _zero(c("d")),
                "Period_DefaultBalance": _zero(c("b")).cast("decimal(38,2)"),
                "Period_LossOnSale": _zero(c("l")).cast("decimal(38,2)"),
                "Period_LossSeverity": F.when(c("d") > 0, divide(_zero(c("l")), c("b")) * 100),
            }
        )
        .drop("r", "d", "b", "l")
    )


def prep_delinquency(loans: DataFrame) -> DataFrame:
    """All seven buckets per tape, also empty ones: one aggregate, then rows from its columns."""
    bal = F.col("CurrentBalance")
    aggs = []
    for i, name in enumerate(DQ_BUCKETS):
        hit = F.col("DelinquencyBucket") == name
        aggs += [
            _zero(F.sum(F.when(hit, bal))).cast("decimal(38,2)").alias(f"b{i}"),
            F.count_if(hit).alias(f"n{i}"),
        ]
    stacked = ", ".join(f"'{name}', {i + 1}, b{i}, n{i}" for i, name in enumerate(DQ_BUCKETS))
    return (
        loans.groupBy(*GROUP)
        .agg(F.sum(bal).alias("tot"), *aggs)
        .selectExpr(*GROUP, "tot", f"stack({len(DQ_BUCKETS)}, {stacked}) AS (Bucket, BucketOrder, Balance, Number)")
        .withColumns(
            {
                "PctBalance": divide(F.col("Balance"), F.col("tot")) * 100,
                "Period": period(F.col("CutoffDate")),
                "Source": F.lit(TAPE_SOURCE),
            }
        )
        .drop("tot")
    )


def month_calendar(spark, first: str = "1997-01-01", last: str = "2030-12-01") -> DataFrame:
    """One row per month with year, quarter and month labels."""
    months = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)), F.expr("INTERVAL 1 MONTH"))).alias("Date")
    )
    return months.select(
        "Date",
        F.year("Date").alias("Year"),
        F.concat(F.lit("Q"), F.quarter("Date")).alias("Quarter"),
        F.month("Date").alias("Month"),
        F.date_format("Date", "MMM").alias("MonthName"),
        F.date_format("Date", "yyyy-MM").alias("YearMonth"),
    )
