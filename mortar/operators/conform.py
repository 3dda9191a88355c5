"""Conform a deal's coded tape to the two-table star.

What differs between deals is data (:class:`DealFormat`, or a table of them), not code.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mortar.functions.casts import decode as decode_label
from mortar.functions.casts import iso_date, money, ratio, whole
from mortar.functions.dates import quarter_end
from mortar.operators.grouping import pick_one
from mortar.sources.seeds import REF_TABLES, ref_table
from mortar.sources.tape import with_fields


@dataclass(frozen=True)
class DealFormat:
    """How one deal fills its tape."""

    deal_id: str
    rate_factor: Decimal = Decimal(1)  # 0.01 when rates are printed as percent
    quarter_dates: bool = False  # origination as Q4-2006 instead of a date
    absent: frozenset[str] = frozenset()  # fields the deal never delivers
    keep_null_ids: bool = False


AVON = DealFormat("AVON2", Decimal("0.01"), True, frozenset({"AR123", "AR162", "AR173"}), keep_null_ids=True)
BLETCHLEY = DealFormat("BLETCHLEY")
FORMATS = (AVON, BLETCHLEY)

# fixed values: canonical name, tape field and code list of the decoded columns
DIM_DECODED = [
    ("EmploymentStatus", "AR21", "employment_status"),
    ("IncomeVerification", "AR27", "income_verification"),
    ("OccupancyType", "AR130", "occupancy"),
    ("OriginationChannel", "AR58", "origination_channel"),
    ("Purpose", "AR59", "loan_purpose"),
    ("RepaymentMethod", "AR69", "repayment_method"),
    ("PropertyType", "AR131", "property_type"),
    ("Region", "AR128", "region"),
]
DIM_EXTENDED_DECODED = [
    ("SharedOwnership", "AR60", "shared_ownership"),
    ("PaymentFrequency", "AR70", "payment_frequency"),
    ("Lien", "AR84", "lien"),
    ("InterestRateType", "AR107", "interest_rate_type"),
    ("OriginalValuationType", "AR137", "valuation_type"),
]
FACT_DECODED = [
    ("CurrentInterestRateIndex", "AR108", "interest_rate_index"),
    ("CurrentValuationType", "AR144", "valuation_type"),
    ("ForbearanceType", "AR123", "forbearance_type"),
    ("CurrentEPC", "AR162", "epc_rating"),
    ("AccountStatus", "AR166", "account_status"),
]
# fixed values: canonical name -> (tape field, kind)
DIM_PLAIN = {
    "LoanID": ("AR3", "text"), "BorrowerID": ("AR7", "text"), "PropertyID": ("AR8", "text"),
    "Pool": ("AR2", "text"), "Originator": ("AR5", "text"), "ServicerID": ("AR6", "text"),
    "NumberOfDebtors": ("AR19", "whole"), "PrimaryIncome": ("AR26", "money"), "SecondaryIncome": ("AR28", "money"),
    "LoanTerm": ("AR61", "whole"), "OriginalBalance": ("AR66", "money"), "OriginalLTV": ("AR135", "ratio"),
    "OriginalValuation": ("AR136", "money"), "LoanOriginationDate": ("AR55", "origination"),
    "AccountStatusDate": ("AR57", "date"), "OriginalValuationDate": ("AR138", "date"),
}
DIM_EXTENDED_PLAIN = {
    "RegulatedLoan": ("AR4", "text"), "BorrowerCreditQuality": ("AR17", "text"), "FirstTimeBuyer": ("AR22", "text"),
    "CCJUnsatisfiedNumber": ("AR33", "whole"), "GrossAnnualRentalIncome": ("AR154", "money"),
    "NumberOfBTLProperties": ("AR155", "whole"), "DebtServiceCoverageRatio": ("AR156", "ratio"),
}
FACT_PLAIN = {
    "LoanID": ("AR3", "text"), "CutoffDate": ("AR1", "date"), "CurrentBalance": ("AR67", "money"),
    "PaymentDue": ("AR71", "money"), "PrepaymentAmount": ("AR97", "money"), "CumulativePrepayments": ("AR100", "money"),
    "CurrentInterestRate": ("AR109", "rate"), "CurrentInterestRateMargin": ("AR110", "rate"),
    "InterestRateResetInterval": ("AR111", "whole"), "CurrentLTV": ("AR141", "ratio"),
    "CurrentValuation": ("AR143", "money"), "CurrentValuationDate": ("AR145", "date"),
    "ArrearsBalance": ("AR169", "money"), "MonthsInArrears": ("AR170", "ratio"),
    "Arrears1MonthAgo": ("AR171", "ratio"), "Arrears2MonthsAgo": ("AR172", "ratio"),
    "BankruptcyFlag": ("AR36", "text"), "DateOfLoanMaturity": ("AR56", "date"), "NextRevisionDate": ("AR113", "date"),
    "PerformanceArrangementDate": ("AR173", "date"), "Litigation": ("AR174", "text"),
    "RedemptionDate": ("AR175", "date"), "DefaultAmount": ("AR177", "money"), "DateOfDefault": ("AR178", "date"),
    "SalePrice": ("AR179", "money"), "LossOnSale": ("AR180", "money"), "CumulativeRecoveries": ("AR181", "money"),
}

#: a loan's rows of one cut-off are told apart by these fields (ties beyond them carry the same loan)
TIE_BREAK = ("AR8", "AR7", "AR2", "AR5", "AR6", "AR66", "AR55")


#: every tape field that the star is made of; one that no file delivers is NULL
FIELDS = sorted(
    {f for plain in (DIM_PLAIN, DIM_EXTENDED_PLAIN, FACT_PLAIN) for f, _ in plain.values()}
    | {f for decoded in (DIM_DECODED, DIM_EXTENDED_DECODED, FACT_DECODED) for _, f, _ in decoded}
)


def _deals(formats: Sequence[DealFormat], test) -> list[str]:
    return [f.deal_id for f in formats if test(f)]


def _by_deal(formats: Sequence[DealFormat], test, yes: Column, no: Column) -> Column:
    """``yes`` for the deals whose format passes the test, ``no`` for the others."""
    some = _deals(formats, test)
    if len(some) in (0, len(formats)):
        return yes if some else no
    return F.when(F.col("DealID").isin(some), yes).otherwise(no)


def _typed(field: str, kind: str, formats: Sequence[DealFormat]) -> Column:
    c = _by_deal(formats, lambda f: field in f.absent, F.lit(None).cast("string"), F.col(field))
    if kind == "rate":
        factor = F.lit(formats[0].rate_factor)
        for other in {f.rate_factor for f in formats} - {formats[0].rate_factor}:
            factor = _by_deal(formats, lambda f, v=other: f.rate_factor == v, F.lit(other), factor)
        return (ratio(c) * factor).cast("decimal(18,9)")
    if kind == "origination":
        return _by_deal(formats, lambda f: f.quarter_dates, quarter_end(c), iso_date(c))
    return {"text": lambda x: x, "whole": whole, "money": money, "ratio": ratio, "date": iso_date}[kind](c)


def decode_join(df: DataFrame, code: str, labels: DataFrame, label: str) -> DataFrame:
    """Add the label of a code column by left join to a ``(code, label)`` list.

    For lists held in tables.  Spark broadcasts the list when its size allows and shuffles otherwise.
    """
    lookup = labels.select(F.col("code").alias("_code"), F.col("label").alias(label))
    return df.join(lookup, F.col(code) == F.col("_code"), "left").drop("_code")


def _project(tape: DataFrame, typed: Callable[[str, str], Column], plain: dict, decoded: list) -> DataFrame:
    """Project the tape to canonical columns, all deals in one pass; ``typed(field, kind)`` reads a field.

    The code lists are fixed and short, so labels come from literal maps: unlike joins they vanish
    from every plan that does not look at the label.
    """
    columns = [typed(field, kind).alias(name) for name, (field, kind) in plain.items()]
    for name, field, ref in decoded:
        code = typed(field, "text")
        columns += [decode_label(code, REF_TABLES[ref]).alias(name), code.alias(f"{name}_code")]
    return tape.select("DealID", *columns)


def _conform(tape: DataFrame, formats: Sequence[DealFormat], plain: dict, decoded: list) -> DataFrame:
    return _project(tape, lambda field, kind: _typed(field, kind, formats), plain, decoded)


def deal_rows(tape: DataFrame, formats: Sequence[DealFormat]) -> DataFrame:
    """Rows of the deals that have a format; rows without a loan id only where the deal keeps them."""
    tape = with_fields(tape, FIELDS)
    keeps = _by_deal(formats, lambda f: f.keep_null_ids, F.lit(True), F.col("AR3").isNotNull())
    return tape.filter(F.col("DealID").isin(_deals(formats, lambda f: True)) & keeps)


def latest_per_loan(tape: DataFrame) -> DataFrame:
    """The tape row of the latest cut-off per ``(DealID, loan)``."""
    order = [iso_date(F.col("AR1")).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in TIE_BREAK]]
    # the loan id leads because sorting is fastest when the first key tells most rows apart
    return pick_one(tape, ["AR3", "DealID"], order)


def conform_dim_loan(tape: DataFrame, *formats: DealFormat) -> DataFrame:
    """Loan attributes of the deals, one row per loan (33 columns)."""
    return _conform(latest_per_loan(deal_rows(tape, formats)), formats, DIM_PLAIN, DIM_DECODED)


def conform_extended_dim(tape: DataFrame, *formats: DealFormat) -> DataFrame:
    """Loan attributes with the twelve further documented columns."""
    plain = {**DIM_PLAIN, **DIM_EXTENDED_PLAIN}
    return _conform(latest_per_loan(deal_rows(tape, formats)), formats, plain, DIM_DECODED + DIM_EXTENDED_DECODED)


def conform_fact_loan_period(tape: DataFrame, *formats: DealFormat) -> DataFrame:
    """Loan-period facts of the deals, one row per loan and cut-off (38 columns); absent fields are typed NULLs."""
    return _conform(deal_rows(tape, formats), formats, FACT_PLAIN, FACT_DECODED)


# ------------------------------------------------------------------ deal formats as rows

#: fields in one word of the bitmap of absent fields
_WORD = 32
_FORMAT_COLUMNS = ["rate_factor", "quarter_dates", "keep_null_ids", *[f"absent_{w}" for w in range(-(-len(FIELDS) // _WORD))]]


def format_table(spark: SparkSession, formats: Sequence[DealFormat]) -> DataFrame:
    """Deal formats as rows: ``DealID``, factor, date style and a bitmap of the fields in ``FIELDS`` that are absent."""
    schema = "DealID string, rate_factor decimal(18,9), quarter_dates boolean, keep_null_ids boolean"
    words = range(-(-len(FIELDS) // _WORD))
    rows = []
    for f in formats:
        mask = sum(1 << i for i, field in enumerate(FIELDS) if field in f.absent)
        rows.append((f.deal_id, f.rate_factor, f.quarter_dates, f.keep_null_ids, *[mask >> _WORD * w & (1 << _WORD) - 1 for w in words]))
    return spark.createDataFrame(rows, schema + "".join(f", absent_{w} bigint" for w in words))


def _typed_by_row(field: str, kind: str) -> Column:
    """A field read as its row's own format says."""
    at = FIELDS.index(field)
    c = F.when(F.col(f"_absent_{at // _WORD}").bitwiseAND(F.lit(1 << at % _WORD)) == 0, F.col(field))
    if kind == "rate":
        return (ratio(c) * F.col("_rate_factor")).cast("decimal(18,9)")
    if kind == "origination":
        return F.when(F.col("_quarter_dates"), quarter_end(c)).otherwise(iso_date(c))
    return {"text": lambda x: x, "whole": whole, "money": money, "ratio": ratio, "date": iso_date}[kind](c)


def _described(tape: DataFrame, formats: DataFrame) -> DataFrame:
    """Tape rows with the format of their deal; deals without a format are left out, as in :func:`deal_rows`.

    Formats are one row a deal.  Spark broadcasts them where their size allows; beyond it both sides meet by
    deal, and AQE splits a large one.
    """
    own = formats.select("DealID", *[F.col(c).alias(f"_{c}") for c in _FORMAT_COLUMNS])
    return with_fields(tape, FIELDS).join(own, "DealID").filter(F.col("_keep_null_ids") | F.col("AR3").isNotNull())


def conform_dim_loan_by_table(tape: DataFrame, formats: DataFrame) -> DataFrame:
    """:func:`conform_dim_loan` with formats from a table (:func:`format_table`): a deal is a row, the plan stays the same."""
    rows = latest_per_loan(_described(tape, formats))
    return _project(rows, _typed_by_row, DIM_PLAIN, DIM_DECODED)


def conform_fact_loan_period_by_table(tape: DataFrame, formats: DataFrame) -> DataFrame:
    """:func:`conform_fact_loan_period` with formats from a table."""
    return _project(_described(tape, formats), _typed_by_row, FACT_PLAIN, FACT_DECODED)


def region_from_postcode(df: DataFrame, field: str) -> DataFrame:
    """Region of a column holding postcodes or region codes: postcode area first, else the raw code."""
    spark = df.sparkSession
    areas = ref_table(spark, "postcode_to_region")
    regions = ref_table(spark, "region").select(F.col("code").alias("RegionCode"), F.col("label").alias("Region"))
    return (
        df.withColumn("postcode_area", F.regexp_extract(F.upper(F.col(field)), r"^([A-Z]{1,2})", 1))
        .join(F.broadcast(areas), "postcode_area", "left")
        .withColumn("RegionCode", F.coalesce("region_code", field))
        .join(F.broadcast(regions), "RegionCode", "left")
        .drop("postcode_area", "region_code")
    )


#: amount, rate and count fields whose casts may fail
CAST_FIELDS = {name: spec for name, spec in {**DIM_PLAIN, **FACT_PLAIN}.items() if spec[1] != "text"}


def cast_failures(tape: DataFrame, formats=FORMATS) -> DataFrame:
    """Per deal and column: delivered values, and those the tolerant cast turned into NULL."""
    tape, counts = with_fields(tape, FIELDS), []
    for name, (field, kind) in CAST_FIELDS.items():
        typed = None
        for fmt in formats:
            typed = (
                F.when(F.col("DealID") == fmt.deal_id, _typed(field, kind, [fmt]).isNull())
                if typed is None
                else typed.when(F.col("DealID") == fmt.deal_id, _typed(field, kind, [fmt]).isNull())
            )
        counts.append(F.count(field).alias(f"{name}_n"))
        counts.append(F.count_if(F.col(field).isNotNull() & typed).alias(f"{name}_f"))
    wide = tape.groupBy("DealID").agg(*counts)
    stacked = ", ".join(f"'{n}', {n}_n, {n}_f" for n in CAST_FIELDS)
    return wide.selectExpr("DealID", f"stack({len(CAST_FIELDS)}, {stacked}) AS (ColumnName, Delivered, Failed)")
