"""Banding ladders as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: band edges and labels; every ladder ends in (None, label above the last edge)
MART_LTV = [(0.60, "<60%"), (0.70, "60-70%"), (0.80, "70-80%"), (0.90, "80-90%"), (1.00, "90-100%"), (None, ">100%")]
MART_SEASONING = [(12, "<1yr"), (36, "1-3yr"), (60, "3-5yr"), (120, "5-10yr"), (None, "10yr+")]
MART_ARREARS = [(1, "<1M"), (2, "1-2M"), (3, "2-3M"), (None, "3M+")]
PREP_LTV = [
    (50, "0-50%"), (60, "50-60%"), (70, "60-70%"), (80, "70-80%"), (90, "80-90%"), (100, "90-100%"),
    (None, ">100% (underwater)"),
]
PREP_SEASONING = [(60, "0-5y"), (120, "5-10y"), (180, "10-15y"), (240, "15-20y"), (None, "20y+")]
PREP_RATE = [(2, "<2%"), (3, "2-3%"), (4, "3-4%"), (5, "4-5%"), (None, ">5%")]
PREP_BALANCE = [
    (50000, "<50k"), (100000, "50-100k"), (150000, "100-150k"), (250000, "150-250k"), (500000, "250-500k"),
    (None, ">500k"),
]
PREP_ARREARS = [
    (1, "<= 1 Month"), (2, "1 - 2 Months"), (3, "2 - 3 Months"), (4, "3 - 4 Months"), (5, "4 - 5 Months"),
    (6, "5 - 6 Months"), (None, "> 6 Months"),
]
# fixed values: probability of default by months in arrears (upper edge included; 0 means none)
PD_LADDER = [(0, 0.02), (1, 0.08), (3, 0.25), (6, 0.50), (None, 0.85)]

UNKNOWN = "Unknown"


def ladder(value: Column, steps: list, closed: bool = False) -> Column:
    """First label whose edge lies above ``value`` (``closed``: at or above)."""
    out = None
    for edge, label in steps[:-1]:
        hit = value <= F.lit(edge) if closed else value < F.lit(edge)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(steps[-1][1]))


def known(value: Column, label: Column) -> Column:
    return F.when(value.isNull(), UNKNOWN).otherwise(label)


def ordinal(steps: list, first: int = 1) -> list:
    """The same ladder with running numbers for labels."""
    return [(edge, i + first) for i, (edge, _) in enumerate(steps)]


# ---- mart ladders: fractions, upper edge excluded


def mart_ltv_band(ltv: Column) -> Column:
    return known(ltv, ladder(ltv, MART_LTV))


def mart_ltv_order(ltv: Column) -> Column:
    return F.when(ltv.isNull(), 99).otherwise(ladder(ltv, ordinal(MART_LTV)))


def mart_seasoning_band(months: Column) -> Column:
    return known(months, ladder(months, MART_SEASONING))


def mart_seasoning_order(months: Column) -> Column:
    return F.when(months.isNull(), 99).otherwise(ladder(months, ordinal(MART_SEASONING)))


def mart_delinquency_bucket(months: Column, status: Column, default_label: str) -> Column:
    return (
        F.when(status == default_label, "Default")
        .when(status == "Redeemed", "Redeemed")
        .when(months.isNull() | (months == 0), "Current")
        .otherwise(ladder(months, MART_ARREARS))
    )


def mart_delinquency_order(months: Column, status: Column, default_label: str) -> Column:
    """Default ranks only among loans three or more months behind, unlike in the bucket itself."""
    late = F.when(status == default_label, 6).otherwise(5)
    return (
        F.when(status == "Redeemed", 0)
        .when(months.isNull() | (months == 0), 1)
        .when(months < 3, ladder(months, ordinal(MART_ARREARS, 2)))
        .otherwise(late)
    )


# ---- preparation ladders: percent, LTV edges included


def ltv_band(ltv: Column) -> Column:
    """Values up to 2 are fractions and are scaled to percent."""
    percent = F.when(ltv <= 2, ltv * 100).otherwise(ltv)
    return known(ltv, ladder(percent, PREP_LTV, closed=True))


def seasoning_band(months: Column) -> Column:
    return known(months, ladder(months, PREP_SEASONING))


def rate_band(rate: Column) -> Column:
    return known(rate, ladder(rate, PREP_RATE))


def balance_band(balance: Column) -> Column:
    return known(balance, ladder(balance, PREP_BALANCE))


def arrears_bucket(months: Column) -> Column:
    return ladder(F.coalesce(months, F.lit(0.0)), PREP_ARREARS, closed=True)


def base_pd(months: Column) -> Column:
    """The first step holds for no arrears exactly; negative months belong to the second."""
    known_months = F.coalesce(months, F.lit(0.0))
    return F.when(known_months == 0, F.lit(PD_LADDER[0][1])).otherwise(ladder(known_months, PD_LADDER[1:], closed=True))
