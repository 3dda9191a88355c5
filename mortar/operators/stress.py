"""Stress scenarios over all loans without multiplying loans by scenarios.

* Stressed LTV is linear in ``1 / (1 + shock)``: one sum serves every shock.
* Underwater balance needs one conditional sum per shock.
* Expected loss is piecewise linear in a loan's balance and valuation; the pieces change at a few
  dozen values of ``valuation / balance``.  Loans are summed per default-probability class and
  piece, and the full grid is evaluated on those sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mortar.functions.averages import divide
from mortar.functions.bands import base_pd
from mortar.sources.seeds import CDR_MULTIPLIERS, HPI_SHOCKS, SEVERITY_MULTIPLIERS

# fixed value: loss severity never falls below this
SEVERITY_FLOOR = 0.10


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def stressed_wa_ltv(loans: DataFrame, by: Sequence[str], shocks: Sequence[float] = HPI_SHOCKS) -> DataFrame:
    """Balance-weighted LTV in percent under each house-price shock."""
    bal = _double("CurrentBalance")
    base = loans.groupBy(*by).agg(
        F.sum(bal * divide(bal, _double("CurrentValuation"))).alias("squares"), F.sum("CurrentBalance").alias("total")
    )
    shock = F.explode(F.array(*[F.lit(float(s)) for s in shocks])).alias("HPI_Shock_pct")
    ltv = divide(F.col("squares") * 100, F.col("total")) / (1 + F.col("HPI_Shock_pct") / 100)
    return base.select(*by, "squares", "total", shock).select(*by, "HPI_Shock_pct", ltv.alias("StressedWALTV"))


def stressed_underwater(loans: DataFrame, by: Sequence[str], shocks: Sequence[float] = HPI_SHOCKS) -> DataFrame:
    """Balance of loans above 100% LTV under each shock, and its part of the pool."""
    bal, val = _double("CurrentBalance"), _double("CurrentValuation")
    sums = [
        F.sum(F.when(divide(bal, val * (1 + s / 100)) > 1, F.col("CurrentBalance")).otherwise(0)).alias(f"u{i}")
        for i, s in enumerate(shocks)
    ]
    stacked = ", ".join(f"{float(s)}D, u{i}" for i, s in enumerate(shocks))
    return (
        loans.groupBy(*by)
        .agg(F.sum("CurrentBalance").alias("total"), *sums)
        .selectExpr(*by, "total", f"stack({len(shocks)}, {stacked}) AS (HPI_Shock_pct, UnderwaterBalance)")
        .withColumn("Pct_Underwater", divide(F.col("UnderwaterBalance"), F.col("total")))
        .drop("total")
    )


def base_pd_balance(loans: DataFrame, by: Sequence[str]) -> DataFrame:
    """Balance times default probability of the arrears class."""
    pd = base_pd(F.col("MonthsInArrears"))
    return loans.groupBy(*by).agg(F.sum(_double("CurrentBalance") * pd).alias("BasePD"))


def _pieces(shocks: Sequence[float], severities: Sequence[float]) -> list[float]:
    """Values of valuation / balance at which some scenario's severity changes its formula."""
    floor_at = {(1 - SEVERITY_FLOOR) / (1 + s / 100) for s in shocks}
    full_at = {(1 - 1 / m) / (1 + s / 100) for s in shocks for m in severities if m > 1}
    return sorted(floor_at | full_at)


def _piece_of(v: Column, edges: list[float], low: int = 0) -> Column:
    """Number of edges at or below ``v`` by halving: a CASE tree of logarithmic depth."""
    if not edges:
        return F.lit(low)
    mid = len(edges) // 2
    return F.when(v < edges[mid], _piece_of(v, edges[:mid], low)).otherwise(_piece_of(v, edges[mid + 1 :], low + mid + 1))


def stress_grid(
    loans: DataFrame,
    by: Sequence[str],
    shocks: Sequence[float] = HPI_SHOCKS,
    cdrs: Sequence[float] = CDR_MULTIPLIERS,
    severities: Sequence[float] = SEVERITY_MULTIPLIERS,
) -> DataFrame:
    """Expected loss and loss rate for every combination of shock, default and severity multiplier.

    A missing or zero valuation means full severity.
    """
    edges = _pieces(shocks, severities)
    bal = F.col("CurrentBalance")
    val = F.coalesce(F.col("CurrentValuation"), F.lit(0))
    sums = (
        loans.filter(bal.isNotNull())
        .select(*by, base_pd(F.col("MonthsInArrears")).alias("pd"), divide(val, bal).alias("cover"), bal.alias("b"), val.alias("v"))
        # the quotient is a column, since the tree looks at it several times
        .select(*by, "pd", F.coalesce(_piece_of(F.col("cover"), edges), F.lit(0)).alias("piece"), "b", "v")
        .groupBy(*by, "pd", "piece")
        .agg(F.sum("b").alias("b"), F.sum("v").alias("v"))
    )
    settings = []
    for s in shocks:
        for m in severities:
            floor_from = edges.index((1 - SEVERITY_FLOOR) / (1 + s / 100)) + 1
            full_to = edges.index((1 - 1 / m) / (1 + s / 100)) if m > 1 else -1
            values = dict(hpi=float(s), sev=float(m), up=1 + s / 100, floor_from=floor_from, full_to=full_to)
            settings.append(F.struct(*[F.lit(x).alias(n) for n, x in values.items()]))
    b, v = _double("b"), _double("v")
    lost = (
        F.when(F.col("piece") >= F.col("x.floor_from"), b * F.least(F.lit(1.0), SEVERITY_FLOOR * F.col("x.sev")))
        .when(F.col("piece") <= F.col("x.full_to"), b)
        .otherwise(F.col("x.sev") * (b - F.col("x.up") * v))
    )
    per_class = (
        sums.select(*by, "pd", "piece", "b", "v", F.explode(F.array(*settings)).alias("x"))
        .groupBy(*by, "pd", F.col("x.hpi").alias("HPI_Shock_pct"), F.col("x.sev").alias("Severity_Multiplier"))
        .agg(F.sum(lost).alias("lost"), F.sum("b").alias("b"))
    )
    cdr = F.explode(F.array(*[F.lit(float(c)) for c in cdrs])).alias("CDR_Multiplier")
    scenario = ["HPI_Shock_pct", "CDR_Multiplier", "Severity_Multiplier"]
    return (
        per_class.select(*by, "pd", "HPI_Shock_pct", "Severity_Multiplier", "lost", "b", cdr)
        .groupBy(*by, *scenario)
        .agg(
            F.sum(F.least(F.lit(1.0), F.col("pd") * F.col("CDR_Multiplier")) * F.col("lost")).alias("ExpectedLoss"),
            F.sum("b").alias("total"),
        )
        .withColumn("LossRate", divide(F.col("ExpectedLoss"), F.col("total")))
        .drop("total")
    )


def stressed_expected_loss(
    loans: DataFrame, by: Sequence[str], hpi_shock: float = 0, cdr: float = 1, severity: float = 1
) -> DataFrame:
    """One selected scenario; the defaults are the unselected slicers."""
    return stress_grid(loans, by, [hpi_shock], [cdr], [severity])


def credit_support(notes: DataFrame) -> DataFrame:
    """Balance of the notes below Class A, without the risk-retention note, per deal."""
    below = notes.filter((F.col("Class") != "Class A") & (F.col("Subordination") != "Risk Retention"))
    return below.groupBy("DealID").agg(F.sum("CurrentBalance").alias("CreditSupport"))


def note_coverage(losses: DataFrame, notes: DataFrame) -> DataFrame:
    """Stressed loss as a part of the credit support of the deal."""
    return losses.join(credit_support(notes), "DealID", "left").withColumn(
        "LossVsSupport", divide(F.col("ExpectedLoss"), F.col("CreditSupport"))
    )
