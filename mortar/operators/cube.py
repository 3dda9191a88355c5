"""Sums per cell of all bands, from which every strat and every slice is answered.

A cell is a deal, a cut-off and one band of each of the six strats.  All figures of a cell can be added (counts, sums,
products with the balance), or united (a sketch of distinct loans), so cells of several deliveries, periods or tables are
simply put together.  Loans are read once; what follows works on the cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from mortar.functions import bands
from mortar.functions.averages import divide
from mortar.functions.dates import month_steps
from mortar.operators.marts import DEFAULT_LABEL_CODED, GROUP

#: Size of the sketch (2**LOG_SKETCH registers): a standard error of 1.04 / sqrt(2**LOG_SKETCH), 1.6 %.
LOG_SKETCH = 12
SUMS = [
    "LoanCount", "Balance", "LTV_x_Balance", "Rate_x_Balance", "LoansInArrears", "ArrearsBalance", "SeasoningMonths", "SeasoningLoans",
]
METRICS = ["WA_LTV", "WA_Rate", "LoansInArrears", "ArrearsBalance", "ArrearsRate", "Avg_Seasoning_Months"]


def _dimensions() -> dict[str, tuple[Column, Column]]:
    """Band and its place, per strat."""
    ltv, months, status = F.col("CurrentLTV"), F.col("MonthsInArrears"), F.col("AccountStatus")
    seasoning = month_steps(F.col("CutoffDate"), F.col("LoanOriginationDate"))
    label = lambda c: (F.coalesce(F.col(c), F.lit(bands.UNKNOWN)), F.lit(None).cast("int"))
    return {
        "LTV": (bands.mart_ltv_band(ltv), bands.mart_ltv_order(ltv)),
        "Delinquency": (
            bands.mart_delinquency_bucket(months, status, DEFAULT_LABEL_CODED),
            bands.mart_delinquency_order(months, status, DEFAULT_LABEL_CODED),
        ),
        "Region": label("Region"),
        "Seasoning": (bands.mart_seasoning_band(seasoning), bands.mart_seasoning_order(seasoning)),
        "Occupancy": label("OccupancyType"),
        "Repayment": label("RepaymentMethod"),
    }


def cells(star: DataFrame, sketch: bool = True) -> DataFrame:
    """One row per cell: the bands, their places, the sums, and the sketch of distinct loans."""
    table = _dimensions()
    balance, seasoning = F.col("CurrentBalance"), month_steps(F.col("CutoffDate"), F.col("LoanOriginationDate"))
    weighted = lambda c: F.sum(F.col(c).cast("double") * balance.cast("double"))
    banded = star.withColumns(
        {**{f"_{n}": band for n, (band, _) in table.items()}, **{f"_{n}_Order": place for n, (_, place) in table.items()}}
    )
    keys = [F.col(f"_{n}{s}").alias(f"{n}{s}") for n in table for s in ("", "_Order")]
    figures = [
        F.count("*"), F.sum(balance), weighted("CurrentLTV"), weighted("CurrentInterestRate"),
        F.count_if(F.col("MonthsInArrears") > 0), F.sum("ArrearsBalance"), F.sum(seasoning), F.count(seasoning),
    ]
    loans = [F.hll_sketch_agg("LoanID", F.lit(LOG_SKETCH)).alias("Loans")] if sketch else []
    return banded.groupBy(*GROUP, *keys).agg(*[f.alias(n) for f, n in zip(figures, SUMS)], *loans)


def _total(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    loans = [F.hll_union_agg("Loans").alias("Loans")] if "Loans" in df.columns else []
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS], *loans)


def _with_metrics(df: DataFrame) -> DataFrame:
    made = {
        "WA_LTV": divide(F.col("LTV_x_Balance"), F.col("Balance")),
        "WA_Rate": divide(F.col("Rate_x_Balance"), F.col("Balance")),
        "ArrearsRate": divide(F.col("ArrearsBalance"), F.col("Balance")),
        "Avg_Seasoning_Months": divide(F.col("SeasoningMonths"), F.col("SeasoningLoans")),
    }
    if "Loans" in df.columns:
        made["DistinctLoans"] = F.hll_sketch_estimate("Loans")
    return df.withColumns(made).drop("LTV_x_Balance", "Rate_x_Balance", "SeasoningMonths", "SeasoningLoans", "Loans")


def merged(*parts: DataFrame) -> DataFrame:
    """Cells of several deliveries or periods as one."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return _total(out, [c for c in out.columns if c not in (*SUMS, "Loans")])


def strats(cube: DataFrame) -> DataFrame:
    """All six strats with every column: ``(DealID, CutoffDate, Dimension, Band, Band_Order)``, figures and shares."""
    entries = [
        F.struct(F.lit(n).alias("Dimension"), F.col(n).alias("Band"), F.col(f"{n}_Order").alias("Band_Order")) for n in _dimensions()
    ]
    entry = cube.select(*GROUP, *[c for c in cube.columns if c in SUMS], F.explode(F.array(*entries)).alias("e"))
    rows = _total(entry.select("*", "e.*"), [*GROUP, "Dimension", "Band", "Band_Order"])
    whole = F.sum("Balance").over(Window.partitionBy(*GROUP, "Dimension"))
    return _with_metrics(rows.withColumn("Balance_Pct", divide(F.col("Balance"), whole)))


def measure(cube: DataFrame, by: Sequence[str] = GROUP, where: Column | None = None) -> DataFrame:
    """Figures of a slice by any columns of the cube, ``DistinctLoans`` estimated from the sketches."""
    return _with_metrics(_total(cube if where is None else cube.filter(where), by))
