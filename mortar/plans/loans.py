"""Queries on marts, bands, measures and stress."""

from __future__ import annotations

from pyspark.sql import functions as F

from mortar.functions.averages import wavg_strict as strict_average
from mortar.functions.averages import wavg_total as total_average
from mortar.operators import cube, marts, measures, prep, stress
from mortar.plans.frames import Frames, present
from mortar.plans.registry import SQL, register
from mortar.plans.sqltext import EXITS, FACT, LOANS, REFS, STAR, TAPE, d, n, query, r, ratio, values, wavg, wavg_strict
from mortar.session import kept, work_folder
from mortar.sources import seeds, stored_star

GROUP = ["DealID", "CutoffDate"]
G = "DealID, CutoffDate"
SHARE = f"{r(ratio('SUM(CurrentBalance)', f'SUM(SUM(CurrentBalance)) OVER (PARTITION BY {G})'))} AS Balance_Pct"
COUNT = f"count(*) AS LoanCount, {d('SUM(CurrentBalance)')} AS Balance, {SHARE}"
IN_ARREARS = f"{n('count(CASE WHEN MonthsInArrears > 0 THEN 1 END)')} AS LoansInArrears"
ARREARS = f"{d('SUM(ArrearsBalance)')} AS ArrearsBalance"
WA = f"{r(wavg('CurrentLTV'))} AS WA_LTV, {r(wavg('CurrentInterestRate'))} AS WA_Rate"

# ------------------------------------------------------------------ marts

POOL_SUMMARY_COLUMNS = f"""{G}, count(*) AS LoanCount, {d('SUM(CurrentBalance)')} AS TotalBalance,
 {r(ratio('SUM(CurrentBalance)', 'count(CurrentBalance)'))} AS AvgBalance, {r(wavg('CurrentInterestRate'))} AS WA_InterestRate,
 {r(wavg('CurrentLTV'))} AS WA_LTV, {r(wavg('Seasoning'))} AS WA_Seasoning_Months,
 {d('SUM(ArrearsBalance)')} AS TotalArrearsBalance, {r(ratio('SUM(ArrearsBalance)', 'SUM(CurrentBalance)'))} AS ArrearsRate,
 {IN_ARREARS}, {d('SUM(PrepaymentAmount)')} AS TotalPrepayment, {d('SUM(CumulativePrepayments)')} AS TotalCumulativePrepayments"""
POOL_SUMMARY = f"SELECT {POOL_SUMMARY_COLUMNS} FROM star GROUP BY {G}"

register(
    "pool_summary",
    lambda x: present(marts.pool_summary(x.star("LoanOriginationDate"))),
    query(POOL_SUMMARY, TAPE, STAR),
)

LTV_SQL = f"""SELECT {G}, LTV_Band, Band_Order, {COUNT}, {WA}, {IN_ARREARS}, {ARREARS} FROM (SELECT *,
 CASE WHEN CurrentLTV >= 1 THEN '>100%' WHEN CurrentLTV >= 0.9 THEN '90-100%' WHEN CurrentLTV >= 0.8 THEN '80-90%'
  WHEN CurrentLTV >= 0.7 THEN '70-80%' WHEN CurrentLTV >= 0.6 THEN '60-70%' WHEN CurrentLTV IS NULL THEN 'Unknown' ELSE '<60%' END AS LTV_Band,
 {n('''CASE WHEN CurrentLTV >= 1 THEN 6 WHEN CurrentLTV >= 0.9 THEN 5 WHEN CurrentLTV >= 0.8 THEN 4
  WHEN CurrentLTV >= 0.7 THEN 3 WHEN CurrentLTV >= 0.6 THEN 2 WHEN CurrentLTV IS NULL THEN 99 ELSE 1 END''')} AS Band_Order
 FROM fact) GROUP BY {G}, LTV_Band, Band_Order"""
register("strat_ltv", lambda x: present(marts.strat_ltv(x.fact())), query(LTV_SQL, TAPE, REFS, FACT))


def _delinquency_sql(label: str) -> str:
    return query(
        f"""SELECT {G}, Delinquency_Bucket, Bucket_Order, {COUNT}, {ARREARS}, {r(wavg('CurrentLTV'))} AS WA_LTV FROM (SELECT *,
 CASE WHEN AccountStatus = '{label}' THEN 'Default' WHEN AccountStatus = 'Redeemed' THEN 'Redeemed'
  WHEN COALESCE(MonthsInArrears, 0) = 0 THEN 'Current' WHEN MonthsInArrears >= 3 THEN '3M+'
  WHEN MonthsInArrears >= 2 THEN '2-3M' WHEN MonthsInArrears >= 1 THEN '1-2M' ELSE '<1M' END AS Delinquency_Bucket,
 {n(f'''CASE WHEN AccountStatus = 'Redeemed' THEN 0 WHEN COALESCE(MonthsInArrears, 0) = 0 THEN 1
  WHEN MonthsInArrears >= 3 THEN CASE WHEN AccountStatus = '{label}' THEN 6 ELSE 5 END
  WHEN MonthsInArrears >= 2 THEN 4 WHEN MonthsInArrears >= 1 THEN 3 ELSE 2 END''')} AS Bucket_Order
 FROM fact) GROUP BY {G}, Delinquency_Bucket, Bucket_Order""",
        TAPE, REFS, FACT,
    )


register("strat_delinquency", lambda x: present(marts.strat_delinquency(x.fact())), _delinquency_sql("Defaulted"))
register(
    "strat_delinquency_intended",
    lambda x: present(marts.strat_delinquency(x.fact(), marts.DEFAULT_LABEL_INTENDED)),
    _delinquency_sql("Default or Foreclosure"),
)
for _name, _column in (("region", "Region"), ("occupancy", "OccupancyType"), ("repayment", "RepaymentMethod")):
    register(
        f"strat_{_name}",
        lambda x, column=_column: present(marts.strat_label(x.star(column), column)),
        query(
            f"SELECT {G}, label AS {_column}, {COUNT}, {WA}, {IN_ARREARS}, {ARREARS} FROM"
            f" (SELECT *, COALESCE({_column}, 'Unknown') AS label FROM star) GROUP BY {G}, label",
            TAPE, STAR,
        ),
    )


def _stored(x: Frames, columns: list[str]):
    path = work_folder(x.spark, "star")
    stored_star.write_star(x.fact(), x.dim(), path, x.parts())
    return stored_star.stored_join(x.spark, path, columns)


register("strat_region_stored", lambda x: present(marts.strat_label(_stored(x, ["Region"]), "Region")), SQL["strat_region"])
SEASONING = """CASE WHEN Seasoning >= 120 THEN '10yr+' WHEN Seasoning >= 60 THEN '5-10yr' WHEN Seasoning >= 36 THEN '3-5yr'
  WHEN Seasoning >= 12 THEN '1-3yr' WHEN Seasoning IS NULL THEN 'Unknown' ELSE '<1yr' END"""
register(
    "strat_seasoning",
    lambda x: present(marts.strat_seasoning(x.star("LoanOriginationDate"))),
    query(
        f"""SELECT {G}, Seasoning_Band, Band_Order, {COUNT}, {r('avg(Seasoning)')} AS Avg_Seasoning_Months, {IN_ARREARS},
 {r(ratio('SUM(ArrearsBalance)', 'SUM(CurrentBalance)'))} AS ArrearsRate FROM (SELECT *, {SEASONING} AS Seasoning_Band,
 {n('''CASE WHEN Seasoning >= 120 THEN 5 WHEN Seasoning >= 60 THEN 4 WHEN Seasoning >= 36 THEN 3
  WHEN Seasoning >= 12 THEN 2 WHEN Seasoning IS NULL THEN 99 ELSE 1 END''')} AS Band_Order
 FROM star) GROUP BY {G}, Seasoning_Band, Band_Order""",
        TAPE, STAR,
    ),
)

_STRATS = {
    "LTV": "CASE WHEN CurrentLTV >= 1 THEN '>100%' WHEN CurrentLTV >= 0.9 THEN '90-100%' WHEN CurrentLTV >= 0.8 THEN '80-90%'"
    " WHEN CurrentLTV >= 0.7 THEN '70-80%' WHEN CurrentLTV >= 0.6 THEN '60-70%' WHEN CurrentLTV IS NULL THEN 'Unknown'"
    " ELSE '<60%' END",
    "Delinquency": "CASE WHEN AccountStatus = 'Redeemed' THEN 'Redeemed' WHEN COALESCE(MonthsInArrears, 0) = 0 THEN 'Current'"
    " WHEN MonthsInArrears >= 3 THEN '3M+' WHEN MonthsInArrears >= 2 THEN '2-3M' WHEN MonthsInArrears >= 1 THEN '1-2M'"
    " ELSE '<1M' END",
    "Region": "COALESCE(Region, 'Unknown')",
    "Seasoning": SEASONING,
    "Occupancy": "COALESCE(OccupancyType, 'Unknown')",
    "Repayment": "COALESCE(RepaymentMethod, 'Unknown')",
}
register(
    "strat_all_grouping_sets",
    lambda x: present(marts.strat_all(x.star(*marts.STAR_COLUMNS))),
    query(
        " UNION ALL ".join(
            f"SELECT {G}, '{name}' AS Dimension, {expr} AS Band, {COUNT} FROM star GROUP BY {G}, {expr}"
            for name, expr in _STRATS.items()
        ),
        TAPE, STAR,
    ),
)
_EVERY = f"""{COUNT}, {WA}, {IN_ARREARS}, {ARREARS}, {r(ratio('SUM(ArrearsBalance)', 'SUM(CurrentBalance)'))} AS ArrearsRate,
 {r('avg(Seasoning)')} AS Avg_Seasoning_Months"""
_PLACES = {
    "LTV": n("""CASE WHEN CurrentLTV >= 1 THEN 6 WHEN CurrentLTV >= 0.9 THEN 5 WHEN CurrentLTV >= 0.8 THEN 4
  WHEN CurrentLTV >= 0.7 THEN 3 WHEN CurrentLTV >= 0.6 THEN 2 WHEN CurrentLTV IS NULL THEN 99 ELSE 1 END"""),
    "Delinquency": n("""CASE WHEN AccountStatus = 'Redeemed' THEN 0 WHEN COALESCE(MonthsInArrears, 0) = 0 THEN 1
  WHEN MonthsInArrears >= 3 THEN 5 WHEN MonthsInArrears >= 2 THEN 4 WHEN MonthsInArrears >= 1 THEN 3 ELSE 2 END"""),
    "Seasoning": n("""CASE WHEN Seasoning >= 120 THEN 5 WHEN Seasoning >= 60 THEN 4 WHEN Seasoning >= 36 THEN 3
  WHEN Seasoning >= 12 THEN 2 WHEN Seasoning IS NULL THEN 99 ELSE 1 END"""),
}


def _cells(x: Frames):
    return cube.cells(x.star(*marts.STAR_COLUMNS), sketch=False)


register(
    "strat_every_column",
    lambda x: present(cube.strats(_cells(x))),
    query(
        " UNION ALL ".join(
            f"SELECT {G}, '{name}' AS Dimension, Band, Band_Order, {_EVERY} FROM (SELECT *, {expr} AS Band,"
            f" {_PLACES.get(name, 'CAST(NULL AS BIGINT)')} AS Band_Order FROM star) GROUP BY {G}, Band, Band_Order"
            for name, expr in _STRATS.items()
        ),
        TAPE, STAR,
    ),
)


def _from_stored_cube(x: Frames):
    """A slice answered from a stored cube whose deals were stored one after the other."""
    path, whole = work_folder(x.spark, "cube"), kept(_cells(x), "cells")
    for test in (F.col("DealID") == "AVON2", ~F.col("DealID").eqNullSafe(F.lit("AVON2"))):
        whole.filter(test).write.mode("append").parquet(path)
    stored = x.spark.read.schema(whole.schema).parquet(path)
    slice_ = F.col("Seasoning").isin("3-5yr", "5-10yr") & (F.col("LTV") != ">100%")
    return cube.measure(stored, ["CutoffDate", "Region"], slice_)


register(
    "measure_from_cube",
    lambda x: present(_from_stored_cube(x)),
    query(
        f"SELECT CutoffDate, Area AS Region, count(*) AS LoanCount, {d('SUM(CurrentBalance)')} AS Balance, {WA}, {IN_ARREARS},"
        f" {ARREARS}, {r(ratio('SUM(ArrearsBalance)', 'SUM(CurrentBalance)'))} AS ArrearsRate,"
        f" {r('avg(Seasoning)')} AS Avg_Seasoning_Months FROM (SELECT *, COALESCE(Region, 'Unknown') AS Area FROM star)"
        " WHERE Seasoning >= 36 AND Seasoning < 120 AND (CurrentLTV IS NULL OR CurrentLTV < 1) GROUP BY CutoffDate, Area",
        TAPE, STAR,
    ),
)
register(
    "portfolio_insights",
    lambda x: present(marts.portfolio_insights(x.star(*marts.STAR_COLUMNS))),
    query(
        f"""SELECT a.DealID, a.CutoffDate, IO_Share, IO_WA_LTV, Pre2010_Share, LTV90_Share,
 {r(d('top') + ' / ' + d('bal'))} AS Top2_Region_Share FROM
 (SELECT {G}, SUM(CurrentBalance) AS bal,
  {r(ratio("SUM(CASE WHEN RepaymentMethod = 'Interest Only' THEN CurrentBalance END)", 'SUM(CurrentBalance)'))} AS IO_Share,
  {r(ratio(f"SUM(CASE WHEN RepaymentMethod = 'Interest Only' THEN {d('CurrentBalance')} * {d('CurrentLTV')} END)",
           "SUM(CASE WHEN RepaymentMethod = 'Interest Only' THEN CurrentBalance END)"))} AS IO_WA_LTV,
  {r(ratio("SUM(CASE WHEN LoanOriginationDate < DATE '2010-01-01' THEN CurrentBalance END)", 'SUM(CurrentBalance)'))} AS Pre2010_Share,
  {r(ratio("SUM(CASE WHEN CurrentLTV >= 0.9 THEN CurrentBalance END)", 'SUM(CurrentBalance)'))} AS LTV90_Share
  FROM star GROUP BY {G}) a
 JOIN (SELECT {G}, SUM(b) AS top FROM (SELECT {G}, Region, SUM(CurrentBalance) AS b FROM star WHERE Region IS NOT NULL
  GROUP BY {G}, Region QUALIFY row_number() OVER (PARTITION BY {G} ORDER BY SUM(CurrentBalance) DESC) <= 2) GROUP BY {G}) t
 ON a.DealID = t.DealID AND a.CutoffDate = t.CutoffDate""",
        TAPE, STAR,
    ),
)

# ------------------------------------------------------------------ averages and bands

register(
    "wavg_strict",
    lambda x: present(
        x.loans().groupBy(*GROUP).agg(
            *[strict_average(F.col(c), F.col("CurrentBalance")).alias(c) for c in ("CurrentRate", "Margin", "CurrentLTV", "OrigLTV", "SeasoningMonths")]
        )
    ),
    query(
        f"SELECT {G}, " + ", ".join(f"{r(wavg_strict(c))} AS {c}" for c in ("CurrentRate", "Margin", "CurrentLTV", "OrigLTV", "SeasoningMonths"))
        + f" FROM loans GROUP BY {G}",
        TAPE, LOANS,
    ),
)
register(
    "wavg_total",
    lambda x: present(
        x.fact().groupBy(*GROUP).agg(
            *[total_average(F.col(c), F.col("CurrentBalance")).alias(c) for c in ("CurrentInterestRate", "CurrentLTV")]
        )
    ),
    query(
        f"SELECT {G}, " + ", ".join(f"{r(wavg(c))} AS {c}" for c in ("CurrentInterestRate", "CurrentLTV")) + f" FROM fact GROUP BY {G}",
        TAPE, REFS, FACT,
    ),
)

BANDS = {
    "band_ltv": ["LTVBand", "OrigLTVBand"],
    "band_seasoning": ["SeasoningBand"],
    "band_rate": ["RateBand"],
    "band_balance": ["BalanceBand"],
    "band_dq": ["DelinquencyBucket"],
}
for _name, _columns in BANDS.items():
    register(
        _name,
        lambda x, columns=_columns: present(
            x.loans().groupBy("DealID", *columns).agg(F.count("*").alias("Loans"), F.sum("CurrentBalance").alias("Balance"))
        ),
        query(
            f"SELECT DealID, {', '.join(_columns)}, count(*) AS Loans, {d('SUM(CurrentBalance)')} AS Balance FROM loans GROUP BY ALL",
            TAPE, LOANS,
        ),
    )


def _pct(pred: str) -> str:
    return f"{ratio(f'COALESCE(SUM(CASE WHEN {pred} THEN CurrentBalance END), 0)', 'SUM(CurrentBalance)')} * 100"


PREP_POOL = f"""pool0 AS (SELECT {G}, count(*) AS NumLoans, SUM(CurrentBalance) AS CurrentBalance,
 SUM(OrigBalance) AS OriginalBalance, {ratio('SUM(CurrentBalance)', 'count(CurrentBalance)')} AS AvgLoanSize,
 {ratio('SUM(CurrentBalance)', 'SUM(OrigBalance)')} AS PoolFactor,
 {wavg_strict('CurrentRate')} AS WA_Coupon, {wavg_strict('Margin')} AS WA_Margin,
 {wavg_strict('CurrentLTV')} * 100 AS WA_CurrentLTV, {wavg_strict('OrigLTV')} * 100 AS WA_OrigLTV,
 {wavg_strict('SeasoningMonths')} AS WA_Seasoning_Months, {wavg_strict('RemainingTermMonths')} AS WA_RemainingTerm_Months,
 SUM(ArrearsBalance) AS ArrearsBalance, {_pct('MonthsInArrears >= 1')} AS Pct_Delinquent_1m_plus,
 {_pct('MonthsInArrears > 3')} AS Pct_SeriousArrears_3m_plus, {_pct('CurrentLTV > 1')} AS Pct_Underwater,
 {_pct("IsInterestOnly = 'Interest Only'")} AS Pct_InterestOnly, {_pct("IsBTL = 'Buy-to-Let'")} AS Pct_BTL,
 {ratio('SUM(PrepayAmountMonth)', 'SUM(CurrentBalance)')} * 100 AS SMM_PartialPrepay_proxy FROM loans GROUP BY {G}),
left0 AS (SELECT {G}, SUM(IsRedemption) AS rc, SUM(IsDefault) AS dc,
 SUM(CASE WHEN IsDefault = 1 THEN DefaultBalance END) AS db, SUM(CASE WHEN IsDefault = 1 THEN LossOnSale END) AS ls
 FROM exits GROUP BY {G}),
prep_pool AS (SELECT p.*, strftime(p.CutoffDate, '%Y-%m') AS Period, 'Tape (loan-level)' AS Source,
 COALESCE(rc, 0) AS Redemptions_Count, COALESCE(dc, 0) AS Defaults_Count, COALESCE(db, 0) AS Period_DefaultBalance,
 COALESCE(ls, 0) AS Period_LossOnSale, CASE WHEN dc > 0 THEN {ratio('COALESCE(ls, 0)', 'db')} * 100 END AS Period_LossSeverity
 FROM pool0 p LEFT JOIN left0 e ON p.DealID = e.DealID AND p.CutoffDate = e.CutoffDate)"""
PREP_POOL_DOUBLE = (
    "AvgLoanSize PoolFactor WA_Coupon WA_Margin WA_CurrentLTV WA_OrigLTV WA_Seasoning_Months WA_RemainingTerm_Months"
    " Pct_Delinquent_1m_plus Pct_SeriousArrears_3m_plus Pct_Underwater Pct_InterestOnly Pct_BTL SMM_PartialPrepay_proxy"
    " Period_LossSeverity"
).split()
PREP_POOL_MONEY = "CurrentBalance OriginalBalance ArrearsBalance Period_DefaultBalance Period_LossOnSale".split()
PREP_POOL_SHOWN = (
    "SELECT * REPLACE ("
    + ", ".join([f"{r(c)} AS {c}" for c in PREP_POOL_DOUBLE] + [f"{d(c)} AS {c}" for c in PREP_POOL_MONEY])
    + f", {n('Redemptions_Count')} AS Redemptions_Count, {n('Defaults_Count')} AS Defaults_Count)"
)
register(
    "prep_pool_summary",
    lambda x: present(prep.prep_pool_summary(x.loans(), x.exits())),
    query(PREP_POOL_SHOWN + " FROM prep_pool", TAPE, LOANS, EXITS, PREP_POOL),
)

DELINQUENCY = f"""totals AS (SELECT {G}, SUM(CurrentBalance) AS tot FROM loans GROUP BY {G}),
{values('buckets', 'Bucket, BucketOrder', [(b, i + 1) for i, b in enumerate(seeds.DQ_BUCKETS)])},
held AS (SELECT {G}, DelinquencyBucket, count(*) AS cnt, SUM(CurrentBalance) AS bal FROM loans GROUP BY ALL),
delinquency AS (SELECT t.DealID, t.CutoffDate, strftime(t.CutoffDate, '%Y-%m') AS Period, 'Tape (loan-level)' AS Source,
 b.Bucket, {n('b.BucketOrder')} AS BucketOrder, {d('COALESCE(h.bal, 0)')} AS Balance, COALESCE(h.cnt, 0) AS Number,
 {d('COALESCE(h.bal, 0)')} / {d('t.tot')} * 100 AS PctBalance
 FROM totals t CROSS JOIN buckets b LEFT JOIN held h
 ON h.DealID = t.DealID AND h.CutoffDate = t.CutoffDate AND h.DelinquencyBucket = b.Bucket)"""
register(
    "prep_delinquency",
    lambda x: present(prep.prep_delinquency(x.loans())),
    query(f"SELECT * REPLACE ({r('PctBalance')} AS PctBalance) FROM delinquency", TAPE, LOANS, DELINQUENCY),
)

# ------------------------------------------------------------------ measures


def _sum_if(pred: str) -> str:
    return f"SUM(CASE WHEN {pred} THEN CurrentBalance END)"


def _part(pred: str) -> str:
    return ratio(_sum_if(pred), "SUM(CurrentBalance)")


MONEY_MEASURES = {
    "CurrentBalance": "SUM(CurrentBalance)",
    "OriginalBalance": "SUM(OrigBalance)",
    "ArrearsBalance": "SUM(ArrearsBalance)",
    "DelinquentBalance_1m": _sum_if("MonthsInArrears >= 1"),
    "SeriousArrearsBalance_3m": _sum_if("MonthsInArrears > 3"),
    "DefaultBalance": "SUM(DefaultBalance)",
    "LossOnSale": "SUM(LossOnSale)",
    "Recoveries": "SUM(SalePrice)",
}
COUNT_MEASURES = {
    "LoanCount": "count(DISTINCT LoanID)",
    "DefaultsCount": "count(CASE WHEN IsDefault = 1 THEN 1 END)",
    "RedemptionsCount": "count(CASE WHEN IsRedemption = 1 THEN 1 END)",
}
RATIO_MEASURES = {
    "AvgLoanSize": ratio("SUM(CurrentBalance)", "count(DISTINCT LoanID)"),
    "PoolFactor": ratio("SUM(CurrentBalance)", "SUM(OrigBalance)"),
    "WA_Coupon": wavg("CurrentRate"),
    "WA_Margin": wavg("Margin"),
    "WA_CurrentLTV": wavg("CurrentLTV_pct"),
    "WA_OriginalLTV": wavg("OrigLTV_pct"),
    "WA_Seasoning": wavg("SeasoningMonths"),
    "WA_RemainingTerm": wavg("RemainingTermMonths"),
    "Pct_InterestOnly": _part("IsInterestOnly = 'Interest Only'"),
    "Pct_BuyToLet": _part("IsBTL = 'Buy-to-Let'"),
    "Pct_Delinquent_1m": _part("MonthsInArrears >= 1"),
    "Pct_SeriousArrears_3m": _part("MonthsInArrears > 3"),
    "Pct_Default": _part("AccountStatus IN ('Default / Foreclosure', 'Repossessed')"),
    "Pct_90DPD": _part("MonthsInArrears >= 3"),
    "SMM_PartialPrepay": ratio("SUM(PrepayAmountMonth)", "SUM(CurrentBalance)") + " * 100",
    "LossSeverity": ratio("SUM(LossOnSale)", "SUM(DefaultBalance)"),
    "RecoveryRate": ratio("SUM(SalePrice)", "SUM(DefaultBalance)"),
}


def measure_sql(names: list[str], table: str, by: str, where: str = "") -> str:
    cols = []
    for m in names:
        if m in MONEY_MEASURES:
            cols.append(f"{d(MONEY_MEASURES[m])} AS {m}")
        elif m in COUNT_MEASURES:
            cols.append(f"{n(COUNT_MEASURES[m])} AS {m}")
        else:
            cols.append(f"{r(RATIO_MEASURES[m])} AS {m}")
    return f"SELECT {by}, {', '.join(cols)} FROM {table} {where} GROUP BY {by}"


LOAN_QUERIES = {
    "dax_pool_overview": ["CurrentBalance", "OriginalBalance", "LoanCount", "AvgLoanSize", "PoolFactor"],
    "dax_weighted_averages": ["WA_Coupon", "WA_Margin", "WA_CurrentLTV", "WA_OriginalLTV", "WA_Seasoning", "WA_RemainingTerm"],
    "dax_product_mix": ["Pct_InterestOnly", "Pct_BuyToLet"],
    "dax_delinquency": [
        "ArrearsBalance", "DelinquentBalance_1m", "Pct_Delinquent_1m", "SeriousArrearsBalance_3m", "Pct_SeriousArrears_3m",
        "Pct_Default", "Pct_90DPD",
    ],
    "smm_partial_prepay": ["SMM_PartialPrepay"],
}
for _name, _names in LOAN_QUERIES.items():
    register(
        _name,
        lambda x, names=_names: present(measures.evaluate(x.loans(), measures.loan_measures(), names, GROUP)),
        query(measure_sql(_names, "loans", G), TAPE, LOANS),
    )
_SLICED = ["CurrentBalance", "LoanCount", "WA_CurrentLTV", "Pct_Delinquent_1m", "Pct_90DPD"]
register(
    "measure_sliced",
    lambda x: present(
        measures.evaluate(
            x.loans(), measures.loan_measures(), _SLICED, ["CutoffDate", "Region", "IsBTL"],
            (F.col("DealID") == "AVON2") & F.col("LTVBand").isin("70-80%", "80-90%"),
        )
    ),
    query(
        measure_sql(_SLICED, "loans", "CutoffDate, Region, IsBTL", "WHERE DealID = 'AVON2' AND LTVBand IN ('70-80%', '80-90%')"),
        TAPE, LOANS,
    ),
)
_LOSS = ["DefaultBalance", "LossOnSale", "Recoveries", "LossSeverity", "RecoveryRate", "DefaultsCount", "RedemptionsCount"]
register(
    "dax_loss",
    lambda x: present(measures.evaluate(x.exits(), measures.exit_measures(), _LOSS, GROUP)),
    query(measure_sql(_LOSS, "exits", G), TAPE, EXITS),
)
register(
    "dax_bucket_pct",
    lambda x: present(measures.bucket_share(x.loans(), GROUP)),
    query(
        f"SELECT {G}, DelinquencyBucket, {d('SUM(CurrentBalance)')} AS Balance,"
        f" {r(ratio('SUM(CurrentBalance)', f'SUM(SUM(CurrentBalance)) OVER (PARTITION BY {G})'))} AS BucketPct"
        f" FROM loans GROUP BY {G}, DelinquencyBucket",
        TAPE, LOANS,
    ),
)

# ------------------------------------------------------------------ stress

SHOCKS = values("shocks", "HPI_Shock_pct", [(float(s),) for s in seeds.HPI_SHOCKS])
CDRS = values("cdrs", "CDR_Multiplier", [(c,) for c in seeds.CDR_MULTIPLIERS])
SEVERITIES = values("severities", "Severity_Multiplier", [(s,) for s in seeds.SEVERITY_MULTIPLIERS])
BAL, VAL, UP = d("CurrentBalance"), d("CurrentValuation"), f"(1 + {d('HPI_Shock_pct')} / 100)"
NEW_LTV = f"({BAL} / NULLIF({VAL} * {UP}, 0))"
PD = (
    "(CASE WHEN MonthsInArrears = 0 THEN 0.02 WHEN MonthsInArrears <= 1 THEN 0.08 WHEN MonthsInArrears <= 3 THEN 0.25"
    " WHEN MonthsInArrears <= 6 THEN 0.5 ELSE 0.85 END)"
)
register(
    "stress_wa_ltv",
    lambda x: present(stress.stressed_wa_ltv(x.loans(), GROUP)),
    query(
        f"SELECT {G}, {d('HPI_Shock_pct')} AS HPI_Shock_pct,"
        f" {r(ratio(f'SUM({BAL} * {NEW_LTV} * 100)', 'SUM(CurrentBalance)'))} AS StressedWALTV"
        f" FROM loans CROSS JOIN shocks GROUP BY {G}, HPI_Shock_pct",
        TAPE, LOANS, SHOCKS,
    ),
)
register(
    "stress_underwater",
    lambda x: present(stress.stressed_underwater(x.loans(), GROUP)),
    query(
        f"SELECT {G}, {d('HPI_Shock_pct')} AS HPI_Shock_pct,"
        f" {d(f'SUM(CASE WHEN {NEW_LTV} > 1 THEN CurrentBalance ELSE 0 END)')} AS UnderwaterBalance,"
        f" {r(ratio(f'SUM(CASE WHEN {NEW_LTV} > 1 THEN CurrentBalance ELSE 0 END)', 'SUM(CurrentBalance)'))} AS Pct_Underwater"
        f" FROM loans CROSS JOIN shocks GROUP BY {G}, HPI_Shock_pct",
        TAPE, LOANS, SHOCKS,
    ),
)
register(
    "stress_base_pd",
    lambda x: present(stress.base_pd_balance(x.loans(), GROUP), BasePD=1),
    query(f"SELECT {G}, {r(f'fsum({BAL} * {PD})', 1)} AS BasePD FROM loans GROUP BY {G}", TAPE, LOANS),
)
# every loan times shock and severity; default multipliers act on the five probability classes afterwards
GRID = f"""exposed AS (SELECT {G}, HPI_Shock_pct, Severity_Multiplier, {PD} AS pd,
 fsum({BAL} * LEAST(1, GREATEST(0.1, 1 - COALESCE(1 / NULLIF({NEW_LTV}, 0), 0)) * Severity_Multiplier)) AS lost,
 fsum({BAL}) AS bal FROM loans CROSS JOIN shocks CROSS JOIN severities WHERE CurrentBalance IS NOT NULL GROUP BY ALL),
grid AS (SELECT {G}, {d('HPI_Shock_pct')} AS HPI_Shock_pct, {d('CDR_Multiplier')} AS CDR_Multiplier,
 {d('Severity_Multiplier')} AS Severity_Multiplier, fsum(LEAST(1, {d('pd')} * {d('CDR_Multiplier')}) * lost) AS ExpectedLoss,
 fsum(bal) AS bal FROM exposed CROSS JOIN cdrs GROUP BY ALL)"""
SCENARIO = "HPI_Shock_pct, CDR_Multiplier, Severity_Multiplier"
GRID_SHOWN = f"{G}, {SCENARIO}, {r('ExpectedLoss', 0)} AS ExpectedLoss, {r('ExpectedLoss / bal')} AS LossRate"
register(
    "stress_grid",
    lambda x: present(stress.stress_grid(x.loans(), GROUP), ExpectedLoss=0),
    query(f"SELECT {GRID_SHOWN} FROM grid", TAPE, LOANS, SHOCKS, CDRS, SEVERITIES, GRID),
)
register(
    "stress_expected_loss",
    lambda x: present(stress.stressed_expected_loss(x.loans(), GROUP, -30, 2, 1.25), ExpectedLoss=0),
    query(
        f"SELECT {GRID_SHOWN} FROM grid WHERE HPI_Shock_pct = -30 AND CDR_Multiplier = 2 AND Severity_Multiplier = 1.25",
        TAPE, LOANS, SHOCKS, CDRS, SEVERITIES, GRID,
    ),
)


def _coverage(x: Frames):
    return present(stress.note_coverage(stress.stress_grid(x.loans(), GROUP), seeds.note_classes(x.spark)), ExpectedLoss=0)


register(
    "stress_note_coverage",
    _coverage,
    query(
        f"SELECT {GRID_SHOWN}, CASE WHEN DealID = 'AVON2' THEN {d('support')} END AS CreditSupport,"
        f" CASE WHEN DealID = 'AVON2' THEN {r('ExpectedLoss / support')} END AS LossVsSupport FROM grid CROSS JOIN below",
        TAPE, LOANS, SHOCKS, CDRS, SEVERITIES, GRID,
        values("classes", "Class, CurrentBalance, Role", [(row[0], row[3], row[6]) for row in seeds.NOTE_CLASSES]),
        "below AS (SELECT CAST(sum(CurrentBalance) AS DOUBLE) AS support FROM classes WHERE Class <> 'Class A' AND Role <> 'Risk Retention')",
    ),
)
