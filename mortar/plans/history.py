"""Queries on history tables, period comparisons and reported measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from mortar.operators import controls, history, marts, measures, prep, reports
from mortar.plans.frames import Frames, present
from mortar.plans.loans import DELINQUENCY, G, POOL_SUMMARY_COLUMNS, PREP_POOL, PREP_POOL_DOUBLE, PREP_POOL_MONEY
from mortar.plans.registry import register
from mortar.plans.sqltext import EXITS, FACT, LOANS, REFS, REPORTED, STAR, TAPE, d, n, prep_arrears, query, r, ratio, values, wavg
from mortar.session import work_folder
from mortar.sources import history_table, seeds

KEY = ["DealID", "Period", "Source"]
_KEPT = "DealID Period Source Delivery CutoffDate CurrentBalance WA_Coupon WA_CurrentLTV CPR_1m CPR_12m CDR_1m".split()
NEWEST = "reported QUALIFY row_number() OVER (PARTITION BY DealID, Period, Source ORDER BY Batch DESC, Delivery DESC) = 1"


def _upserted(x: Frames):
    rows = x.reported()
    return history.upsert(rows.filter("Batch = 0"), rows.filter("Batch = 1"), KEY, ["Delivery"])


register(
    "history_upsert",
    lambda x: present(_upserted(x).select(*_KEPT)),
    query(
        f"SELECT * REPLACE ({d('CurrentBalance')} AS CurrentBalance) FROM (SELECT {', '.join(_KEPT)} FROM {NEWEST})", REPORTED
    ),
)


#: columns that only later deliveries have
_LATER = ["CPR_12m", "CDR_1m"]


def _stored(x: Frames):
    """The same through a stored history: batches merged one after the other, the second one twice.

    The first delivery lacks two columns, and a deal that is stored in between is replaced by nothing.
    """
    path = work_folder(x.spark, "history")
    rows = x.reported()
    first = rows.filter("Batch = 0").drop(*_LATER)
    history_table.merge_into(first, path, KEY, ["Delivery"])
    history_table.merge_into(first.filter("DealID = 'AVON2'").withColumn("DealID", F.lit("SOLD")), path, KEY, ["Delivery"])
    for _ in range(2):
        history_table.merge_into(rows.filter("Batch = 1"), path, KEY, ["Delivery"])
    history_table.replace_deal(rows.limit(0), path, "SOLD", KEY)
    history_table.remove_old(x.spark, path, 1)
    return history_table.read_history(x.spark, path)


register(
    "history_store",
    lambda x: present(_stored(x).select(*_KEPT)),
    query(
        f"SELECT * REPLACE ({d('CurrentBalance')} AS CurrentBalance) FROM (SELECT {', '.join(c for c in _KEPT if c not in _LATER)}, "
        + ", ".join(f"CASE WHEN Batch > 0 THEN {c} END AS {c}" for c in _LATER)
        + f" FROM {NEWEST})",
        REPORTED,
    ),
)


def _tape_history(x: Frames):
    return prep.prep_pool_summary(x.loans(), x.exits())


_SEEDED = ["Period", "CutoffDate", "Source", "NumLoans", "CurrentBalance", "AvgLoanSize", "WA_CurrentLTV", "WA_Coupon",
           "WA_Seasoning_Months", "CPR_1m", "CPR_3m", "CPR_12m", "PPR_1m", "PPR_3m", "PPR_12m", "CDR_1m", "CDR_3m",
           "CDR_Lifetime", "CumLossSeverity", "Pct_Delinquent_1m_plus"]
_SEED_ROWS = values(
    "seeded", ", ".join(_SEEDED),
    [tuple(str(v) if k in ("CutoffDate",) else float(v) if k == "CurrentBalance" else v for k, v in row.items()) for row in seeds.REPORTED_POOL],
)
register(
    "history_seeded",
    lambda x: present(history.seed(seeds.reported_pool(x.spark), _tape_history(x))),
    query(
        "SELECT * REPLACE ("
        + ", ".join([f"{r(c)} AS {c}" for c in PREP_POOL_DOUBLE + _SEEDED[9:-1]] + [f"{d(c)} AS {c}" for c in PREP_POOL_MONEY])
        + f", {n('NumLoans')} AS NumLoans, {n('Redemptions_Count')} AS Redemptions_Count, {n('Defaults_Count')} AS Defaults_Count) FROM"
        " (SELECT * REPLACE (CAST(CutoffDate AS DATE) AS CutoffDate) FROM seeded UNION ALL BY NAME"
        " SELECT * REPLACE (" + ", ".join(f"{d(c)} AS {c}" for c in PREP_POOL_MONEY) + ") FROM prep_pool)",
        TAPE, LOANS, EXITS, PREP_POOL, _SEED_ROWS,
    ),
)


def _balances(x: Frames):
    """Balances of both series: tapes and reports."""
    columns = ["DealID", "Source", "CutoffDate", "CurrentBalance"]
    tape = x.loans().groupBy("DealID", "CutoffDate").agg(F.sum("CurrentBalance").alias("CurrentBalance"))
    return tape.withColumn("Source", F.lit(prep.TAPE_SOURCE)).select(*columns).unionByName(
        x.reported().withColumn("Source", F.lit("Investor Report")).select(*columns)
    )


register(
    "roll_forward_cpr",
    lambda x: present(history.roll_forward_cpr(_balances(x))),
    query(
        f"""SELECT DealID, Source, CutoffDate, {d('bal')} AS Balance, {d('prev')} AS PreviousBalance, {r('smm')} AS SMM,
 {r('(1 - pow(1 - smm, 12)) * 100')} AS RollForwardCPR FROM
 (SELECT *, ({d('prev - bal')} / NULLIF({d('prev')}, 0)) AS smm FROM (SELECT DealID, Source, CutoffDate, SUM(CurrentBalance) AS bal,
  lag(SUM(CurrentBalance)) OVER (PARTITION BY DealID, Source ORDER BY CutoffDate) AS prev FROM
  (SELECT DealID, 'Tape (loan-level)' AS Source, CutoffDate, CurrentBalance FROM loans
   UNION ALL SELECT DealID, 'Investor Report', CutoffDate, CurrentBalance FROM reported) GROUP BY DealID, Source, CutoffDate))""",
        TAPE, LOANS, REPORTED,
    ),
)
_POOL = f"pool AS (SELECT {POOL_SUMMARY_COLUMNS} FROM star GROUP BY {G})"
register(
    "kpi_latest_period",
    lambda x: present(measures.kpi_latest_period(marts.pool_summary(x.star("LoanOriginationDate")), ["DealID"])),
    query(
        "SELECT DealID, CutoffDate AS LatestCutoff, TotalBalance AS PoolBalance, LoanCount AS TotalLoans, WA_LTV,"
        " WA_InterestRate AS WA_IntRate FROM pool QUALIFY row_number() OVER (PARTITION BY DealID ORDER BY CutoffDate DESC) = 1",
        TAPE, STAR, _POOL,
    ),
)
register(
    "kpi_latest_period_sliced",
    lambda x: present(
        measures.kpi_latest_period(marts.pool_summary(x.star("LoanOriginationDate")), where=F.col("CutoffDate") <= "2001-12-31")
    ),
    query(
        f"SELECT CutoffDate AS LatestCutoff, SUM(TotalBalance) AS PoolBalance, {n('SUM(LoanCount)')} AS TotalLoans,"
        f" {r('avg(WA_LTV)')} AS WA_LTV, {r('avg(WA_IntRate)')} AS WA_IntRate FROM"
        f" (SELECT CutoffDate, {d('SUM(CurrentBalance)')} AS TotalBalance, count(*) AS LoanCount, {wavg('CurrentLTV')} AS WA_LTV,"
        f" {wavg('CurrentInterestRate')} AS WA_IntRate FROM star GROUP BY {G})"
        " WHERE CutoffDate = DATE '2001-12-31' GROUP BY CutoffDate",
        TAPE, STAR,
    ),
)
register(
    "period_on_period",
    lambda x: present(history.period_on_period(x.fact())),
    query(
        f"""SELECT {G}, {d('bal')} AS Balance, {d('pre')} AS Prepayment, {d('def')} AS NewDefaults, {d('prev')} AS PreviousBalance,
 {d('bal - prev')} AS BalanceChange, {r(f"(1 - pow(1 - {ratio('pre', 'prev')}, 12)) * 100")} AS CPR,
 {r(f"(1 - pow(1 - {ratio('COALESCE(def, 0)', 'prev')}, 12)) * 100")} AS CDR FROM (SELECT {G}, SUM(CurrentBalance) AS bal,
 SUM(PrepaymentAmount) AS pre, SUM(CASE WHEN date_trunc('month', DateOfDefault) = date_trunc('month', CutoffDate)
 THEN DefaultAmount END) AS def, lag(SUM(CurrentBalance)) OVER (PARTITION BY DealID ORDER BY CutoffDate) AS prev
 FROM fact GROUP BY {G})""",
        TAPE, REFS, FACT,
    ),
)


def _migration_sql(source: str, *parts: str) -> str:
    return query(
        f"SELECT {G}, FromBucket, ToBucket, count(*) AS Loans, {d('SUM(CurrentBalance)')} AS Balance,"
        f" {r(ratio('count(*)', f'SUM(count(*)) OVER (PARTITION BY {G}, FromBucket)'))} AS RowShare"
        f" FROM ({source}) GROUP BY {G}, FromBucket, ToBucket",
        *parts,
    )


for _months, _name in ((1, "arrears_migration"), (2, "arrears_migration_two_months")):
    _before = {1: "Arrears1MonthAgo", 2: "Arrears2MonthsAgo"}[_months]
    register(
        _name,
        lambda x, months=_months: present(history.arrears_migration(x.fact(), months)),
        _migration_sql(
            f"SELECT {G}, CurrentBalance, {prep_arrears(_before)} AS FromBucket, {prep_arrears('MonthsInArrears')} AS ToBucket FROM fact",
            TAPE, REFS, FACT,
        ),
    )
register(
    "arrears_migration_periods",
    lambda x: present(history.arrears_migration_periods(x.fact(), x.parts())),
    _migration_sql(
        f"SELECT * FROM (SELECT {G}, CurrentBalance, ToBucket, lag(ToBucket) OVER (PARTITION BY DealID, LoanID ORDER BY CutoffDate)"
        f" AS FromBucket FROM (SELECT {G}, LoanID, CurrentBalance, {prep_arrears('MonthsInArrears')} AS ToBucket FROM fact"
        " WHERE LoanID IS NOT NULL)) WHERE FromBucket IS NOT NULL",
        TAPE, REFS, FACT,
    ),
)


def _monthly(x: Frames):
    return x.reported().groupBy("DealID", "CutoffDate").agg(F.sum("CurrentBalance").alias("Balance"))


register(
    "time_intelligence",
    lambda x: present(history.time_intelligence(_monthly(x), "Balance")),
    query(
        f"""SELECT m.DealID, m.CutoffDate, {d('m.Balance')} AS Balance, {d('m.FirstPeriod')} AS FirstPeriod,
 {d('m.PriorPeriod')} AS PriorPeriod, {d('m.YearToDate')} AS YearToDate, {d('y.Balance')} AS YearAgo FROM
 (SELECT *, first_value(Balance) OVER w AS FirstPeriod, lag(Balance) OVER w AS PriorPeriod,
  SUM(Balance) OVER (PARTITION BY DealID, year(CutoffDate) ORDER BY CutoffDate ROWS UNBOUNDED PRECEDING) AS YearToDate
  FROM monthly WINDOW w AS (PARTITION BY DealID ORDER BY CutoffDate)) m
 LEFT JOIN monthly y ON y.DealID = m.DealID AND year(y.CutoffDate) = year(m.CutoffDate) - 1 AND month(y.CutoffDate) = month(m.CutoffDate)""",
        REPORTED, "monthly AS (SELECT DealID, CutoffDate, SUM(CurrentBalance) AS Balance FROM reported GROUP BY DealID, CutoffDate)",
    ),
)

# ------------------------------------------------------------------ reported measures

_AVG = {
    "CPR_1M": "CPR_1m", "CPR_3M": "CPR_3m", "CPR_12M": "CPR_12m", "CDR_1M": "CDR_1m", "CDR_Lifetime": "CDR_Lifetime",
    "CumulativeLossSeverity": "CumLossSeverity", "HistoryWACoupon": "WA_Coupon", "HistoryWALTV": "WA_CurrentLTV",
    "HistoryPctDelinquent": "Pct_Delinquent_1m_plus",
}
_SMM = "1 - pow(1 - avg(CPR_1m) / 100, 1.0::DOUBLE / 12)"


def _reported_sql(names: list[str]) -> str:
    cols = []
    for name in names:
        if name == "HistoryBalance":
            cols.append(f"{d('SUM(CurrentBalance)')} AS HistoryBalance")
        else:
            cols.append(f"{r(_SMM if name == 'SMM' else f'avg({_AVG[name]})')} AS {name}")
    return query(f"SELECT DealID, Period, {', '.join(cols)} FROM {{}} GROUP BY DealID, Period".format(f"(SELECT * FROM {NEWEST})"), REPORTED)


for _name, _names in {
    "dax_cpr_reported": ["CPR_1M", "CPR_3M", "CPR_12M"],
    "smm_from_cpr": ["CPR_1M", "SMM"],
    "dax_cdr_reported": ["CDR_1M", "CDR_Lifetime", "CumulativeLossSeverity"],
    "dax_history": ["HistoryBalance", "HistoryWACoupon", "HistoryWALTV", "HistoryPctDelinquent"],
}.items():
    register(
        _name,
        lambda x, names=_names: present(measures.evaluate(_upserted(x), measures.history_measures(), names, ["DealID", "Period"])),
        _reported_sql(_names),
    )
register(
    "psa_equivalent",
    lambda x: present(measures.psa_equivalent(_upserted(x), x.loans(), ["DealID"])),
    query(
        f"SELECT h.DealID, {r('cpr')} AS CPR_1M, {r('age')} AS WA_Seasoning, {r('cpr / LEAST(0.2::DOUBLE * age, 6) * 100')} AS PSA FROM"
        f" (SELECT DealID, avg(CPR_1m) AS cpr FROM (SELECT * FROM {NEWEST}) GROUP BY DealID) h"
        f" JOIN (SELECT DealID, {wavg('SeasoningMonths')} AS age FROM loans GROUP BY DealID) l ON h.DealID = l.DealID",
        TAPE, LOANS, REPORTED,
    ),
)
_DQ_SEED = values(
    "dq_seed", "Period, Bucket, Balance, PctBalance",
    [(p, seeds.DQ_BUCKETS[i], bal, pct) for p, rows in seeds.REPORTED_DELINQUENCY.items() for i, (bal, _, pct) in enumerate(rows)],
)


def _dq_history(x: Frames):
    return history.seed(seeds.reported_delinquency(x.spark), prep.prep_delinquency(x.loans()))


register(
    "dax_dq_history",
    lambda x: present(
        measures.evaluate(_dq_history(x), measures.history_measures(), ["BucketBalance", "BucketPct"], ["Period", "Bucket"])
    ),
    query(
        f"SELECT Period, Bucket, {r('SUM(b)', 2)} AS BucketBalance, {r('avg(p)')} AS BucketPct FROM"
        f" (SELECT Period, Bucket, {d('Balance')} AS b, {d('PctBalance')} AS p FROM dq_seed"
        " UNION ALL SELECT Period, Bucket, Balance, PctBalance FROM delinquency) GROUP BY Period, Bucket",
        TAPE, LOANS, DELINQUENCY, _DQ_SEED,
    ),
)
