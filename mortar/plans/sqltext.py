"""Building blocks of the DuckDB check queries."""

from __future__ import annotations

from mortar.operators import conform as cf
from mortar.sources import sample_tape, seeds


def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def r(x: str, digits: int = 6) -> str:
    return f"round_even({x}, {digits})"


def he(x: str, digits: int) -> str:
    """Half-even rounding of a double by its decimal digits (the engine's own works on the binary product)."""
    return hd(f"CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18))", digits)


def hd(x: str, digits: int) -> str:
    """Half-even rounding of an exact decimal."""
    scaled = f"abs({x}) * {10**digits}"
    up = "CASE WHEN v - floor(v) > 0.5 OR (v - floor(v) = 0.5 AND floor(v) % 2 = 1) THEN 1 ELSE 0 END"
    return (
        f"CAST(CAST(sign({x}) * list_transform([{scaled}], lambda v: floor(v) + {up})[1] AS DECIMAL(38,0))"
        f" AS DOUBLE) / {10**digits}"
    )


def n(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def ratio(a: str, b: str) -> str:
    return f"({d(a)} / NULLIF({d(b)}, 0))"


def wavg(value: str, weight: str = "CurrentBalance") -> str:
    """Total-form weighted average."""
    return ratio(f"SUM({d(value)} * {d(weight)})", f"SUM({weight})")


def wavg_strict(value: str, weight: str = "CurrentBalance") -> str:
    ok = f"FILTER (WHERE ({value}) IS NOT NULL AND {weight} > 0)"
    return ratio(f"SUM({d(value)} * {d(weight)}) {ok}", f"SUM({weight}) {ok}")


def text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def labels(expr: str, mapping: dict[str, str], numeric: bool = True) -> str:
    """CASE over a code list; numeric codes compare as numbers."""
    key = f"TRY_CAST({expr} AS DOUBLE)" if numeric else expr
    arms = " ".join(f"WHEN {code if numeric else text(code)} THEN {text(label)}" for code, label in mapping.items())
    return f"(CASE {key} {arms} END)"


def typed(field: str, kind: str, fmt: cf.DealFormat) -> str:
    c = f"CAST(NULL AS VARCHAR)" if field in fmt.absent else f"t.{field}"
    quarter = f"last_day(make_date(CAST(right({c}, 4) AS INT), CAST(substr({c}, 2, 1) AS INT) * 3, 1))"
    return {
        "text": c,
        "whole": f"(CASE WHEN regexp_matches({c}, '^[+-]?[0-9]+$') THEN TRY_CAST({c} AS BIGINT) END)",
        "money": f"TRY_CAST({c} AS DECIMAL(18,2))",
        "ratio": f"TRY_CAST({c} AS DECIMAL(18,9))",
        "rate": f"CAST(TRY_CAST({c} AS DECIMAL(18,9)) * {fmt.rate_factor} AS DECIMAL(18,9))",
        "date": f"TRY_CAST({c} AS DATE)",
        "origination": quarter if fmt.quarter_dates else f"TRY_CAST({c} AS DATE)",
    }[kind]


def conformed(name: str, fmt: cf.DealFormat, plain: dict, decoded: list, latest: bool) -> str:
    """One conformed deal as a common table expression."""
    cols = ["t.DealID"] + [f"{typed(f, k, fmt)} AS {c}" for c, (f, k) in plain.items()]
    joins = []
    for i, (c, f, ref) in enumerate(decoded):
        code = typed(f, "text", fmt)
        cols += [f"r{i}.label AS {c}", f"{code} AS {c}_code"]
        joins.append(f"LEFT JOIN ref_{ref} r{i} ON {code} = r{i}.code")
    rows = f"SELECT * FROM tape WHERE DealID = '{fmt.deal_id}'" + ("" if fmt.keep_null_ids else " AND AR3 IS NOT NULL")
    if latest:
        ties = ", ".join(f"{c} ASC NULLS LAST" for c in cf.TIE_BREAK)
        rows += f" QUALIFY row_number() OVER (PARTITION BY DealID, AR3 ORDER BY AR1 DESC, {ties}) = 1"
    return f"{name} AS (SELECT {', '.join(cols)} FROM ({rows}) t {' '.join(joins)})"


def shown(plain: dict, decoded: list) -> str:
    """Output list of a conformed table."""
    cols = ["DealID"]
    for c, (_, kind) in plain.items():
        cols.append(f"{d(c)} AS {c}" if kind in ("money", "ratio", "rate") else c)
    for c, _, _ in decoded:
        cols += [c, f"{c}_code"]
    return ", ".join(cols)


REFS = ",\n".join(values(f"ref_{name}", "code, label", rows.items()) for name, rows in seeds.REF_TABLES.items())
AREAS = values(
    "areas", "area, region_code", seeds.POSTCODE_AREAS
)
TAPE = sample_tape.loan_tape_sql()
NOTES = sample_tape.note_tape_sql()
REPORTED = sample_tape.reported_history_sql()
PAGES = sample_tape.report_pages_sql()

DIM = ",\n".join(
    [
        REFS,
        conformed("dim_a", cf.AVON, cf.DIM_PLAIN, cf.DIM_DECODED, True),
        conformed("dim_b", cf.BLETCHLEY, cf.DIM_PLAIN, cf.DIM_DECODED, True),
        "dim AS (SELECT * FROM dim_a UNION ALL SELECT * FROM dim_b)",
    ]
)
FACT = ",\n".join(
    [
        conformed("fact_a", cf.AVON, cf.FACT_PLAIN, cf.FACT_DECODED, False),
        conformed("fact_b", cf.BLETCHLEY, cf.FACT_PLAIN, cf.FACT_DECODED, False),
        "fact AS (SELECT * FROM fact_a UNION ALL SELECT * FROM fact_b)",
    ]
)
STAR = (
    f"{DIM},\n{FACT},\n"
    "star AS (SELECT f.*, l.Region, l.OccupancyType, l.RepaymentMethod, l.LoanOriginationDate,"
    " date_diff('month', l.LoanOriginationDate, f.CutoffDate) AS Seasoning"
    " FROM fact f LEFT JOIN dim l ON f.DealID = l.DealID AND f.LoanID = l.LoanID)"
)

P = seeds.PREP_LABELS


def prep_label(field: str, labels_: str, default: str) -> str:
    return f"COALESCE({labels(field, P[labels_])}, '{default}')"


LTV_CASE = """CASE WHEN {x} IS NULL THEN 'Unknown'
 WHEN {p} <= 50 THEN '0-50%' WHEN {p} <= 60 THEN '50-60%' WHEN {p} <= 70 THEN '60-70%' WHEN {p} <= 80 THEN '70-80%'
 WHEN {p} <= 90 THEN '80-90%' WHEN {p} <= 100 THEN '90-100%' ELSE '>100% (underwater)' END"""


def prep_ltv(x: str) -> str:
    return LTV_CASE.format(x=x, p=f"(CASE WHEN {x} <= 2 THEN {x} * 100 ELSE {x} END)")


def prep_arrears(x: str) -> str:
    m = f"COALESCE({x}, 0)"
    return (
        f"CASE WHEN {m} > 6 THEN '> 6 Months' WHEN {m} > 5 THEN '5 - 6 Months' WHEN {m} > 4 THEN '4 - 5 Months'"
        f" WHEN {m} > 3 THEN '3 - 4 Months' WHEN {m} > 2 THEN '2 - 3 Months' WHEN {m} > 1 THEN '1 - 2 Months'"
        f" ELSE '<= 1 Month' END"
    )


LOANS = f"""loans0 AS (SELECT DealID, AR3 AS LoanID, AR2 AS Pool, CAST(AR1 AS DATE) AS CutoffDate, AR5 AS Originator,
 CASE AR4 WHEN 'Y' THEN 'Regulated' WHEN 'N' THEN 'Unregulated' ELSE 'Unknown' END AS Regulated,
 COALESCE(AR17, 'No Data') AS CreditQuality, AR22 AS FirstTimeBuyer,
 {prep_label('AR27', 'income_verification', 'No Data')} AS IncomeVerification,
 TRY_CAST(AR26 AS DECIMAL(18,2)) AS PrimaryIncome,
 {prep_label('AR58', 'channel', 'No Data')} AS OrigChannel, {prep_label('AR59', 'purpose', 'No Data')} AS Purpose,
 CASE WHEN AR55 LIKE 'Q%' THEN make_date(CAST(right(AR55, 4) AS INT), CAST(substr(AR55, 2, 1) AS INT) * 3 - 1, 1)
   ELSE TRY_CAST(AR55 AS DATE) END AS OrigDate,
 TRY_CAST(AR56 AS DATE) AS MaturityDate, TRY_CAST(AR61 AS DOUBLE) AS OrigTermMonths,
 TRY_CAST(AR66 AS DECIMAL(18,2)) AS OrigBalance,
 CASE WHEN TRY_CAST(AR67 AS DECIMAL(18,2)) < 0 THEN 0 ELSE TRY_CAST(AR67 AS DECIMAL(18,2)) END AS CurrentBalance,
 {prep_label('AR69', 'repayment', 'Other')} AS RepaymentMethod, TRY_CAST(AR71 AS DECIMAL(18,2)) AS PaymentDue,
 {prep_label('AR107', 'rate_type', 'Other')} AS RateType, {prep_label('AR108', 'rate_index', 'Other')} AS RateIndex,
 TRY_CAST(AR109 AS DOUBLE) AS CurrentRate, TRY_CAST(AR110 AS DOUBLE) AS Margin,
 COALESCE({labels('AR128', P['region'], False)}, AR128, 'Unknown') AS Region,
 {prep_label('AR130', 'occupancy', 'No Data')} AS Occupancy,
 {prep_label('AR131', 'property_type', 'No Data')} AS PropertyType,
 TRY_CAST(AR135 AS DOUBLE) AS OrigLTV, TRY_CAST(AR136 AS DECIMAL(18,2)) AS OrigValuation,
 TRY_CAST(AR141 AS DOUBLE) AS CurrentLTV, TRY_CAST(AR143 AS DECIMAL(18,2)) AS CurrentValuation,
 {prep_label('AR166', 'account_status', 'Performing')} AS AccountStatus,
 COALESCE(TRY_CAST(AR169 AS DECIMAL(18,2)), 0) AS ArrearsBalance,
 COALESCE(TRY_CAST(AR170 AS DOUBLE), 0) AS MonthsInArrears,
 COALESCE(TRY_CAST(AR97 AS DECIMAL(18,2)), 0) AS PrepayAmountMonth,
 COALESCE(TRY_CAST(AR100 AS DECIMAL(18,2)), 0) AS CumulativePrepay, AR174 AS Litigation
 FROM tape WHERE AR3 IS NOT NULL),
loans AS (SELECT *, date_diff('month', OrigDate, CutoffDate) AS SeasoningMonths,
 date_diff('month', CutoffDate, MaturityDate) AS RemainingTermMonths, year(OrigDate) AS VintageYear,
 CASE WHEN RepaymentMethod IN ('Interest Only', 'Part & Part') THEN 'Interest Only' ELSE 'Repayment' END AS IsInterestOnly,
 CASE WHEN Occupancy LIKE '%Buy-to-Let%' THEN 'Buy-to-Let' ELSE 'Owner-Occupied' END AS IsBTL,
 CASE WHEN CurrentLTV > 1 THEN 'Underwater (LTV>100%)' ELSE 'In Equity' END AS Underwater,
 CASE WHEN MonthsInArrears >= 1 THEN 1 ELSE 0 END AS IsDelinquent,
 CASE WHEN MonthsInArrears > 3 THEN 1 ELSE 0 END AS IsSeriousArrears,
 {prep_ltv('CurrentLTV')} AS LTVBand, {prep_ltv('OrigLTV')} AS OrigLTVBand,
 CASE WHEN date_diff('month', OrigDate, CutoffDate) IS NULL THEN 'Unknown'
   WHEN date_diff('month', OrigDate, CutoffDate) < 60 THEN '0-5y'
   WHEN date_diff('month', OrigDate, CutoffDate) < 120 THEN '5-10y'
   WHEN date_diff('month', OrigDate, CutoffDate) < 180 THEN '10-15y'
   WHEN date_diff('month', OrigDate, CutoffDate) < 240 THEN '15-20y' ELSE '20y+' END AS SeasoningBand,
 CASE WHEN CurrentRate IS NULL THEN 'Unknown' WHEN CurrentRate < 2 THEN '<2%' WHEN CurrentRate < 3 THEN '2-3%'
   WHEN CurrentRate < 4 THEN '3-4%' WHEN CurrentRate < 5 THEN '4-5%' ELSE '>5%' END AS RateBand,
 CASE WHEN CurrentBalance IS NULL THEN 'Unknown' WHEN CurrentBalance < 50000 THEN '<50k'
   WHEN CurrentBalance < 100000 THEN '50-100k' WHEN CurrentBalance < 150000 THEN '100-150k'
   WHEN CurrentBalance < 250000 THEN '150-250k' WHEN CurrentBalance < 500000 THEN '250-500k' ELSE '>500k' END AS BalanceBand,
 {prep_arrears('MonthsInArrears')} AS DelinquencyBucket,
 CurrentLTV * 100 AS CurrentLTV_pct, OrigLTV * 100 AS OrigLTV_pct FROM loans0)"""

EXITS = f"""exits0 AS (SELECT DealID, AR2 AS Pool, AR8 AS PropertyID,
 {prep_label('AR166', 'account_status', 'Other')} AS ExitStatus, TRY_CAST(AR175 AS DATE) AS RedemptionDate,
 TRY_CAST(AR177 AS DECIMAL(18,2)) AS DefaultBalance, TRY_CAST(AR178 AS DATE) AS DefaultDate,
 TRY_CAST(AR179 AS DECIMAL(18,2)) AS SalePrice, TRY_CAST(AR180 AS DECIMAL(18,2)) AS LossOnSale,
 CAST(AR1 AS DATE) AS CutoffDate
 FROM tape WHERE AR166 IN ('3', '4', '5') AND AR8 IS NOT NULL),
exits AS (SELECT *, CASE WHEN DefaultBalance > 0 THEN {ratio('LossOnSale', 'DefaultBalance')} END AS LossSeverity,
 CASE WHEN DefaultBalance > 0 THEN {ratio('SalePrice', 'DefaultBalance')} END AS RecoveryRate,
 CASE WHEN DefaultBalance > 0 THEN 1 ELSE 0 END AS IsDefault,
 CASE WHEN ExitStatus = 'Redeemed' THEN 1 ELSE 0 END AS IsRedemption FROM exits0)"""


def query(select: str, *parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select
