"""Queries on investor-report text."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from mortar.operators import controls, marts, reports
from mortar.plans.frames import Frames, present
from mortar.plans.loans import G, POOL_SUMMARY_COLUMNS
from mortar.plans.registry import register
from mortar.plans.sqltext import PAGES, STAR, TAPE, d, he, query, r, values
from mortar.session import kept, work_folder
from mortar.sources import history_table, seeds

CONFIG = values("config", "deal_id, pattern, class_a, subordination", seeds.REPORT_CONFIG)
CHOSEN = (
    "chosen AS (SELECT p.* FROM report_pages p JOIN config c ON p.deal_id = c.deal_id WHERE regexp_matches(file_name, pattern)"
    " AND file_name NOT LIKE '%DBRS%' AND lower(file_name) NOT LIKE '%rating%')"
)

# fixed values: the layouts of the two report families, written out for the check
WRITTEN = SimpleNamespace(
    BALANCE=[
        r"Current Balance of Mortgage Loans[^\d]*([\d,]+\.?\d*)",
        r"Outstanding Current Balance of the Portfolio[^\d]*([\d,]+\.?\d*)",
    ],
    LOANS=[r"Number of.*Mortgage Loans[^\d]*([\d,]+)"],
    LTV=[r"Weighted Average Loan to Value[^\d]*([\d.]+)%?", r"Weighted Average Current Loan to Value[^\d]*([\d.]+)%?"],
    CPR_YEAR=[r"Annualised CPR[^\d]*([\d.]+)%?"],
    CPR_MONTH=[r"Current CPR\s+([\d.]+)%?", r"Constant Principal Pre-?payment Rate[^\d]*([\d.]+)%?"],
    ANY_DATE=r"(\d{1,2})[-/](Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[-/](\d{4})",
    ARREARS_SIX=r">\s*6\.?\d*\s*Months in Arrears[^\d]*([\d,]+\.?\d*)[^\d]*([\d,]+)[^\d]*([\d.]+)%?",
    ARREARS_THREE=r">=\s*3\s+(\d+)\s+([\d.]+)%?\s+([\d,.]+)\s+([\d.]+)%?",
    ARREARS_ROWS=r"([345]\.?\d*|>\s*6).*Months in Arrears[^\d]*([\d,]+\.?\d*)[^\d]*([\d,]+)[^\d]*([\d.]+)%?",
    PERIOD_END=r"Reporting Period End Date[:\s]+(\d{1,2}[-/]\w+[-/]\d{4})",
    NAME_STAMP=r"(\d{4})(\d{2})(\d{2})",
    NAME_MONTH=r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\s*(\d{4})",
    NOTE_NUMBERS=r"([\d,]{3,}(?:,\d{3})*\.?\d*)",
    ROW_NUMBERS=r"([\d,]+\.?\d*)",
)
ANY_CASE = "(?i)"


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _found(column: str, pattern: str, group: int) -> str:
    return f"NULLIF(regexp_extract({column}, {_q(pattern)}, {group}), '')"


def _num(text: str) -> str:
    return f"TRY_CAST(replace(replace({text}, ',', ''), '%', '') AS DOUBLE)"


_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _month(text: str) -> str:
    return f"NULLIF(list_position({_MONTHS}, lower({text})), 0)"


_YEAR = f"CAST({_found('lower(file_name)', WRITTEN.NAME_MONTH, 2)} AS INT)"
_MON = f"CAST({_month(_found('lower(file_name)', WRITTEN.NAME_MONTH, 1))} AS INT)"
REPORT_DATE = (
    f"CASE WHEN regexp_matches(file_name, {_q(WRITTEN.NAME_STAMP)}) THEN TRY_CAST("
    + " || '-' || ".join(_found("file_name", WRITTEN.NAME_STAMP, g) for g in (1, 2, 3))
    + f" AS DATE) WHEN {_MON} = 2 THEN make_date({_YEAR}, 2, 28) ELSE last_day(make_date({_YEAR}, {_MON}, 1)) END"
)
_WRITTEN = f"CAST(try_strptime({_found('text', WRITTEN.PERIOD_END, 1)}, ['%d-%b-%Y', '%d/%b/%Y', '%d-%B-%Y']) AS DATE)"
_ANY = (
    f"TRY_CAST({_found('text', ANY_CASE + WRITTEN.ANY_DATE, 3)} || '-' || lpad(CAST({_month(_found('text', ANY_CASE + WRITTEN.ANY_DATE, 2))} AS VARCHAR), 2, '0')"
    f" || '-' || lpad({_found('text', ANY_CASE + WRITTEN.ANY_DATE, 1)}, 2, '0') AS DATE)"
)
DATES = f"""dates AS (SELECT deal_id, file_name, {REPORT_DATE} AS ReportDate, COALESCE(found, {REPORT_DATE}) AS CutoffDate FROM
 (SELECT deal_id, file_name, arg_min(hit, page_no) FILTER (WHERE hit IS NOT NULL) AS found FROM
  (SELECT deal_id, file_name, page_no, COALESCE({_WRITTEN}, {_ANY}) AS hit FROM chosen)
  GROUP BY deal_id, file_name))"""

_ROWS = f"regexp_extract_all(text, {_q(WRITTEN.ARREARS_ROWS)}, 4)"
_CANDIDATES = {
    "PoolBalance": [_num(_found("text", p, 1)) for p in WRITTEN.BALANCE],
    "WA_LTV": [_num(_found("text", ANY_CASE + p, 1)) for p in WRITTEN.LTV],
    "LoanCount": [_num(_found("text", p, 1)) for p in WRITTEN.LOANS],
    "CPR_1m": [_num(_found("text", ANY_CASE + p, 1)) for p in WRITTEN.CPR_MONTH],
    "CPR_12m": [_num(_found("text", ANY_CASE + p, 1)) for p in WRITTEN.CPR_YEAR],
    "Arrears_90Plus_Pct": [
        _num(_found("text", WRITTEN.ARREARS_SIX, 3)),
        f"CASE WHEN contains(text, 'Current Months in Arrears') THEN {_num(_found('text', WRITTEN.ARREARS_THREE, 4))} END",
        f"CASE WHEN len({_ROWS}) > 0 THEN list_sum(list_transform({_ROWS}, lambda t: COALESCE(TRY_CAST(t AS DOUBLE), 0))) END",
    ],
}
METRICS = (
    "tried AS (SELECT deal_id, file_name, page_no, "
    + ", ".join(f"[{', '.join(c)}] AS c_{name}" for name, c in _CANDIDATES.items())
    + " FROM chosen),\nflagged AS (SELECT deal_id, file_name, page_no, "
    + ", ".join(
        f"list_filter(c_{name}, lambda v: v <> 0)[1] AS v_{name}, len(list_filter(c_{name}, lambda v: v = 0)) > 0 AS z_{name}"
        for name in _CANDIDATES
    )
    + " FROM tried),\nmetrics AS (SELECT deal_id, file_name, "
    + ", ".join(
        f"COALESCE(arg_min(v_{name}, page_no) FILTER (WHERE v_{name} IS NOT NULL), CASE WHEN bool_or(z_{name}) THEN 0 END) AS {name}"
        for name in _CANDIDATES
    )
    + " FROM flagged GROUP BY deal_id, file_name)"
)
_LARGE = f"list_filter(list_transform(regexp_extract_all(line, {_q(WRITTEN.NOTE_NUMBERS)}, 1), lambda t: {_num('t')}), lambda v: v > 1000000)"
_CELLS = f"list_transform(regexp_extract_all(line, {_q(WRITTEN.ROW_NUMBERS)}, 1), lambda t: {_num('t')})"
NOTE_ROWS = f"""note_lines AS (SELECT deal_id, file_name, page_no, text, unnest(string_split(text, chr(10))) AS line,
 generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM chosen),
isin_rows AS (SELECT deal_id, file_name, page_no, 1 AS layout, line_no, COALESCE({_LARGE}[2], {_LARGE}[1]) AS value, NULL::DOUBLE AS factor
 FROM note_lines WHERE line LIKE '%Class A%' AND line LIKE '%XS%' AND line LIKE '%GBP%' AND line NOT LIKE '%Class B%' AND line NOT LIKE '%Notes%'),
table_rows AS (SELECT deal_id, file_name, page_no, 2 AS layout, line_no, {_CELLS}[4] AS value, {_CELLS}[5] AS factor FROM note_lines
 WHERE text LIKE '%Principal%' AND text LIKE '%Ending Balance%' AND trim(line) LIKE 'Class A%' AND line NOT LIKE '%Notes%'
 AND line NOT LIKE '%XS%' AND len({_CELLS}) = 5 AND {_CELLS}[4] > 1000000 AND {_CELLS}[5] > 0 AND {_CELLS}[5] < 2),
note_values AS (SELECT deal_id, file_name, value AS ClassA_Balance, factor AS ReportedFactor FROM
 (SELECT * FROM isin_rows UNION ALL SELECT * FROM table_rows) WHERE value IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY deal_id, file_name ORDER BY page_no, layout, line_no) = 1),
note_ratios AS (SELECT v.*, CASE WHEN ClassA_Balance <> 0 THEN {he('c.subordination / (v.ClassA_Balance + c.subordination)', 4)} END AS CE_ClassA,
 {he('COALESCE(v.ReportedFactor, v.ClassA_Balance / c.class_a)', 4)} AS Factor_ClassA
 FROM note_values v JOIN (SELECT deal_id, CAST(class_a AS DOUBLE) AS class_a, CAST(subordination AS DOUBLE) AS subordination FROM config) c
 ON v.deal_id = c.deal_id)"""
REPORT = """report AS (SELECT t.deal_id AS DealID, ReportDate, CutoffDate, CPR_1m, CPR_12m, PoolBalance, WA_LTV, Arrears_90Plus_Pct,
 CE_ClassA, Factor_ClassA FROM dates t JOIN metrics m ON t.deal_id = m.deal_id AND t.file_name = m.file_name
 LEFT JOIN note_ratios n ON t.deal_id = n.deal_id AND t.file_name = n.file_name WHERE CutoffDate IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY t.deal_id, CutoffDate ORDER BY t.file_name) = 1)"""
ALL_PARTS = (PAGES, CONFIG, CHOSEN, DATES, METRICS, NOTE_ROWS, REPORT)


def _chosen(x: Frames):
    return reports.select_reports(x.pages(), seeds.report_config(x.spark))


def _metrics(x: Frames):
    return reports.report_metrics(x.pages(), seeds.report_config(x.spark))


register("ir_dates", lambda x: reports.report_dates(_chosen(x)), query("SELECT * FROM dates", PAGES, CONFIG, CHOSEN, DATES))
register(
    "ir_pool_metrics",
    lambda x: present(reports.pool_metrics(_chosen(x))),
    query(
        f"SELECT * REPLACE ({r('Arrears_90Plus_Pct')} AS Arrears_90Plus_Pct) FROM metrics", PAGES, CONFIG, CHOSEN, METRICS
    ),
)
register(
    "ir_note_balances",
    lambda x: present(reports.note_balances(_chosen(x))),
    query("SELECT * FROM note_values", PAGES, CONFIG, CHOSEN, NOTE_ROWS),
)
register(
    "ir_credit_enhancement",
    lambda x: present(reports.class_a_ratios(reports.note_balances(_chosen(x)), seeds.report_config(x.spark))),
    query("SELECT deal_id, file_name, ClassA_Balance, CE_ClassA, Factor_ClassA FROM note_ratios", PAGES, CONFIG, CHOSEN, NOTE_ROWS),
)
_SHOWN = f"SELECT * REPLACE ({r('Arrears_90Plus_Pct')} AS Arrears_90Plus_Pct) FROM report"
register("ir_metrics", lambda x: present(_metrics(x)), query(_SHOWN, *ALL_PARTS))


def _replaced(x: Frames):
    """A stored history of both deals whose slice of one deal is replaced by a new extraction.

    The old slice has other dates and balances, none of which may be left.
    """
    path, order = work_folder(x.spark, "reports"), ["DealID", "CutoffDate"]
    metrics, mine = kept(_metrics(x), "metrics"), F.col("DealID") == "AVON2"
    old = metrics.withColumns(
        {
            "CutoffDate": F.when(mine, F.date_sub("CutoffDate", 400)).otherwise(F.col("CutoffDate")),
            "PoolBalance": F.when(mine, F.lit(1.0)).otherwise(F.col("PoolBalance")),
        }
    )
    history_table.merge_into(reports.as_history(old, "stored earlier"), path, order)
    for _ in range(2):  # the second time changes nothing
        history_table.replace_deal(reports.as_history(metrics.filter(mine)), path, "AVON2", order)
    return history_table.read_history(x.spark, path)


_EMPTY = [c for c in reports.HISTORY_COLUMNS if c in (
    "CPR_3m CDR_1m CDR_3m CDR_Lifetime PoolFactor WA_Coupon Arrears_30_60_Pct Arrears_60_90_Pct LRF_Balance".split()
)]
register(
    "replace_deal_slice",
    lambda x: present(_replaced(x)),
    query(
        f"SELECT *, {', '.join(f'NULL::DOUBLE AS {c}' for c in _EMPTY)}, CASE WHEN DealID = 'AVON2' THEN 'extracted by script'"
        f" ELSE 'stored earlier' END AS Notes FROM ({_SHOWN})",
        *ALL_PARTS,
    ),
)
register(
    "control_tape_vs_report",
    lambda x: present(
        controls.control_tape_vs_report(marts.pool_summary(x.star("LoanOriginationDate")), _metrics(x)), difference=2
    ),
    query(
        f"SELECT 'TAPE_VS_REPORT' AS check_name, p.DealID, p.CutoffDate, p.TotalBalance AS tape, r.PoolBalance AS report,"
        f" {he('p.TotalBalance - r.PoolBalance', 2)} AS difference FROM pool p JOIN report r ON p.DealID = r.DealID"
        " AND p.CutoffDate = r.CutoffDate WHERE abs(p.TotalBalance - r.PoolBalance) > 0.01 * abs(p.TotalBalance)",
        TAPE, STAR, f"pool AS (SELECT {POOL_SUMMARY_COLUMNS} FROM star GROUP BY {G})", *ALL_PARTS,
    ),
)
