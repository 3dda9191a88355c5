"""Metrics from investor-report page text.

Input is page text ``(deal_id, file_name, page_no, text)``.  Every metric is a column of
regular-expression candidates per page; a file's value is the first usable one in page order, taken
with ``min_by`` so that no file is ever gathered in one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mortar.functions.averages import divide, half_even
from mortar.functions.casts import figure, iso_date, without_noise
from mortar.functions.dates import month_number
from mortar.operators.history import keep_first
from mortar.operators.rwa import class_a_enhancement

FILE = ["deal_id", "file_name"]

# fixed values: phrases and layouts of the two report families
BALANCE = [
    r"Current Balance of Mortgage Loans[^\d]*([\d,]+\.?\d*)",
    r"Outstanding Current Balance of the Portfolio[^\d]*([\d,]+\.?\d*)",
]
LOANS = [r"Number of.*Mortgage Loans[^\d]*([\d,]+)"]
# fixed values: these are found in any case
LTV = [r"Weighted Average Loan to Value[^\d]*([\d.]+)%?", r"Weighted Average Current Loan to Value[^\d]*([\d.]+)%?"]
CPR_YEAR = [r"Annualised CPR[^\d]*([\d.]+)%?"]
CPR_MONTH = [r"Current CPR\s+([\d.]+)%?", r"Constant Principal Pre-?payment Rate[^\d]*([\d.]+)%?"]
ANY_DATE = r"(\d{1,2})[-/](Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[-/](\d{4})"
ANY_CASE = "(?i)"
ARREARS_SIX = r">\s*6\.?\d*\s*Months in Arrears[^\d]*([\d,]+\.?\d*)[^\d]*([\d,]+)[^\d]*([\d.]+)%?"
ARREARS_THREE = r">=\s*3\s+(\d+)\s+([\d.]+)%?\s+([\d,.]+)\s+([\d.]+)%?"
ARREARS_ROWS = r"([345]\.?\d*|>\s*6).*Months in Arrears[^\d]*([\d,]+\.?\d*)[^\d]*([\d,]+)[^\d]*([\d.]+)%?"
PERIOD_END = r"Reporting Period End Date[:\s]+(\d{1,2}[-/]\w+[-/]\d{4})"
NAME_STAMP = r"(\d{4})(\d{2})(\d{2})"
NAME_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\s*(\d{4})"
NOTE_NUMBERS = r"([\d,]{3,}(?:,\d{3})*\.?\d*)"
ROW_NUMBERS = r"([\d,]+\.?\d*)"
NOTE_MINIMUM = 1_000_000

# fixed values: columns of the report history
HISTORY_COLUMNS = [
    "DealID", "ReportDate", "CutoffDate", "CPR_1m", "CPR_3m", "CPR_12m", "CDR_1m", "CDR_3m", "CDR_Lifetime",
    "PoolBalance", "PoolFactor", "WA_LTV", "WA_Coupon", "Arrears_30_60_Pct", "Arrears_60_90_Pct",
    "Arrears_90Plus_Pct", "CE_ClassA", "Factor_ClassA", "LRF_Balance", "Notes",
]


def select_reports(pages: DataFrame, config: DataFrame) -> DataFrame:
    """Pages of files that match the deal's name pattern and are no rating reports.

    A pattern held in a column is compiled whenever it differs from the row before, not for every row.
    """
    name = F.col("file_name")
    rating = name.contains("DBRS") | F.lower(name).contains("rating")
    return (
        pages.join(config.select("deal_id", "ir_pattern"), "deal_id")
        .filter((F.regexp_instr(name, F.col("ir_pattern")) > 0) & ~rating)
        .drop("ir_pattern")
    )


def date_from_name(name: Column) -> Column:
    """``20201130`` or ``Dec 2021`` (end of month; February always has 28 days)."""
    stamp = F.concat_ws("-", *[F.regexp_extract(name, NAME_STAMP, g) for g in (1, 2, 3)])
    month = month_number(F.regexp_extract(F.lower(name), NAME_MONTH, 1))
    year = F.regexp_extract(F.lower(name), NAME_MONTH, 2).try_cast("int")
    end = F.last_day(F.make_date(year, month, F.lit(1)))
    end = F.when(month == 2, F.make_date(year, month, F.lit(28))).otherwise(end)
    return F.when(name.rlike(NAME_STAMP), iso_date(stamp)).otherwise(end)


class PageColumns:
    """Columns taken from one page, step by step so that no expression runs twice.

    ``raw`` holds what the expressions find on a page (``figures`` names the texts among them that are
    read as numbers next), ``made`` what follows from it, ``file`` the aggregates that turn pages into one
    row per file.  A cheap test for the phrase goes before every regular expression.
    """

    def __init__(self) -> None:
        self.raw: dict[str, Column] = {}
        self.figures: set[str] = set()
        self.made: dict[str, Column] = {}
        self.file: dict[str, Column] = {}

    def first(self, name: str) -> Column:
        """First value in page order."""
        return F.min_by(F.col(name), F.when(F.col(name).isNotNull(), F.col("page_no")))

    def per_file(self, pages: DataFrame) -> DataFrame:
        found = pages.withColumn("low", F.lower("text")).select(*FILE, "page_no", *[c.alias(n) for n, c in self.raw.items()])
        for read in (without_noise, figure):  # both look at their column more than once
            found = found.select(*[read(F.col(n)).alias(n) if n in self.figures else n for n in found.columns])
        made = found.select(*FILE, "page_no", *[c.alias(n) for n, c in self.made.items()])
        return made.groupBy(*FILE).agg(*[c.alias(n) for n, c in self.file.items()])


def _date_columns(page: PageColumns) -> None:
    text = F.col("text")
    named = text.contains("Reporting Period End Date")
    page.raw["named"] = F.when(named, F.regexp_extract(text, PERIOD_END, 1))
    page.raw["any_date"] = F.regexp_extract(text, ANY_CASE + ANY_DATE, 0)
    written = [F.try_to_date(F.nullif("named", F.lit("")), f) for f in ("d-MMM-yyyy", "d/MMM/yyyy", "d-MMMM-yyyy")]
    parts = F.split("any_date", "[-/]")
    day, month, year = [F.get(parts, F.lit(i)) for i in range(3)]
    month = F.lpad(month_number(month).cast("string"), 2, "0")
    anywhere = iso_date(F.concat(year, F.lit("-"), month, F.lit("-"), F.lpad(day, 2, "0")))
    page.made["date"] = F.coalesce(*written, anywhere)
    page.file["found"] = page.first("date")


def _numbers(texts: Column) -> Column:
    return F.transform(F.transform(texts, without_noise), figure)


def _candidates() -> dict[str, list[Column]]:
    """Candidate values of each metric on a page, in the order they are tried; texts are read as numbers later."""
    text, low = F.col("text"), F.col("low")

    def number(where: Column, phrase: str, pattern: str, group: int = 1) -> Column:
        return F.when(where.contains(phrase), F.regexp_extract(where, pattern, group))

    def any_case(phrase: str, pattern: str) -> Column:
        return F.when(low.contains(phrase.lower()), F.regexp_extract(text, ANY_CASE + pattern, 1))

    late = "Months in Arrears"
    rows = F.regexp_extract_all(text, F.lit(ARREARS_ROWS), F.lit(4))
    total = F.aggregate(
        _numbers(rows), F.lit(None).cast("double"), lambda a, v: F.coalesce(a, F.lit(0.0)) + F.coalesce(v, F.lit(0.0))
    )
    return {
        "PoolBalance": [
            number(text, "Current Balance of Mortgage Loans", BALANCE[0]),
            number(text, "Outstanding Current Balance of the Portfolio", BALANCE[1]),
        ],
        "WA_LTV": [
            any_case("Weighted Average Loan to Value", LTV[0]),
            any_case("Weighted Average Current Loan to Value", LTV[1]),
        ],
        "LoanCount": [number(text, "Mortgage Loans", LOANS[0])],
        "CPR_1m": [any_case("Current CPR", CPR_MONTH[0]), any_case("Constant Principal Pre", CPR_MONTH[1])],
        "CPR_12m": [any_case("Annualised CPR", CPR_YEAR[0])],
        "Arrears_90Plus_Pct": [
            number(text, late, ARREARS_SIX, 3),
            number(text, "Current Months in Arrears", ARREARS_THREE, 4),
            F.when(text.contains(late), total),
        ],
    }


def _metric_columns(page: PageColumns) -> None:
    for name, candidates in _candidates().items():
        tried = [f"{name}_{i}" for i in range(len(candidates))]
        page.raw.update(zip(tried, candidates))
        page.figures.update(t for t in tried if t != "Arrears_90Plus_Pct_2")  # a sum already
        page.made[name] = F.coalesce(*[F.when(F.col(c) != 0, F.col(c)) for c in tried])
        page.made[f"{name}_zero"] = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) == 0, F.lit(False)) for c in tried])
        page.file[name] = F.coalesce(page.first(name), F.when(F.max(f"{name}_zero"), F.lit(0.0)))


def _note_columns(page: PageColumns) -> None:
    text = F.col("text")
    lines = F.split(text, "\n")
    figures = lambda line, p: _numbers(F.regexp_extract_all(line, F.lit(p), F.lit(1)))
    table_page = text.contains("Principal") & text.contains("Ending Balance")

    def isin_row(line: Column) -> Column:
        return (
            line.contains("Class A") & line.contains("XS") & line.contains("GBP")
            & ~line.contains("Class B") & ~line.contains("Notes")
        )

    def table_row(line: Column) -> Column:
        return F.startswith(F.trim(line), F.lit("Class A")) & ~line.contains("Notes") & ~line.contains("XS")

    def complete(cells: Column) -> Column:
        return (F.size(cells) == 5) & (cells[3] > NOTE_MINIMUM) & (cells[4] > 0) & (cells[4] < 2)

    large = F.transform(
        F.filter(lines, isin_row), lambda line: F.filter(figures(line, NOTE_NUMBERS), lambda x: x > NOTE_MINIMUM)
    )
    here = text.contains("Class A")
    page.raw["isin_figures"] = F.when(here, F.get(F.filter(large, lambda x: F.size(x) > 0), F.lit(0)))
    rows = F.transform(F.filter(lines, table_row), lambda line: figures(line, ROW_NUMBERS))
    page.raw["table_figures"] = F.when(here & table_page, F.get(F.filter(rows, complete), F.lit(0)))
    isin, table = F.col("isin_figures"), F.col("table_figures")
    one = F.coalesce(F.get(isin, F.lit(1)), F.get(isin, F.lit(0)))
    # plain doubles, not a struct: they keep the aggregate a hash aggregate
    page.made["balance"] = F.coalesce(one, F.get(table, F.lit(3)))
    page.made["factor"] = F.when(one.isNull(), F.get(table, F.lit(4)))
    where = F.when(F.col("balance").isNotNull(), F.col("page_no"))
    page.file["ClassA_Balance"] = F.min_by("balance", where)
    page.file["ReportedFactor"] = F.min_by("factor", where)


def _with_dates(files: DataFrame) -> DataFrame:
    return files.withColumn("ReportDate", date_from_name(F.col("file_name"))).withColumn(
        "CutoffDate", F.coalesce("found", "ReportDate")
    )


def report_dates(pages: DataFrame) -> DataFrame:
    """Report date from the file name, cut-off date from the first page that has one, else the report date."""
    page = PageColumns()
    _date_columns(page)
    return _with_dates(page.per_file(pages)).select(*FILE, "ReportDate", "CutoffDate")


def pool_metrics(pages: DataFrame) -> DataFrame:
    """Per file: the first non-zero value in page order, 0 when only zeros were found, else NULL."""
    page = PageColumns()
    _metric_columns(page)
    return page.per_file(pages)


def note_balances(pages: DataFrame) -> DataFrame:
    """Class A balance, and factor where reported, from the lines of all pages.

    Two layouts: a line with an ISIN and a currency (second large figure, else the only one), or a
    five-figure row of a principal table.  Earlier pages win, then the first layout, then earlier lines.
    """
    page = PageColumns()
    _note_columns(page)
    return page.per_file(pages).filter("ClassA_Balance IS NOT NULL")


def _with_ratios(files: DataFrame, config: DataFrame) -> DataFrame:
    settings = config.select("deal_id", "original_class_a", "subordination")
    balance = F.col("ClassA_Balance")
    factor = F.coalesce("ReportedFactor", divide(balance, F.col("original_class_a")))
    return files.join(settings, "deal_id", "left").withColumns(
        {
            "CE_ClassA": half_even(class_a_enhancement(balance, F.col("subordination")), 4),
            "Factor_ClassA": half_even(factor, 4),
        }
    )


def class_a_ratios(notes: DataFrame, config: DataFrame) -> DataFrame:
    """Credit enhancement and factor of Class A (the reported factor is preferred), 4 digits."""
    return _with_ratios(notes, config).select(*FILE, "ClassA_Balance", "CE_ClassA", "Factor_ClassA")


def report_metrics(pages: DataFrame, config: DataFrame) -> DataFrame:
    """One row per deal and cut-off; files without a cut-off are dropped, the first file name wins.

    Dates, pool metrics and notes are taken in one pass over the pages and one shuffle by file.
    """
    page = PageColumns()
    _date_columns(page)
    _metric_columns(page)
    _note_columns(page)
    files = _with_dates(page.per_file(select_reports(pages, config))).filter("CutoffDate IS NOT NULL")
    rows = _with_ratios(files, config).withColumnRenamed("deal_id", "DealID")
    return keep_first(rows, ["DealID", "CutoffDate"], "file_name").select(
        "DealID", "ReportDate", "CutoffDate", "CPR_1m", "CPR_12m", "PoolBalance", "WA_LTV", "Arrears_90Plus_Pct",
        "CE_ClassA", "Factor_ClassA",
    )


def as_history(metrics: DataFrame, note: str = "extracted by script") -> DataFrame:
    """The metrics in the columns of the report history; unknown ones are NULL."""
    have = set(metrics.columns)
    column = lambda c: F.col(c) if c in have else F.lit(None).cast("double").alias(c)
    return metrics.withColumn("Notes", F.lit(note)).select(*[F.col(c) if c == "Notes" else column(c) for c in HISTORY_COLUMNS])
