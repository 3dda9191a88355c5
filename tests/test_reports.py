"""Report text: both layouts of every metric, page order, zeros and skipped files."""

import datetime as dt

import pytest

from mortar.operators import reports
from mortar.sources import seeds

AVON, BLETCHLEY = "Avon 2 IR 20201130.pdf", "Bletchley Park IR Feb 2024.pdf"


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "deal_id string, file_name string, page_no int, text string")


def metrics(spark, *texts):
    return reports.pool_metrics(pages(spark, *[("AVON2", AVON, i + 1, t) for i, t in enumerate(texts)])).first()


def test_first_layout(spark):
    m = metrics(
        spark,
        "Current Balance of Mortgage Loans 839,448,269.75\nWeighted Average Loan to Value 75.79%\nNumber of all Mortgage Loans 8,246",
        "Annualised CPR 8.17%\nConstant Principal Prepayment Rate 0.71%\n> 6.0 Months in Arrears 10,914,950.29 91 1.79%",
    )
    assert m[2:] == (839448269.75, 75.79, 8246.0, 0.71, 8.17, 1.79)


def test_second_layout(spark):
    m = metrics(
        spark,
        "Outstanding Current Balance of the Portfolio GBP 233,239,855.77\nWEIGHTED AVERAGE CURRENT LOAN TO VALUE 68.97%",
        "Current CPR 2.54% 2.54% 2.54%\nCurrent Months in Arrears\n>= 3 12 1.11% 2,345,678.90 1.02%",
    )
    assert m["PoolBalance"] == 233239855.77 and m["WA_LTV"] == 68.97 and m["CPR_1m"] == 2.54
    assert m["Arrears_90Plus_Pct"] == 1.02 and m["CPR_12m"] is None and m["LoanCount"] is None


def test_zero_gives_way_to_a_later_value(spark):
    assert metrics(spark, "Annualised CPR 0.00%", "Annualised CPR 5.00%", "Annualised CPR 6.00%")["CPR_12m"] == 5.0
    assert metrics(spark, "Annualised CPR 0.00%", "nothing")["CPR_12m"] == 0.0


def test_sum_of_arrears_rows(spark):
    m = metrics(spark, "3.0 Months in Arrears 1,000.00 12 0.84%\n4.0 Months in Arrears 500.00 3 0.30%\n2.0 Months in Arrears 1.00 1 9.00%")
    assert m["Arrears_90Plus_Pct"] == pytest.approx(1.14)


def test_dates(spark):
    rows = pages(
        spark,
        ("AVON2", AVON, 1, "Reporting Period End Date: 31-Oct-2020"), ("AVON2", AVON, 2, "1-Jan-2019"),
        ("AVON2", "Avon 2 IR Dec 2021.pdf", 1, "issued 5/nov/2021"),
        ("AVON2", "Avon 2 IR Feb 2024.pdf", 4, "Reporting Period End Date: 31-Oct-2020"),
        ("AVON2", "Avon 2 IR.pdf", 1, "no date"),
    )
    got = {r["file_name"]: (r["ReportDate"], r["CutoffDate"]) for r in reports.report_dates(rows).collect()}
    assert got == {
        AVON: (dt.date(2020, 11, 30), dt.date(2020, 10, 31)),
        "Avon 2 IR Dec 2021.pdf": (dt.date(2021, 12, 31), dt.date(2021, 11, 5)),
        "Avon 2 IR Feb 2024.pdf": (dt.date(2024, 2, 28), dt.date(2020, 10, 31)),
        "Avon 2 IR.pdf": (None, None),
    }


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Class A Notes XS GBP 9,000,000\nClass A XS1 666,345,000.00 648,188,081.84 GBP", (648188081.84, None)),
        ("Class A XS1 500 648,188,081.84 GBP", (648188081.84, None)),
        ("Principal\nEnding Balance\nClass A 207,150,000 207,000,000.00 1,000.00 206,049,819.26 0.9947", (206049819.26, 0.9947)),
        ("Ending Balance\nClass A 207,150,000 207,000,000.00 1,000.00 206,049,819.26 0.9947", None),
        ("Principal Ending Balance\nClass A 1 2 3 4 5", None),
    ],
)
def test_note_lines(spark, text, expected):
    row = reports.note_balances(pages(spark, ("AVON2", AVON, 2, text), ("AVON2", AVON, 1, "Class A only by name"))).first()
    assert (row and (row["ClassA_Balance"], row["ReportedFactor"])) == expected


def test_report_row_and_skipped_files(spark):
    text = "Class A XS1 666,345,000.00 648,188,081.84 GBP\nCurrent Balance of Mortgage Loans 825,538,991.45\nReporting Period End Date: 28-Feb-2021"
    rows = pages(
        spark, ("AVON2", "Avon 2 IR 20210228.pdf", 1, text), ("AVON2", "Avon 2 IR 20210228 resent.pdf", 1, text),
        ("AVON2", "Avon 2 IR DBRS 20210131.pdf", 1, text), ("AVON2", "Avon 2 Monthly rating Report 20210131.pdf", 1, text),
        ("AVON2", "Other 20210131.pdf", 1, text), ("AVON2", "Avon 2 IR.pdf", 1, "no date"),
    )
    out = reports.report_metrics(rows, seeds.report_config(spark)).collect()
    assert len(out) == 1
    assert (out[0]["CE_ClassA"], out[0]["Factor_ClassA"], out[0]["PoolBalance"]) == (0.1841, 0.9728, 825538991.45)
    assert reports.as_history(reports.report_metrics(rows, seeds.report_config(spark))).columns == reports.HISTORY_COLUMNS
