"""Cases that the generated tables do not hold."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from mortar.functions import bands, casts
from mortar.operators import controls, history, measures, reports
from mortar.session import work_folder
from mortar.sources import history_table


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("text, number", [("12d", None), ("5f", None), ("1e3", 1000.0), ("-.5", -0.5), ("7.", 7.0), ("NaN", None), ("", None)])
def test_numeric_shapes(spark, text, number):
    assert one(spark, text, "string", casts.number) == number
    assert one(spark, text, "string", casts.parse_number) == number


@pytest.mark.parametrize("months, pd", [(None, 0.02), (0.0, 0.02), (-1.0, 0.08), (0.5, 0.08), (1.0, 0.08), (1.5, 0.25), (7.0, 0.85)])
def test_default_ladder(spark, months, pd):
    assert float(one(spark, months, "double", bands.base_pd)) == pd


def test_psa_without_seasoning_or_tape(spark):
    history_ = spark.createDataFrame([("A", 5.0), ("B", 5.0), ("C", 5.0)], "DealID string, CPR_1m double")
    for c in ("CPR_3m", "CPR_12m", "CDR_1m", "CDR_Lifetime", "CumLossSeverity"):
        history_ = history_.withColumn(c, F.lit(0.0))
    loans = spark.createDataFrame([("A", 100.0, 10.0), ("B", 100.0, None)], "DealID string, CurrentBalance double, SeasoningMonths double")
    got = {r["DealID"]: r["PSA"] for r in measures.psa_equivalent(history_, loans, ["DealID"]).collect()}
    assert got["A"] == pytest.approx(250.0) and got["B"] is None and got["C"] is None


def test_year_ago_by_month(spark):
    days = [dt.date(2019, 12, 31), dt.date(2020, 12, 28), dt.date(2021, 12, 30)]
    rows = spark.createDataFrame([("A", d, float(i)) for i, d in enumerate(days)], "DealID string, CutoffDate date, v double")
    got = {r["CutoffDate"]: r["YearAgo"] for r in history.time_intelligence(rows, "v").collect()}
    assert got == {days[0]: None, days[1]: 0.0, days[2]: 1.0}


def test_balance_control_finds_missing_deals(spark):
    tape = spark.createDataFrame([("A", "10.00"), ("B", "5.00"), ("D", "ND")], "DealID string, AR67 string")
    fact = spark.createDataFrame([("A", Decimal("10.00")), ("C", Decimal("2.00"))], "DealID string, CurrentBalance decimal(18,2)")
    got = {r["DealID"]: r["difference"] for r in controls.control_balance(tape, fact).collect()}
    assert got == {"B": "5.00", "C": "-2.00"}


def test_reports_are_read_to_their_last_page(spark):
    pages = [("AVON2", "r 20200101.pdf", i, "notice") for i in range(1, 12)]
    pages += [("AVON2", "r 20200101.pdf", 12, "Reporting Period End Date: 30-Nov-2020")]
    pages += [("AVON2", "r 20200101.pdf", 15, "Class A XS1 666,345,000.00 648,188,081.84 GBP")]
    df = spark.createDataFrame(pages, "deal_id string, file_name string, page_no int, text string")
    assert reports.report_dates(df).first()["CutoffDate"] == dt.date(2020, 11, 30)
    assert reports.note_balances(df).first()["ClassA_Balance"] == 648188081.84


def test_stored_history(spark):
    path = work_folder(spark, "history")
    assert history_table.read_history(spark, path) is None
    rows = lambda *r: spark.createDataFrame(list(r), "DealID string, Period string, v int")
    history_table.merge_into(rows(("A", "1", 1), ("B", "1", 2)), path, ["DealID", "Period"])
    for _ in range(2):
        history_table.merge_into(rows(("A", "1", 3), ("A", "2", 4)), path, ["DealID", "Period"])
    table = lambda: [tuple(r) for r in history_table.read_history(spark, path).collect()]
    assert sorted(table()) == [("A", "1", 3), ("A", "2", 4), ("B", "1", 2)]
    history_table.replace_deal(rows(("A", "9", 9)), path, "A", ["DealID", "Period"])
    assert sorted(table()) == [("A", "9", 9), ("B", "1", 2)]


def test_report_history_keeps_count_of_bad_lines(spark):
    path = work_folder(spark, "csv")
    spark.createDataFrame([("DealID,v\nA,1\nA\nB,x\nB,2,3\nC,4",)], "t string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("DealID", T.StringType()), T.StructField("v", T.IntegerType())])
    rows, bad = history_table.read_report_history(spark, path, schema)
    assert sorted(tuple(r) for r in rows.collect()) == [("A", 1), ("C", 4)]
    assert bad.count() == 3


def test_replacing_a_deal_keeps_rows_without_a_deal(spark):
    from mortar.operators import history

    old = spark.createDataFrame([("A", 1), (None, 2), ("B", 3)], "DealID string, n int")
    new = spark.createDataFrame([("A", 4)], "DealID string, n int")
    assert sorted(r["n"] for r in history.replace_slice(old, new, "A").collect()) == [2, 3, 4]
