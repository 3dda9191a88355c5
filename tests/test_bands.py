"""Both sides of every band edge, and missing values."""

import pytest
from pyspark.sql import functions as F

from mortar.functions import bands, casts, dates


def apply(spark, column, values, kind="double"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "column, cases",
    [
        (bands.mart_ltv_band, {None: "Unknown", 0.59: "<60%", 0.6: "60-70%", 0.7: "70-80%", 0.8: "80-90%", 0.9: "90-100%",
                               0.999: "90-100%", 1.0: ">100%", 75.8: ">100%"}),
        (bands.mart_ltv_order, {None: 99, 0.59: 1, 0.6: 2, 0.7: 3, 0.8: 4, 0.9: 5, 1.0: 6}),
        (bands.ltv_band, {None: "Unknown", 0.5: "0-50%", 0.6: "50-60%", 0.7: "60-70%", 0.8: "70-80%", 0.9: "80-90%",
                          1.0: "90-100%", 1.0001: ">100% (underwater)", 2.0: ">100% (underwater)", 2.01: "0-50%", 75.8: "70-80%"}),
        (bands.seasoning_band, {None: "Unknown", 59.0: "0-5y", 60.0: "5-10y", 119.0: "5-10y", 120.0: "10-15y",
                                179.0: "10-15y", 180.0: "15-20y", 239.0: "15-20y", 240.0: "20y+"}),
        (bands.mart_seasoning_band, {None: "Unknown", 11.0: "<1yr", 12.0: "1-3yr", 35.0: "1-3yr", 36.0: "3-5yr",
                                     59.0: "3-5yr", 60.0: "5-10yr", 119.0: "5-10yr", 120.0: "10yr+"}),
        (bands.rate_band, {None: "Unknown", 1.99: "<2%", 2.0: "2-3%", 3.0: "3-4%", 4.0: "4-5%", 5.0: ">5%"}),
        (bands.balance_band, {None: "Unknown", 49999.99: "<50k", 50000.0: "50-100k", 100000.0: "100-150k",
                              150000.0: "150-250k", 250000.0: "250-500k", 500000.0: ">500k"}),
        (bands.arrears_bucket, {None: "<= 1 Month", 0.0: "<= 1 Month", 1.0: "<= 1 Month", 1.01: "1 - 2 Months", 3.0: "2 - 3 Months",
                                6.0: "5 - 6 Months", 6.01: "> 6 Months"}),
        (bands.base_pd, {None: 0.02, 0.0: 0.02, 0.5: 0.08, 1.0: 0.08, 3.0: 0.25, 6.0: 0.5, 6.1: 0.85}),
    ],
)
def test_edges(spark, column, cases):
    assert apply(spark, column, list(cases)) == list(cases.values())


def test_delinquency_bucket_and_order_use_different_precedence(spark):
    rows = spark.createDataFrame(
        [(1, None, "Default or Foreclosure"), (2, 4.0, "Default or Foreclosure"), (3, 0.5, "Redeemed"), (4, 4.0, "Arrears"), (5, 2.5, None)],
        "i int, m double, s string",
    )
    def both(label):
        out = rows.orderBy("i").select(
            bands.mart_delinquency_bucket(F.col("m"), F.col("s"), label), bands.mart_delinquency_order(F.col("m"), F.col("s"), label)
        )
        return [tuple(r) for r in out.collect()]
    assert both("Defaulted") == [("Current", 1), ("3M+", 5), ("Redeemed", 0), ("3M+", 5), ("2-3M", 4)]
    assert both("Default or Foreclosure") == [("Default", 1), ("Default", 6), ("Redeemed", 0), ("3M+", 5), ("2-3M", 4)]


def test_tolerant_casts(spark):
    assert apply(spark, casts.whole, ["12", "12.0", "ND", None], "string") == [12, None, None, None]
    assert [str(d) if d else None for d in apply(spark, casts.iso_date, ["2020-11-30", "2020-1-30", "2020-13-01", "2001-9-1 x"], "string")] == [
        "2020-11-30", None, None, None]
    assert apply(spark, casts.number, ["1.5", "nan", "x", None], "string") == [1.5, None, None, None]
    assert apply(spark, casts.null_spellings, ["", " ", "nan", "NaT", "ND", "x"], "string") == [None] * 5 + ["x"]
    assert apply(spark, casts.parse_number, ["£1,234.50", "75.79%", "GBP 10", "N/A", "-", "null", "", "x"], "string") == [
        1234.5, 75.79, 10.0, None, None, None, None, None]


def test_decode_accepts_any_spelling_of_a_whole_number(spark):
    decode = lambda c: casts.decode_number(c, {"1": "one", "18": "eighteen"})
    assert apply(spark, decode, ["1", "1.0", "18", "1.5", "2", "ND", None], "string") == [
        "one", "one", "eighteen", None, None, None, None]


def test_quarters_and_months(spark):
    text = ["Q4-2006", "Q1-1997", "Q5-2006", "2006-01-02", None]
    assert [str(d) if d else None for d in apply(spark, dates.quarter_end, text, "string")] == ["2006-12-31", "1997-03-31", None, None, None]
    text = ["Q2-1997", "q2/1997", "Q2 1997", "2006-01-02", "01/31/2006", "rubbish", None]
    assert [str(d) if d else None for d in apply(spark, dates.parse_origination, text, "string")] == [
        "1997-05-01", "1997-05-01", "1997-05-01", "2006-01-02", "2006-01-31", None, None]
    step = spark.sql("SELECT DATE '2020-02-01' AS a, DATE '2020-01-31' AS b").select(dates.month_steps(F.col("a"), F.col("b")))
    assert step.first()[0] == 1
