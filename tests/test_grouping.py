"""Group operators: hot groups, ties and rows without a key."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from mortar.operators.grouping import pick_one, with_totals
from mortar.operators.star import star_join


def test_pick_one_is_total(spark):
    df = spark.createDataFrame([(None, 1, "b"), (None, 1, "a"), ("x", 2, "c"), ("x", 3, "d")], "k string, d int, t string")
    for n in (1, 3):
        picked = pick_one(df.repartition(n), ["k"], [F.col("d").desc(), F.col("t").asc()]).collect()
        assert {tuple(r) for r in picked} == {(None, 1, "a"), ("x", 3, "d")}


def test_totals_of_every_key(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    # two keys have 15 rows, five have 14
    assert with_totals(df, ["k"], t=F.count("*")).agg(F.sum("t")).first()[0] == 2 * 15**2 + 5 * 14**2


def test_star_join_keeps_facts_without_loan_id(spark):
    day = dt.date(2020, 11, 30)
    fact = spark.createDataFrame(
        [("D", None, day, Decimal(i), Decimal(0)) for i in range(50)] + [("D", "1", day, Decimal(7), Decimal(0)), ("D", "9", day, Decimal(8), Decimal(0))],
        "DealID string, LoanID string, CutoffDate date, CurrentBalance decimal(18,2), ArrearsBalance decimal(18,2)",
    )
    dim = spark.createDataFrame([("D", None, "nowhere"), ("D", "1", "London")], "DealID string, LoanID string, Region string")
    out = star_join(fact, dim, ["Region"])
    assert out.count() == 52
    assert {tuple(r) for r in out.filter("Region IS NOT NULL").select("LoanID", "Region").collect()} == {("1", "London")}
