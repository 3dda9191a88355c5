"""Work that must grow no faster than the input: rows over tasks, cells made, joins by a few keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mortar.operators import prep
from mortar.plans.frames import Frames
from mortar.session import small_methods, work_folder
from mortar.sources import sample_tape, tape


@pytest.fixture(scope="module")
def orders(spark):
    folder = work_folder(spark, "orders")
    spark.range(12_000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), (F.col("id") + 0.5).alias("o_totalprice"),
        F.lit(dt.datetime(2000, 1, 5)).alias("o_orderdate"),
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(50).select(F.col("id").alias("c_custkey"), (F.col("id") % 4).alias("c_nationkey")).write.parquet(f"{folder}/customer.parquet")
    spark.range(4).select(F.col("id").alias("n_nationkey")).write.parquet(f"{folder}/nation.parquet")
    return folder


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def tasks(df):
    return df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()


@pytest.mark.parametrize("build, rows", [("loan_tape", 6), ("note_tape", 6), ("reported_history", 1), ("report_pages", 4)])
def test_orders_are_dealt_over_tasks(spark, orders, no_broadcast, build, rows):
    found = tasks(getattr(sample_tape, build)(spark, orders))
    assert len(found) == 3 and sum(r["n"] for r in found) >= 12_000 * rows


def test_cells_are_made_in_first_rows_only(spark):
    cell = F.when(F.col("FirstRow"), F.lit("Loan Balance or Date")).otherwise(F.raise_error(F.lit("cell made")))
    raw = spark.range(40).select(F.lit("D").alias("DealID"), (F.col("id") == 0).alias("FirstRow"), *[cell.alias(f"AR{i}") for i in range(1, 9)])
    assert [tuple(r) for r in tape.description_rows(raw).collect()] == [("D", 40, 39)]


def test_raw_tape_makes_no_cells_that_are_not_looked_at(spark, orders):
    plan = tape.description_rows(Frames(spark, orders).raw())._jdf.queryExecution().optimizedPlan().toString()
    assert " AS AR67" not in plan


def test_each_line_is_cut_once(spark, no_broadcast):
    folder, names = work_folder(spark, "cut"), [f"AR{i}" for i in range(1, 13)]
    spark.range(100).select(*[F.col("id").cast("string").alias(n) for n in names], F.lit("D").alias("DealID")).write.option("header", True).csv(folder)
    staged = tape.stage_tape(tape.read_tape(spark, folder, "*.csv"))
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2  # headers, lines
    assert "BroadcastHashJoin" in staged._jdf.queryExecution().executedPlan().toString()
    assert staged.count() == 100 and staged.agg(F.sum(F.col("AR12").cast("long"))).first()[0] == 4950


def test_rows_do_not_meet_by_tape(spark, no_broadcast):
    rows = [("D", f"200{i}-01-31", str(i), "5", f"T{i % 2}") for i in range(4)]
    loans = prep.prep_loans(spark.createDataFrame(rows, "DealID string, AR1 string, AR3 string, AR67 string, T string"), ["T"])
    assert "SortMergeJoin" not in loans._jdf.queryExecution().executedPlan().toString()
    found = {r["LoanID"]: str(r["CutoffDate"]) for r in loans.collect()}
    assert found == {"0": "2002-01-31", "1": "2003-01-31", "2": "2002-01-31", "3": "2003-01-31"}


def test_method_limit_of_a_plain_session(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    for given, want in (("65535", "8000"), ("6000", "6000")):
        spark.conf.set(name, given)
        small_methods(spark)
        assert spark.conf.get(name) == want
    spark.conf.set(name, "8000")
