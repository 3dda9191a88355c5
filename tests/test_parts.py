"""Rows made once, and shuffles dealt over tasks that grow with the table."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mortar.functions import casts
from mortar.operators import history, rwa, stress
from mortar.plans import loans, reports
from mortar.plans.frames import Frames
from mortar.session import kept, work_folder
from mortar.sources import history_table, ordered, sample_tape


@pytest.fixture(scope="module")
def orders(spark):
    folder = work_folder(spark, "orders")
    spark.range(2_000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), (F.col("id") + 0.5).alias("o_totalprice"),
        F.lit(dt.datetime(2000, 1, 5)).alias("o_orderdate"),
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(50).select(F.col("id").alias("c_custkey"), (F.col("id") % 4).alias("c_nationkey")).write.parquet(f"{folder}/customer.parquet")
    spark.range(4).select(F.col("id").alias("n_nationkey")).write.parquet(f"{folder}/nation.parquet")
    return folder


@pytest.fixture
def six_parts(monkeypatch):
    monkeypatch.setattr(sample_tape, "ORDERS_A_TASK", 400)
    monkeypatch.setattr(sample_tape, "MANY_PARTS", 2)
    monkeypatch.setattr(sample_tape, "MOST_ORDERS_A_PART", 350)


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def counted(spark):
    """The same rows, and a counter of how many were made."""

    def count(df):
        seen = spark.sparkContext.accumulator(0)

        def look(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(look, df.schema), seen

    return count


def tasks(df):
    return df.groupBy(F.spark_partition_id()).count().count()


def test_a_delivery_is_made_once(spark, counted):
    path = work_folder(spark, "history")
    rows, seen = counted(spark.createDataFrame([("A", "1", 1), ("B", "1", 2)], "DealID string, Period string, v int"))
    history_table.merge_into(rows, path, ["DealID", "Period"])
    assert seen.value == 2
    rows, seen = counted(spark.createDataFrame([("A", "2", 3)], "DealID string, Period string, v int"))
    history_table.replace_deal(rows, path, "A", ["DealID", "Period"])
    assert seen.value == 1
    assert sorted(map(tuple, history_table.read_history(spark, path).collect())) == [("A", "2", 3), ("B", "1", 2)]
    record = history_table._newest(spark, path)
    system, make = history_table._files(spark, path)
    left = {f.getPath().getName() for f in system.listStatus(make(f"{path}/data"))}
    assert {f.split("/")[0] for f in record.slices.values()} <= left and len(left) == 2  # deliveries are gone


def test_reports_are_read_once(spark, counted, monkeypatch):
    columns = "DealID string, ReportDate date, CutoffDate date, PoolBalance double"
    day = dt.date(2020, 1, 31)
    rows, seen = counted(spark.createDataFrame([("AVON2", day, day, 5.0), ("BLETCHLEY", day, day, 6.0)], columns))
    monkeypatch.setattr(reports, "_metrics", lambda x: rows)
    found = reports._replaced(Frames(spark, "")).select("DealID", "CutoffDate", "PoolBalance", "Notes").collect()
    assert sorted(map(tuple, found)) == [("AVON2", day, 5.0, "extracted by script"), ("BLETCHLEY", day, 6.0, "stored earlier")]
    assert seen.value == 2


def test_cells_are_made_once(spark, orders, counted, monkeypatch):
    whole = kept(loans._cells(Frames(spark, orders)), "cells")
    cells, seen = counted(whole)
    monkeypatch.setattr(loans, "_cells", lambda x: cells)
    loans._from_stored_cube(Frames(spark, orders)).collect()
    assert seen.value == whole.count() > 0


def test_tasks_follow_the_number_of_orders(spark, orders, monkeypatch):
    monkeypatch.setattr(sample_tape, "ORDERS_A_TASK", 100)
    assert sample_tape._tasks(spark, orders, 50, 400) == 20  # of 100 orders
    assert sample_tape._tasks(spark, orders, 10, 400) == 10  # no more than 10
    assert sample_tape._tasks(spark, orders, 3, 400) == 5  # but none of over 400 orders


def test_star_meets_in_parts(spark, orders, six_parts, no_broadcast):
    frames = Frames(spark, orders)
    monkeyed = frames._once  # parts are remembered per folder: ask anew
    frames._once = lambda name, build: build() if name == "parts" else monkeyed(name, build)
    joined = frames.star("Region")
    assert tasks(joined) == 6 and joined.count() == frames.fact().count()
    stored = loans._stored(frames, ["Region"])
    assert len(stored.inputFiles()) == 12  # six buckets of both tables


def test_movements_are_dealt_over_parts(spark):
    day = [dt.date(2020, 1, 31), dt.date(2020, 2, 29)]
    notes = spark.createDataFrame(
        [("D", f"N{i}", d, Decimal(i), Decimal(j + 1)) for i in range(60) for j, d in enumerate(day)],
        "DealID string, NoteID string, CutoffDate date, CurrentBalance decimal(18,2), RWA decimal(18,2)",
    )
    moved = rwa.rwa_movement(notes, 6)
    assert tasks(moved) == 6
    assert sorted(map(tuple, moved.collect())) == sorted(map(tuple, rwa.rwa_movement(notes).collect()))
    fact = notes.select("DealID", F.col("NoteID").alias("LoanID"), "CutoffDate", F.col("RWA").cast("double").alias("MonthsInArrears"), "CurrentBalance")
    periods = history.arrears_migration_periods(fact, 6)
    assert "LoanID#" in (plan := periods._jdf.queryExecution().executedPlan().toString()) and ", 6), REPARTITION_BY_NUM" in plan
    assert sorted(map(tuple, periods.collect())) == sorted(map(tuple, history.arrears_migration_periods(fact).collect()))


def test_an_export_has_as_many_parts_as_asked_for(spark):
    path = work_folder(spark, "export")
    ordered.write_ordered(spark.range(600), path, [F.col("id").desc()], ranges=6)
    assert len(ordered.part_files(spark, path)) == 6
    placed = ordered.read_ordered(spark, path, spark.range(1).schema, "Place").orderBy("Place").collect()
    assert [tuple(r) for r in placed] == [(599 - i, i + 1) for i in range(600)]


def test_words_that_may_be_figures(spark):
    words = ["1", "£1,234.50", "75.79%", "GBP10", "GBP", ".5", "-3", "+4", "1e5", "%7", ",8", "", "Balance", "x1", "_1", "~", "é9", "Gross", "1x", "N/A"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.select("w", casts.may_be_figure(F.col("w")).alias("may"), casts.parse_number(F.col("w")).alias("n")).collect()
    assert all(r["may"] for r in rows if r["n"] is not None) and sum(r["n"] is not None for r in rows) == 10
    assert [r["w"] for r in rows if not r["may"]] == ["Balance", "x1", "_1", "N/A"]


def test_quotient_of_a_loan_is_taken_once(spark):
    rows = spark.createDataFrame([("D", 1.0, Decimal(100), Decimal(90))], "DealID string, MonthsInArrears double, CurrentBalance decimal(18,2), CurrentValuation decimal(18,2)")
    plan = stress.stress_grid(rows, ["DealID"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" AS cover#") == 1
