"""Deal formats as a joined table."""

from decimal import Decimal

from mortar.operators import conform as cf
from mortar.plans.frames import Frames

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted(df.collect(), key=repr)


def test_table_equals_formats_in_the_plan(spark):
    tape = Frames(spark, SMALL).tape()
    formats = cf.format_table(spark, cf.FORMATS)
    assert rows(cf.conform_fact_loan_period_by_table(tape, formats)) == rows(cf.conform_fact_loan_period(tape, *cf.FORMATS))
    assert rows(cf.conform_dim_loan_by_table(tape, formats)) == rows(cf.conform_dim_loan(tape, *cf.FORMATS))


def test_two_hundred_deals_have_the_plan_of_two(spark):
    tape = Frames(spark, SMALL).tape()

    def plan(n):
        formats = [cf.DealFormat(f"D{i}", Decimal("0.01") if i % 2 else Decimal(1), i % 3 == 0) for i in range(n)]
        made = cf.conform_fact_loan_period_by_table(tape, cf.format_table(spark, formats))
        return made._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert plan(2) == plan(200)


def test_absent_fields_and_deals_without_a_format(spark):
    tape = spark.createDataFrame(
        [("A", "1", "5", "2020-01-31"), ("B", "1", "5", "2020-01-31"), ("C", "1", "5", "2020-01-31"), ("A", None, "5", None), (None, "1", "5", None)],
        "DealID string, AR3 string, AR67 string, AR1 string",
    )
    formats = cf.format_table(spark, [cf.DealFormat("A", absent=frozenset({"AR67"})), cf.DealFormat("B", keep_null_ids=True)])
    found = cf.conform_fact_loan_period_by_table(tape, formats).select("DealID", "LoanID", "CurrentBalance").collect()
    assert sorted(map(tuple, found)) == [("A", "1", None), ("B", "1", Decimal("5.00"))]
    assert cf.conform_fact_loan_period_by_table(tape, cf.format_table(spark, [])).count() == 0
