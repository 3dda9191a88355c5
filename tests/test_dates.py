"""Date spellings of tapes, against literal values, and tapes that lack fields."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mortar.functions import dates
from mortar.operators import conform, prep
from mortar.sources import tape

SPELLINGS = {
    "2006-12-31": "2006-12-31", " 2006-12-31 ": "2006-12-31", "2006-02-30": None,
    "31/12/2006": "2006-12-31", "31-12-2006": "2006-12-31", "12/31/2006": "2006-12-31", "12-31-2006": "2006-12-31",
    "02/03/2006": "2006-02-03", "1-2-2006": "2006-01-02", "31.12.2006": "2006-12-31", "02.03.2006": "2006-02-03",
    "1/2/06": "2006-01-02", "31/12/06": "2006-12-31", "13/13/2006": None, "31/02/2006": None,
    "2006-12-31T00:00:00": "2006-12-31", "2006-12-31 10:11:12": "2006-12-31", "2006-12-31T10:11:12Z": "2006-12-31",
    "2006-12-31 10:11": "2006-12-31", "2006-12-31T10:11:12.123+01:00": "2006-12-31", "2006-12-31 25:00:00": None,
    "2006/12/31": "2006-12-31", "2006-1-5": "2006-01-05", "20061231": "2006-12-31", "20061331": None,
    "31-Dec-2006": "2006-12-31", "31 Dec 2006": "2006-12-31", "31Dec2006": "2006-12-31", "31 December 2006": "2006-12-31",
    "Dec 31, 2006": "2006-12-31", "December 31 2006": "2006-12-31", "05-May-97": "1997-05-05", "31-Foo-2006": None,
    "Dec-2006": "2006-12-01", "Dec 2006": "2006-12-01", "2006-12": "2006-12-01", "12/2006": "2006-12-01", "2006": "2006-01-01",
    "Q2-1997": None, "39082": None, "2006-365": None, "rubbish": None, "": None, "12": None,
}


def test_every_spelling(spark):
    rows = spark.createDataFrame([(s,) for s in SPELLINGS], "s string").select("s", dates.parse_date(F.col("s")).alias("d"))
    assert {r["s"]: r["d"] and r["d"].isoformat() for r in rows.collect()} == SPELLINGS
    quarter = spark.createDataFrame([("Q2-1997",), ("31/12/2006",)], "s string").select(dates.parse_origination(F.col("s")))
    assert [r[0] for r in quarter.collect()] == [dt.date(1997, 5, 1), dt.date(2006, 12, 31)]


@pytest.mark.parametrize("gone", ["AR123", "AR55"])
def test_a_field_that_no_file_delivers_is_null(spark, gone):
    fields = [f for f in {*conform.FIELDS, *prep.LOAN_FIELDS, *prep.EXIT_FIELDS} if f != gone]
    values = {"AR1": "2020-01-31", "AR3": "1", "AR67": "100", "AR8": "p", "AR166": "3"}
    row = spark.createDataFrame([("AVON2", *[values.get(f) for f in fields])], ", ".join(f"{f} string" for f in ["DealID", *fields]))
    assert gone not in row.columns
    formats = conform.FORMATS
    made = [
        conform.conform_dim_loan(row, *formats), conform.conform_extended_dim(row, *formats),
        conform.conform_fact_loan_period(row, *formats), prep.prep_loans(row), prep.prep_exits(prep.exits_sheet(row)),
    ]
    full = tape.with_fields(row, [gone])
    for got, want in zip(made, [
        conform.conform_dim_loan(full, *formats), conform.conform_extended_dim(full, *formats),
        conform.conform_fact_loan_period(full, *formats), prep.prep_loans(full), prep.prep_exits(prep.exits_sheet(full)),
    ]):
        rows = got.collect()
        assert rows == want.collect() and got.schema == want.schema and len(rows) == 1
