"""Streaming state of the newest delivery per key, against the batch result."""

import datetime as dt

import pytest

from mortar.operators.history import keep_last
from mortar.session import work_folder
from mortar.streaming.keyed_state import KeyedState

SCHEMA = "DealID string, LoanID int, At timestamp, Delivery int, Balance double"
DAY = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def deliver(spark):
    folder, seen = work_folder(spark, "in"), []

    def put(*rows):
        seen.extend(rows)
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    put.stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    put.seen = seen
    return put


def as_set(df):
    return sorted(map(tuple, df.collect()))


def test_four_batches_with_late_and_repeated_deliveries_and_restarts(spark, deliver):
    keys = ["DealID", "LoanID"]
    state = KeyedState(work_folder(spark, "state"), keys, ["Delivery"])
    schema = spark.createDataFrame([], SCHEMA).schema
    batches = [
        [("A", 1, DAY(0), 1, 10.0), ("A", 2, DAY(0), 5, 20.0), ("B", 1, DAY(0), 1, 1.0)],
        [("A", 1, DAY(1), 3, 30.0), ("A", 2, DAY(1), 4, 21.0)],  # the second is late
        [("A", 1, DAY(1), 3, 30.0), ("B", 1, DAY(2), 1, 2.0)],  # repeated; a tie in the ordinal
        [("C", 9, DAY(3), 1, None), ("A", 1, DAY(3), 2, 99.0)],
    ]
    for i, rows in enumerate(batches):
        deliver(*rows)
        progress = state.run(deliver.stream())  # every run starts from the checkpoint
        want = keep_last(spark.createDataFrame(deliver.seen, SCHEMA), keys, "Delivery", "At", "Balance")
        assert as_set(state.current(spark, schema)) == as_set(want)
        assert progress[-1]["stateOperators"][0]["numRowsTotal"] == want.count()  # bounded by the keys
        if i in (1, 2):
            state.fold(spark, schema)
            assert state._changes(spark, schema)[1] == []
            assert as_set(state.current(spark, schema)) == as_set(want)
    state.fold(spark, schema)
    state.fold(spark, schema)
    assert as_set(state.current(spark, schema)) == as_set(want)


def test_nothing_has_arrived(spark):
    state = KeyedState(work_folder(spark, "state"), ["DealID"], ["Delivery"])
    assert state.current(spark, spark.createDataFrame([], SCHEMA).schema).collect() == []


def test_keys_are_retired(spark, deliver):
    state = KeyedState(work_folder(spark, "state"), ["DealID", "At"], ["Delivery"], retire_on="At", delay="2 days")
    schema = spark.createDataFrame([], SCHEMA).schema
    for n in range(0, 40, 5):
        deliver(("A", 1, DAY(n), 1, float(n)))
    progress = state.run(deliver.stream())
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 3
    deliver(("A", 1, DAY(0), 2, -1.0))  # far too late
    state.run(deliver.stream())
    got = state.current(spark, schema).select("DealID", "At", "Balance").orderBy("At").collect()
    assert [tuple(r) for r in got] == [("A", DAY(n), float(n)) for n in range(0, 40, 5)]
