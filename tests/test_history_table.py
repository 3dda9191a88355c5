"""Stored history: versions, slices, columns that come later, writers that meet."""

import pytest

from mortar.session import work_folder
from mortar.sources import history_table

KEY = ["DealID", "Period"]


@pytest.fixture
def path(spark):
    return work_folder(spark, "history")


@pytest.fixture
def rows(spark):
    return lambda *r, more="": spark.createDataFrame(list(r), "DealID string, Period string, v int" + more)


def table(spark, path, version=None):
    return sorted((tuple(r) for r in history_table.read_history(spark, path, version).collect()), key=repr)


def test_a_deal_replaced_by_nothing_is_gone(spark, path, rows):
    history_table.merge_into(rows(("A", "1", 1), ("B", "1", 2)), path, KEY)
    history_table.replace_deal(rows(), path, "A", KEY)
    assert table(spark, path) == [("B", "1", 2)]
    history_table.replace_deal(rows(), path, "B", KEY)
    assert table(spark, path) == [] and history_table.read_history(spark, path).columns == ["DealID", "Period", "v"]
    history_table.merge_into(rows(("A", "1", 5)), path, KEY)
    assert table(spark, path) == [("A", "1", 5)]
    assert history_table.merge_into(rows(), path, KEY) == 5 and table(spark, path) == [("A", "1", 5)]


def test_columns_of_all_deliveries_are_united(spark, path, rows):
    history_table.merge_into(rows(("A", "1", 1), ("B", "1", 2)), path, KEY)
    history_table.merge_into(rows(("B", "2", 3, 0.5), more=", w double"), path, KEY)
    history_table.merge_into(rows(("C", "1", 4)).drop("v"), path, KEY)
    assert table(spark, path) == [("A", "1", 1, None), ("B", "1", 2, None), ("B", "2", 3, 0.5), ("C", "1", None, None)]
    with pytest.raises(ValueError, match="v is stored as int"):
        history_table.merge_into(spark.createDataFrame([("A", "1", "x")], "DealID string, Period string, v string"), path, KEY)


def test_the_writer_that_comes_second_merges_again(spark, path, rows, monkeypatch):
    history_table.merge_into(rows(("A", "1", 1), ("B", "1", 2)), path, KEY)
    plain, others = history_table._write, [rows(("A", "2", 20), ("D", "1", 30)), rows(("A", "1", 40))]

    def write(*args):
        done = plain(*args)
        if others:  # another writer commits between this one's reading and its commit
            other = others.pop()
            monkeypatch.setattr(history_table, "_write", plain)
            history_table.merge_into(other, path, KEY)
            monkeypatch.setattr(history_table, "_write", write)
        return done

    monkeypatch.setattr(history_table, "_write", write)
    assert history_table.merge_into(rows(("A", "3", 50)), path, KEY) == 4
    assert table(spark, path) == [("A", "1", 40), ("A", "2", 20), ("A", "3", 50), ("B", "1", 2), ("D", "1", 30)]
    assert history_table.versions(spark, path) == [1, 2, 3, 4]
    system, make = history_table._files(spark, path)
    named = {f.split("/")[0] for v in (1, 2, 3, 4) for f in history_table._record(spark, path, v).slices.values()}
    assert {f.getPath().getName() for f in system.listStatus(make(f"{path}/data"))} == named  # what lost is removed
    assert [f.getPath().getName() for f in system.listStatus(make(f"{path}/log")) if f.getPath().getName().startswith(".")] == []


def test_one_record_a_version(spark, path, rows):
    history_table.merge_into(rows(("A", "1", 1)), path, KEY)
    again = history_table._Record(1, rows().schema, {})
    with pytest.raises(history_table.Taken):
        history_table._commit(spark, path, again)
    assert table(spark, path) == [("A", "1", 1)]


def test_untouched_slices_are_carried_over_and_old_versions_removed(spark, path, rows):
    history_table.merge_into(rows(("A", "1", 1), ("B", "1", 2), (None, "1", 3)), path, KEY)
    history_table.merge_into(rows(("B", "1", 4)), path, KEY)
    first, second = (history_table._record(spark, path, v).slices for v in (1, 2))
    changed = history_table.slice_name("B")
    assert {n for n in second if second[n] != first.get(n)} == {changed}
    assert table(spark, path, 1) == [("A", "1", 1), ("B", "1", 2), (None, "1", 3)]
    history_table.replace_deal(rows((None, "9", 9)), path, None, KEY)
    history_table.remove_old(spark, path, 1)
    assert history_table.versions(spark, path) == [3]
    assert table(spark, path) == [("A", "1", 1), ("B", "1", 4), (None, "9", 9)]
    with pytest.raises(ValueError, match="other deals"):
        history_table.replace_deal(rows(("C", "1", 1)), path, "A", KEY)


def test_rows_are_sorted_within_files(spark, path, rows):
    history_table.merge_into(rows(*[("A", f"{i:03d}", i) for i in range(200, 0, -1)]), path, KEY)
    got = [r["Period"] for r in history_table.read_history(spark, path).coalesce(1).collect()]
    assert sorted(got) == [f"{i:03d}" for i in range(1, 201)]
    found = history_table.read_history(spark, path).selectExpr("input_file_name() AS f", "Period").collect()
    for f in {r["f"] for r in found}:
        own = [r["Period"] for r in found if r["f"] == f]
        assert own == sorted(own)
