"""Exports in order, the tranche table, and the choice of a tape by name."""

import pytest
from pyspark.sql import functions as F

from mortar.session import work_folder
from mortar.sources import ordered, tape


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_parts_follow_each_other(spark, kind):
    rows = spark.range(5000).selectExpr("CAST(id % 7 AS STRING) AS deal", "CAST((id * 7919) % 5000 AS INT) AS v", "id")
    path = work_folder(spark, "export")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered.write_ordered(rows, path, ["deal", F.col("v").desc()], kind)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(ordered.part_files(spark, path)) > 1
    got = [tuple(r) for part in ordered.parts(spark, path, rows.schema, kind) for r in part.collect()]
    assert got == sorted(map(tuple, rows.collect()), key=lambda r: (r[0], -r[1]))
    if kind == "parquet":
        placed = ordered.read_ordered(spark, path, rows.schema, "place").orderBy("place").collect()
        assert [tuple(r)[:3] for r in placed] == got and [r["place"] for r in placed] == list(range(1, 5001))


def test_empty_export(spark):
    path, rows = work_folder(spark, "export"), spark.createDataFrame([], "a int, b string")
    ordered.write_ordered(rows, path, ["a"])
    assert ordered.read_ordered(spark, path, rows.schema, "place").collect() == []


def test_tranche_table_is_replaced(spark):
    path = work_folder(spark, "tranches")
    one = [("A", "A1", "XS1", "10.5", "5.25", "0.5", "0.1", "1", "0.1", "SONIA", "2050-01-31", "2020-01-31", "more")]
    names = ", ".join(f"{f.name} string" for f in tape.TRANCHE_SCHEMA) + ", extra string"
    for rows in (one * 1 + [("A", "Z", *one[0][2:6], "0.0", *one[0][7:])], one):
        tape.write_tranches(spark.createDataFrame(rows, names), path)
        got = tape.read_tranches(spark, path)
        assert got.schema == tape.TRANCHE_SCHEMA and [r["TrancheID"] for r in got.coalesce(1).collect()] == [r[1] for r in rows]
    assert str(got.first()["CurrentBalance"]) == "5.25"


def test_a_tape_chosen_by_name(spark):
    folder = work_folder(spark, "tapes")
    system, make = ordered._files(spark, folder)
    for name in ("Avon Nov 2020.csv", "Avon Dec 2020.csv"):
        out = system.create(make(f"{folder}/{name}"))
        out.write(bytearray(b"AR1,AR3\n2020-11-30,1\n"))
        out.close()
    registry = spark.createDataFrame([("AVON2", "active", "Avon*.csv")], "DealID string, status string, tape_pattern string")
    with pytest.raises(ValueError, match="more than one"):
        tape.resolve_tape(registry, folder, "avon2")
    assert "Nov" in tape.resolve_tape(registry, folder, "avon2", name="nOv")
    with pytest.raises(ValueError, match="no tape"):
        tape.resolve_tape(registry, folder, "avon2", name="2021")
