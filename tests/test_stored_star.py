"""The bucketed star and the cube of cells."""

import pytest
from pyspark.sql import functions as F

from mortar.operators import cube, marts, star
from mortar.plans.frames import Frames
from mortar.session import work_folder
from mortar.sources import stored_star


@pytest.fixture(scope="module")
def frames(spark):
    return Frames(spark, "/root/testdata/sf0.001")


def key(r):
    return tuple(str(v) for v in r)


def test_stored_star_joins_without_a_shuffle(spark, frames):
    path = work_folder(spark, "star")
    stored_star.write_star(frames.fact(), frames.dim(), path, 4)
    columns = ["Region", "LoanOriginationDate"]
    want = sorted(map(tuple, star.star_join(frames.fact(), frames.dim(), columns).collect()), key=key)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for _ in range(2):  # the second time the session does not know the tables
            joined = stored_star.stored_join(spark, path, columns)
            plan = marts.strat_label(joined, "Region")._jdf.queryExecution().executedPlan().toString()
            assert "_loan" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
            assert "SortMergeJoin" in plan and joined.columns == star.star_join(frames.fact(), frames.dim(), columns).columns
            assert sorted(map(tuple, joined.collect()), key=key) == want
            stored_star.forget(spark, path)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.filter("LoanID IS NULL").count() > 0


def test_slices_from_the_cube_equal_the_scan(frames):
    whole = frames.star(*marts.STAR_COLUMNS).cache()
    halves = [whole.filter(F.pmod(F.xxhash64("LoanID"), F.lit(2)).eqNullSafe(F.lit(k))) for k in (0, 1)]
    cells = cube.merged(*[cube.cells(h) for h in halves])
    figures = ["LoanCount", "Balance", "LoansInArrears"]
    for by, where in ((["DealID"], None), (["Region"], F.col("LTV") == "60-70%"), ([], F.col("Delinquency") != "Current")):
        got = {tuple(r[c] for c in by): r for r in cube.measure(cells, by, where).collect()}
        scan = cube.measure(cube.cells(whole), by, where).collect()
        assert got.keys() == {tuple(r[c] for c in by) for r in scan}
        for r in scan:
            mine = got[tuple(r[c] for c in by)]
            assert [mine[c] for c in figures] == [r[c] for c in figures]
            assert mine["WA_LTV"] == pytest.approx(r["WA_LTV"], rel=1e-12)
    exact = {r["DealID"]: r["n"] for r in whole.groupBy("DealID").agg(F.countDistinct("LoanID").alias("n")).collect()}
    for r in cube.measure(cells, ["DealID"]).collect():
        assert abs(r["DistinctLoans"] - exact[r["DealID"]]) <= 0.05 * exact[r["DealID"]]
    whole.unpersist()
