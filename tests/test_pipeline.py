"""Staging, preparation, stress, history and stream on small literal data."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mortar.functions.averages import wavg_strict, wavg_total
from mortar.operators import history, marts, measures, prep, stress
from mortar.plans.frames import Frames
from mortar.session import work_folder
from mortar.sources import seeds
from mortar.sources import tape as tp
from mortar.streaming import upsert

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ staging


def test_headers():
    assert [tp.clean_header(h) for h in ("AR3 Loan Identifier", "AR162_", " AR1", "EXTRA1", "2nd col", "a-b")] == [
        "AR3", "AR162", "AR1", "EXTRA1", "_2nd_col", "a_b"]


def test_stage_tape(spark):
    fields = [f"AR{i}" for i in range(1, 8)]
    rows = [
        tuple(f"Loan Identifier {i}" for i in range(7)) + ("x",),
        (None,) * 7 + ("x",),
        ("2020-11-30", "P", "1", "ND", "nan", "NaT", "") + ("x",),
        tuple("d" * 51 for _ in range(7)) + ("x",),
    ]
    rows = [(*r, i in (0, 3)) for i, r in enumerate([*rows, rows[0]])]  # the last one is no file's first row
    schema = ", ".join(f"`{f}{' Loan' if f == 'AR3' else ''}` string" for f in fields) + ", EXTRA1 string, FirstRow boolean"
    out = tp.stage_tape(spark.createDataFrame(rows, schema), "AVON2")
    assert out.columns == ["DealID", *fields]
    kept = [("AVON2", "2020-11-30", "P", "1", None, None, None, None), ("AVON2", *(f"Loan Identifier {i}" for i in range(7)))]
    assert [tuple(r) for r in out.collect()] == kept


def test_staging_replace_and_append(spark):
    path = work_folder(spark, "staging")
    rows = lambda deal, n: spark.createDataFrame([(deal, str(i)) for i in range(n)], "DealID string, AR3 string")
    tp.write_staging(rows("A", 3).union(rows("B", 2)), path)
    tp.write_staging(rows("A", 5), path)
    tp.write_staging(rows("B", 1), path, append=True)
    back = tp.read_staging(spark, path, ["AR3"])
    assert {tuple(r) for r in back.groupBy("DealID").count().collect()} == {("A", 5), ("B", 3)}


def test_registry(spark):
    registry = spark.createDataFrame(
        [("OK", "active", "*Data_Tape*.xlsx"), ("WAIT", "awaiting_data", "*"), ("TWO", "active", "*.xlsx"), ("NONE", "active", "*.csv")],
        "DealID string, status string, tape_pattern string",
    )
    files = spark.createDataFrame(
        [("OK", "2020-11", "x_Data_Tape_1.xlsx"), ("OK", "2020-11", "xDataXTape.xlsx"), ("TWO", "2020-11", "a.xlsx"), ("TWO", "2020-11", "b.xlsx"), ("NONE", "2020-11", "a.xlsx")],
        "DealID string, period string, file_name string",
    )
    verdicts = {r["DealID"]: r["verdict"] for r in tp.registry_check(registry, files).collect()}
    assert verdicts == {"OK": "ok", "WAIT": "inactive", "TWO": "ambiguous", "NONE": "no tape"}
    assert tp.find_deal(registry, "ok").count() == 1 and tp.find_deal(registry, "zzz").count() == 0


def write_lines(spark, folder, *lines):
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").text(folder)


def test_tape_files_are_read_by_header_name(spark):
    folder = work_folder(spark, "tapes")
    described = "Loan Identifier,Balance,Date of Loan,Pool,Pool Date,Loan Date"
    write_lines(spark, folder, "AR3 Loan Identifier,AR67,AR1,AR2,AR5,AR6", described, "L1,100,2020-11-30,P,o,s", described + "s")
    write_lines(spark, folder, "AR67 Balance,AR3,AR1,AR3", "200,L2,2020-11-30,again", "300,L3", "400,L4,2020-11-30,a,b")
    raw = tp.read_tape(spark, folder, "*.txt")
    staged = {r["AR3"]: r for r in tp.stage_tape(raw, "A").collect()}
    assert set(staged) == {"L1", "L2", "L3", "L4", "Loan Identifier"}  # the second description is no first row
    assert [staged[k]["AR67"] for k in ("L1", "L2", "L3", "L4")] == ["100", "200", "300", "400"]
    assert staged["L1"]["AR2"] == "P" and staged["L2"]["AR2"] is None
    assert [r["MalformedRows"] for r in tp.malformed_rows(raw).collect()] == [2]
    assert {r["AR3"] for r in raw.filter("Malformed IS NOT NULL").collect()} == {"L3", "L4"}


def test_tape_of_a_registered_deal(spark):
    folder = work_folder(spark, "deals")
    for name in ("one", "two", "two"):
        write_lines(spark, f"{folder}/{name}", "AR3", "L1")
    registry = spark.createDataFrame(
        [("ONE", "active", "*.txt"), ("WAIT", "awaiting_data", "*.txt"), ("NONE", "active", "*.csv")],
        "DealID string, status string, tape_pattern string",
    )
    assert tp.read_deal_tape(registry, f"{folder}/one", "one").first()["AR3"] == "L1"
    for deal, where, message in (("ZZZ", "one", "unknown"), ("WAIT", "one", "awaiting"), ("NONE", "one", "no tape"), ("ONE", "two", "more than one")):
        with pytest.raises(ValueError, match=message):
            tp.resolve_tape(registry, f"{folder}/{where}", deal)


def test_delimited_sources(spark):
    folder = work_folder(spark, "csv")
    tp.write_csv(spark.createDataFrame([("2020-11-30", "1")], "AR1 string, AR3 string").coalesce(1), folder)
    back = tp.read_tape(spark, folder, "*.csv")
    assert [tuple(r)[:2] for r in back.collect()] == [("2020-11-30", "1")] and "TapeFile" in back.columns
    line = "AVON2,Class A,XS1,666345000,648188081.84,0.97,0.18,1.0,0.18,SONIA+0.90,2048-09-21,2020-11-30"
    path = work_folder(spark, "tranches")
    spark.createDataFrame([(",".join(tp.TRANCHE_SCHEMA.names),), (line,)], "value string").coalesce(1).write.text(path)
    row = tp.read_tranches(spark, path).first()
    assert row["CurrentBalance"] == Decimal("648188081.84") and row["MaturityDate"] == dt.date(2048, 9, 21)


# ------------------------------------------------------------------ averages and preparation


def test_the_two_weighted_averages(spark):
    df = spark.createDataFrame([(10.0, 1.0), (None, 1.0), (40.0, 2.0), (7.0, -1.0)], "v double, w double")
    strict, total = df.agg(wavg_strict(F.col("v"), F.col("w")), wavg_total(F.col("v"), F.col("w"))).first()
    assert strict == pytest.approx(90 / 3) and total == pytest.approx((10 + 80 - 7) / 3)
    empty = df.filter("w > 9").agg(wavg_strict(F.col("v"), F.col("w")), wavg_total(F.col("v"), F.col("w"))).first()
    assert tuple(empty) == (None, None)


def test_balance_is_clipped_but_stays_missing(spark):
    tape = Frames(spark, SF).tape().filter("AR3 IN ('0', '997', '1009')")
    got = {r["LoanID"]: r["CurrentBalance"] for r in prep.prep_loans(tape).select("LoanID", "CurrentBalance").distinct().collect()}
    assert got["997"] == 0 and got["0"] is None and got["1009"] is None


def test_delinquency_lists_empty_buckets(spark):
    loans = prep.prep_loans(Frames(spark, SF).tape().filter("AR3 = '3'"))
    out = prep.prep_delinquency(loans)
    assert out.groupBy("DealID", "CutoffDate").count().select("count").distinct().collect()[0][0] == len(seeds.DQ_BUCKETS)


def test_calendar(spark):
    months = prep.month_calendar(spark)
    assert months.count() == 408
    assert months.filter("Date = DATE '1997-05-01'").first()[1:] == (1997, "Q2", 5, "May", "1997-05")


def test_shares_add_up_to_the_pool(spark):
    x = Frames(spark, SF)
    star = x.star(*marts.STAR_COLUMNS).cache()
    pool = {r[:2]: r[2] for r in marts.pool_summary(star).select("DealID", "CutoffDate", "TotalBalance").collect()}
    for strat in (marts.strat_ltv(star), marts.strat_delinquency(star), marts.strat_seasoning(star), marts.strat_label(star, "Region")):
        for row in strat.groupBy("DealID", "CutoffDate").agg(F.sum("Balance"), F.sum("Balance_Pct")).collect():
            assert row[2] == pool[row[:2]] and row[3] == pytest.approx(1)
    star.unpersist()


# ------------------------------------------------------------------ stress

LOANS = [
    (100.0, 80.0, 0.0), (100.0, 200.0, 0.5), (50.0, None, 2.0), (70.0, 0.0, 7.0), (0.0, 10.0, 0.0), (None, 10.0, 0.0), (90.0, 91.0, 4.0),
]


def loans(spark):
    rows = [("D", None if b is None else Decimal(str(b)), None if v is None else Decimal(str(v)), m) for b, v, m in LOANS]
    return spark.createDataFrame(rows, "DealID string, CurrentBalance decimal(18,2), CurrentValuation decimal(18,2), MonthsInArrears double")


def pd_of(m):
    return 0.02 if m == 0 else 0.08 if m <= 1 else 0.25 if m <= 3 else 0.5 if m <= 6 else 0.85


def loss(shock, cdr, sev):
    total = 0.0
    for b, v, m in LOANS:
        if not b:
            continue
        base = 1.0 if not v else max(0.1, 1 - v * (1 + shock / 100) / b)
        total += b * min(1, pd_of(m) * cdr) * min(1, base * sev)
    return total


def test_grid_matches_loan_by_loan(spark):
    rows = stress.stress_grid(loans(spark), ["DealID"]).collect()
    assert len(rows) == 11 * 9 * 7
    for r in rows:
        expected = loss(r["HPI_Shock_pct"], r["CDR_Multiplier"], r["Severity_Multiplier"])
        assert r["ExpectedLoss"] == pytest.approx(expected, rel=1e-12)
        assert r["LossRate"] == pytest.approx(expected / 410)


def test_defaults_of_the_slicers(spark):
    row = stress.stressed_expected_loss(loans(spark), ["DealID"]).first()
    assert row["ExpectedLoss"] == pytest.approx(loss(0, 1, 1))


def test_stressed_ltv_and_underwater(spark):
    for r in stress.stressed_wa_ltv(loans(spark), ["DealID"]).collect():
        up = 1 + r["HPI_Shock_pct"] / 100
        assert r["StressedWALTV"] == pytest.approx(sum(b * b / (v * up) * 100 for b, v, _ in LOANS if b and v) / 410)
    for r in stress.stressed_underwater(loans(spark), ["DealID"]).collect():
        up = 1 + r["HPI_Shock_pct"] / 100
        assert float(r["UnderwaterBalance"]) == sum(b for b, v, _ in LOANS if b and v and b / (v * up) > 1)


def test_note_coverage(spark):
    losses = stress.stressed_expected_loss(loans(spark).withColumn("DealID", F.lit("AVON2")), ["DealID"])
    row = stress.note_coverage(losses, seeds.note_classes(spark)).first()
    assert row["CreditSupport"] == 146270000.0 and row["LossVsSupport"] == pytest.approx(row["ExpectedLoss"] / 146270000)


# ------------------------------------------------------------------ measures and history


def test_measures_without_grouping_give_one_row(spark):
    x = Frames(spark, SF)
    all_rows = measures.evaluate(x.loans(), measures.loan_measures(), ["CurrentBalance", "LoanCount"])
    assert all_rows.count() == 1
    nothing = measures.evaluate(x.loans(), measures.loan_measures(), ["PoolFactor"], where=F.col("DealID") == "none")
    assert nothing.first()[0] is None


def test_smm_and_roll_forward(spark):
    rows = [("D", "s", "2020-01-31", 100.0), ("D", "s", "2020-02-29", 60.0), ("D", "s", "2020-02-29", 30.0), ("E", "s", "2020-02-29", 1.0)]
    out = history.roll_forward_cpr(spark.createDataFrame(rows, "DealID string, Source string, CutoffDate string, CurrentBalance double"))
    got = {(r["DealID"], r["CutoffDate"]): r["RollForwardCPR"] for r in out.collect()}
    assert got["D", "2020-02-29"] == pytest.approx((1 - 0.9**12) * 100)
    assert got["D", "2020-01-31"] is None and got["E", "2020-02-29"] is None
    smm = spark.createDataFrame([(12.0,)], "CPR_1m double").agg(measures.history_measures()["SMM"]).first()[0]
    assert smm == pytest.approx(1 - (1 - 0.12) ** (1 / 12))


def test_upsert_is_idempotent_and_keeps_the_last(spark):
    old = spark.createDataFrame([("2020-01", "s", 1), ("2020-02", "s", 2)], "Period string, Source string, v int")
    new = spark.createDataFrame([("2020-02", "s", 3, "x"), ("2020-03", "s", 4, "y")], "Period string, Source string, v int, extra string")
    once = history.upsert(old, new, ["Period", "Source"])
    twice = history.upsert(once, new, ["Period", "Source"])
    expected = {("2020-01", 1, None), ("2020-02", 3, "x"), ("2020-03", 4, "y")}
    for df in (once, twice):
        assert {tuple(r) for r in df.select("Period", "v", "extra").collect()} == expected


def test_replace_slice(spark):
    stored = spark.createDataFrame([("A", 1), ("B", 2)], "DealID string, v int")
    out = history.replace_slice(stored, spark.createDataFrame([("A", 9)], "DealID string, v int"), "A")
    assert {tuple(r) for r in out.collect()} == {("A", 9), ("B", 2)}


def test_seeded_history(spark):
    pool = seeds.reported_pool(spark)
    assert pool.count() == 2
    dq = seeds.reported_delinquency(spark)
    assert dq.count() == 14 and {str(r[0]) for r in dq.select("CutoffDate").distinct().collect()} == {"2022-12-28", "2023-02-28"}


def test_replayed_batch_changes_nothing(spark):
    log, source = work_folder(spark, "log"), work_folder(spark, "source")
    spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int").coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema("k string, v int").parquet(source)
    first = work_folder(spark, "checkpoint")
    upsert.land_batches(stream(), log, first)
    spark.createDataFrame([("b", 2)], "k string, v int").coalesce(1).write.mode("append").parquet(source)
    upsert.land_batches(stream(), log, first)
    expected = {("a", 1), ("b", 2)}
    rows = lambda: {tuple(r) for r in upsert.current_rows(spark, log, ["k"], "v").collect()}
    assert rows() == expected
    upsert.land_batches(stream(), log, work_folder(spark, "checkpoint"))
    assert rows() == expected
