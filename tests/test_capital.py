"""Risk weights, published tranche results and structure checks."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mortar.operators import rwa

NOTE = (
    "DealID string, CutoffDate string, NoteID string, TrancheID string, Rating string, Seniority string, WAL double,"
    " CurrentBalance decimal(18,2), Attachment decimal(9,4), Detachment decimal(9,4)"
)


def note(name, rating, balance, a, d, wal, seniority, deal="D"):
    return (deal, "2020-11-30", name, name, rating, seniority, wal, Decimal(balance), Decimal(a), Decimal(d))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), NOTE)


def weights(spark, *rows):
    out = rwa.rwa_tranche(frame(spark, *rows)).select("NoteID", "RiskWeight", "RWA", "Capital").collect()
    return {r[0]: (r[1], float(r[2]), float(r[3])) for r in out}


def test_library_weights(spark):
    got = weights(
        spark,
        note("A", "AAA", "1000000", "0.15", "1", 3.0, "senior"),
        note("moodys", "Aaa", "1", "0.15", "1", 1.0, "senior"),
        note("five", "AAA", "1", "0.15", "1", 5.0, "senior"),
        note("short", "AAA", "1", "0.15", "1", 0.5, "senior"),
        note("flp", None, "1000000", "0", "0.01", 5.0, "non-senior"),
        note("odd", "XYZ", "1", "0", "0.5", 5.0, "non-senior"),
        note("thick", "BBB", "1", "0", "0.5", 3.0, "non-senior"),
        note("thin", "BBB", "1", "0", "0.05", 5.0, "non-senior"),
    )
    assert got["A"] == (0.175, 175000.0, 14000.0)
    assert got["moodys"][0] == 0.15 and got["five"][0] == 0.2 and got["short"][0] >= 0.15
    assert got["flp"] == (12.5, 12500000.0, 1000000.0)
    assert got["odd"][0] == 12.5
    assert got["thick"][0] == 1.15
    assert got["thin"][0] == round(1.4 * 1.1, 4)


def test_rating_spellings(spark):
    rows = spark.createDataFrame([("Aa1",), (" AA ",), ("XYZ",), (None,)], "r string")
    assert [x[0] for x in rows.select(rwa.normalise_rating(F.col("r"))).collect()] == ["AA+", "AA", None, None]


def test_interpolation(spark):
    out = spark.range(1).select(*[rwa.interpolate(F.lit(0.15), F.lit(0.20), F.lit(m)) for m in (0.5, 1.0, 3.0, 5.0, 9.0)]).first()
    assert out[0] == out[1] == 0.15 and out[2] == pytest.approx(0.175) and out[3] == out[4] == 0.20


# fixed values: published balances and attachment points with the published weight, RWA and capital
PUBLISHED = [
    ("AVON2", "Class A", "648188081.84", "0.18", "1", 0.1813, 18.13, 117484089.83, 9398727.19),
    ("AVON2", "Class B", "32504000.00", "0.14", "0.18", 0.4375, 43.75, 14220500.0, 1137640.0),
    ("AVON2", "Class C", "32505000.00", "0.10", "0.14", 0.7625, 76.25, 24785062.5, 1982805.0),
    ("AVON2", "Class D", "24378000.00", "0.07", "0.10", 1.4, 140.0, 34129200.0, 2730336.0),
    ("AVON2", "Class E", "20316000.00", "0.045", "0.07", 3.3, 330.0, 67042800.0, 5363424.0),
    ("AVON2", "Class F", "8126000.00", "0.035", "0.045", 7.5, 750.0, 60945000.0, 4875600.0),
    ("AVON2", "Class Z", "28441000.00", "0", "0.035", 12.5, 1250.0, 355512500.0, 28441000.0),
    ("BLETCHLEY", "Class A", "206049819.26", "0.1536", "1", 0.175, 17.5, 36058718.37, 2884697.47),
    ("BLETCHLEY", "Class B", "13058000", "0.0999", "0.1536", 0.4062, 40.62, 5304812.5, 424385.0),
    ("BLETCHLEY", "Class C", "8903000", "0.0633", "0.0999", 0.725, 72.5, 6454675.0, 516374.0),
    ("BLETCHLEY", "Class D", "4748000", "0.0438", "0.0633", 1.3375, 133.75, 6350450.0, 508036.0),
    ("BLETCHLEY", "Class E", "3563000", "0.0291", "0.0438", 3.3, 330.0, 11757900.0, 940632.0),
    ("BLETCHLEY", "Class X1", "2409989.35", "0", "0.0291", 12.5, 1250.0, 30124866.88, 2409989.35),
    ("BLETCHLEY", "Class X2", "2967000", "0", "0.0291", 12.5, 1250.0, 37087500.0, 2967000.0),
]


def published(spark):
    return frame(spark, *[note(c, None, b, a, d, 0.0, "", deal) for deal, c, b, a, d, *_ in PUBLISHED])


def test_published_tranches(spark):
    out = rwa.rwa_export(published(spark)).select("DealID", "TrancheID", "RiskWeight", "RiskWeight_Pct", "RWA", "Capital")
    assert {tuple(r) for r in out.collect()} == {(p[0], p[1], *p[5:]) for p in PUBLISHED}


def test_published_deal_totals(spark):
    out = {r["DealID"]: r for r in rwa.rwa_deal(rwa.rwa_export(published(spark))).collect()}
    assert round(out["AVON2"]["TotalRWA"], 2) == 674119152.33 and round(out["AVON2"]["Density"], 4) == 0.8485
    assert round(out["BLETCHLEY"]["TotalRWA"], 2) == 133138922.75 and round(out["BLETCHLEY"]["CapitalRequired"], 2) == 10651113.82


def test_published_structures(spark):
    out = rwa.structure_checks(published(spark).withColumn("Seniority", F.when(F.col("TrancheID") == "Class A", "senior").otherwise("non-senior")))
    assert {(r["DealID"], r["check_name"]) for r in out.collect()} == {("BLETCHLEY", "OVERLAP")}


def test_template_structure(spark):
    pool = spark.createDataFrame([("AVON2", "2020-11-30", Decimal("839000000.00"))], "DealID string, CutoffDate string, TotalBalance decimal(18,2)")
    built = rwa.structure_from_pool(pool)
    assert built.count() == 5
    assert rwa.credit_enhancement(built).first()["CreditEnhancement"] == 0.15
    total = rwa.rwa_deal(rwa.rwa_tranche(built), pool).first()
    assert float(total["CapitalRequired"]) == pytest.approx(float(total["TotalRWA"]) * 0.08)
    assert round(total["Density"], 3) == 0.394
    assert rwa.structure_checks(built).count() == 0


def test_row_and_structure_checks(spark):
    rows = frame(
        spark,
        note("low", "A", "1", "-0.1", "0.5", 1.0, "non-senior"),
        note("turned", "A", "1", "0.5", "0.3", 1.0, "non-senior"),
        note("fine", "A", "1", "0.1", "0.3", 1.0, "non-senior"),
    )
    assert {(r["NoteID"], r["error"]) for r in rwa.tranche_row_checks(rows).collect()} == {
        ("low", "ATTACHMENT_OUT_OF_RANGE"), ("turned", "DETACHMENT_NOT_ABOVE_ATTACHMENT")}
    over = frame(spark, note("A", "AAA", "1", "0.15", "1", 1.0, "senior"), note("B", "AA", "1", "0.10", "0.20", 1.0, "non-senior"))
    assert [tuple(r)[2:] for r in rwa.structure_checks(over).collect()] == [("OVERLAP", "B / A")]
    two = frame(spark, note("A", "AAA", "1", "0.5", "1", 1.0, "senior"), note("B", "AA", "1", "0", "0.5", 1.0, "senior"))
    assert {tuple(r)[2:] for r in rwa.structure_checks(two).collect()} == {("SENIOR_COUNT", "2"), ("SENIOR_NOT_TOP", "B")}
