"""Ratings-based risk weights, RWA and capital of securitisation tranches, and structure checks.

Two variants are kept apart: the library one (spelling map, thin-tranche uplift, floor, rounded
weight) and the export one (none of these; amounts use the unrounded weight).
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from mortar.functions.averages import divide, half_even
from mortar.functions.casts import decode
from mortar.operators.grouping import dealt, with_totals
from mortar.sources.seeds import (
    CAPITAL_RATIO,
    FLOOR_WEIGHT,
    STRUCTURE_TEMPLATE,
    THIN_LIMIT,
    UNRATED_WEIGHT,
    rating_spellings,
    risk_weights,
    tranche_config,
)

SENIOR = "senior"
DEAL = ["DealID", "CutoffDate"]


def normalise_rating(rating: Column) -> Column:
    """Canonical rating of any accepted spelling; NULL when unknown."""
    return decode(F.trim(rating), rating_spellings())


def interpolate(rw1: Column, rw5: Column, years: Column) -> Column:
    """Weight between the one-year and five-year anchors, clamped outside."""
    return F.when(years <= 1, rw1).when(years >= 5, rw5).otherwise(rw1 + (rw5 - rw1) * (years - 1) / 4)


def thickness() -> Column:
    return F.col("Detachment").cast("double") - F.col("Attachment").cast("double")


def _anchors(df: DataFrame, variant: str) -> DataFrame:
    """Join the anchor weights (a fixed table of about forty rows) on canonical rating and seniority."""
    table = risk_weights(df.sparkSession, variant).withColumnRenamed("Rating", "_rating")
    return df.join(F.broadcast(table), ["_rating", "Seniority"], "left").drop("_rating")


def rwa_tranche(notes: DataFrame) -> DataFrame:
    """Library variant: adds ``Thickness``, ``RiskWeight``, ``RWA`` and ``Capital`` to each tranche.

    The weight has four digits, so amounts stay exact decimals.
    """
    df = _anchors(notes.withColumn("_rating", normalise_rating(F.col("Rating"))), "library")
    thick = F.col("Thickness")
    weight = interpolate(F.col("rw1"), F.col("rw5"), F.col("WAL"))
    thin = (F.col("Seniority") != SENIOR) & (thick < THIN_LIMIT)
    weight = F.when(thin, weight * (1 + (THIN_LIMIT - thick) * 2)).otherwise(weight)
    weight = F.greatest(weight, F.lit(FLOOR_WEIGHT))
    rated = F.col("rw1").isNotNull()
    return (
        df.withColumn("Thickness", thickness())
        .withColumn("RiskWeight", F.when(rated, half_even(weight, 4)).otherwise(F.lit(UNRATED_WEIGHT)))
        .withColumn("RWA", F.col("CurrentBalance") * F.col("RiskWeight").cast("decimal(9,4)"))
        .withColumn("Capital", F.col("RWA") * F.lit(Decimal(str(CAPITAL_RATIO))))
        .drop("rw1", "rw5")
    )


def with_tranche_config(notes: DataFrame, config: DataFrame) -> DataFrame:
    """Rating, seniority and life from the configuration; unknown tranches are unrated, junior, five years."""
    settings = config.select("DealID", "TrancheID", *[F.col(c).alias(f"_{c}") for c in ("Rating", "Seniority", "WAL")])
    return (
        notes.drop("Rating", "Seniority", "WAL")
        .join(settings, ["DealID", "TrancheID"], "left")
        .withColumn("Rating", F.coalesce("_Rating", F.lit("NR")))
        .withColumn("Seniority", F.coalesce("_Seniority", F.lit("non-senior")))
        .withColumn("WAL", F.coalesce("_WAL", F.lit(5.0)))
        .drop("_Rating", "_Seniority", "_WAL")
    )


def rwa_export(notes: DataFrame, config: DataFrame | None = None) -> DataFrame:
    """Export variant for tranches rated by configuration; every output is rounded on its own."""
    settings = config if config is not None else tranche_config(notes.sparkSession)
    df = _anchors(with_tranche_config(notes, settings).withColumn("_rating", F.col("Rating")), "export")
    weight = F.coalesce(interpolate(F.col("rw1"), F.col("rw5"), F.col("WAL")), F.lit(UNRATED_WEIGHT))
    rwa = F.col("CurrentBalance").cast("double") * F.col("_w")
    return (
        df.withColumn("_w", weight)
        .withColumns(
            {
                "Thickness": half_even(thickness(), 4),
                "RiskWeight": half_even(F.col("_w"), 4),
                "RiskWeight_Pct": half_even(F.col("_w") * 100, 2),
                "RWA": half_even(rwa, 2),
                "Capital": half_even(rwa * CAPITAL_RATIO, 2),
            }
        )
        .drop("_w", "rw1", "rw5")
    )


def rwa_deal(tranches: DataFrame, pool: DataFrame | None = None) -> DataFrame:
    """Totals per deal and cut-off; density divides by the pool balance where ``pool`` is given."""
    out = tranches.groupBy(*DEAL).agg(
        F.sum("CurrentBalance").alias("NoteBalance"),
        F.sum("RWA").alias("TotalRWA"),
        F.sum("Capital").alias("CapitalRequired"),
    )
    out = out.withColumn("AvgRiskWeight", F.coalesce(divide(F.col("TotalRWA"), F.col("NoteBalance")), F.lit(0.0)))
    if pool is None:
        return out.withColumn("Density", divide(F.col("TotalRWA"), F.col("NoteBalance")))
    balances = pool.select(*DEAL, F.col("TotalBalance").alias("PoolBalance"))
    return out.join(balances, DEAL, "left").withColumn("Density", divide(F.col("TotalRWA"), F.col("PoolBalance")))


def rwa_share(tranches: DataFrame) -> DataFrame:
    """Each tranche's part of its deal's RWA.  The deal total is joined, not windowed: deals can be huge."""
    return with_totals(tranches, DEAL, _total=F.sum("RWA")).withColumn("RWA_Share", divide(F.col("RWA"), F.col("_total"))).drop("_total")


def rwa_movement(tranches: DataFrame, parts: int | None = None) -> DataFrame:
    """Change of RWA from one cut-off to the next of the same note (one row per note and cut-off).

    Dealt by note once, over ``parts`` tasks: grouping and window both find their rows together.
    """
    window = Window.partitionBy("NoteID", "DealID").orderBy("CutoffDate")
    rows = dealt(tranches.select("DealID", "NoteID", "CutoffDate", "CurrentBalance", "RWA"), parts, "NoteID", "DealID")
    per_cutoff = rows.groupBy("DealID", "NoteID", "CutoffDate").agg(
        F.sum("CurrentBalance").alias("CurrentBalance"), F.sum("RWA").alias("RWA")
    )
    return per_cutoff.withColumn("PreviousRWA", F.lag("RWA").over(window)).withColumn(
        "RWAChange", F.col("RWA") - F.col("PreviousRWA")
    )


def report_table(tranches: DataFrame) -> DataFrame:
    """Formatted columns of the tranche report."""
    text = lambda c, suffix: F.concat(half_even(c, 1).cast("decimal(18,1)").cast("string"), F.lit(suffix))
    return tranches.select(
        *DEAL, "NoteID",
        F.col("TrancheID").alias("tranche"),
        F.coalesce(F.when(F.col("Rating") != "", F.col("Rating")), F.lit("NR")).alias("rating"),
        F.col("Seniority").alias("seniority"),
        F.col("CurrentBalance").alias("balance"),
        text(F.col("Thickness") * 100, "%").alias("thickness"),
        text(F.col("WAL"), "yr").alias("maturity"),
        text(F.col("RiskWeight") * 100, "%").alias("risk_weight"),
        half_even(F.col("RWA"), 2).alias("rwa"),
        half_even(F.col("Capital"), 2).alias("capital"),
    )


# ------------------------------------------------------------------ structures


def tranche_row_checks(notes: DataFrame) -> DataFrame:
    """Tranches whose points lie outside 0..1 or whose detachment is not above the attachment."""
    a, d = F.col("Attachment"), F.col("Detachment")
    error = (
        F.when((a < 0) | (a > 1), "ATTACHMENT_OUT_OF_RANGE")
        .when((d < 0) | (d > 1), "DETACHMENT_OUT_OF_RANGE")
        .when(d <= a, "DETACHMENT_NOT_ABOVE_ATTACHMENT")
    )
    return notes.select("DealID", "NoteID", "CutoffDate", "Attachment", "Detachment", error.alias("error")).filter("error IS NOT NULL")


def structure_checks(notes: DataFrame) -> DataFrame:
    """Overlapping neighbours, senior count other than one, senior not reaching the top.

    Neighbours are found by attachment.  Of tranches that share an attachment the one with the last id is
    next to the following attachment's first, and next to all others.  So only attachment points are put
    in order, however many tranches a point has.
    """
    points = notes.groupBy(*DEAL, "Attachment").agg(F.min("NoteID").alias("_first"), F.max("NoteID").alias("_last"))
    order = Window.partitionBy(*DEAL).orderBy("Attachment")
    points = points.withColumns({"_next": F.lead("_first").over(order), "_at": F.lead("Attachment").over(order)})
    last = F.col("NoteID") == F.col("_last")
    neighbours = notes.join(points, [*DEAL, "Attachment"]).withColumns(
        {
            "_partner": F.when(last, F.col("_next")).otherwise(F.col("_last")),
            "_from": F.when(last, F.col("_at")).otherwise(F.col("Attachment")),
        }
    )
    check = lambda df, name, detail: df.select(*DEAL, F.lit(name).alias("check_name"), detail.alias("detail"))
    overlap = check(
        neighbours.filter(F.col("Detachment") > F.col("_from")),
        "OVERLAP", F.concat_ws(" / ", "NoteID", "_partner"),
    )
    per_deal = notes.groupBy(*DEAL).agg(
        F.count_if(F.col("Seniority") == SENIOR).alias("seniors"), F.max("Detachment").alias("top")
    )
    count = check(per_deal.filter("seniors <> 1"), "SENIOR_COUNT", F.col("seniors").cast("string"))
    low = notes.filter(F.col("Seniority") == SENIOR).join(per_deal, DEAL).filter(F.col("Detachment") != F.col("top"))
    return reduce(DataFrame.unionByName, [overlap, count, check(low, "SENIOR_NOT_TOP", F.col("NoteID"))])


def credit_enhancement(notes: DataFrame) -> DataFrame:
    """Attachment of the first senior tranche per deal (by note id), 0 without one."""
    senior = F.col("Seniority") == SENIOR
    first = F.min(F.when(senior, F.struct("NoteID", "Attachment")))
    return (
        notes.groupBy(*DEAL)
        .agg(first.alias("x"), F.sum("CurrentBalance").alias("TotalTrancheBalance"))
        .select(*DEAL, F.coalesce("x.Attachment", F.lit(0)).cast("double").alias("CreditEnhancement"), "TotalTrancheBalance")
    )


def structure_from_pool(pool: DataFrame) -> DataFrame:
    """Five template tranches for every pool, scaled by its balance.

    ``explode`` of the five fixed rows; no join is involved.
    """
    fields = ["TrancheID", "Rating", "Share", "Attachment", "Detachment", "WAL", "Seniority"]
    texts = ("TrancheID", "Rating", "Seniority")
    kind = lambda f: "string" if f in texts else "decimal(3,2)" if f == "Share" else "double"
    row = lambda values: F.struct(*[F.lit(v).cast(kind(f)).alias(f) for f, v in zip(fields, values)])
    template = F.array(*[row(values) for values in STRUCTURE_TEMPLATE])
    return (
        pool.select(*DEAL, F.col("TotalBalance").alias("PoolBalance"), F.explode(template).alias("t"))
        .select(
            *DEAL, "PoolBalance",
            F.concat_ws(" ", "DealID", "t.TrancheID").alias("NoteID"),
            *[F.col(f"t.{f}").alias(f) for f in fields if f != "Share"],
            (F.col("PoolBalance").cast("decimal(18,2)") * F.col("t.Share")).alias("CurrentBalance"),
        )
    )


def class_a_enhancement(balance: Column, subordination: Column) -> Column:
    """Subordination as a part of all notes; NULL when either side is missing or zero."""
    known = (balance != 0) & (subordination != 0)
    return F.when(known, divide(subordination, balance + subordination))
