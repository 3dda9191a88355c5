"""Connected components of a link table, by alternating star contractions written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortar.llm import scratch


def _toward_minimum(links: DataFrame, both: bool) -> DataFrame:
    """One star step: every node hands the least of its neighbours to the others.

    ``both``: over all neighbours, to the larger ones (large star); otherwise over the smaller ones (small star).
    """
    if both:
        links = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = links.join(least, "u")
    if both:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v), root being the least node that can be reached.

    Each round is a large-star and a small-star step; it ends when every node but the roots points at its root.  Minima
    are aggregated before the shuffle, and the joins on a hub's links are skew joins that Spark splits.  Null ends and
    loops are left out.
    """
    links = links.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = scratch.stored(links, "links")
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or state[0] == 0:
            break
        before = tuple(state)
        links = scratch.stored(_toward_minimum(_toward_minimum(links, True), False), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
