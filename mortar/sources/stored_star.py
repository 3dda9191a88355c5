"""The star kept bucketed: facts and loan attributes dealt and sorted by loan once, joined without a shuffle ever after.

Facts without a loan id get a spread-out key when they are written, so that they fill all buckets evenly.  A loan has one
fact per cut-off, so the rows of one id are bounded by the number of cut-offs; choose the number of buckets so that one is a
few hundred MB.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from mortar.operators.star import attributes, keyed_facts

KEY = ["_loan", "DealID"]
_TABLES = ("fact", "dim")


def _name(path: str, table: str) -> str:
    return f"star_{hashlib.md5(path.encode()).hexdigest()[:16]}_{table}"


def write_star(fact: DataFrame, dim: DataFrame, path: str, buckets: int = 64) -> None:
    """Replace a stored star: one file a bucket, sorted by loan."""
    spark, spec = fact.sparkSession, {"buckets": buckets}
    for table, rows in zip(_TABLES, (keyed_facts(fact), attributes(dim, [c for c in dim.columns if c not in ("DealID", "LoanID")]))):
        dealt = rows.repartition(buckets, *KEY)  # the same hash as the buckets': a task writes one bucket
        writer = dealt.write.format("parquet").mode("overwrite").option("path", f"{path}/{table}")
        writer.bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(_name(path, table))
        spec[table] = dealt.schema.jsonValue()
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")


def _open(spark: SparkSession, path: str) -> list[DataFrame]:
    """Facts and attributes; a session that did not write them gets to know the tables from the stored description."""
    spec = None
    for table in _TABLES:
        if not spark.catalog.tableExists(_name(path, table)):
            spec = spec or json.loads(spark.read.text(f"{path}/spec", wholetext=True).first()[0])
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(spec[table]))
            spark.sql(
                f"CREATE TABLE {_name(path, table)} ({fields}) USING parquet CLUSTERED BY ({', '.join(KEY)})"
                f" SORTED BY ({', '.join(KEY)}) INTO {spec['buckets']} BUCKETS LOCATION '{path}/{table}'"
            )
    return [spark.table(_name(path, table)) for table in _TABLES]


def stored_join(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Facts with the given loan attributes, bucket by bucket; facts without a loan keep NULL attributes."""
    fact, dim = _open(spark, path)
    return fact.join(dim.select(*KEY, *columns), KEY, "left").select(*[c for c in fact.columns if c != "_loan"], *columns)


def forget(spark: SparkSession, path: str) -> None:
    """Take the tables out of this session's catalog; the files stay."""
    for table in _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_name(path, table)}")
