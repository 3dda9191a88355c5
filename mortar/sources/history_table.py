"""Keyed history as a stored table with a commit record, and the tolerant reading of a report history.

A history is a folder of data, cut into slices by deal, and a log of versions.  The record of a version names the schema and
the folder of every slice; it is put in place whole and only if no other writer has put that version there, so a writer
that lost reads the newer version and merges again.  A change reads and writes the slices that it touches, the others
are carried over by name.  Columns of all deliveries are united, and a version may hold no rows at all.

The records are read and written by the driver: one line per deal.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mortar.operators.history import upsert

SLICE = "DealID"
MALFORMED = "Malformed"
_FOLDER = "_slice"
_LOG, _DATA = "log", "data"


class Taken(Exception):
    """Another writer has committed this version."""


class _Record:
    """One version: schema, and the data folder of each slice."""

    def __init__(self, version: int, schema: T.StructType | None, slices: dict[str, str]):
        self.version, self.schema, self.slices = version, schema, slices

    def text(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema.jsonValue(), "slices": self.slices})


def _files(spark: SparkSession, path: str):
    """File system of a folder, and the function that makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def versions(spark: SparkSession, path: str) -> list[int]:
    """Ascending numbers of the stored versions."""
    system, make = _files(spark, path)
    log = make(f"{path}/{_LOG}")
    if not system.exists(log):
        return []
    names = [f.getPath().getName() for f in system.listStatus(log)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _record(spark: SparkSession, path: str, version: int) -> _Record:
    line = spark.read.text(f"{path}/{_LOG}/{version:020d}.json", wholetext=True).first()[0]
    found = json.loads(line)
    return _Record(version, T.StructType.fromJson(found["schema"]), found["slices"])


def _newest(spark: SparkSession, path: str) -> _Record:
    stored = versions(spark, path)
    return _record(spark, path, stored[-1]) if stored else _Record(0, None, {})


def _commit(spark: SparkSession, path: str, record: _Record) -> None:
    """Put the record in its place whole, or raise ``Taken`` if there is one."""
    system, make = _files(spark, path)
    name = f"{path}/{_LOG}/{record.version:020d}.json"
    draft = make(f"{path}/{_LOG}/.{uuid.uuid4().hex}")
    system.mkdirs(draft.getParent())
    out = system.create(draft)
    out.write(bytearray(record.text().encode()))
    out.close()
    if system.getScheme() == "file":
        # a local rename would replace the other's record; a link does not
        local = lambda p: system.makeQualified(p).toUri().getPath()
        try:
            os.link(local(draft), local(make(name)))
        except FileExistsError:
            raise Taken(name) from None
        finally:
            system.delete(draft, False)
    elif not system.rename(draft, make(name)):
        system.delete(draft, False)
        raise Taken(name)


def _folder(deal: Column) -> Column:
    """Name of a deal's slice that every file system takes."""
    return F.coalesce(F.concat(F.lit("d"), F.hex(deal.cast("string"))), F.lit("none"))


def slice_name(deal_id: str | None) -> str:
    return "none" if deal_id is None else f"d{deal_id.encode().hex().upper()}"


def _united(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Stored columns, then those that are new; a column keeps its type."""
    if old is None:
        return T.StructType([T.StructField(f.name, f.dataType) for f in new])
    types = {f.name: f.dataType for f in old}
    for f in new:
        if types.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"{f.name} is stored as {types[f.name].simpleString()} and comes as {f.dataType.simpleString()}")
    return T.StructType([*old, *(T.StructField(f.name, f.dataType) for f in new if f.name not in types)])


def _read(spark: SparkSession, path: str, record: _Record, names: Sequence[str] | None = None) -> DataFrame:
    chosen = [f for n, f in record.slices.items() if names is None or n in names]
    if not chosen:
        return spark.createDataFrame([], record.schema)
    return spark.read.schema(record.schema).parquet(*[f"{path}/{_DATA}/{f}" for f in chosen])


def read_history(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The newest version of a history, or the given one; None where nothing is stored."""
    record = _newest(spark, path) if version is None else _record(spark, path, version)
    return _read(spark, path, record) if record.version else None


def _write(rows: DataFrame, path: str, order: Sequence[str]) -> dict[str, str]:
    """Data folders of the slices of some rows, sorted within files that follow each other in order."""
    spark, name = rows.sparkSession, uuid.uuid4().hex
    keyed = rows.withColumn(_FOLDER, _folder(F.col(SLICE)))
    keyed = keyed.repartitionByRange(_FOLDER, *order).sortWithinPartitions(_FOLDER, *order)
    keyed.write.partitionBy(_FOLDER).parquet(f"{path}/{_DATA}/{name}")
    system, make = _files(spark, path)
    found = [f.getPath().getName() for f in system.listStatus(make(f"{path}/{_DATA}/{name}")) if f.isDirectory()]
    return {f.removeprefix(f"{_FOLDER}="): f"{name}/{f}" for f in found}


def _change(new: DataFrame, path: str, order: Sequence[str], touched: set[str], rows: Callable[[DataFrame], DataFrame]) -> int:
    """Commit the next version: ``rows`` of the stored rows of the touched slices, all others as they are."""
    spark = new.sparkSession
    while True:
        old = _newest(spark, path)
        schema = _united(old.schema, new.schema)
        stored = _Record(old.version, schema, old.slices)
        kept = {n: f for n, f in old.slices.items() if n not in touched}
        written = _write(rows(_read(spark, path, stored, touched)).select(*schema.names), path, order)
        try:
            _commit(spark, path, _Record(old.version + 1, schema, {**kept, **written}))
            return old.version + 1
        except Taken:
            system, make = _files(spark, path)
            for folder in {f.split("/")[0] for f in written.values()}:
                system.delete(make(f"{path}/{_DATA}/{folder}"), True)


@contextmanager
def _delivered(new: DataFrame, path: str) -> Iterator[DataFrame]:
    """The rows of a delivery, made once: they are looked at for their deals, for the bounds of the files and for the merge."""
    spark, folder = new.sparkSession, f"{path}/{_DATA}/{uuid.uuid4().hex}"
    new.write.parquet(folder)
    try:
        yield spark.read.schema(new.schema).parquet(folder)
    finally:
        system, make = _files(spark, path)
        system.delete(make(folder), True)


def _touched(new: DataFrame) -> set[str]:
    return {r[0] for r in new.select(_folder(F.col(SLICE))).distinct().collect()}  # one row a deal


def merge_into(new: DataFrame, path: str, keys: Sequence[str], ordinal: Sequence[str] = ()) -> int:
    """Put rows into a stored history: the new row of a key wins.  Doing it twice changes nothing.  Returns the version."""
    with _delivered(new, path) as rows:
        return _change(rows, path, keys, _touched(rows), lambda old: upsert(old, rows, keys, ordinal))


def replace_deal(new: DataFrame, path: str, deal_id: str | None, order: Sequence[str]) -> int:
    """Put the rows of a deal, which may be none, in place of those stored for it.  Returns the version."""
    name = slice_name(deal_id)
    with _delivered(new, path) as rows:
        if _touched(rows) - {name}:
            raise ValueError(f"rows of other deals than {deal_id}")
        return _change(rows, path, order, {name}, lambda old: old.limit(0).unionByName(rows, allowMissingColumns=True))


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all versions but the last ``keep``, and the data that only they name; data of open changes stay."""
    stored = versions(spark, path)
    system, make = _files(spark, path)
    gone = [_record(spark, path, v) for v in stored[:-keep]]
    needed = {f for v in stored[-keep:] for f in _record(spark, path, v).slices.values()}
    for record in gone:
        system.delete(make(f"{path}/{_LOG}/{record.version:020d}.json"), False)
    for folder in {f for record in gone for f in record.slices.values()} - needed:
        system.delete(make(f"{path}/{_DATA}/{folder}"), True)


def read_report_history(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of a delimited report history, and the lines that do not fit its schema (column ``Malformed``)."""
    wide = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    lines = spark.read.text(path).filter((F.trim("value") != "") & (F.col("value") != ",".join(schema.names)))
    rows = lines.select("value", F.from_csv("value", ddl, options).alias("r"))
    fits = F.col(f"r.{MALFORMED}").isNull()
    return rows.filter(fits).select(*[f"r.{c}" for c in schema.names]), rows.filter(~fits).select(F.col("value").alias(MALFORMED))
