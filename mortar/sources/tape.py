"""Reading tapes: headers, description rows, null spellings, registry checks, staging and writers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mortar.functions.casts import null_spellings
from mortar.sources.ordered import write_ordered

# fixed values: words that mark a description row, and how many marks it takes
DESCRIPTION_WORDS = ("Pool", "Identifier", "Date", "Loan", "Balance")
DESCRIPTION_LENGTH, DESCRIPTION_MARKS = 50, 5

FIELD = re.compile(r"AR\d+")

#: explicit schema of a tranche file; schemas are never inferred
TRANCHE_SCHEMA = T.StructType(
    [
        T.StructField("DealID", T.StringType()),
        T.StructField("TrancheID", T.StringType()),
        T.StructField("ISIN", T.StringType()),
        T.StructField("OriginalBalance", T.DecimalType(18, 2)),
        T.StructField("CurrentBalance", T.DecimalType(18, 2)),
        T.StructField("Factor", T.DoubleType()),
        T.StructField("Attachment", T.DoubleType()),
        T.StructField("Detachment", T.DoubleType()),
        T.StructField("CreditEnhancement", T.DoubleType()),
        T.StructField("Coupon", T.StringType()),
        T.StructField("MaturityDate", T.DateType()),
        T.StructField("CutoffDate", T.DateType()),
    ]
)


def clean_header(name: str) -> str:
    """``AR3 Loan Identifier`` -> ``AR3``; other names become plain identifiers."""
    text = name.strip()
    field = FIELD.match(text)
    if field:
        return field.group()
    plain = re.sub(r"\W", "_", text, flags=re.ASCII)
    return f"_{plain}" if plain[:1].isdigit() else plain


#: columns that reading adds: the row's file, whether it is the file's first, the text of a row that does not fit
FILE, FIRST, MALFORMED = "TapeFile", "FirstRow", "Malformed"


#: a cell of a delimited line that begins with a comma: quoted, with doubled quotes inside, or plain
_CELL = ',("(?:[^"]|"")*"|[^,]*)'


def _cells(line: Column) -> Column:
    """Cells of a line of text; an empty one is NULL."""
    inner = lambda c: F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    plain = lambda c: F.when(F.startswith(c, F.lit('"')), inner(c)).otherwise(c)
    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1)), lambda c: F.nullif(plain(c), F.lit("")))
    return F.when(line.contains('"'), quoted).otherwise(F.transform(F.split(line, ","), lambda c: F.nullif(c, F.lit(""))))


def _clean(name: Column) -> Column:
    """As :func:`clean_header`, for a column."""
    text = F.trim(F.coalesce(name, F.lit("")))
    field, other = F.regexp_extract(text, r"^(AR\d+)", 1), F.regexp_replace(text, r"[^A-Za-z0-9_]", "_")
    return F.when(field != "", field).when(other.rlike("^[0-9]"), F.concat(F.lit("_"), other)).otherwise(other)


def _heads(lines: DataFrame) -> DataFrame:
    """Per file: its header line, the cleaned names in it, and its first data line."""
    # the lines at a file's head are numbered on end by one task: of the first two one is even, one odd
    at_head = lines.filter("at = 0").withColumn("n", F.monotonically_increasing_id())
    least = lambda odd: F.min(F.when(F.col("n") % 2 == odd, F.struct("n", "value")))
    # the set is for the plan: with it groups are hashed, two lines a file in memory; least texts alone would sort all lines
    two = at_head.groupBy("path").agg(least(0).alias("even"), least(1).alias("odd"), F.collect_set("at").alias("blocks"))
    heads = two.filter(F.size("blocks") > 0).select(
        "path", F.least("even", "odd")["value"].alias("header"), F.greatest("even", "odd")["value"].alias("first")
    )
    return heads.withColumn("names", F.transform(_cells(F.regexp_replace("header", "^\ufeff", "")), _clean))


def read_tape(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """Delimited tape files as text columns, found by header name whatever their order in a file.

    The headers are a table by file, joined to the lines; each line is cut against its own file's header.  So the plan is
    the same for any number of files and layouts, and only the names of all columns come to the driver.  Adds
    ``TapeFile``, ``FirstRow`` and ``Malformed``: a row with too few or too many cells is kept with its text there.  A
    column that a file lacks is NULL in its rows; of a name that a header repeats, the first counts and the others are
    left out.  Lines equal to their file's header are headers; blank lines are skipped.
    """
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    lines = reader.text([paths] if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value"
    )
    lines = lines.filter(F.trim("value") != "")
    heads = _heads(lines)
    names = [r[0] for r in heads.select(F.explode("names")).distinct().orderBy("col").collect() if r[0]]
    if not names:
        raise ValueError("no tape file")
    places = F.array(*[F.array_position("names", F.lit(n)).cast("int") for n in names])
    heads = heads.select(F.col("path").alias("_path"), "header", "first", F.size("names").alias("width"), places.alias("places"))
    # one row a file is broadcast: a join by file would send all lines to as many tasks as there are files
    rows = lines.join(F.broadcast(heads), F.col("path") == F.col("_path")).filter(F.col("value") != F.col("header"))
    # exploded from an array of one, so that a filter on the fields cannot be moved below and cut each line once a field
    rows = rows.withColumn("cells", F.explode(F.array(_cells(F.col("value")))))
    # places count from 1; 0 stands for a name that the header lacks
    value = lambda i: F.when(F.col("places")[i] > 0, F.get("cells", F.col("places")[i] - 1))
    return rows.select(
        *[value(i).alias(n) for i, n in enumerate(names)],
        F.when(F.size("cells") != F.col("width"), F.col("value")).alias(MALFORMED),
        F.element_at(F.split("path", "/"), -1).alias(FILE),
        F.col("value").eqNullSafe(F.col("first")).alias(FIRST),
    )


def malformed_rows(raw: DataFrame) -> DataFrame:
    """Rows per tape file that do not fit its header; no row when all fit."""
    return raw.groupBy(FILE).agg(F.count_if(F.col(MALFORMED).isNotNull()).alias("MalformedRows")).filter("MalformedRows > 0")


def read_tranches(spark: SparkSession, path: str) -> DataFrame:
    """Tranche file with its fixed schema."""
    return spark.read.schema(TRANCHE_SCHEMA).option("header", True).csv(path)


def _describes(fields: Sequence[str]) -> Column:
    """A file's first data row that describes the fields: more than five long or keyword cells."""
    words = "|".join(DESCRIPTION_WORDS)
    keyword = lambda cells: F.size(F.filter(cells, lambda x: x.rlike(words)))
    long = lambda cells: F.size(F.filter(cells, lambda x: F.length(x) > DESCRIPTION_LENGTH))
    # each field stands here once and in a branch of its own, so cells are made and looked at in first rows only
    row = F.array(F.array(*[F.col(f) for f in fields]))
    marked = F.exists(row, lambda cells: (keyword(cells) > DESCRIPTION_MARKS) | (long(cells) > DESCRIPTION_MARKS))
    return F.when(F.col(FIRST), marked).otherwise(False)


def drop_description_rows(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Drop description rows at the head of files.  Without ``FirstRow`` nothing is known to be a head."""
    return df.filter(~_describes(fields)) if FIRST in df.columns else df


def stage_tape(raw: DataFrame, deal_id: str | None = None) -> DataFrame:
    """Raw tape to staged tape: clean headers, field columns only, no description or blank rows, real nulls.

    ``DealID`` comes with the rows or is given for a single-deal tape.
    """
    df = raw.toDF(*[clean_header(c) for c in raw.columns])
    if deal_id is not None:
        df = df.withColumn("DealID", F.lit(deal_id))
    fields = sorted((c for c in df.columns if FIELD.fullmatch(c)), key=lambda c: int(c[2:]))
    df = drop_description_rows(df, fields).na.drop("all", subset=fields)
    return df.select("DealID", *[null_spellings(F.col(c)).alias(c) for c in fields])


def description_rows(raw: DataFrame) -> DataFrame:
    """Raw and kept row counts per deal when description rows are dropped."""
    df = raw.toDF(*[clean_header(c) for c in raw.columns])
    fields = [c for c in df.columns if FIELD.fullmatch(c)]
    return df.groupBy("DealID").agg(F.count("*").alias("RawRows"), F.count_if(~_describes(fields)).alias("KeptRows"))


def registry_check(registry: DataFrame, files: DataFrame) -> DataFrame:
    """Can each registered deal and period be resolved to exactly one tape file?

    ``files`` is ``(DealID, period, file_name)``.  Verdicts: ``inactive``, ``no tape``, ``ambiguous``, ``ok``.
    """
    like = F.replace(F.replace(F.col("tape_pattern"), F.lit("_"), F.lit("\\_")), F.lit("*"), F.lit("%"))
    joined = registry.withColumn("like", like).join(files, "DealID", "left")
    per_period = joined.groupBy("DealID", "status", "period").agg(
        F.count_if(F.expr("file_name LIKE like")).alias("matches")
    )
    verdict = (
        F.when(F.col("status") != "active", "inactive")
        .when(F.col("matches") == 0, "no tape")
        .when(F.col("matches") > 1, "ambiguous")
        .otherwise("ok")
    )
    return per_period.withColumn("verdict", verdict)


def find_deal(registry: DataFrame, deal_id: str) -> DataFrame:
    """Registry row of a deal id in any case; no row when unknown."""
    return registry.filter(F.upper("DealID") == deal_id.upper())


def resolve_tape(registry: DataFrame, folder: str, deal_id: str, period: str = "*", name: str | None = None) -> str:
    """Path of the one tape file of a registered deal (its row is a setting, so it is read here).

    ``name`` chooses among the files that match: a part of the file name, in any case.  Refuses an unknown or inactive
    deal, and a choice of no file or of more than one.
    """
    row = find_deal(registry, deal_id).first()
    if row is None:
        raise ValueError(f"unknown deal {deal_id}")
    if row["status"] != "active":
        raise ValueError(f"deal {row['DealID']} is {row['status']}")
    spark = registry.sparkSession
    glob = row["tape_pattern"].replace("{period}", period)
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path")
        if name:
            glob = f"{glob} with {name}"
            files = files.filter(F.contains(F.lower(F.element_at(F.split("path", "/"), -1)), F.lit(name.lower())))
        found = files.limit(3).collect()
    except AnalysisException:
        found = []
    if not found:
        raise ValueError(f"no tape for {row['DealID']} matches {glob}")
    if len(found) > 1:
        raise ValueError(f"more than one tape for {row['DealID']} matches {glob}: {sorted(r['path'] for r in found)}")
    return found[0]["path"]


def read_deal_tape(registry: DataFrame, folder: str, deal_id: str, period: str = "*", name: str | None = None) -> DataFrame:
    """Rows of the tape that the registry resolves to."""
    return read_tape(registry.sparkSession, resolve_tape(registry, folder, deal_id, period, name))


# ------------------------------------------------------------------ writers


def with_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """The tape with a NULL column for every field that no file delivers."""
    return df.withColumns({f: F.lit(None).cast("string") for f in sorted(set(fields) - set(df.columns))})


def write_staging(df: DataFrame, path: str, append: bool = False) -> None:
    """Staged rows partitioned by deal; without ``append`` only the delivered deals are replaced."""
    writer = df.write.partitionBy("DealID").option("partitionOverwriteMode", "dynamic")
    writer.mode("append" if append else "overwrite").parquet(path)


def read_staging(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """The staging table; the text schema is given, so appended tapes cannot drift."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, "DealID"]])
    return spark.read.schema(schema).parquet(path)


def write_tranches(df: DataFrame, path: str) -> None:
    """Replace the tranche table: its own columns with their types, sorted by deal and from the most junior up."""
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANCHE_SCHEMA])
    write_ordered(typed, path, ["DealID", F.col("Attachment").desc_nulls_last(), "TrancheID", "CutoffDate"], "csv")


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    df.write.mode("overwrite").option("header", True).csv(path, compression=compression)
