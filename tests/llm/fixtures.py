"""Small documents with every awkward case, shared by the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

DOCS = "/root/testdata/sf0.001/documents.parquet"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet consectetur " * 4000

AWKWARD = [
    (9001, None, "en", "s", None),
    (9002, "", None, "s", 0),
    (9003, " \t\n ", "en", None, 4),
    (9004, "word", "en", "s", 4),
    (9005, "the same line of seven plain words\nand another line of some words", "en", "s", 66),
    (9006, "the same line of seven plain words\nand another line of some words", "en", "s", 66),
    (9007, "head\nthe same line of seven plain words\nand another line of some words\n", "en", "s", 72),
    (9008, LONG, "en", "s", len(LONG)),
    (9008, "a second text of the same id, the id is repeated", "en", "s", 48),
    (9009, "row twice", "en", "s", 9),
    (9009, "row twice", "en", "s", 9),
    (None, "no id at all here", "en", "s", 17),
    (9010, "Ünïcödé 日本語のテキスト \U0001f600 ΣΑΣ <|endoftext|> \x00\x1c x", "de", "s", 40),
]


def documents(spark, awkward=True, real=True):
    """The smallest documents table and the awkward rows, with extra columns whose names the operators use."""
    rows = spark.createDataFrame(AWKWARD, SCHEMA)
    if not real:
        found = rows
    elif not awkward:
        return spark.read.parquet(DOCS)
    else:
        found = spark.read.parquet(DOCS).unionByName(rows)
    clash = {c: F.lit("kept") for c in ("score", "spans", "items", "n_words", "row_key", "fp", "owners", "repeats", "n_lines")}
    return found.withColumns(clash)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
