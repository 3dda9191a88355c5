"""Corpus clean-up: stages over the documents table, each written as Parquet before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortar.llm import bpe, decontaminate, line_dedup, quality, scratch, simhash
from mortar.llm.queries import VOCABULARY


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs)


def without_copied_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that an earlier one has; those that are nothing else go."""
    return line_dedup.without_copied_lines(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints are linked (four-word shingles, four bits) the one with the least id."""
    return simhash.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and ids of every document that is left, with digests of the ids and of their decoding."""
    coded = bpe.round_trip(docs.select("doc_id", "text"), VOCABULARY)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", *bpe.digest_columns())


STAGES = [
    ("quality classifier", good),
    ("line dedup", without_copied_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("BPE encoding and decoding", tokenised),
]

#: Stages of this pipeline have no SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
