"""Queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession

from mortar.llm import bpe, chunks, decontaminate, iblt, langid, line_dedup, prefix_trie, quality, records, secret_scan
from mortar.llm import simhash, warc, whitening

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"), again=True)


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.compare_versions(table(spark, sf_dir, "documents"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.report(table(spark, sf_dir, "documents"), chunks.FINE)


@query
def op9_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


@query
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op4_decontamination"] = f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, list_slice(w, s, s + 9) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc_words, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, d.n, item FROM doc_windows d JOIN windows USING (win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hits)) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

# CRC-32 bit by bit: a byte is xored in, then eight shifts (the -1 entries)
_CRC = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
    lambda ch: [ascii(ch)::BIGINT] || list_transform(range(8), lambda i: -1::BIGINT))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""

SQL["op12_prefix_trie"] = f"""
WITH plain AS (
  SELECT conv_id AS c, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sig,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT c, sig, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sig) AS p FROM plain),
convs AS (
  SELECT c, c - c % 20 AS f, CASE WHEN c % 20 = 0 THEN 0 ELSE {_CRC} % 4 END AS h FROM (SELECT DISTINCT c FROM plain)),
rebuilt AS (
  SELECT convs.c, 0 AS part, p, sig, w FROM convs JOIN numbered n ON n.c = convs.f AND n.p <= convs.h
  UNION ALL SELECT convs.c, 1, p, sig, w FROM convs JOIN numbered n ON n.c = convs.c AND n.p > convs.h),
turns AS (SELECT c, sig, w, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d FROM rebuilt),
members AS (
  SELECT c, d, w, string_agg(sig, ',') OVER (PARTITION BY c ORDER BY d) AS k FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM convs),
lengths AS (SELECT c, max(d) AS len FROM members GROUP BY c),
nodes AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = len), '') AS ends
  FROM members JOIN lengths USING (c) GROUP BY k, d),
parents AS (
  SELECT n.k, m.k AS parent, p.conv_id AS parent_conv_id
  FROM nodes n JOIN members m ON m.c = n.conv_id AND m.d = n.d - 1 JOIN nodes p ON p.k = m.k),
children AS (SELECT parent AS k, count(*) AS n_children FROM parents GROUP BY parent),
figures AS (
  SELECT k, d, n.conv_id, n_convs, ends, coalesce(n_children, 0) AS n_children, (n_convs - 1) * w AS saved
  FROM nodes n LEFT JOIN children USING (k)),
subtrees AS (
  SELECT a.k, count(*) FILTER (WHERE x.n_children = 0) AS n_leaves, sum(x.saved) AS saved_tokens
  FROM figures x JOIN members a ON a.c = x.conv_id AND a.d <= x.d GROUP BY a.k)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
  sha256(ends) AS ends_sha256
FROM figures LEFT JOIN parents USING (k) JOIN subtrees USING (k)"""

# base 32 of a hex digest: five hex digits are four letters
SQL["op2_warc"] = """
WITH payloads AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS first FROM payloads GROUP BY hex),
marked AS (SELECT page_id, url, n, hex, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM payloads JOIN firsts USING (hex))
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, 5 * (j // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, url AS target
FROM marked"""
