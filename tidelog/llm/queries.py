"""Queries over the tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import ann, bpe, exact_dedup, html_extract, langid, mixing, ngram_join, sharding, token_counts, warc
from tidelog.llm.common import table
from tidelog.llm.words import load_pieces

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, "text", public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES["op1_bpe"] = op1_bpe


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), "doc_id", "text", 24).drop("row_no")


QUERIES["op2_sharding"] = op2_sharding


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op5_exact_dedup"] = op5_exact_dedup
ORACLE_SQL["op5_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("_rounds", "_upto")


QUERIES["op6_mixing"] = op6_mixing
ORACLE_SQL["op6_mixing"] = mixing.ORACLE_SQL


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", pieces)


QUERIES["op4_token_counts"] = op4_token_counts


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id", "text", "lang", pieces, keep=["doc_id"])


QUERIES["op10_langid"] = op10_langid


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, "vec_id", "embedding", F.col("vec_id") % 20 == 0)


QUERIES["op8_ann"] = op8_ann


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


QUERIES["op9_warc"] = op9_warc
ORACLE_SQL["op9_warc"] = warc.ORACLE_SQL


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op7_ngram_join"] = op7_ngram_join


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES["op3_html"] = op3_html
