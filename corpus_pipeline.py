"""The corpus pipeline: language ID, exact dedup, n-gram Jaccard join, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents. A stage's table is
removed from the shared folder when the next one is written.

Defined cases, from the stages' operators: a null, empty or letterless text goes in language ID, as do
all rows where no row is labelled; of equal texts the row of smallest id stays, rows without id after
all others; one row of each class of near copies stays, rows of equal ids are told apart by their
place; a null source is a source of the mix; texts of any length pass whole; an empty table gives an
empty table of the last stage's columns; columns besides those of documents are passed on to the mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import bpe, exact_dedup, langid, mixing, ngram_join
from tidelog.llm.common import discard, scratch, table
from tidelog.llm.words import load_pieces

LEAST_SCORE = 0.5  #: a document whose best language has a smaller share goes


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter, or of no clear language, go."""
    pieces = load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    found = langid.identify(docs, "doc_id", "text", "lang", pieces)
    return found.filter((found["lang_pred"] != "und") & (found["score"] >= LEAST_SCORE)).select(*docs.columns)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return exact_dedup.keep_rows(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngram_join.keep_rows(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last one of a quota whole too."""
    return mixing.mixed_rows(docs, whole_documents=True).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids of each document."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs.select("doc_id", "lang", "source", "text"), "text", path, public_tokenizers.PATTERN, with_ids=True, cached=200_000)


STAGES = [("language_id", language_id), ("exact_dedup", dedup), ("near_dedup", near_dedup), ("mixing", mix), ("bpe", tokenise)]

#: Language ID and the n-gram join have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if last:
                discard(spark, last)
            last = path
    return docs
