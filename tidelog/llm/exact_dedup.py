"""Exact dedup by a content sort (native SQL functions only).

Texts are normalised (each run of space and U+0009 to U+000D becomes one space) and
range-partitioned by sampled splitters over (first characters, SHA-256, salt of the row), so that
splitters are short whatever the texts; the external sort of each partition is by the whole normalised
text, which places equal texts next to each other, and a window compares neighbouring rows by it. The
salt cuts a text with many copies into runs that may lie in several partitions, so no task gets a
whole hot group; the heads of the runs, at most SALTS a text, are united by digest and give the
smallest id and the group's size.

Defined cases: a null text equals an empty one; null ids sort last and stay only where a group
has no other; of rows that repeat both id and text exactly one stays; an empty table gives an
empty table; other columns are carried by `keep_rows`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import materialise

SALTS = 4096  #: only those that occur make runs
PREFIX = 24


def normalised(text: Column) -> Column:
    """Runs of white space as one space. Single spaces, which need no change, do not match."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _runs(df: DataFrame, id_col: str, text: str, carry: bool) -> DataFrame:
    """Rows with the run they stand in: _id, _sha, _salt, _rn, _run_min, _run_size, and the columns of df if carry (as _row)."""
    ident = F.col(f"`{id_col}`")
    norm = normalised(F.col(f"`{text}`"))
    cols = [ident.alias("_id"), *([F.struct("*").alias("_row")] if carry else []), norm.alias("_norm")]
    keyed = df.select(*cols).withColumns({"_sha": F.sha2(F.col("_norm").cast("binary"), 256), "_pre": F.substring("_norm", 1, PREFIX), "_salt": F.pmod(F.xxhash64("_id", F.spark_partition_id()), F.lit(SALTS)).cast("int")})
    if carry:  # the text is in the row already; it is normalised again behind the exchange
        keyed = keyed.drop("_norm")
    placed = keyed.repartitionByRange("_pre", "_sha", "_salt")
    if carry:
        placed = placed.withColumn("_norm", normalised(F.col(f"_row.`{text}`")))
    same = Window.partitionBy("_pre", "_norm", "_sha", "_salt")
    found = placed.withColumns({"_rn": F.row_number().over(same.orderBy(F.col("_id").asc_nulls_last())), "_run_min": F.min("_id").over(same), "_run_size": F.count("*").over(same)})
    return materialise(found.drop("_norm", "_pre"), "dedup-runs")


def _joined(runs: DataFrame) -> DataFrame:
    heads = runs.filter("_rn = 1").select("_sha", "_salt", "_run_min", "_run_size")
    text = Window.partitionBy("_sha")
    heads = heads.select(
        "_sha", "_salt", F.min("_run_min").over(text).alias("keep_id"), F.sum("_run_size").over(text).alias("group_size"),
        (F.row_number().over(text.orderBy(F.col("_run_min").asc_nulls_last(), "_salt")) == 1).alias("_first"),
    )
    return runs.join(heads, ["_sha", "_salt"]).withColumn("kept", F.col("_first") & (F.col("_rn") == 1))


def mark(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of df: doc_id, keep_id, group_size, kept, text_sha256."""
    return _joined(_runs(df, id_col, text, False)).select(F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("_sha").alias("text_sha256"))


def keep_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df that stay, with all their columns."""
    return _joined(_runs(df, id_col, text, True)).filter("kept").select("_row.*")
