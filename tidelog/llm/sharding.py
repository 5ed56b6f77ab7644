"""Sharding by a Feistel permutation with cycle walking over global row numbers (native SQL functions only).

Rows get gapless global numbers in the order of (id, text checksum, size, text hash): a range
partitioning sorts slim rows, and offsets by partition turn positions within a partition into
global numbers. The seeded permutation p of 0..n-1 is a Feistel network over Z_a x Z_a with
a = ceil(sqrt(n)); a value of n or more is permuted again (cycle walking; at most 2a-1 of the a*a
values lie outside, so walks are short). Shard = p mod shards, slot = p div shards: counts differ
by one at most, slots have no gaps, and both can be computed from the row number alone, as can
the row number from (shard, slot) (`row_of`).

The law is `rows`. Equal texts (groups) are spread like any other rows: keeping them together
and counts at most one apart exclude each other when a group holds a third of the rows.

Defined cases: a null text has no bytes (size 8, checksum 0); null and repeated ids sort and get
slots of their own, wholly equal rows being interchangeable; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import materialise

ROUNDS = 6
MOST_WALKS = 64


def _mix(value: Column, turn: int, seed: int, a: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(turn).cast("bigint"), F.lit(seed).cast("bigint")), F.lit(a).cast("bigint"))


def _network(x: Column, a: int, seed: int) -> Column:
    left, right = (x - x % a) / a, x % a
    left = left.cast("bigint")
    for turn in range(ROUNDS):
        left, right = right, (left + _mix(right, turn, seed, a)) % a
    return left * a + right


def permuted(x: Column, n: int, seed: int) -> Column:
    """The image of x (0 <= x < n) under the seeded permutation of 0..n-1."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    walks = min(a * a - n + 1, MOST_WALKS)
    once = _network(x, a, seed)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(walks)), once, lambda y, _: F.when(y < n, y).otherwise(_network(y, a, seed)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("a walk of the permutation did not end")).cast("bigint"))


def _mix_value(value: int, turn: int, seed: int, a: int) -> int:
    import xxhash

    h = 42
    for v in (value, turn, seed):
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return (h - (1 << 64) if h >> 63 else h) % a


def image_of(x: int, n: int, seed: int) -> int:
    """permuted() for one number, without Spark."""
    a = math.isqrt(max(n - 1, 0)) + 1
    while True:
        left, right = divmod(x, a)
        for turn in range(ROUNDS):
            left, right = right, (left + _mix_value(right, turn, seed, a)) % a
        x = left * a + right
        if x < n:
            return x


def row_of(shard: int, slot: int, n: int, n_shards: int, seed: int) -> int:
    """The global row number at a slot of a shard: the permutation run backwards."""
    a, x = math.isqrt(max(n - 1, 0)) + 1, slot * n_shards + shard
    while True:
        left, right = divmod(x, a)
        for turn in reversed(range(ROUNDS)):
            left, right = (right - _mix_value(left, turn, seed, a)) % a, left
        x = left * a + right
        if x < n:
            return x


def numbered(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """df with gapless row_no in the given order, and its number of rows. df is written once to the shared folder."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(placed, name)
    counts = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n")).collect()  # a row for each partition
    n, offsets = 0, {}
    for r in sorted(counts, key=lambda r: r["_part"]):
        offsets[r["_part"]] = n - (r["_part"] << 33)
        n += r["_n"]
    if not n:
        return placed.withColumn("row_no", F.lit(0).cast("bigint")).drop("_at"), 0
    table = placed.sparkSession.createDataFrame(list(offsets.items()), "_part bigint, _offset bigint")
    joined = placed.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(table), "_part")
    return joined.withColumn("row_no", F.col("_at") + F.col("_offset")).drop("_at", "_part", "_offset"), n


def shard(df: DataFrame, id_col: str, text: str, n_shards: int = 24, seed: int = 20240229) -> DataFrame:
    body = F.col(f"`{text}`").cast("string")
    slim = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("_tie"),
    )
    rows, n = numbered(slim, ["doc_id", "text_crc32", "size", "_tie"], "shard-rows")
    image = permuted(F.col("row_no"), n, seed) if n else F.lit(0).cast("bigint")
    return rows.withColumn("_p", image).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("_p") % n_shards).cast("int").alias("shard"),
        F.floor((F.col("_p") - F.col("_p") % n_shards) / n_shards).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_no",
    )
