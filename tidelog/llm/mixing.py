"""Mixing sources to target weights by Sainte-Lague apportionment (native SQL functions only).

Sizes are words. Sources in code point order (null last) weigh 3, 1, 2, repeating, and share
150 % of all words; a target stops at twice its source's size, and the excess is shared again by
weight (water filling, in closed form over the sources sorted by size / weight).

The mix is made of blocks of equal length. The documents of a source, in seeded order, are its
blocks one after another. Shard by shard, the blocks of the mix go to the sources with the highest
quotients target / (2 * blocks so far + 1): integer quotas for each source and shard. A source
then gives its blocks in turn, from the first again after the last, two rounds at most; a document
is taken as far as it lies in the blocks that are given.

Running positions are two-level prefix sums over (source, bucket of the seeded hash), so a hot
source is spread over many tasks.

Defined cases: a null text has size 0 and nothing is taken; a null source is a source; rows that
repeat an id follow each other in a fixed order; a row without id takes its place by its text;
without any words all targets are 0; an empty table gives an empty table; texts of any length are
counted whole; other columns, whatever their names, are passed on by `mixed_rows` only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, materialise
from tidelog.llm.exact_dedup import normalised

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SHARDS = 8
SEED = "mix-1"


def n_words(text: Column) -> Column:
    """Number of words: spaces between words, plus one."""
    flat = F.trim(normalised(text))
    return F.when(flat == "", F.lit(0)).otherwise(F.octet_length(flat) - F.octet_length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size -> also weight, target and rank. One row for each source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    t = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", F.get(weights, (F.col("rank") - 1) % len(WEIGHTS)))
    t = t.withColumn("_ratio", F.lit(float(MOST)) * F.col("source_size") / F.col("weight"))
    below = Window.orderBy("_ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    t = t.withColumns({"_cap": F.coalesce(F.sum(F.lit(MOST) * F.col("source_size")).over(below), F.lit(0)), "_w": F.coalesce(F.sum("weight").over(below), F.lit(0)), "_all": F.sum("source_size").over(total), "_all_w": F.sum("weight").over(total)})
    t = t.withColumn("_level", (F.lit(SHARE) * F.col("_all") - F.col("_cap")) / (F.col("_all_w") - F.col("_w")))
    t = t.withColumn("_water", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.struct(-F.row_number().over(Window.orderBy("_ratio", "rank")), "_level"))).over(total)["_level"])
    return t.select("source", "source_size", "rank", "weight", F.least(F.lit(float(MOST)) * F.col("source_size"), F.col("_water") * F.col("weight")).alias("target"))


def quotas(t: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Blocks of each source in each shard: adds shard, quota and block (words of a block). Highest quotients, exactly."""
    total = Window.partitionBy()
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(total)
    t = t.withColumns({"block": F.greatest(F.lit(1), F.least(F.lit(256), F.coalesce(F.floor(smallest / 64), F.lit(1)))).cast("bigint"), "_sum": F.sum("target").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    t = t.withColumn("_blocks", F.floor(F.col("_sum") / F.col("block") + 0.5))
    t = t.select("*", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("_house"))
    t = t.withColumn("_seats", F.floor(F.col("_blocks") * F.col("_house") / shards).cast("bigint"))
    t = t.withColumn("_base", F.when(F.col("_sum") > 0, F.floor(F.col("target") * F.col("_seats") / F.col("_sum") + 0.5)).otherwise(F.lit(0)).cast("bigint"))
    house = Window.partitionBy("_house")
    t = t.withColumn("_off", F.abs(F.sum("_base").over(house) - F.col("_seats")) + 1).withColumn("_sure", F.greatest(F.lit(0), F.col("_base") - F.col("_off")))
    t = t.withColumn("_open", F.col("_seats") - F.sum("_sure").over(house))
    seats = t.filter("target > 0").select("*", F.explode(F.sequence(F.col("_sure"), F.col("_base") + F.col("_off"))).alias("_j"))
    order = house.orderBy(F.desc(F.col("target") / (2 * F.col("_j") + 1)), "rank")
    won = seats.withColumn("_won", (F.row_number().over(order) <= F.col("_open")).cast("bigint")).groupBy("rank", "_house").agg((F.first("_sure") + F.sum("_won")).alias("_all"))
    t = t.join(won, ["rank", "_house"], "left").withColumn("_all", F.coalesce("_all", F.lit(0)))
    return t.select("source", "source_size", "rank", "weight", "target", "block", (F.col("_house") - 1).alias("shard"), (F.col("_all") - F.coalesce(F.lag("_all").over(Window.partitionBy("rank").orderBy("_house")), F.lit(0))).alias("quota"))


def plan(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", *, carry: bool = False) -> DataFrame:
    """A row for each row of df: doc_id, size, source_size, target, taken, _rounds and _upto (words of a last, partial round), and _row if carry."""
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), n_words(F.col(f"`{text}`")).alias("size"), F.xxhash64(F.col(f"`{text}`")).alias("_tie"), *([F.struct("*").alias("_row")] if carry else []))
    if not carry:
        rows = materialise(rows, "mix-sizes")
    n = df.count()
    buckets = max(256, math.isqrt(n))  # buckets of a source, and rows of a bucket, grow alike
    rows = rows.withColumn("_h", F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.col("_tie").cast("string")))).cast("binary")))
    rows = rows.withColumn("_b", F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") * buckets / float(1 << 32)).cast("int"))
    sums = materialise(rows.groupBy("source", "_b").agg(F.sum("size").alias("_words")), "mix-sums")
    shares = quotas(targets(sums.groupBy("source").agg(F.sum("_words").alias("source_size"))))
    given = shares.groupBy("source", "source_size", "target", "block").agg(F.sum("quota").alias("_quota"))
    given = given.withColumn("_n", F.ceil(F.col("source_size") / F.col("block"))).withColumn("_quota", F.least("_quota", MOST * F.col("_n")))
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("_s"), F.col("_b").alias("_sb"), F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_start"))
    starts = materialise(starts.join(given.withColumnRenamed("source", "_s2"), F.col("_s").eqNullSafe(F.col("_s2"))), "mix-starts")
    own = Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_within", F.coalesce(F.sum("size").over(own), F.lit(0)))
    rows = rows.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_sb")))
    at = F.col("_start") + F.col("_within")
    rounds = F.when(F.col("_n") > 0, F.floor(F.col("_quota") / F.col("_n"))).otherwise(F.lit(0)).cast("bigint")
    rest = F.when(F.col("_n") > 0, (F.col("_quota") % F.col("_n")) * F.col("block")).otherwise(F.lit(0))
    rows = rows.withColumns({"_rounds": rounds, "_upto": F.greatest(F.lit(0), F.least(F.col("size"), rest - at)).cast("bigint")})
    return rows.select("doc_id", "size", "source_size", "target", (F.col("_rounds") * F.col("size") + F.col("_upto")).cast("bigint").alias("taken"), "_rounds", "_upto", *(["_row"] if carry else []))


def mixed_rows(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", *, whole_documents: bool = False) -> DataFrame:
    """The mix itself: a row of df for each time it is taken. At the end of a quota a document gives its first words only, or, with whole_documents, all of them."""
    rows = plan(df, id_col, source, text, carry=True).filter("size > 0")
    times = F.concat(F.array_repeat(F.col("size"), F.col("_rounds").cast("int")), F.when(F.col("_upto") > 0, F.array("size" if whole_documents else "_upto")).otherwise(F.array().cast("array<bigint>")))
    rows = rows.select("_row", "size", F.explode(times).alias("_words"))
    whole = F.col(f"_row.`{text}`")
    cut = F.array_join(F.slice(F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), F.lit(1), F.col("_words").cast("int")), " ")
    body = F.when(F.col("_words") == F.col("size"), whole).otherwise(cut)
    return rows.select(*[body.alias(c) if c == text else F.col(f"_row.`{c}`") for c in df.columns])


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5('mix-1|' || doc_id::VARCHAR) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM r),
q AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio FROM w),
l AS (SELECT *, row_number() OVER (ORDER BY ratio, rank) AS pos,
             (1.5::DOUBLE * (SELECT sum(source_size) FROM w)::DOUBLE - coalesce(sum(2 * source_size) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
             / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level FROM q),
water AS (SELECT level FROM l WHERE level <= ratio ORDER BY pos LIMIT 1),
t AS (SELECT source, source_size, rank, least(2.0::DOUBLE * source_size, (SELECT level FROM water) * weight) AS target FROM l),
b AS (SELECT greatest(1, least(256, coalesce(floor(min(target) FILTER (target > 0) / 64), 1)))::BIGINT AS block, sum(target) AS total FROM t),
n AS (SELECT block, floor(total / block + 0.5)::BIGINT AS blocks FROM b),
c AS (SELECT source, rank, target, unnest(generate_series(0, 2 * (source_size // (SELECT block FROM n)) + 8)) AS j FROM t WHERE target > 0),
o AS (SELECT source, rank, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, rank) AS seat FROM c),
g AS (SELECT rank, count(*) AS quota FROM o WHERE seat <= (SELECT blocks FROM n) GROUP BY rank),
f AS (SELECT t.*, block, CASE WHEN source_size > 0 THEN (source_size + block - 1) // block ELSE 0 END AS nb, coalesce(quota, 0) AS quota0 FROM t LEFT JOIN g USING (rank), n),
e AS (SELECT *, least(quota0, 2 * nb) AS quota FROM f),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos0 FROM d)
SELECT doc_id, size, source_size, target,
       (CASE WHEN nb > 0 THEN (quota // nb) * size + greatest(0, least(size, (quota % nb) * block - pos0)) ELSE 0 END)::BIGINT AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source
"""
