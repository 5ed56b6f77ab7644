"""Operators on the log: restart, transactions, decompression, chunks, tombstones, overlap, statistics.

All are partitioned by transaction, key or chunk, so that a log spreads over a cluster; order within
a partition is (lsn, seq).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def restart_filter(log: DataFrame, restart_lsn: int) -> DataFrame:
    """Rows from the restart position on, and all relation messages."""
    return log.filter((F.col("msg_type") == "R") | (F.col("lsn") >= restart_lsn))


def restart_point(confirmed: Column, offset: Column, server: Column) -> Column:
    """The larger of the slot's and our own position, else the server's."""
    return F.coalesce(F.nullif(F.greatest(F.coalesce(confirmed, F.lit(0)), F.coalesce(offset, F.lit(0))), F.lit(0)), server)


def check_slot(plugin: str, slot_type: str) -> None:
    if plugin != "pgoutput":
        raise ValueError(f"illegal plugin name: {plugin}")
    if slot_type != "logical":
        raise ValueError(f"illegal slot type: {slot_type}")


def carried(column: str, partition: str, order: str) -> Column:
    """The last value that was not null, this row's included."""
    return F.last(column, ignorenulls=True).over(Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def committed_only(log: DataFrame, commits: DataFrame) -> DataFrame:
    """Rows of transactions whose commit has been seen; the others stay in the window."""
    return log.join(commits.select("xid").distinct(), "xid", "left_semi")


def transactions(log: DataFrame) -> DataFrame:
    return log.groupBy("xid").agg(F.count("*").alias("n_rows"), F.min("lsn").alias("first_lsn"), F.max("lsn").alias("last_lsn"))


def overflowed(log: DataFrame, most: int) -> DataFrame:
    """Whether a row is beyond the window's size in its transaction, and so passes unbuffered."""
    return log.withColumn("overflow", F.row_number().over(Window.partitionBy("xid").orderBy("lsn")) > most)


def without_marked_decompression(log: DataFrame, inserts: Column) -> DataFrame:
    """Inserts between a transaction's start and end marker are only a chunk being decompressed."""
    is_open = F.coalesce(F.last("marker", ignorenulls=True).over(Window.partitionBy("xid").orderBy("lsn").rowsBetween(Window.unboundedPreceding, 0)) == "start", F.lit(False))
    return log.withColumn("_open", is_open).filter(~(F.col("_open") & inserts)).drop("_open")


def without_unmarked_decompression(log: DataFrame, inserts: Column, decompresses: Column) -> DataFrame:
    """Without markers: inserts after a status change that decompresses, in the same transaction."""
    seen = F.coalesce(F.max(decompresses.cast("int")).over(Window.partitionBy("xid").orderBy("lsn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    return log.withColumn("_seen", seen).filter(~(F.col("_seen") & inserts)).drop("_seen")


def compression_events(log: DataFrame, chunk: str, status: str, order: str) -> DataFrame:
    """Chunk rows whose status goes from 0 to another (tsdb_op c) or back to 0 (d)."""
    before = F.lag(status).over(Window.partitionBy(chunk).orderBy(order))
    op = F.when((F.col("_b") == 0) & (F.col(status) != 0), "c").when((F.col("_b") != 0) & (F.col(status) == 0), "d")
    return log.filter(F.col(status).isNotNull()).withColumn("_b", before).withColumn("tsdb_op", op).filter("tsdb_op IS NOT NULL").drop("_b")


def without_snapshot_overlap(log: DataFrame, snapshots: DataFrame, chunk: str) -> DataFrame:
    """Drops a chunk's rows that its snapshot (chunk, snapshot_lsn) has already seen."""
    return log.join(snapshots, chunk, "left").filter(F.col("snapshot_lsn").isNull() | (F.col("server_wal_end") >= F.col("snapshot_lsn")))


def with_tombstones(events: DataFrame, enabled: bool = True) -> DataFrame:
    """A second event after each delete, its after-image explicitly null."""
    if not enabled:
        return events.withColumn("tombstone", F.lit(False))
    return events.withColumn("tombstone", F.explode(F.when(F.col("op") == "d", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))


def truncated_tables(truncates: DataFrame, relations: DataFrame) -> DataFrame:
    """Each truncate's parent tables once, in the order of first mention: (lsn, table, position)."""
    each = truncates.select("lsn", F.posexplode("relation_ids").alias("pos", "relation_id"))
    return each.join(relations, "relation_id").groupBy("lsn", "canonical").agg(F.min("pos").alias("position"))


def switched(events: DataFrame, enabled: dict[str, bool]) -> DataFrame:
    """Events whose kind is switched on; a kind not named is on."""
    off = [k for k, on in enabled.items() if not on]
    return events.filter(~F.col("op").isin(off)) if off else events


def statistics(log: DataFrame, kind: str) -> DataFrame:
    n = lambda *ks: F.count_if(F.col(kind).isin(*ks))
    return log.agg(F.count("*").alias("total"), n("c").alias("inserts"), n("u").alias("updates"), n("d").alias("deletes"), n("r").alias("reads"), F.countDistinct("xid").alias("transactions"))


def processed_positions(log: DataFrame, batch: Column, span: int = 4096) -> DataFrame:
    """The position to confirm after each batch (a number): never smaller than before. Running maxima within spans of batches, then over the spans."""
    per = log.groupBy(batch.alias("batch")).agg(F.max("lsn").alias("m")).withColumn("span", F.floor(F.col("batch") / span))
    before = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = per.groupBy("span").agg(F.max("m").alias("m")).select("span", F.max("m").over(before).alias("earlier"))  # a row for each span
    own = F.max("m").over(Window.partitionBy("span").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0))
    return per.withColumn("own", own).join(spans, "span").select("batch", F.greatest("own", "earlier").alias("processed_lsn"))


def decode(log: DataFrame, types: dict[str, str], side: str = "new") -> DataFrame:
    """The typed columns of a table from its tuple map, and which of them the tuple had."""
    m = F.col(side)
    return log.select("*", *[m[c].cast(t).alias(c) for c, t in types.items()], F.filter(F.array(*[F.lit(c) for c in types]), lambda c: F.map_contains_key(m, c)).alias("present"))
