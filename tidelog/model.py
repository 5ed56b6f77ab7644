"""The data model: op codes, log positions, the log's schema, and its derivation from the local tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Op codes of events, sub-ops of "$", message kinds of the log.
READ, CREATE, UPDATE, DELETE, TRUNCATE, MESSAGE, TIMESERIES = "r", "c", "u", "d", "t", "m", "$"
COMPRESSION, DECOMPRESSION = "c", "d"
KINDS = {"R": "relation", "B": "begin", "C": "commit", "I": "insert", "U": "update", "D": "delete", "T": "truncate", "Y": "type", "O": "origin", "M": "message"}

WAL = T.StructType(
    [T.StructField("lsn", T.LongType()), T.StructField("server_wal_end", T.LongType()), T.StructField("server_time", T.TimestampType()), T.StructField("xid", T.LongType()), T.StructField("seq", T.IntegerType()), T.StructField("msg_type", T.StringType()), T.StructField("relation_id", T.LongType()), T.StructField("namespace", T.StringType()), T.StructField("relation", T.StringType()), T.StructField("relation_ids", T.ArrayType(T.LongType())), T.StructField("old", T.MapType(T.StringType(), T.StringType())), T.StructField("new", T.MapType(T.StringType(), T.StringType())), T.StructField("flags", T.IntegerType()), T.StructField("prefix", T.StringType()), T.StructField("content", T.BinaryType()), T.StructField("txn_end_lsn", T.LongType())]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lsn_text(lsn: Column) -> Column:
    """A log position as text: upper and lower half in upper-case hex."""
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(0xFFFFFFFF)))


def lsn_number(text: Column) -> Column:
    half = lambda i: F.conv(F.split_part(text, F.lit("/"), F.lit(i)), 16, 10).cast("bigint")
    return F.shiftleft(half(1), 32).bitwiseOR(half(2))


def wal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decoded log of the events table: ten rows a transaction, users as tables' keys, days as partitions."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") * 16 + 16).alias("lsn"), (F.col("event_id") * 16 + 24).alias("server_wal_end"), F.floor(F.col("event_id") / 10).alias("xid"),
        F.when(kind.isin("signup", "purchase"), CREATE).when(kind == "view", READ).when(kind == "click", UPDATE).otherwise(DELETE).alias("op"),
        F.col("user_id").alias("key"), F.date_trunc("day", "ts").alias("chunk_day"), "ts", "value", "props", "event_type",
        F.when(kind == "purchase", 1).when(kind == "click", 0).alias("status"), F.when(F.col("event_id") % 10 == 3, "start").when(F.col("event_id") % 10 == 6, "end").alias("marker"),
    )


def with_before(log: DataFrame) -> DataFrame:
    """The previous value of each key, as before-image."""
    return log.withColumn("before_value", F.lag("value").over(Window.partitionBy("key").orderBy("event_id")))


def source(lsn: Column, ts_ms: Column, snapshot: Column, db: Column, schema: Column, name: Column, xid: Column) -> Column:
    """The source block of an event."""
    return F.struct(
        F.lit("0.1.0").alias("version"), F.lit("tidelog").alias("connector"), db.alias("name"), ts_ms.alias("ts_ms"), snapshot.alias("snapshot"), db.alias("db"),
        schema.alias("schema"), name.alias("table"), xid.alias("txId"), lsn_text(lsn).alias("lsn"),
    )


def payload(op: Column, before: Column, after: Column, src: Column, ts_ms: Column, tsdb_op: Column | None = None, message: Column | None = None) -> Column:
    """An event's payload. Which images an op has: r, c after; u both; d before; t, m, $ none."""
    none = F.lit(None)
    return F.struct(
        op.alias("op"), (none if tsdb_op is None else tsdb_op).cast("string").alias("tsdb_op"), F.when(op.isin(UPDATE, DELETE), before).alias("before"),
        F.when(op.isin(READ, CREATE, UPDATE), after).alias("after"), (none.cast("string") if message is None else message).alias("message"), src.alias("source"), ts_ms.alias("ts_ms"),
    )


def topic(prefix: str, schema: Column, name: Column) -> Column:
    return F.concat_ws(".", F.lit(prefix), schema, name)


def message_topic(prefix: str) -> Column:
    return F.lit(f"{prefix}.message")


def sanitised(name: Column) -> tuple[Column, Column]:
    """A topic name with allowed characters only, and whether it differs."""
    clean = F.regexp_replace(name, "[^._A-Za-z0-9-]", "_")
    return clean, clean != name
