"""Registered queries of the change-log operators and, for each, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog import sinks
from tidelog.functions import convert as C
from tidelog.model import lsn_text, message_topic, payload, sanitised, source, table, topic, wal, with_before
from tidelog.operators import catalog, exprfilter, replication, snapshot
from tidelog.operators.tablefilter import TableFilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

WAL = """WITH wal AS (SELECT event_id, 16*(event_id+1) AS lsn, 16*(event_id+1)+8 AS server_wal_end, event_id//10 AS xid, event_type, user_id AS key, date_trunc('day', ts) AS chunk_day, ts, value, props,
  CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'c' WHEN 'view' THEN 'r' WHEN 'click' THEN 'u' ELSE 'd' END AS op,
  lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS before_value,
  CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 0 END AS status,
  CASE event_id % 10 WHEN 3 THEN 'start' WHEN 6 THEN 'end' END AS marker FROM events)
"""
LSN = "upper(to_hex(lsn >> 32)) || '/' || upper(to_hex(lsn & 4294967295))"
DAY = "strftime(chunk_day, '%Y-%m-%d')"


def day(c="chunk_day"):
    return F.date_format(c, "yyyy-MM-dd")


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return add


# ---- snapshots, pages and watermarks


@query("SELECT 'r' AS op, true AS snapshot, o_orderkey AS key, o_custkey AS after_custkey, o_totalprice AS after_totalprice, 'pub.tsdb.orders' AS topic FROM orders")
def snapshot_read_orders(spark, sf):
    events = snapshot.read_events(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])
    return events.select("op", "snapshot", F.col("key.o_orderkey").alias("key"), F.col("after.o_custkey").alias("after_custkey"), F.col("after.o_totalprice").alias("after_totalprice"), topic("pub", F.lit("tsdb"), F.lit("orders")).alias("topic"))


@query("SELECT CASE WHEN l_shipdate < TIMESTAMP '1995-01-01' THEN 'r' ELSE 'c' END AS op, l_orderkey, l_linenumber FROM lineitem")
def snapshot_chunk_insert(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    created = F.when(F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz"), F.lit(1))
    return snapshot.read_events(rows, ["l_orderkey"], created).select("op", "after.l_orderkey", "after.l_linenumber")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 100 AND o_orderkey <= 50000 ORDER BY o_orderkey LIMIT 1000")
def keyset_page_orders(spark, sf):
    return snapshot.page(table(spark, sf, "orders"), ["o_orderkey"], (100,), (50000,), 1000).select("o_orderkey", "o_custkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_orderkey > 10 OR (l_orderkey = 10 AND (l_linenumber > 2 OR (l_linenumber = 2 AND (l_partkey > 0 OR (l_partkey = 0 AND l_suppkey > 0))))))
AND (l_orderkey < 5000 OR (l_orderkey = 5000 AND (l_linenumber < 3 OR (l_linenumber = 3 AND (l_partkey < 100 OR (l_partkey = 100 AND l_suppkey <= 10)))))) ORDER BY 1, 2, 3, 4 LIMIT 500""")
def keyset_page_lineitem(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return snapshot.page(table(spark, sf, "lineitem").select(*[F.col(k).cast("long").alias(k) for k in keys]), keys, (10, 2, 0, 0), (5000, 3, 100, 10), 500)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY 1 DESC, 2 DESC, 3 DESC LIMIT 1")
def high_watermark_lineitem(spark, sf):
    return snapshot.high_watermark(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"])


@query("""WITH p AS (SELECT o_orderkey, (o_orderkey // 1000) AS page FROM orders)
SELECT page, min(o_orderkey) AS first_key, max(o_orderkey) AS low, (SELECT max(o_orderkey) FROM orders) AS high, max(o_orderkey) = (SELECT max(o_orderkey) FROM orders) AS complete FROM p GROUP BY page""")
def watermark_progress(spark, sf):
    keyed = table(spark, sf, "orders").select("o_orderkey", F.floor(F.col("o_orderkey") / 1000).alias("page"))
    pages = keyed.groupBy("page").agg(F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("low"))
    high = snapshot.high_watermark(keyed, ["o_orderkey"]).withColumnRenamed("o_orderkey", "high")  # one row
    return pages.join(F.broadcast(high)).withColumn("complete", F.col("low") == F.col("high"))


# ---- chunks and aggregates


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS chunk, dense_rank() OVER (ORDER BY date_trunc('day', ts)) AS chunk_id, count(*) AS n FROM events GROUP BY date_trunc('day', ts)")
def chunk_assign(spark, sf):
    per = wal(spark, sf).groupBy("chunk_day").agg(F.count("*").alias("n"))
    return per.select(day().alias("chunk"), F.dense_rank().over(Window.orderBy("chunk_day")).cast("long").alias("chunk_id"), "n")


@query("SELECT epoch_ms(date_trunc('minute', ts)) AS bucket, max(value) AS val FROM events GROUP BY 1")
def cagg_minute_max(spark, sf):
    return table(spark, sf, "events").groupBy(F.date_trunc("minute", "ts").alias("b")).agg(F.max("value").alias("val")).select(C.timestamp(F.col("b")).alias("bucket"), "val")


@query("SELECT epoch_ms(date_trunc('day', ts)) AS bucket, max(value) AS val FROM events GROUP BY 1")
def cagg_day_max(spark, sf):
    return table(spark, sf, "events").groupBy(F.date_trunc("day", "ts").alias("b")).agg(F.max("value").alias("val")).select(C.timestamp(F.col("b")).alias("bucket"), "val")


# ---- joins


@query(WAL + f"SELECT event_id, {DAY} AS chunk, r_name AS hypertable FROM wal JOIN nation ON key % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'")
def chunk_to_hypertable(spark, sf):
    chunks, tables = table(spark, sf, "nation"), table(spark, sf, "region").filter("r_name <> 'ASIA'")
    joined = wal(spark, sf).join(chunks, F.col("key") % 25 == F.col("n_nationkey")).join(tables, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("event_id", day().alias("chunk"), F.col("r_name").alias("hypertable"))


@query("SELECT o_orderkey, c_name AS relation FROM orders JOIN customer ON o_custkey = c_custkey")
def vanilla_lookup(spark, sf):
    return table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_name").alias("relation"))


@query("SELECT a.n_name AS uncompressed, b.n_name AS compressed FROM nation a LEFT JOIN nation b ON a.n_nationkey + 12 = b.n_nationkey")
def compressed_pair(spark, sf):
    n = table(spark, sf, "nation")
    return n.select(F.col("n_name").alias("uncompressed"), (F.col("n_nationkey") + 12).alias("c")).join(n.select(F.col("n_name").alias("compressed"), "n_nationkey"), F.col("c") == F.col("n_nationkey"), "left").select("uncompressed", "compressed")


@query(WAL + """, dim AS (SELECT key AS table_id, lsn AS valid_from_lsn, lead(lsn) OVER (PARTITION BY key ORDER BY lsn) AS valid_to_lsn, op, value AS version FROM wal WHERE event_type IN ('signup', 'error'))
SELECT event_id, valid_from_lsn, version FROM wal JOIN dim ON key = table_id AND lsn >= valid_from_lsn AND (valid_to_lsn IS NULL OR lsn < valid_to_lsn) WHERE dim.op <> 'd'""")
def catalog_asof(spark, sf):
    log = wal(spark, sf)
    changes = log.filter(F.col("event_type").isin("signup", "error")).select(F.col("key").alias("table_id"), F.col("lsn").alias("at"), "op", F.col("value").alias("version"))
    dim = catalog.versions(changes, "table_id", "at").select("table_id", "valid_from_lsn", "valid_to_lsn", "version")
    return catalog.as_of(log, dim, "key", "table_id").select("event_id", "valid_from_lsn", "version")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def publication_missing(spark, sf):
    known = table(spark, sf, "customer").select("c_custkey")
    return catalog.missing(known, table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def known_still_existing(spark, sf):
    return catalog.still_existing(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT p_partkey FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45) ON p_partkey = l_partkey WHERE l_partkey IS NULL")
def vanilla_antijoin_idiom(spark, sf):
    return table(spark, sf, "part").join(table(spark, sf, "lineitem").filter("l_quantity > 45"), F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey")


@query("SELECT r_name, n_name FROM nation RIGHT JOIN region ON n_regionkey = r_regionkey AND r_regionkey = 2")
def right_join_constant_on(spark, sf):
    return table(spark, sf, "nation").join(table(spark, sf, "region"), (F.col("n_regionkey") == F.col("r_regionkey")) & (F.col("r_regionkey") == 2), "right").select("r_name", "n_name")


@query("""WITH o AS (SELECT n_nationkey, unnest([n_nationkey % 4, n_regionkey % 4]) AS opt, unnest([1, 2]) AS ord FROM nation)
SELECT n_nationkey, ord, CASE WHEN opt & 1 = 1 THEN 'DESC' ELSE 'ASC' END AS sort_order, CASE WHEN opt & 2 = 2 THEN 'NULLS FIRST' ELSE 'NULLS LAST' END AS nulls_order FROM o""")
def lateral_options(spark, sf):
    each = table(spark, sf, "nation").select("n_nationkey", F.posexplode(F.array(F.col("n_nationkey") % 4, F.col("n_regionkey") % 4)).alias("p", "opt"))
    return each.select("n_nationkey", (F.col("p") + 1).alias("ord"), F.when(F.col("opt").bitwiseAND(1) == 1, "DESC").otherwise("ASC").alias("sort_order"), F.when(F.col("opt").bitwiseAND(2) == 2, "NULLS FIRST").otherwise("NULLS LAST").alias("nulls_order"))


@query("SELECT a.v AS system_id, b.v AS timeline FROM (SELECT count(*) AS v FROM region) a CROSS JOIN (SELECT count(*) AS v FROM nation) b")
def cross_probe(spark, sf):
    n = lambda t, c: table(spark, sf, t).agg(F.count("*").alias(c))
    return n("region", "system_id").crossJoin(n("nation", "timeline"))


@query("SELECT r_name AS enum, array_to_string(list_sort(list(n_name)), ',') AS labels FROM region LEFT JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name")
def enum_labels(spark, sf):
    labels = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("labels"))
    return table(spark, sf, "region").join(labels, F.col("r_regionkey") == F.col("n_regionkey"), "left").select(F.col("r_name").alias("enum"), "labels")


@query("SELECT DISTINCT ON (p_type) p_type AS typname, p_partkey AS oid, p_size AS rank FROM part ORDER BY p_type DESC, p_size, p_partkey")
def distinct_on_type(spark, sf):
    first = F.row_number().over(Window.partitionBy("p_type").orderBy("p_size", "p_partkey"))
    return table(spark, sf, "part").withColumn("_n", first).filter("_n = 1").select(F.col("p_type").alias("typname"), F.col("p_partkey").alias("oid"), F.col("p_size").alias("rank"))


@query("SELECT s AS schema, row_number() OVER (ORDER BY o) AS rank FROM (SELECT r_name AS s, r_regionkey AS o FROM region UNION ALL SELECT 'internal', 99)")
def search_path_rank(spark, sf):
    path = table(spark, sf, "region").select(F.col("r_name").alias("schema"), F.col("r_regionkey").alias("o")).unionByName(spark.range(1).select(F.lit("internal").alias("schema"), F.lit(99).alias("o")))
    return path.select("schema", F.row_number().over(Window.orderBy("o")).cast("long").alias("rank"))


@query("SELECT n_name, rank() OVER (ORDER BY CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_regionkey END ASC NULLS LAST) AS dim_seq FROM nation")
def dimension_rank(spark, sf):
    dim = F.when(F.col("n_nationkey") % 3 != 0, F.col("n_regionkey"))
    return table(spark, sf, "nation").select("n_name", F.rank().over(Window.orderBy(dim.asc_nulls_last())).cast("long").alias("dim_seq"))


# ---- transactions and the log


@query(WAL + """, t AS (SELECT lsn, unnest([key % 25, (key + 5) % 25, (key + 1) % 25]) AS relation_id, unnest([0, 1, 2]) AS pos FROM wal WHERE op = 'd')
SELECT lsn, r_name AS canonical, min(pos) AS position FROM t JOIN nation ON relation_id = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY lsn, r_name""")
def truncate_fanout(spark, sf):
    k = F.col("key")
    log = wal(spark, sf).filter("op = 'd'").select("lsn", F.array(k % 25, (k + 5) % 25, (k + 1) % 25).alias("relation_ids"))
    relations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("long").alias("relation_id"), F.col("r_name").alias("canonical"))
    return replication.truncated_tables(log, relations)


@query(WAL + "SELECT xid, count(*) AS n_rows, min(lsn) AS first_lsn, max(lsn) AS last_lsn FROM wal GROUP BY xid")
def txn_summary(spark, sf):
    return replication.transactions(wal(spark, sf))


@query(WAL + "SELECT max(n) AS largest, count(*) AS transactions FROM (SELECT count(*) AS n FROM wal WHERE op <> 'd' GROUP BY xid)")
def largest_txn(spark, sf):
    return replication.transactions(wal(spark, sf).filter("op <> 'd'")).agg(F.max("n_rows").alias("largest"), F.count("*").alias("transactions"))


@query(WAL + "SELECT event_id, row_number() OVER (PARTITION BY xid ORDER BY lsn) > 7 AS overflow FROM wal")
def txn_overflow(spark, sf):
    return replication.overflowed(wal(spark, sf), 7).select("event_id", "overflow")


@query(WAL + "SELECT event_id, xid FROM wal WHERE xid IN (SELECT xid FROM wal WHERE event_type = 'purchase')")
def open_txn_hold(spark, sf):
    log = wal(spark, sf)
    return replication.committed_only(log, log.filter("event_type = 'purchase'")).select("event_id", "xid")


@query(WAL + """, m AS (SELECT *, last_value(marker IGNORE NULLS) OVER (PARTITION BY xid ORDER BY lsn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mk FROM wal)
SELECT event_id, op FROM m WHERE NOT (op = 'c' AND coalesce(mk = 'start', false))""")
def decompression_markers(spark, sf):
    return replication.without_marked_decompression(wal(spark, sf), F.col("op") == "c").select("event_id", "op")


@query(WAL + """, m AS (SELECT *, max(CASE WHEN status = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY xid ORDER BY lsn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM wal)
SELECT event_id, op FROM m WHERE NOT (op = 'c' AND coalesce(seen, 0) = 1)""")
def decompression_status(spark, sf):
    log = replication.without_unmarked_decompression(wal(spark, sf), F.col("op") == "c", F.coalesce(F.col("status") == 0, F.lit(False)))
    return log.select("event_id", "op")


@query(WAL + """, m AS (SELECT event_id, key, status, lag(status) OVER (PARTITION BY key ORDER BY event_id) AS b FROM wal WHERE status IS NOT NULL)
SELECT event_id, key, CASE WHEN b = 0 AND status <> 0 THEN 'c' WHEN b <> 0 AND status = 0 THEN 'd' END AS tsdb_op FROM m WHERE (b = 0 AND status <> 0) OR (b <> 0 AND status = 0)""")
def compression_transitions(spark, sf):
    log = wal(spark, sf).filter("status IS NOT NULL")
    return replication.compression_events(log, "key", "status", "event_id").select("event_id", "key", "tsdb_op")


@query(WAL + "SELECT event_id, lsn FROM wal WHERE event_type = 'signup' OR lsn >= 16000")
def restart_skip(spark, sf):
    log = wal(spark, sf).withColumn("msg_type", F.when(F.col("event_type") == "signup", "R").otherwise("I"))
    return replication.restart_filter(log, 16000).select("event_id", "lsn")


@query("SELECT o_orderkey, coalesce(nullif(greatest(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE 0 END, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END, 0)), 0), 10000) AS restart_lsn FROM orders")
def restart_point(spark, sf):
    k = F.col("o_orderkey")
    found = replication.restart_point(F.when(k % 3 == 0, k).otherwise(0), F.when(k % 2 == 0, F.col("o_custkey")), F.lit(10000))
    return table(spark, sf, "orders").select("o_orderkey", found.cast("long").alias("restart_lsn"))


@query(WAL + """, s AS (SELECT key, max(lsn) AS snapshot_lsn FROM wal WHERE event_type = 'signup' AND key % 2 = 0 GROUP BY key)
SELECT event_id FROM wal LEFT JOIN s USING (key) WHERE snapshot_lsn IS NULL OR server_wal_end >= snapshot_lsn""")
def overlap_drop(spark, sf):
    log = wal(spark, sf)
    snaps = log.filter("event_type = 'signup' AND key % 2 = 0").groupBy("key").agg(F.max("lsn").alias("snapshot_lsn"))
    return replication.without_snapshot_overlap(log, snaps, "key").select("event_id")


@query(WAL + """SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN xid END IGNORE NULLS) OVER (PARTITION BY key ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_xid FROM wal""")
def xid_carry(spark, sf):
    log = wal(spark, sf).withColumn("x", F.when(F.col("event_type") == "signup", F.col("xid")))
    return log.select("event_id", replication.carried("x", "key", "event_id").alias("last_xid"))


# ---- events


def _events(spark, sf):
    """Flat payloads of the whole log."""
    log = with_before(wal(spark, sf))
    ms = C.timestamp(F.col("ts"))
    src = source(F.col("server_wal_end"), ms, F.col("op") == "r", F.lit("tsdb"), F.lit("tsdb"), F.lit("events"), F.col("xid"))
    image = lambda v: F.struct(F.col("key").alias("id"), v.alias("val"))
    value = payload(F.col("op"), image(F.col("before_value")), image(F.col("value")), src, ms)
    return log.select("event_id", "lsn", "key", "xid", "op", "chunk_day", value.alias("value"))


def _flat(events):
    v = F.col("value")
    return events.select("event_id", "op", v["before"]["val"].alias("before_val"), v["after"]["val"].alias("after_val"), v["source"]["lsn"].alias("source_lsn"), v["source"]["txId"].alias("tx_id"), v["source"]["snapshot"].alias("snapshot"), v["ts_ms"].alias("ts_ms"))


END = "upper(to_hex(server_wal_end >> 32)) || '/' || upper(to_hex(server_wal_end & 4294967295))"
FLAT = f"""SELECT event_id, op, CASE WHEN op IN ('u', 'd') THEN before_value END AS before_val, CASE WHEN op IN ('r', 'c', 'u') THEN value END AS after_val,
{END} AS source_lsn, xid AS tx_id, op = 'r' AS snapshot, epoch_us(ts) // 1000 AS ts_ms FROM wal"""
for _name, _op in (("event_read", "r"), ("event_create", "c"), ("event_update", "u"), ("event_delete", "d")):
    query(WAL + FLAT + f" WHERE op = '{_op}'", _name)(lambda spark, sf, op=_op: _flat(_events(spark, sf).filter(F.col("op") == op)))


@query(WAL + "SELECT event_id, 'm' AS op, marker AS prefix, base64(encode('this is event ' || event_id)) AS content, 'pub.message' AS topic FROM wal WHERE marker IS NOT NULL")
def event_message(spark, sf):
    text = F.concat(F.lit("this is event "), F.col("event_id").cast("string"))
    return wal(spark, sf).filter("marker IS NOT NULL").select("event_id", F.lit("m").alias("op"), F.col("marker").alias("prefix"), F.base64(text.cast("binary")).alias("content"), message_topic("pub").alias("topic"))


@query(ORACLE_SQL["compression_transitions"].replace("SELECT event_id, key, CASE", "SELECT event_id, '$' AS op, 'tsdb' AS key_schema, 'u' || key AS key_table, CASE"))
def event_compression(spark, sf):
    found = compression_transitions(spark, sf)
    return found.select("event_id", F.lit("$").alias("op"), F.lit("tsdb").alias("key_schema"), F.concat(F.lit("u"), F.col("key").cast("string")).alias("key_table"), "tsdb_op")


@query(WAL + "SELECT event_id, op, tombstone FROM wal, (VALUES (false), (true)) v(tombstone) WHERE NOT tombstone OR op = 'd'")
def delete_tombstones(spark, sf):
    return replication.with_tombstones(wal(spark, sf)).select("event_id", "op", "tombstone")


@query(WAL + """SELECT event_id, CASE key % 4 WHEN 0 THEN NULL WHEN 1 THEN before_value WHEN 2 THEN NULL ELSE before_value END AS before_val,
CASE key % 4 WHEN 0 THEN NULL ELSE key END AS before_id FROM wal WHERE op = 'u'""")
def before_image_identity(spark, sf):
    kind = F.get(F.array(*map(F.lit, ["n", "f", "d", "i"])), (F.col("key") % 4).cast("int"))
    log = with_before(wal(spark, sf)).filter("op = 'u'").withColumn("identity", kind)
    return log.select("event_id", F.when(F.col("identity").isin("f", "i"), F.col("before_value")).alias("before_val"), F.when(F.col("identity") != "n", F.col("key")).alias("before_id"))


@query(WAL + "SELECT event_id, event_id % 5 <> 0 AS has_props, CASE WHEN event_id % 5 <> 0 THEN props END AS props, event_id % 7 = 0 AS value_is_null FROM wal")
def toast_absent(spark, sf):
    tuples = F.map_filter(F.create_map(F.lit("props"), F.col("props"), F.lit("value"), F.when(F.col("event_id") % 7 != 0, F.col("value").cast("string"))), lambda k, v: (k != "props") | (F.col("event_id") % 5 != 0))
    found = replication.decode(wal(spark, sf).select("event_id", tuples.alias("new")), {"props": "string", "value": "string"})
    return found.select("event_id", F.array_contains("present", "props").alias("has_props"), "props", (F.array_contains("present", "value") & F.col("value").isNull()).alias("value_is_null"))


@query("SELECT l_orderkey AS key_orderkey, l_linenumber AS key_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2")
def key_projection(spark, sf):
    key = F.struct(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber")).alias("key")
    return table(spark, sf, "lineitem").select(key).groupBy("key").count().select(F.col("key.orderkey").alias("key_orderkey"), F.col("key.linenumber").alias("key_linenumber"), F.col("count").alias("n"))


@query("""WITH c AS (SELECT n_nationkey AS id, n_regionkey % 2 = 0 AS pk, n_name FROM nation)
SELECT n_regionkey AS table_id, CASE WHEN n_regionkey % 2 = 0 THEN string_agg(n_name, ',' ORDER BY n_nationkey DESC) ELSE string_agg(n_name, ',' ORDER BY n_name) END AS key FROM nation GROUP BY n_regionkey""")
def key_choice(spark, sf):
    n = table(spark, sf, "nation")
    dense = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_name"))
    cols = n.select(F.col("n_regionkey").alias("table_id"), F.col("n_name").alias("name"), (F.col("n_regionkey") % 2 == 0).alias("is_pk"), (-F.col("n_nationkey")).alias("key_seq"), F.lit(True).alias("is_dimension"), dense.alias("dim_seq"))
    return catalog.key_columns(cols).select("table_id", F.array_join("key", ",").alias("key"))


@query("SELECT 'pub.tsdb.' || lower(p_type) AS topic, count(*) AS n FROM part GROUP BY 1")
def topic_names(spark, sf):
    return table(spark, sf, "part").groupBy(topic("pub", F.lit("tsdb"), F.lower("p_type")).alias("topic")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey, regexp_replace(p_type || ' é/' || p_brand, '[^._A-Za-z0-9-]', '_', 'g') AS topic, regexp_replace(p_type || ' é/' || p_brand, '[^._A-Za-z0-9-]', '_', 'g') <> p_type || ' é/' || p_brand AS changed FROM part")
def topic_sanitize(spark, sf):
    clean, changed = sanitised(F.concat("p_type", F.lit(" é/"), "p_brand"))
    return table(spark, sf, "part").select("p_partkey", clean.alias("topic"), changed.alias("changed"))


@query("SELECT event_id, upper(to_hex(lsn >> 32)) || '/' || upper(to_hex(lsn & 4294967295)) AS lsn_text FROM (SELECT event_id, 16*(event_id+1) * 1000003 AS lsn FROM events)")
def lsn_codec(spark, sf):
    return wal(spark, sf).select("event_id", lsn_text(F.col("lsn") * 1000003).alias("lsn_text"))


# ---- filters


@query("""SELECT 'public.t' || n_nationkey AS s_name, CASE WHEN regexp_full_match('t' || n_nationkey, 't.*4') THEN false WHEN regexp_full_match('t' || n_nationkey, 't.') THEN true
WHEN n_nationkey = 20 THEN true ELSE false END AS enabled FROM nation""")
def table_filter(spark, sf):
    f = TableFilter(excludes=["public.t*4"], includes=["pub*.t?", 'public."t20"'])
    name = F.concat(F.lit("t"), F.col("n_nationkey").cast("string"))
    return table(spark, sf, "nation").select(F.concat(F.lit("public."), name).alias("s_name"), f.column(F.lit("public"), name).alias("enabled"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey < 10 ELSE false END AS enabled FROM nation")
def table_filter_cagg(spark, sf):
    f = TableFilter(includes=["public.view?"])
    view = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("view"), F.col("n_nationkey").cast("string")))
    return table(spark, sf, "nation").select("n_nationkey", f.column(F.lit("_timescaledb_internal"), F.lit("_materialized_1"), F.when(view.isNotNull(), F.lit("public")), view).alias("enabled"))


def _filtered(spark, sf, *filters):
    return exprfilter.apply_filters(_events(spark, sf).withColumn("t", F.concat(F.lit("u"), (F.col("key") % 3).cast("string"))), list(filters), F.lit("tsdb"), F.col("t")).select("event_id", "op")


@query(WAL + "SELECT event_id, op FROM wal WHERE op = 'u' AND key = 2 OR op = 'c'")
def sink_filter_positive(spark, sf):
    return _filtered(spark, sf, exprfilter.SinkFilter('value.op == "u" && value.after.id == 2 || value.op == "c"'))


@query(WAL + "SELECT event_id, op FROM wal WHERE NOT coalesce(op IN ('r', 'd') OR value > 50, false)")
def sink_filter_negative(spark, sf):
    return _filtered(spark, sf, exprfilter.SinkFilter('value.op in ["r", "d"] or value.after.val > 50', default=False))


@query(WAL + "SELECT event_id, op FROM wal WHERE key % 3 = 1 OR op = 'c'")
def sink_filter_scoped(spark, sf):
    return _filtered(spark, sf, exprfilter.SinkFilter('value.op == "c"', excludes=["tsdb.u1"]))


@query(WAL + "SELECT event_id, op FROM wal WHERE op <> 'd' AND (op = 'c' OR op = 'u')")
def sink_filter_and(spark, sf):
    return _filtered(spark, sf, exprfilter.SinkFilter('!(value.op == "d")'), exprfilter.SinkFilter('value.op matches "^[cu]$"'))


@query(WAL + "SELECT event_id, op FROM wal WHERE op NOT IN ('r', 'd')")
def event_switches(spark, sf):
    return replication.switched(wal(spark, sf), {"r": False, "c": True, "d": False}).select("event_id", "op")


@query("""SELECT 'tsdb.' || n_name AS table, 'vanilla' AS kind, CASE WHEN n_nationkey % 4 = 3 AND n_regionkey <> 1 THEN 'index' WHEN n_regionkey <> 2 THEN 'default' END AS issue FROM nation
WHERE n_nationkey % 4 <> 1 AND ((n_nationkey % 4 = 3 AND n_regionkey <> 1) OR n_regionkey <> 2)""")
def replica_identity_issues(spark, sf):
    n = table(spark, sf, "nation")
    tables = n.select(F.col("n_nationkey").alias("id"), F.lit("tsdb").alias("schema_name"), F.col("n_name").alias("table_name"), F.lit("vanilla").alias("kind"), F.get(F.array(*map(F.lit, "nfdi")), F.col("n_nationkey") % 4).alias("replica_identity"), F.lit(False).alias("is_cagg"))
    columns = n.select(F.col("n_nationkey").alias("table_id"), (F.col("n_regionkey") == 2).alias("is_pk"), (F.col("n_regionkey") == 1).alias("is_replica_ident"))
    return catalog.identity_issues(tables, columns)


@query("""SELECT coalesce(a.n_regionkey, b.n_regionkey) AS table_id, coalesce(a.n_name, b.n_name) AS name, CASE WHEN a.n_name IS NULL THEN 'added' WHEN b.n_name IS NULL THEN 'dropped' ELSE 'changed' END AS change
FROM (SELECT * FROM nation WHERE n_nationkey % 3 <> 0) a FULL JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) b USING (n_nationkey) WHERE a.n_name IS NULL OR b.n_name IS NULL OR b.n_nationkey % 7 = 0""")
def schema_diff(spark, sf):
    side = lambda cond, kind: table(spark, sf, "nation").filter(cond).select(F.col("n_regionkey").alias("table_id"), F.col("n_name").alias("name"), kind.alias("type"))
    return catalog.schema_diff_columns(side("n_nationkey % 3 <> 0", F.lit("int4")), side("n_nationkey % 5 <> 0", F.when(F.col("n_nationkey") % 7 == 0, "int8").otherwise("int4")))


@query("SELECT n_nationkey, CASE WHEN n_nationkey - 1 > 1 THEN n_nationkey - 1 END AS bit_length, CASE WHEN n_nationkey > 5 THEN n_nationkey - 4 END AS char_length FROM nation")
def field_length(spark, sf):
    k = F.col("n_nationkey")
    return table(spark, sf, "nation").select("n_nationkey", C.field_length("varbit", k - 1).alias("bit_length"), C.field_length("varchar[]", k).alias("char_length"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'boolean' WHEN 1 THEN CASE WHEN p_partkey = 1 THEN 'boolean' ELSE 'integer' END WHEN 2 THEN 'float' ELSE 'string' END AS kind FROM part""")
def default_coercion(spark, sf):
    k = F.col("p_partkey")
    text = F.when(k % 4 == 0, "true").when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, F.concat(k.cast("string"), F.lit(".5"))).otherwise(F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", C.default_kind(text).alias("kind"))


# ---- sinks and statistics


JSON_KEYS = "list_sort(json_keys(p))"


@query(f"""WITH e AS (SELECT event_id, props::JSON AS p, event_type AS t FROM events)
SELECT event_id, '{{' || array_to_string(list_transform({JSON_KEYS}, lambda k: '"' || k || '":' || json_extract(p, '$."' || k || '"')::VARCHAR), ',') || '}}' AS props,
'{{"a":{{"w":"' || t || '","x":"l1\\nl2"}},"b":"12","c":[1,' || event_id || ',0.5],"d":"\\u003c\\u0026\\u003e","e":null,"f":true}}' AS nested FROM e""")
def json_props_text(spark, sf):
    return table(spark, sf, "events").select("event_id", C.json(F.col("props")).alias("props"), C.json(_nested()).alias("nested"))


def _nested():
    """An object whose members are out of order, of all types, with characters that are escaped."""
    return F.concat(F.lit('{"f":true, "e":null, "d":"<&>", "c":[1.0, '), F.col("event_id").cast("string"), F.lit(', 5e-1], "b":"12", "a":{"x":"l1\\nl2", "w":"'), F.col("event_type"), F.lit('"}}'))


@query("SELECT event_id, base64(encode(event_type)) AS content FROM events")
def message_base64(spark, sf):
    return table(spark, sf, "events").select("event_id", F.base64(F.col("event_type").cast("binary")).alias("content"))


@query(WAL + f"SELECT event_id, upper(sha256({LSN} || '-' || CASE WHEN op <> 'd' THEN xid || '-' ELSE '' END || event_type)) AS dedup_id FROM wal")
def sqs_dedup_id(spark, sf):
    return wal(spark, sf).select("event_id", sinks.sqs_dedup_id(lsn_text(F.col("lsn")), F.when(F.col("op") != "d", F.col("xid")), F.col("event_type")).alias("dedup_id"))


@query(WAL + "SELECT 'pub.tsdb.' || event_type AS topic, count(*) AS n, min(lsn) AS first_lsn FROM wal GROUP BY 1")
def kinesis_partitions(spark, sf):
    return wal(spark, sf).groupBy(topic("pub", F.lit("tsdb"), F.col("event_type")).alias("topic")).agg(F.count("*").alias("n"), F.min("lsn").alias("first_lsn"))


@query(WAL + "SELECT 'pub.tsdb.events' AS topic, '{\"id\":' || key || '}' AS key, '{\"op\":\"' || op || '\",\"type\":\"' || event_type || '\"}' AS value, lsn FROM wal")
def kafka_records(spark, sf):
    log = wal(spark, sf)
    return sinks.records(log, "pub", F.struct(F.col("key").alias("id")), F.lit("tsdb"), F.lit("events"), F.struct("op", F.col("event_type").alias("type")))


@query(WAL + """SELECT count(*) AS total, count(*) FILTER (op = 'c') AS inserts, count(*) FILTER (op = 'u') AS updates, count(*) FILTER (op = 'd') AS deletes, count(*) FILTER (op = 'r') AS reads, count(DISTINCT xid) AS transactions FROM wal""")
def replication_stats(spark, sf):
    return replication.statistics(wal(spark, sf), "op")


@query(WAL + "SELECT batch, max(m) OVER (ORDER BY batch) AS processed_lsn FROM (SELECT event_id // 100 AS batch, max(lsn) AS m FROM wal GROUP BY 1)")
def processed_lsn(spark, sf):
    return replication.processed_positions(wal(spark, sf), F.floor(F.col("event_id") / 100))


# ---- converters


@query("SELECT o_orderkey, (o_orderdate::DATE - DATE '1970-01-01')::INT AS v FROM orders")
def conv_date(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.date(F.col("o_orderdate")).alias("v"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS v FROM events")
def conv_timestamp(spark, sf):
    return table(spark, sf, "events").select("event_id", C.timestamp(F.col("ts")).alias("v"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || rtrim(rtrim(strftime(ts, '.%f'), '0'), '.') || 'Z' AS v FROM events")
def conv_timestamptz(spark, sf):
    return table(spark, sf, "events").select("event_id", C.timestamptz(F.col("ts")).alias("v"))


@query("SELECT event_id, strftime(ts, '%H:%M:%S.%f') AS v FROM events")
def conv_time(spark, sf):
    return table(spark, sf, "events").select("event_id", C.time(C.micros_of_day(F.col("ts"))).alias("v"))


@query("SELECT event_id, strftime(ts + INTERVAL 7 HOUR + INTERVAL 30 MINUTE, '%H:%M:%S.%f') AS v FROM events")
def conv_timetz(spark, sf):
    return table(spark, sf, "events").select("event_id", C.timetz(C.micros_of_day(F.col("ts")), F.lit(27_000)).alias("v"))


@query("SELECT n_nationkey, n_nationkey * 1000 + n_regionkey * 86400000000 + round(n_nationkey * (365.25::DOUBLE / 12) * 86400000000.0::DOUBLE)::BIGINT AS v FROM nation")
def conv_interval(spark, sf):
    k = F.col("n_nationkey").cast("long")
    return table(spark, sf, "nation").select("n_nationkey", C.interval(k, F.col("n_regionkey").cast("long"), k * 1000).alias("v"))


@query("SELECT p_partkey, lower(hex(encode(p_type))) AS v FROM part")
def conv_bytea(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.bytea(F.col("p_type").cast("binary")).alias("v"))


@query("SELECT p_partkey, regexp_replace(md5(p_type), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS v FROM part")
def conv_uuid(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.uuid(F.unhex(F.md5(F.col("p_type").cast("binary")))).alias("v"))


@query("SELECT n_nationkey, left(lpad(bin(n_nationkey * 10), 8, '0'), 5) AS v FROM nation")
def conv_bits(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", C.bits(F.unhex(F.lpad(F.hex(F.col("n_nationkey") * 10), 2, "0")), F.lit(5)).alias("v"))


@query("SELECT p_partkey, p_retailprice::DECIMAL(18,2)::DOUBLE AS v, p_retailprice::FLOAT::DOUBLE AS f FROM part")
def conv_numeric(spark, sf):
    p = F.col("p_retailprice").cast("decimal(18,2)")
    return table(spark, sf, "part").select("p_partkey", C.numeric(p).alias("v"), C.float4(F.col("p_retailprice")).cast("double").alias("f"))


@query("SELECT n_nationkey, lower('08:00:2B:01:02:' || lpad(to_hex(n_nationkey), 2, '0')) AS mac, '10.0.0.' || n_nationkey || CASE WHEN n_nationkey % 2 = 0 THEN '/24' ELSE '/32' END AS inet FROM nation")
def conv_net(spark, sf):
    k = F.col("n_nationkey")
    ip = F.concat(F.lit("10.0.0."), k.cast("string"), F.when(k % 2 == 0, "/24").otherwise(""))
    return table(spark, sf, "nation").select("n_nationkey", C.macaddr(F.concat(F.lit("08:00:2B:01:02:"), F.lpad(F.hex(k), 2, "0"))).alias("mac"), C.inet(ip).alias("inet"))


@query("SELECT n_nationkey, chr(n_nationkey + 65) AS v, n_nationkey::BIGINT AS oid FROM nation")
def conv_qchar_oid(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", C.qchar(F.col("n_nationkey") + 65).alias("v"), C.oid(F.col("n_nationkey")).alias("oid"))


def _range(lo, hi, lo_inc=False, hi_inc=False):
    return F.struct(lo.alias("lo"), hi.alias("hi"), F.lit(lo_inc).alias("lo_inc"), F.lit(hi_inc).alias("hi_inc"), F.lit(False).alias("is_empty"))


@query("SELECT n_nationkey, '[' || (n_nationkey + 1) || ',' || (n_nationkey + 11) || ')' AS v, '(,' || (n_nationkey + 11) || ')' AS unbounded, CASE WHEN n_nationkey < 1 THEN 'empty' ELSE '[1,' || (n_nationkey + 1) || ')' END AS maybe_empty FROM nation")
def conv_int_ranges(spark, sf):
    k = F.col("n_nationkey")
    free = F.struct(F.lit(None).cast("int").alias("lo"), (k + 10).alias("hi"), F.lit(False).alias("lo_inc"), F.lit(True).alias("hi_inc"), F.lit(False).alias("is_empty"))
    return table(spark, sf, "nation").select("n_nationkey", C.int_range(_range(k, k + 10, False, True)).alias("v"), C.int_range(free).alias("unbounded"), C.int_range(_range(F.lit(1), k, True, True)).alias("maybe_empty"))


@query("SELECT n_nationkey, '(' || (n_nationkey + 1) || '.5,200000.2]' AS v FROM nation")
def conv_num_ranges(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", C.num_range(_range(F.col("n_nationkey") + F.lit(1.5), F.lit(200000.2), False, True)).alias("v"))


@query("SELECT o_orderkey, '[' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || ',' || strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') || ')' AS v, '[' || strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') || ',' || strftime(o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d') || ')' AS d FROM orders")
def conv_ts_date_ranges(spark, sf):
    t, d = F.col("o_orderdate"), F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", C.ts_range(_range(t, t + F.expr("INTERVAL 1 DAY"), True)).alias("v"), C.date_range(_range(d, F.date_add(d, 3))).alias("d"))


def _pt(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


@query("""SELECT n_nationkey, '(' || n_nationkey || ',-0.5)' AS point, '(' || n_nationkey + 1 || ',40),(' || n_nationkey || ',20)' AS box, '{0,-1,' || n_nationkey || '}' AS line, '[(1,2),(' || n_nationkey || ',1)]' AS lseg,
'((0,0),(' || n_nationkey || ',20))' AS closed_path, '[(0,0),(' || n_nationkey || ',20)]' AS open_path, '((0,0),(' || n_nationkey || ',20))' AS polygon, '<(0,0),' || n_nationkey || '.25>' AS circle FROM nation""")
def conv_geometric(spark, sf):
    k = F.col("n_nationkey")
    zero, pts = F.lit(0.0), F.array(_pt(F.lit(0), F.lit(0)), _pt(k, F.lit(20)))
    return table(spark, sf, "nation").select(
        "n_nationkey", C.point(_pt(k, F.lit(-0.5))).alias("point"), C.box(_pt(k, F.lit(20)), _pt(k + 1, F.lit(40))).alias("box"), C.line(zero, F.lit(-1.0), k).alias("line"), C.lseg(_pt(F.lit(1), F.lit(2)), _pt(k, F.lit(1))).alias("lseg"),
        C.path(pts, F.lit(True)).alias("closed_path"), C.path(pts, F.lit(False)).alias("open_path"), C.polygon(pts).alias("polygon"), C.circle(_pt(zero, zero), k + F.lit(0.25)).alias("circle"),
    )


@query("SELECT n_nationkey, n_name AS name, n_nationkey::VARCHAR AS key, n_name AS label, 'a.' || n_nationkey AS path FROM nation")
def conv_maps_enums(spark, sf):
    m = C.hstore(F.concat(F.lit('"name"=>"'), F.col("n_name"), F.lit('", key=>'), F.col("n_nationkey").cast("string"), F.lit(", gone=>NULL")))
    return table(spark, sf, "nation").select("n_nationkey", m["name"].alias("name"), m["key"].alias("key"), C.enum(F.col("n_name")).alias("label"), F.concat(F.lit("a."), F.col("n_nationkey").cast("string")).alias("path"))


@query("SELECT n_regionkey, array_to_string(list_sort(list((DATE '2023-01-01' + n_nationkey::INT - DATE '1970-01-01')::VARCHAR)), ',') AS days FROM nation GROUP BY n_regionkey")
def conv_arrays(spark, sf):
    per = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.collect_list(F.date_add(F.lit("2023-01-01").cast("date"), F.col("n_nationkey"))).alias("a"))
    return per.select("n_regionkey", F.array_join(F.array_sort(F.transform(C.array_of(F.col("a"), C.date), lambda x: x.cast("string"))), ",").alias("days"))


@query("SELECT p_partkey, p_type AS id, (DATE '2023-01-01' + p_size - DATE '1970-01-01')::INT AS day FROM part")
def conv_composite(spark, sf):
    made = C.composite({"id": F.col("p_type"), "day": C.date(F.date_add(F.lit("2023-01-01").cast("date"), F.col("p_size")))})
    return table(spark, sf, "part").select("p_partkey", made.alias("c")).select("p_partkey", "c.id", "c.day")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'AAAAAAHAJAAAAAAAAMA0AAAAAAAA' ELSE 'AAAAAAEAAAAAAAAAAAAAAAAAAAAA' END AS wkb, CASE WHEN n_nationkey % 3 = 0 THEN 4326 ELSE 0 END AS srid FROM nation")
def conv_geometry(spark, sf):
    k = F.col("n_nationkey")
    body = F.when(k % 2 == 0, "00000000000024C000000000000034C0").otherwise("0" * 32)
    raw = F.unhex(F.concat(F.lit("01"), F.when(k % 3 == 0, "01000020E6100000").otherwise("01000000"), body))
    return table(spark, sf, "nation").select("n_nationkey", C.ewkb(raw).alias("g")).select("n_nationkey", "g.wkb", "g.srid")


def _hex_xy(*points):
    """Little-endian hex of points with whole coordinates from -1 to 2."""
    of = {-1: "000000000000F0BF", 0: "0" * 16, 1: "000000000000F03F", 2: "0000000000000040"}
    return "".join(of[x] for p in points for x in p)


#: EWKB as hex and WKB as hex of a line, a polygon with a hole, a multi point, a collection, and a line with Z.
SHAPES = [
    ("0102000000" + "02000000" + _hex_xy((1, 2), (0, -1)), "0000000002" + "00000002" + "3FF0000000000000" + "4000000000000000" + "0" * 16 + "BFF0000000000000"),
    ("0103000020E6100000" + "01000000" + "04000000" + _hex_xy((0, 0), (1, 0), (1, 1), (0, 0)), "0000000003" + "00000001" + "00000004" + "0" * 32 + "3FF0000000000000" + "0" * 16 + "3FF0000000000000" * 2 + "0" * 32),
    ("0104000000" + "02000000" + ("0101000000" + _hex_xy((1, 1))) + ("0101000000" + _hex_xy((2, 0))), "0000000004" + "00000002" + "0000000001" + "3FF0000000000000" * 2 + "0000000001" + "4000000000000000" + "0" * 16),
    ("0107000020E6100000" + "01000000" + "0102000000" + "01000000" + _hex_xy((2, 2)), "0000000007" + "00000001" + "0000000002" + "00000001" + "4000000000000000" * 2),
    ("0102000080" + "01000000" + _hex_xy((1, 2, -1)), "00000003EA" + "00000001" + "3FF0000000000000" + "4000000000000000" + "BFF0000000000000"),
]


@query("SELECT n_nationkey, CASE n_nationkey % 5 " + " ".join(f"WHEN {i} THEN '{wkb}'" for i, (_, wkb) in enumerate(SHAPES)) + " END AS wkb, CASE WHEN n_nationkey % 5 IN (1, 3) THEN 4326 ELSE 0 END AS srid FROM nation")
def conv_geometry_shapes(spark, sf):
    raw = F.unhex(F.get(F.array(*[F.lit(e) for e, _ in SHAPES]), (F.col("n_nationkey") % 5).cast("int")))
    return table(spark, sf, "nation").select("n_nationkey", C.ewkb(raw).alias("g")).select("n_nationkey", F.hex(F.unbase64("g.wkb")).alias("wkb"), "g.srid")


@query("SELECT n_nationkey, (n_nationkey + 9) * 10000 + n_regionkey AS v FROM nation")
def version_parse(spark, sf):
    text = F.concat((F.col("n_nationkey") + 9).cast("string"), F.lit("."), F.col("n_regionkey").cast("string"), F.lit(" (Debian)"))
    return table(spark, sf, "nation").select("n_nationkey", C.version_number(text).alias("v"))


# ---- end to end


@query(WAL + f""", m AS (SELECT *, last_value(marker IGNORE NULLS) OVER (PARTITION BY xid ORDER BY lsn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mk FROM wal),
k AS (SELECT m.*, r_name FROM m JOIN nation ON key % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE NOT (op = 'c' AND coalesce(mk = 'start', false)) AND lsn >= 1600)
SELECT event_id, tombstone, 'pub.tsdb.' || lower(r_name) AS topic, key AS key_id, op, CASE WHEN op IN ('u', 'd') THEN before_value END AS before_val, CASE WHEN op IN ('r', 'c', 'u') THEN value END AS after_val,
{END} AS source_lsn, epoch_us(ts) // 1000 AS ts_ms FROM k, (VALUES (false), (true)) v(tombstone) WHERE (NOT tombstone OR op = 'd') AND (op <> 'r' OR value > 10)""")
def replay_end_to_end(spark, sf):
    """The whole path: restart, decompression, partitions to tables, envelope, filter, topic, tombstones."""
    log = with_before(wal(spark, sf))
    log = replication.without_marked_decompression(log, F.col("op") == "c").filter("lsn >= 1600")
    chunks = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.lower("r_name").alias("t"))
    log = log.join(chunks, F.col("key") % 25 == F.col("n_nationkey"))
    ms = C.timestamp(F.col("ts"))
    src = source(F.col("server_wal_end"), ms, F.col("op") == "r", F.lit("tsdb"), F.lit("tsdb"), F.col("t"), F.col("xid"))
    image = lambda v: F.struct(F.col("key").alias("id"), v.alias("val"))
    events = log.select("event_id", "op", "t", F.struct(F.col("key").alias("id")).alias("key"), payload(F.col("op"), image(F.col("before_value")), image(F.col("value")), src, ms).alias("value"))
    events = exprfilter.apply_filters(events, [exprfilter.SinkFilter('value.op != "r" || value.after.val > 10')], F.lit("tsdb"), F.col("t"))
    events = replication.with_tombstones(events)
    v = F.col("value")
    return events.select("event_id", "tombstone", topic("pub", F.lit("tsdb"), F.col("t")).alias("topic"), F.col("key.id").alias("key_id"), "op", v["before"]["val"].alias("before_val"), v["after"]["val"].alias("after_val"), v["source"]["lsn"].alias("source_lsn"), v["ts_ms"].alias("ts_ms"))


from tidelog.plans import catalog_queries, envelope_queries  # noqa: E402, F401  (they add theirs)
