"""Registered queries of catalog scans, snapshots and start modes. The catalog's tables are derived from the local ones, in SQL likewise."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from tidelog.functions import convert as C
from tidelog.model import table, wal
from tidelog.operators import catalog, scans, snapshot
from tidelog.plans.queries import WAL, query

CAT = """WITH namespace AS (SELECT r_regionkey + 100 AS oid, 's' || r_regionkey AS nspname FROM region),
class AS (SELECT p_partkey AS oid, 't' || p_partkey AS relname, p_partkey % 6 + 100 AS relnamespace, ['n', 'f', 'd', 'i'][p_partkey % 4 + 1] AS relreplident,
  CASE WHEN p_partkey % 10 = 0 THEN p_partkey + 1000000 ELSE 0 END AS reltype FROM part),
hyper AS (SELECT p_partkey AS id, 's' || (p_partkey % 6) AS schema_name, 't' || p_partkey AS table_name, CASE WHEN p_partkey % 21 = 0 THEN p_partkey + 7 END AS compressed_hypertable_id FROM part WHERE p_partkey % 7 = 0),
cagg AS (SELECT p_partkey AS mat_hypertable_id, 'v' AS user_view_schema, 'view' || p_partkey AS user_view_name FROM part WHERE p_partkey % 14 = 0),
chunk AS (SELECT o_orderkey AS id, (o_custkey % 20 + 1) * 7 AS hypertable_id, '_timescaledb_internal' AS schema_name, 'c' || o_orderkey AS table_name, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 1 END AS compressed_chunk_id,
  o_orderkey % 11 = 0 AS dropped FROM orders),
info AS (SELECT '_timescaledb_internal' AS chunk_schema, 'c' || o_orderkey AS chunk_name, o_orderdate AS range_start FROM orders WHERE o_orderkey % 4 <> 0),
tables AS (SELECT CASE WHEN p_partkey % 6 = 5 THEN '_timescaledb_catalog' ELSE 's' || (p_partkey % 6) END AS schemaname, 't' || p_partkey AS tablename FROM part),
types AS (SELECT n_nationkey + 1000 AS oid, 'ty' || (n_nationkey % 20) AS typname, n_regionkey + 100 AS typnamespace, CASE WHEN n_nationkey % 9 = 8 THEN 'p' WHEN n_nationkey % 9 = 1 THEN 'e' ELSE 'b' END AS typtype FROM nation),
enums AS (SELECT n_nationkey + 1000 AS enumtypid, pos AS enumsortorder, n_name || pos AS enumlabel FROM nation, (VALUES (2), (1), (3)) v(pos) WHERE n_nationkey % 9 = 1),
cols AS (SELECT l_orderkey AS table_id, l_linenumber AS ordinal_position, 'c' || l_linenumber AS column_name, 'ty' || (l_partkey % 30) AS udt_name, l_suppkey AS atttypmod,
  CASE WHEN l_partkey % 2 = 0 THEN 'YES' ELSE 'NO' END AS is_nullable FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)),
pk AS (SELECT o_orderkey AS table_id, unnest([2, 1]) AS ordinal_position, unnest([1, 2]) AS key_seq, 'ix' || o_orderkey AS index_name, o_orderkey % 4 = 0 AS is_replica_ident, unnest([o_orderkey % 4, o_custkey % 4]) AS option
  FROM orders WHERE o_orderkey % 5 <> 0),
dim AS (SELECT o_orderkey AS hypertable_id, unnest(['c3', 'c1']) AS column_name, unnest([2, 1]) AS id, unnest([NULL, 86400]) AS interval_length, unnest([false, true]) AS aligned FROM orders WHERE o_orderkey % 2 = 0)
"""


def text(prefix: str, c):
    return F.concat(F.lit(prefix), c.cast("string"))


def made(spark, sf) -> SimpleNamespace:
    """The catalog's tables."""
    part, orders, nation, region = (table(spark, sf, t) for t in ("part", "orders", "nation", "region"))
    p, o, n = F.col("p_partkey"), F.col("o_orderkey"), F.col("n_nationkey")
    pick = lambda values, at: F.get(F.array(*map(F.lit, values)), at.cast("int"))
    internal = F.lit("_timescaledb_internal")
    columns = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey")).alias("x"))
    return SimpleNamespace(
        namespaces=region.select((F.col("r_regionkey") + 100).alias("oid"), text("s", F.col("r_regionkey")).alias("nspname")),
        classes=part.select(p.alias("oid"), text("t", p).alias("relname"), (p % 6 + 100).alias("relnamespace"), pick("nfdi", p % 4).alias("relreplident"), F.when(p % 10 == 0, p + 1_000_000).otherwise(0).alias("reltype")),
        hypertables=part.filter(p % 7 == 0).select(p.alias("id"), text("s", p % 6).alias("schema_name"), text("t", p).alias("table_name"), F.when(p % 21 == 0, p + 7).alias("compressed_hypertable_id")),
        caggs=part.filter(p % 14 == 0).select(p.alias("mat_hypertable_id"), F.lit("v").alias("user_view_schema"), text("view", p).alias("user_view_name")),
        chunks=orders.select(o.alias("id"), ((F.col("o_custkey") % 20 + 1) * 7).alias("hypertable_id"), internal.alias("schema_name"), text("c", o).alias("table_name"), F.when(o % 3 == 0, o + 1).alias("compressed_chunk_id"), (o % 11 == 0).alias("dropped")),
        information=orders.filter(o % 4 != 0).select(internal.alias("chunk_schema"), text("c", o).alias("chunk_name"), F.col("o_orderdate").alias("range_start")),
        tables=part.select(F.when(p % 6 == 5, "_timescaledb_catalog").otherwise(text("s", p % 6)).alias("schemaname"), text("t", p).alias("tablename")),
        types=nation.select((n + 1000).alias("oid"), text("ty", n % 20).alias("typname"), (F.col("n_regionkey") + 100).alias("typnamespace"), F.when(n % 9 == 8, "p").when(n % 9 == 1, "e").otherwise("b").alias("typtype")),
        enums=nation.filter(n % 9 == 1).select((n + 1000).alias("enumtypid"), "n_name", F.explode(F.array(*map(F.lit, (2, 1, 3)))).alias("enumsortorder")).withColumn("enumlabel", F.concat("n_name", F.col("enumsortorder").cast("string"))),
        columns=columns.select(
            F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").alias("ordinal_position"), text("c", F.col("l_linenumber")).alias("column_name"), text("ty", F.col("x.l_partkey") % 30).alias("udt_name"),
            F.col("x.l_suppkey").alias("atttypmod"), F.when(F.col("x.l_partkey") % 2 == 0, "YES").otherwise("NO").alias("is_nullable"), F.lit(None).cast("string").alias("column_default"), F.lit(None).cast("int").alias("character_maximum_length"),
        ),
        indexes=orders.select(o.alias("indrelid"), text("ix", o).alias("index_name"), (o % 5 != 0).alias("indisprimary"), (o % 4 == 0).alias("indisreplident"), F.array(F.lit(2), F.lit(1)).alias("indkey"), F.array(o % 4, F.col("o_custkey") % 4).alias("indoption")),
        dimensions=orders.filter(o % 2 == 0).select(
            o.alias("hypertable_id"), F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("id"), F.lit(w).cast("int").alias("interval_length"), F.lit(a).alias("aligned")) for c, i, w, a in (("c3", 2, None, False), ("c1", 1, 86400, True))])).alias("d"),
        ).select("hypertable_id", "d.*"),
    )


CLASS = "LEFT JOIN namespace n ON n.nspname = {s} LEFT JOIN class c ON c.relname = {t} AND c.relnamespace = n.oid"


@query(CAT + "SELECT h.id, h.schema_name, h.table_name, user_view_name, relreplident FROM hyper h LEFT JOIN cagg ON mat_hypertable_id = h.id " + CLASS.format(s="h.schema_name", t="h.table_name"))
def scan_hypertables(spark, sf):
    m = made(spark, sf)
    return scans.hypertables(m.hypertables, m.caggs, m.namespaces, m.classes).select("id", "schema_name", "table_name", "user_view_name", "relreplident")


@query(CAT + """SELECT id, hypertable_id, strftime(range_start, '%Y-%m-%d') AS starts, row_number() OVER (PARTITION BY hypertable_id ORDER BY compressed_chunk_id NULLS FIRST, range_start NULLS LAST, id) AS place
FROM chunk LEFT JOIN info ON chunk_schema = schema_name AND chunk_name = table_name""")
def scan_chunks(spark, sf):
    from pyspark.sql import Window

    m = made(spark, sf)
    place = F.row_number().over(Window.partitionBy("hypertable_id").orderBy(*scans.chunk_order()[1:]))
    return scans.chunks(m.chunks, m.information).select("id", "hypertable_id", F.date_format("range_start", "yyyy-MM-dd").alias("starts"), place.cast("long").alias("place"))


@query(CAT + "SELECT t.schemaname, t.tablename, c.oid AS class_oid, relreplident FROM tables t " + CLASS.format(s="t.schemaname", t="t.tablename")
    + " LEFT JOIN hyper h ON h.schema_name = t.schemaname AND h.table_name = t.tablename WHERE NOT starts_with(t.schemaname, '_timescaledb_') AND h.id IS NULL")
def scan_vanilla_tables(spark, sf):
    m = made(spark, sf)
    return scans.vanilla_tables(m.tables, m.hypertables, m.namespaces, m.classes).select("schemaname", "tablename", "class_oid", "relreplident")


COLUMNS = """SELECT c.table_id, c.ordinal_position, c.column_name, t.oid AS type_oid, is_nullable = 'YES' AS nullable, key_seq IS NOT NULL AS is_primary_key, key_seq, coalesce(is_replica_ident, false) AS is_replica_ident, index_name,
CASE WHEN coalesce(option, 0) & 1 = 1 THEN 'DESC' ELSE 'ASC' END AS sort_order, CASE WHEN coalesce(option, 0) & 2 = 2 THEN 'NULLS FIRST' ELSE 'NULLS LAST' END AS nulls_order{more}
FROM cols c LEFT JOIN types t ON t.typname = c.udt_name LEFT JOIN pk ON pk.table_id = c.table_id AND pk.ordinal_position = c.ordinal_position{join}"""


@query(CAT + COLUMNS.format(more="", join=""))
def scan_vanilla_columns(spark, sf):
    m = made(spark, sf)
    return scans.table_columns(m.columns, m.types, m.indexes).drop("atttypmod", "column_default", "character_maximum_length")


@query(CAT + ", r AS (SELECT *, rank() OVER (PARTITION BY hypertable_id ORDER BY id) AS dim_seq FROM dim) " + COLUMNS.format(
    more=", dim_seq IS NOT NULL AS is_dimension, coalesce(aligned, false) AS dim_aligned, CASE WHEN interval_length IS NULL THEN 'space' ELSE 'time' END AS dim_type, dim_seq",
    join=" LEFT JOIN r ON r.hypertable_id = c.table_id AND r.column_name = c.column_name"))
def scan_hypertable_columns(spark, sf):
    m = made(spark, sf)
    return scans.table_columns(m.columns, m.types, m.indexes, m.dimensions).drop("atttypmod", "column_default", "character_maximum_length")


TYPES = """, path AS (SELECT nspname AS schema, 105 - oid AS rank FROM namespace WHERE oid <> 103),
e AS (SELECT enumtypid, array_to_string(list(enumlabel ORDER BY enumsortorder), ',') AS labels FROM enums GROUP BY enumtypid)
SELECT DISTINCT ON (typname) typname, t.oid, nspname, labels FROM types t JOIN namespace n ON n.oid = typnamespace JOIN path ON schema = nspname LEFT JOIN e ON enumtypid = t.oid WHERE typtype <> 'p' {more} ORDER BY typname, rank, t.oid"""


def _types(spark, sf, oids=None):
    m = made(spark, sf)
    path = m.namespaces.filter("oid <> 103").select(F.col("nspname").alias("schema"), (105 - F.col("oid")).alias("rank"))
    return scans.types(m.types, m.namespaces, path, m.enums, oids).select("typname", "oid", "nspname", F.array_join("enum_values", ",").alias("labels"))


@query(CAT + TYPES.format(more=""))
def scan_types(spark, sf):
    return _types(spark, sf)


@query(CAT + TYPES.format(more="AND t.oid IN (1001, 1004, 1010, 1019)"))
def scan_types_by_oid(spark, sf):
    return _types(spark, sf, [1001, 1004, 1010, 1019])


@query(CAT + """SELECT reltype AS type_oid, ordinal_position AS attnum, column_name AS attname FROM cols JOIN class ON table_id = oid WHERE reltype <> 0 AND ordinal_position > 1 AND ordinal_position % 5 <> 0""")
def scan_composites(spark, sf):
    m = made(spark, sf)
    attributes = m.columns.select(
        F.col("table_id").alias("attrelid"), (F.col("ordinal_position") - 1).alias("attnum"), F.col("column_name").alias("attname"), F.lit(23).alias("atttypid"), "atttypmod",
        F.lit(True).alias("attnotnull"), (F.col("ordinal_position") % 5 == 0).alias("attisdropped"),
    )
    return scans.composite_fields(attributes, m.classes).select("type_oid", (F.col("attnum") + 1).alias("attnum"), "attname")


@query(CAT + "SELECT ch.id AS chunk_id, ch.hypertable_id, coalesce(u.id, ch.hypertable_id) AS origin_id, h.table_name FROM chunk ch LEFT JOIN hyper u ON u.compressed_hypertable_id = ch.hypertable_id JOIN hyper h ON h.id = coalesce(u.id, ch.hypertable_id)")
def origin_hypertable(spark, sf):
    m = made(spark, sf)
    return scans.origin_hypertables(m.chunks, m.hypertables).select("chunk_id", "hypertable_id", "origin_id", "table_name")


@query(CAT + "SELECT id, schema_name, table_name, 'name' AS by FROM hyper WHERE id % 2 = 0 UNION ALL SELECT id, schema_name, table_name, 'id' FROM hyper WHERE id % 4 = 0")
def catalog_lookups(spark, sf):
    h = made(spark, sf).hypertables
    found = lambda df, by: df.select("id", "schema_name", "table_name", F.lit(by).alias("by"))
    return found(scans.by_name(h, h.filter("id % 2 = 0").select("schema_name", "table_name")), "name").unionByName(found(scans.by_id(h, h.filter("id % 4 = 0").select("id")), "id"))


@query(CAT + "SELECT id FROM chunk WHERE NOT dropped AND hypertable_id IN (SELECT id FROM hyper WHERE id % 2 = 0)")
def replicated_chunks(spark, sf):
    m = made(spark, sf)
    return scans.replicated_chunks(m.chunks, m.hypertables, F.col("id") % 2 == 0).select("id")


@query(CAT + "SELECT schema_name, table_name, 'chunk' AS kind FROM chunk UNION ALL SELECT schemaname, tablename, 'vanilla' FROM tables WHERE schemaname = 's1'")
def initial_tables(spark, sf):
    m = made(spark, sf)
    return scans.initial_tables(m.chunks, m.tables.filter("schemaname = 's1'").select(F.col("schemaname").alias("schema_name"), F.col("tablename").alias("table_name")))


@query("SELECT s_suppkey AS usesysid, s_name AS usename FROM supplier WHERE s_suppkey = 7 AND s_nationkey >= 0")
def owner_check(spark, sf):
    users = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("usesysid"), F.col("s_name").alias("usename"))
    name = users.filter("usesysid = 7").first()["usename"]  # the session's user
    return scans.owner_found(users, name, F.lit(7)).select("usesysid", "usename")


@query(CAT + """SELECT h.schema_name || '.' || h.table_name AS table, CASE WHEN relreplident = 'i' THEN 'replica identity by index' ELSE 'no select privilege' END AS reason
FROM hyper h JOIN class c ON c.oid = h.id WHERE h.id % 2 = 0 AND (relreplident = 'i' OR h.id % 3 <> 0)""")
def tables_not_readable(spark, sf):
    m = made(spark, sf)
    known = m.hypertables.join(m.classes.select(F.col("oid").alias("id"), "relreplident"), "id").withColumn("may_select", F.col("id") % 3 == 0)
    return scans.unreadable(known, F.col("id") % 2 == 0)


# ---- the catalog from the log


LOGGED = WAL + """, cat AS (SELECT lsn, CASE op WHEN 'r' THEN 'c' ELSE op END AS op, key, CASE WHEN event_id % 3 = 0 THEN 'chunk' WHEN event_id % 3 = 1 THEN 'hypertable' ELSE 'other' END AS relation,
CASE WHEN event_id % 5 = 4 THEN 'public' ELSE '_timescaledb_catalog' END AS namespace, event_id % 4 = 0 AS dropped, CASE WHEN event_id % 7 = 0 THEN event_id END AS compressed_chunk_id FROM wal)
"""


def logged(spark, sf):
    """The log as rows of catalog relations, their tuples as maps of text."""
    e = F.col("event_id")
    fields = {
        "id": F.col("key"), "hypertable_id": F.col("key") % 10, "schema_name": F.lit("s"), "table_name": text("t", F.col("key")), "dropped": e % 4 == 0, "status": F.lit(0), "compressed_chunk_id": F.when(e % 7 == 0, e),
        "compression_state": F.lit(1), "associated_schema_name": F.lit("_timescaledb_internal"), "associated_table_prefix": text("_hyper_", F.col("key")),
    }
    tuple_ = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))])
    log = wal(spark, sf).withColumn("op", F.when(F.col("op") == "r", "c").otherwise(F.col("op")))
    return log.select(
        "lsn", "op", F.when(e % 5 == 4, "public").otherwise("_timescaledb_catalog").alias("namespace"), F.when(e % 3 == 0, "chunk").when(e % 3 == 1, "hypertable").otherwise("other").alias("relation"),
        F.when(F.col("op") != "d", tuple_).alias("new"), F.when(F.col("op") == "d", tuple_).alias("old"),
    )


@query(LOGGED + "SELECT CASE WHEN namespace = 'public' THEN 'vanilla' WHEN relation = 'other' THEN 'internal' ELSE relation END AS handler, op, count(*) AS n FROM cat GROUP BY 1, 2")
def route_log(spark, sf):
    return scans.routed(logged(spark, sf)).groupBy("handler", "op").agg(F.count("*").alias("n"))


@query(LOGGED + """, v AS (SELECT key AS id, lsn AS valid_from, lead(lsn) OVER (PARTITION BY key ORDER BY lsn) AS valid_to, op, dropped FROM cat WHERE relation = 'chunk' AND namespace <> 'public')
SELECT id, id % 10 AS hypertable_id, dropped, valid_from, valid_to FROM v WHERE op <> 'd'""")
def chunk_versions(spark, sf):
    changes = scans.catalog_changes(logged(spark, sf), "chunk", scans.decomposed_chunks)
    found = catalog.versions(changes, "id")
    return found.select(F.col("id").cast("long").alias("id"), F.col("hypertable_id").cast("long").alias("hypertable_id"), "dropped", F.col("valid_from_lsn").alias("valid_from"), F.col("valid_to_lsn").alias("valid_to"))


@query(LOGGED + """, v AS (SELECT key AS id, lsn AS valid_from, lead(lsn) OVER (PARTITION BY key ORDER BY lsn) AS valid_to, op FROM cat WHERE relation = 'hypertable' AND namespace <> 'public')
SELECT id, '_hyper_' || id AS prefix, valid_from, valid_to FROM v WHERE op <> 'd'""")
def hypertable_versions(spark, sf):
    found = catalog.versions(scans.catalog_changes(logged(spark, sf), "hypertable", scans.decomposed_hypertables), "id")
    return found.select(F.col("id").cast("long").alias("id"), F.col("associated_table_prefix").alias("prefix"), F.col("valid_from_lsn").alias("valid_from"), F.col("valid_to_lsn").alias("valid_to"))


@query(LOGGED + "SELECT key AS id, key % 10 AS hypertable_id, lsn FROM cat WHERE relation = 'chunk' AND namespace <> 'public' AND op = 'c' AND compressed_chunk_id IS NULL AND NOT dropped AND key % 10 < 6")
def chunk_added_snapshots(spark, sf):
    changes = scans.catalog_changes(logged(spark, sf), "chunk", scans.decomposed_chunks)
    selected = spark.range(6).select(F.col("id").cast("int").alias("hypertable_id"))
    return snapshot.chunk_snapshots(changes, selected).select(F.col("id").cast("long").alias("id"), F.col("hypertable_id").cast("long").alias("hypertable_id"), "lsn")


@query(WAL + """, r AS (SELECT key AS relation_id, lsn, event_type AS columns, lag(event_type) OVER (PARTITION BY key ORDER BY lsn) AS b FROM wal),
c AS (SELECT * FROM r WHERE b IS NULL OR b <> columns) SELECT relation_id, columns, lsn AS valid_from, lead(lsn) OVER (PARTITION BY relation_id ORDER BY lsn) AS valid_to FROM c""")
def schema_versions(spark, sf):
    messages = wal(spark, sf).select(F.col("key").alias("relation_id"), "lsn", F.col("event_type").alias("columns"))
    return scans.schema_versions(messages).select("relation_id", "columns", F.col("valid_from_lsn").alias("valid_from"), F.col("valid_to_lsn").alias("valid_to"))


@query("""WITH o AS (SELECT n_regionkey AS t, n_name AS name, n_nationkey % 2 AS type, n_nationkey AS pos FROM nation WHERE n_nationkey % 3 <> 0),
n AS (SELECT n_regionkey AS t, CASE WHEN n_nationkey % 4 = 0 THEN 'new_' || n_name ELSE n_name END AS name, CASE WHEN n_nationkey % 7 = 0 THEN 5 ELSE n_nationkey % 2 END AS type, n_nationkey AS pos FROM nation WHERE n_nationkey % 5 <> 0),
g AS (SELECT t, name, type, row_number() OVER (PARTITION BY t ORDER BY pos) AS p FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.t = o.t AND n.name = o.name)),
c AS (SELECT t, name, type, row_number() OVER (PARTITION BY t ORDER BY pos) AS p FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.t = n.t AND o.name = n.name)),
b AS (SELECT coalesce(g.t, c.t) AS t, g.name AS old, c.name AS new, coalesce(g.type = c.type, false) AS same FROM g FULL JOIN c ON g.t = c.t AND g.p = c.p)
SELECT o.t AS table_id, o.name, 'changed' AS change, NULL::VARCHAR AS new_name FROM o JOIN n ON o.t = n.t AND o.name = n.name WHERE o.type <> n.type
UNION ALL SELECT t, old, 'renamed', new FROM b WHERE same UNION ALL SELECT t, old, 'dropped', NULL FROM b WHERE NOT same AND old IS NOT NULL UNION ALL SELECT t, new, 'added', NULL FROM b WHERE NOT same AND new IS NOT NULL""")
def schema_renames(spark, sf):
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation")
    side = lambda rows, name, kind: rows.select(F.col("n_regionkey").alias("table_id"), name.alias("name"), kind.alias("type"), k.alias("position"))
    old = side(n.filter(k % 3 != 0), F.col("n_name"), k % 2)
    new = side(n.filter(k % 5 != 0), F.when(k % 4 == 0, F.concat(F.lit("new_"), "n_name")).otherwise(F.col("n_name")), F.when(k % 7 == 0, 5).otherwise(k % 2))
    return scans.column_changes(old, new)


# ---- snapshots and start modes


FNV = """list_reduce(list_prepend(14695981039346656037::HUGEINT, list_transform(range(1, length(n_name) + 1), lambda i: ascii(substr(n_name, i::INT, 1))::HUGEINT)), lambda h, b: (xor(h, b) * 1099511628211) % 18446744073709551616)"""


@query(f"SELECT n_name AS canonical, ({FNV} % 5)::INT AS worker FROM nation")
def snapshot_tasks(spark, sf):
    return snapshot.tasks(table(spark, sf, "nation").select(F.col("n_name").alias("canonical")))


@query("""WITH t AS (SELECT n_name AS canonical, CASE WHEN n_nationkey % 2 = 0 THEN 'hypertable' ELSE 'vanilla' END AS kind, n_nationkey AS k FROM nation)
SELECT canonical, kind, row_number() OVER (ORDER BY kind, canonical) AS place, CASE WHEN k % 3 = 0 THEN 'start' WHEN k % 3 = 1 THEN 'skip' ELSE 'resume' END AS action, CASE WHEN k % 3 = 2 THEN k END AS above FROM t""")
def snapshot_sequence(spark, sf):
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation")
    tables = n.select(F.col("n_name").alias("canonical"), F.when(k % 2 == 0, "hypertable").otherwise("vanilla").alias("kind"))
    left = n.filter(k % 3 != 0).select(F.col("n_name").alias("canonical"), k.alias("low"), F.when(k % 3 == 1, k).otherwise(k + 100).alias("high"))
    return snapshot.sequence(tables, left).withColumn("place", F.col("place").cast("long"))


@query("SELECT o_orderkey, 'r' AS op FROM orders")
def snapshot_ranges(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    parts = [snapshot.read_events(snapshot.range_rows(orders, ["o_orderkey"], low, high), ["o_orderkey"]) for low, high in snapshot.ranges(orders, ["o_orderkey"], 8)]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.select(F.col("after.o_orderkey").alias("o_orderkey"), "op")


@query(WAL + """, s AS (SELECT key, min(lsn) AS started, max(lsn) AS finished, (min(lsn) + max(lsn)) / 2 AS snap FROM wal WHERE key % 2 = 0 GROUP BY key)
SELECT event_id, CASE WHEN lsn >= started AND lsn < finished THEN finished ELSE lsn END AS released_lsn FROM wal LEFT JOIN s USING (key) WHERE NOT coalesce(lsn >= started AND lsn < finished AND server_wal_end < snap, false)""")
def chunk_snapshot_drain(spark, sf):
    log = wal(spark, sf)
    snaps = log.filter("key % 2 = 0").groupBy("key").agg(F.min("lsn").alias("started_lsn"), F.max("lsn").alias("finished_lsn"), ((F.min("lsn") + F.max("lsn")) / 2).alias("snapshot_lsn"))
    return snapshot.drained(log, snaps, "key").select("event_id", "released_lsn")


@query("""WITH m AS (SELECT n_nationkey, ['never', 'initial_only', 'always'][n_nationkey % 3 + 1] AS mode, n_nationkey % 2 = 0 AS has_offset, n_nationkey % 4 = 0 AS begun, n_nationkey % 5 < 2 AS created FROM nation)
SELECT n_nationkey, mode, CASE WHEN mode = 'always' AND created THEN 'snapshot' WHEN mode = 'always' THEN 'error: always needs a new slot' WHEN mode = 'never' THEN 'replicate' WHEN NOT has_offset AND created THEN 'snapshot'
WHEN NOT has_offset OR NOT begun THEN 'replicate' WHEN created THEN 'error: state of another slot' ELSE 'resume' END AS action FROM m""")
def start_mode_actions(spark, sf):
    k = F.col("n_nationkey")
    mode = F.get(F.array(*map(F.lit, (snapshot.NEVER, snapshot.INITIAL_ONLY, snapshot.ALWAYS))), (k % 3).cast("int"))
    return table(spark, sf, "nation").select("n_nationkey", mode.alias("mode"), snapshot.start_action(mode, k % 2 == 0, k % 4 == 0, k % 5 < 2).alias("action"))


@query("SELECT n_nationkey, lpad((n_nationkey % 24)::VARCHAR, 2, '0') || ':00:00.000001' AS t, 'a.b' || n_nationkey AS path, n_name || '|x y|' || n_nationkey AS elements FROM nation")
def conv_binary_codecs(spark, sf):
    k = F.col("n_nationkey")
    hours = F.lpad(F.hex((k % 24) * 3_600_000_000 + 7_200_000_001), 16, "0")
    raw = F.unhex(F.concat(hours, F.lit("FFFFE3E0")))  # a zone of two hours less
    items = F.concat(F.lit('{"'), F.col("n_name"), F.lit('";"x y";'), k.cast("string"), F.lit(";NULL}"))
    return table(spark, sf, "nation").select(
        "n_nationkey", C.timetz_binary(raw).alias("t"), C.ltree_binary(F.concat(F.unhex(F.lit("01")), text("a.b", k).cast("binary"))).alias("path"), F.array_join(C.array_text(items, ";"), "|").alias("elements"),
    )
