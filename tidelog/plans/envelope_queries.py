"""Registered queries of schema descriptors and envelopes."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidelog import schema, sinks
from tidelog.functions import convert as C
from tidelog.model import table, wal
from tidelog.operators import exprfilter
from tidelog.operators.catalog import ColumnDef
from tidelog.plans.queries import WAL, _events, compression_transitions, query

EVENTS = [ColumnDef("id", "int8", is_pk=True), ColumnDef("val", "float8", nullable=True)]
KEY = '{"type":"struct","name":"pub.tsdb.events.Key","optional":false,"fields":[{"name":"id","index":0,"schema":{"type":"int64","optional":false}}]}'


@query(WAL + f"""SELECT event_id, '{{"schema":{KEY},"payload":{{"id":' || key || '}}}}' AS key FROM wal""")
def key_envelope(spark, sf):
    s = schema.key_schema("pub", "tsdb", "events", EVENTS)
    return wal(spark, sf).select("event_id", schema.enveloped(s, F.struct(F.col("key").alias("id"))).alias("key"))


MESSAGE_KEY = '{"version":1,"name":"io.debezium.connector.postgresql.MessageKey","fields":[{"type":"string","optional":true,"field":"prefix"}]}'


@query(WAL + f"""SELECT event_id, '{{"schema":{MESSAGE_KEY},"payload":{{"prefix":"' || marker || '"}}}}' AS key, 'pub.message.Envelope' AS value_schema,
'{{"prefix":"' || marker || '","content":"' || base64(encode('this is event ' || event_id)) || '"}}' AS message FROM wal WHERE marker IS NOT NULL""")
def message_envelope(spark, sf):
    content = F.base64(F.concat(F.lit("this is event "), F.col("event_id").cast("string")).cast("binary"))
    block = F.struct(F.col("marker").alias("prefix"), content.alias("content"))
    value = schema.enveloped(schema.message_envelope_schema("pub"), F.struct(F.lit("m").alias("op"), block.alias("message")))
    rows = wal(spark, sf).filter("marker IS NOT NULL").select("event_id", schema.enveloped(schema.message_key_schema(), schema.message_key(F.col("marker"))).alias("key"), value.alias("v"))
    return rows.select("event_id", "key", F.get_json_object("v", "$.schema.name").alias("value_schema"), F.get_json_object("v", "$.payload.message").alias("message"))


EVENT_KEY = '{"type":"struct","name":"com.timescale.Event","optional":false,"fields":[{"type":"string","optional":false,"field":"schema"},{"type":"string","optional":false,"field":"table"}]}'


@query(WAL + f""", m AS (SELECT event_id, key, status, lag(status) OVER (PARTITION BY key ORDER BY event_id) AS b FROM wal WHERE status IS NOT NULL)
SELECT event_id, '{{"schema":{EVENT_KEY},"payload":{{"schema":"tsdb","table":"u' || key || '"}}}}' AS key FROM m WHERE (b = 0 AND status <> 0) OR (b <> 0 AND status = 0)""")
def compression_key_envelope(spark, sf):
    key = schema.event_key(F.lit("tsdb"), F.concat(F.lit("u"), F.col("key").cast("string")))
    return compression_transitions(spark, sf).select("event_id", schema.enveloped(schema.event_key_schema(), key).alias("key"))


def _fields(spark, schemas: dict[str, dict]):
    """A row for each field of some descriptors, read back from their text."""
    shape = "struct<fields:array<struct<field:string,type:string,optional:boolean,default:string,name:string,fields:array<struct<field:string>>>>>"
    rows = spark.createDataFrame([(k, schema.schema_text(s)) for k, s in schemas.items()], "of string, text string")
    each = rows.select("of", F.posexplode(F.from_json("text", shape)["fields"]).alias("place", "f"))
    return each.select("of", "place", F.col("f.field").alias("field"), F.col("f.type").alias("type"), F.coalesce("f.optional", F.lit(False)).alias("optional"), F.col("f.default").alias("default_value"), F.col("f.name").alias("name"), F.array_join("f.fields.field", ",").alias("fields"))


ROWS = "SELECT * FROM (VALUES {}) v(of, place, field, type, optional, default_value, name, fields)"
SOURCE = "version,connector,name,ts_ms,snapshot,schema,table,txId,lsn,xmin"


@query(ROWS.format(f"""('e', 0, 'before', 'struct', false, NULL, 'pub.tsdb.t.Value', 'id,val,tags,note'), ('e', 1, 'after', 'struct', false, NULL, 'pub.tsdb.t.Value', 'id,val,tags,note'),
('e', 2, 'source', 'struct', false, NULL, 'io.debezium.connector.postgresql.Source', '{SOURCE}'), ('e', 3, 'op', 'string', false, NULL, NULL, NULL), ('e', 4, 'tsdb_op', 'string', false, NULL, NULL, NULL),
('e', 5, 'ts_ms', 'int64', false, NULL, NULL, NULL), ('t', 0, 'id', 'int64', false, NULL, NULL, NULL), ('t', 1, 'val', 'float64', true, '1.5', NULL, NULL), ('t', 2, 'tags', 'array', true, NULL, NULL, NULL),
('t', 3, 'note', 'string', true, 'none', 'io.debezium.data.Json', NULL)"""))
def envelope_schema(spark, sf):
    columns = [ColumnDef("id", "int8", is_pk=True), ColumnDef("val", "float8", nullable=True, default="1.5"), ColumnDef("tags", "text[]", nullable=True), ColumnDef("note", "jsonb", nullable=True, default="none")]
    return _fields(spark, {"e": schema.envelope_schema("pub", "tsdb", "t", columns), "t": schema.table_schema("tsdb", "t", columns)})


@query(ROWS.format(", ".join(
    f"('s', {i}, '{f}', '{'boolean' if f == 'snapshot' else 'int64' if f in ('txId', 'lsn', 'xmin') else 'string'}', false, {repr('false') if f == 'snapshot' else 'NULL::VARCHAR'}, NULL::VARCHAR, NULL::VARCHAR)"
    for i, f in enumerate(SOURCE.split(",")))))
def source_schema(spark, sf):
    return _fields(spark, {"s": schema.source_schema()})


@query(WAL + """SELECT 'pub.tsdb.events' AS topic, key AS key_id, op, CASE WHEN op IN ('r', 'c', 'u') THEN value END AS after_val, 'pub.tsdb.events.Envelope' AS schema_name, epoch_us(ts) // 1000 AS ts_ms,
upper(sha256((upper(to_hex(lsn >> 32)) || '/' || upper(to_hex(lsn & 4294967295))) || '-' || xid || '-' || op)) AS dedup_id FROM wal""")
def enveloped_records(spark, sf):
    events = _events(spark, sf)
    found = sinks.records(
        events, "pub", F.struct(F.col("key").alias("id")), F.lit("tsdb"), F.lit("events"), F.col("value"), key_schema=schema.key_schema("pub", "tsdb", "events", EVENTS),
        value_schema=schema.envelope_schema("pub", "tsdb", "events", EVENTS), ts_ms=F.col("value.ts_ms"), dedup_id=sinks.sqs_dedup_id(_lsn(), F.col("xid"), F.col("op")),
    )
    at = lambda c, p: F.get_json_object(c, p)
    return found.select("topic", at("key", "$.payload.id").cast("long").alias("key_id"), at("value", "$.payload.op").alias("op"), at("value", "$.payload.after.val").cast("double").alias("after_val"), at("value", "$.schema.name").alias("schema_name"), "ts_ms", "dedup_id")


def _lsn():
    from tidelog.model import lsn_text

    return lsn_text(F.col("lsn"))


@query(WAL + "SELECT event_id, op FROM wal WHERE (key BETWEEN 3 AND 12 OR length('tsdb') = 4 AND key ** 2 > 400) AND upper(op) <> 'D'")
def sink_filter_calls(spark, sf):
    """Ranges, calls, powers, members of the key and of its descriptor."""
    events = _events(spark, sf).withColumn("key", F.struct(F.col("key").alias("id")))
    schemas = {"keySchema": schema.key_schema("pub", "tsdb", "events", EVENTS), "valueSchema": schema.envelope_schema("pub", "tsdb", "events", EVENTS)}
    condition = 'keySchema.fields[0].name == "id" && valueSchema.name endsWith ".Envelope" && (key.id in 3..12 || len(value.source.db) == 4 && key.id ** 2 > 400) && upper(value.op) != "D"'
    return exprfilter.apply_filters(events, [exprfilter.SinkFilter(condition)], F.lit("tsdb"), F.lit("events"), schemas).select("event_id", "op")


@query("""SELECT t AS type, k AS kind FROM (VALUES ('int2', 'int16'), ('int4', 'int32'), ('int8', 'int64'), ('float4', 'float32'), ('float8', 'float64'), ('bool', 'boolean'), ('text', 'string'), ('timestamptz', 'string'),
('numeric', 'float64'), ('date', 'int32'), ('hstore', 'map'), ('geometry', 'struct'), ('int4[]', 'array'), ('uuid', 'string')) v(t, k)""")
def type_schemas(spark, sf):
    names = ["int2", "int4", "int8", "float4", "float8", "bool", "text", "timestamptz", "numeric", "date", "hstore", "geometry", "int4[]", "uuid"]
    rows = spark.createDataFrame([(n, json.dumps(schema.type_schema(n))) for n in names], "type string, text string")
    return rows.select("type", F.get_json_object("text", "$.type").alias("kind"))


@query("SELECT o_orderkey, epoch_ms(o_orderdate) AS ms, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' AS utc FROM orders")
def conv_zone_free(spark, sf):
    """Timestamps read the same under any zone of the session."""
    return table(spark, sf, "orders").select("o_orderkey", C.timestamp(F.col("o_orderdate")).alias("ms"), C.timestamptz(F.col("o_orderdate")).alias("utc"))
