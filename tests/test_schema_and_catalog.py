"""Descriptors, envelopes, JSON text, geometry, codecs, catalog scans, start modes, sinks and streams."""

import base64
import datetime
import json
import struct

import pytest
from pyspark.sql import functions as F
from tests.conftest import SF, same_rows
from tidelog import schema, sinks
from tidelog.functions import convert as C
from tidelog.operators import exprfilter, scans, snapshot
from tidelog.operators.catalog import ColumnDef
from tidelog.plans.queries import ORACLE_SQL, QUERIES

COLUMNS = [ColumnDef("id", "int4", is_pk=True), ColumnDef("name", "varchar", 24, nullable=True), ColumnDef("on", "bool", default="t"), ColumnDef("at", "geometry", nullable=True)]


def test_descriptors():
    found = schema.table_schema("s", "t", COLUMNS)
    assert found["fields"][0] == {"type": "int32", "field": "id", "index": 0}
    assert found["fields"][1] == {"type": "string", "field": "name", "index": 1, "optional": True, "length": 20}
    assert found["fields"][2]["default"] is True
    assert [f["field"] for f in found["fields"][3]["fields"]] == ["wkb", "srid"]
    key = schema.key_schema("p", "s", "t", COLUMNS)
    assert key["name"] == "p.s.t.Key" and key["fields"] == [{"name": "id", "index": 0, "schema": {"type": "int32", "optional": False}}]
    assert [f["field"] for f in schema.envelope_schema("p", "s", "t", COLUMNS)["fields"]] == ["before", "after", "source", "op", "tsdb_op", "ts_ms"]
    assert schema.message_envelope_schema("p")["fields"][0]["fields"][3]["message"]["name"] == schema.MESSAGE_NAME
    assert schema.spark_schema(found).simpleString() == "struct<id:int,name:string,on:boolean,at:struct<wkb:string,srid:int>>"
    assert schema.type_schema("color", enum=["a", "b"])["allowed"] == ["a", "b"] and schema.type_schema("hstore")["keySchema"] == {"type": "string"}


@pytest.mark.parametrize("text,want", [("1", True), ("0", False), ("True", True), ("tRUE", "tRUE"), ("12", 12), ("-7", -7), ("1.5", 1.5), (".5", 0.5), ("1e3", 1000.0), ("99999999999999999999", 1e20), ("x", "x"), ("", "")])
def test_defaults(spark, text, want):
    assert C.default_value(text) == want and type(C.default_value(text)) is type(want)
    kind = spark.range(1).select(C.default_kind(F.lit(text))).first()[0]
    assert kind in {bool: ("boolean",), int: ("integer",), float: ("float", "integer"), str: ("string",)}[type(want)]


def test_json_text(spark):
    cases = {
        '{"b":"12","a":"true","c":"[x","d":"l1\\nl2","f":"<&>"}': '{"a":"true","b":"12","c":"[x","d":"l1\\nl2","f":"\\u003c\\u0026\\u003e"}',
        '{ "z" : {"y": [1.0, 1e21, 1e-7, 2.50], "x": null}, "é": "\\u2028\\u0007" }': '{"z":{"x":null,"y":[1,1e+21,1e-7,2.5]},"é":"\\u2028\\u0007"}',
        "{}": "{}", "[1, 2]": "[1, 2]", "no json": "no json", '{"a":': '{"a":', '{"a":NaN}': '{"a":NaN}', '{"a":1,"a":2}': '{"a":2}',
    }
    df = spark.createDataFrame([*((k,) for k in cases), (None,)], "t string").select("t", C.json(F.col("t")).alias("j"))
    assert {r.t: r.j for r in df.collect()} == cases | {None: None}
    assert all(json.loads(v) == json.loads(k) for k, v in list(cases.items())[:3])


def test_geometry():
    xyzm = struct.pack("<BIi", 1, 1 | C.EWKB_Z | C.EWKB_M | C.EWKB_SRID, 4326) + struct.pack("<4d", 1, 2, 3, 4)
    assert C.wkb_of(xyzm) == (struct.pack(">BI4d", 0, 3001, 1, 2, 3, 4), 4326)
    big = struct.pack(">BII", 0, 2, 2) + struct.pack(">4d", 1, 2, 3, 4)
    assert C.wkb_of(big) == (big, 0)
    ring = struct.pack("<I8d", 4, 0, 0, 1, 0, 1, 1, 0, 0)
    shapes = struct.pack("<BII", 1, 6, 1) + struct.pack("<BII", 1, 3, 2) + ring + ring
    out, _ = C.wkb_of(shapes)
    assert len(out) == len(shapes) and out[:9] == struct.pack(">BII", 0, 6, 1)
    for bad in (struct.pack("<BI", 1, 8), shapes + b"x"):
        with pytest.raises(ValueError):
            C.wkb_of(bad)
    with pytest.raises((ValueError, struct.error)):
        C.wkb_of(shapes[:-1])


def test_geometry_nulls(spark):
    row = spark.createDataFrame([(None,), (bytes.fromhex("010100000000000000000024C000000000000034C0"),)], "g binary").select(C.ewkb(F.col("g")).alias("g")).collect()
    assert row[0].g is None and base64.b64decode(row[1].g.wkb) == struct.pack(">BI2d", 0, 1, -10, -20)


def test_codecs(spark):
    df = spark.range(1).select(
        C.timetz_binary(F.unhex(F.lit(struct.pack(">qi", 3_600_000_001, -7200).hex()))).alias("t"), C.array_text(F.lit('{a,"b \\"c\\"",NULL,"NULL",d e}')).alias("a"), C.array_text(F.lit("{}")).alias("none"),
        C.partition_of(F.lit(""), 5).alias("p"), C.ltree_binary(F.unhex(F.lit("01612E62"))).alias("l"),
    )
    row = df.first()
    assert (row.t, row.a[0], row.a[1], row.a[2], row.a[4], row.none, row.l) == ("23:00:00.000001", "a", 'b "c"', None, "d e", [], "a.b")
    assert row.p == 0xCBF29CE484222325 % 5
    with pytest.raises(Exception, match="12 bytes"):
        spark.range(1).select(C.timetz_binary(F.unhex(F.lit("00")))).collect()


@pytest.mark.parametrize("name", ["conv_timestamptz", "conv_timestamp", "conv_time", "conv_timetz", "conv_ts_date_ranges", "conv_zone_free", "event_update", "cagg_day_max", "chunk_assign", "replay_end_to_end"])
def test_any_zone(spark, oracle, name):
    if name not in QUERIES:
        pytest.skip(name)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        same_rows(spark, oracle, QUERIES[name], ORACLE_SQL[name], SF)
        at = spark.sql("SELECT timestamp'2024-03-10 12:00:00Z' AS t").select(C.timestamptz(F.col("t"))).first()[0]
        assert at == "2024-03-10T12:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_filter_calls(spark):
    df = spark.createDataFrame([(1, "abc", [1, 2, 3]), (7, "x", [5])], "id int, name string, tags array<int>")
    true = {
        "id in 1..3": [1], "len(name) == 3": [1], "count(tags, {true}) == 1": [7], "id ** 2 == 49": [7], "any(tags, {# > 4})": [7], "all(tags, {# < 4})": [1], "none(tags, {# == 2 || # == 9})": [7], "count(tags, {# >= 2}) == 2": [1],
        "one(tags, {# == 5})": [7], 'upper(name) in ["ABC", "Y"]': [1], "max(id, 5) == 5": [1], "2 in tags": [1], "not (id in 1..3)": [7], 'keySchema.fields[0].name == "id" and id == 7': [7], "keySchema.none == nil": [1, 7],
    }
    schemas = {"keySchema": schema.key_schema("p", "s", "t", COLUMNS)}
    for condition, ids in true.items():
        assert sorted(r.id for r in df.filter(exprfilter.compile_condition(condition, schemas)).collect()) == ids, condition
    for bad in ("1..3", "name.foo(1)", "nope(1)", "any(tags, # > 1)", "# > 1", "len()"):
        with pytest.raises(exprfilter.FilterError):
            exprfilter.compile_condition(bad)


def test_start_modes():
    assert snapshot.start("never", None, True, "n") == ("replicate", "")
    assert snapshot.start("initial_only", None, True, "n") == ("snapshot", "n") and snapshot.start("initial_only", None, False) == ("replicate", "")
    begun = {"snapshot": True, "snapshot_name": "old"}
    assert snapshot.start("initial_only", begun, False, "n") == ("resume", "old") and snapshot.start("initial_only", {"snapshot": False}, False) == ("replicate", "")
    assert snapshot.start("always", begun, True, "n") == ("snapshot", "n")
    for mode, offset, created in (("always", None, False), ("initial_only", begun, True)):
        with pytest.raises(ValueError):
            snapshot.start(mode, offset, created)


def test_snapshot_resumes(spark):
    """A table is read in ranges; a run that stops after some of them goes on above its low watermark."""
    df = spark.createDataFrame([(k // 3, k) for k in range(100)], "a int, b int")
    parts = snapshot.ranges(df, ["a", "b"], 4)
    assert len(parts) >= 3 and parts[0][0] is None and parts[-1][1] == (33, 99)
    rows = [sorted(map(tuple, snapshot.range_rows(df, ["a", "b"], low, high).collect())) for low, high in parts]
    assert sorted(x for r in rows for x in r) == [(k // 3, k) for k in range(100)]
    done, left = rows[:2], [r for low, high in parts if low is not None and low >= parts[1][1] for r in snapshot.range_rows(df, ["a", "b"], low, high).collect()]
    assert len(left) + sum(map(len, done)) == 100
    assert snapshot.ranges(df.limit(0), ["a", "b"], 4) == []


def test_sql_text():
    import duckdb

    con = duckdb.connect()
    values = [(None, "string"), ("it's", "string"), (3, "int32"), (-0.5, "float64"), (True, "boolean"), (datetime.datetime(2024, 1, 2, 3, 4, 5), "string")]
    assert con.execute("SELECT " + ", ".join(snapshot.literal_text(v, k) for v, k in values)).fetchone()[:2] == (None, "it's")
    assert snapshot.literal_text(b"\x01\xff", "bytes") == "bytea '\\x01FF'" and snapshot.literal_text([1, None], "array") == "'{1,NULL}'"
    assert snapshot.order_text(["a", "b"], True) == "a DESC,b DESC" and snapshot.after_text(["a", "b"], ["int32", "string"], (1, "x")) == "(a,b) > (1,'x')"


def test_scans(spark):
    slots = spark.createDataFrame([("a", "pgoutput", "logical", 5, 6), ("b", "pgoutput", "logical", None, None)], "slot_name string, plugin string, slot_type string, restart_lsn long, confirmed_flush_lsn long")
    assert scans.replication_slot(slots, "a")["restart_lsn"] == 5 and scans.replication_slot(slots, "c") is None
    with pytest.raises(ValueError):
        scans.replication_slot(slots, "b")
    pubs = spark.createDataFrame([("p", "s", "t")], "pubname string, schemaname string, tablename string")
    assert scans.is_published(pubs, "p", "s", "t") and not scans.is_published(pubs, "p", "s", "u") and not scans.publication_exists(pubs, "q")
    users = spark.createDataFrame([(1, "me"), (2, "you")], "usesysid int, usename string")
    assert scans.owner_found(users, "me", F.lit(1)).count() == 1 and scans.owner_found(users, "me", F.lit(2)).count() == 0 and scans.owner_found(users, "who", F.lit(1)).count() == 0


def test_sinks_get_time_and_dedup_id(spark, tmp_path):
    out = tmp_path / "sent"

    class Keep(sinks.Sink):
        def emit(self, topic, key, value, ts_ms=None, dedup_id=None):
            with open(out, "a") as f:
                f.write(json.dumps([topic, ts_ms, dedup_id, json.loads(value)["payload"]["id"]]) + "\n")

    events = spark.createDataFrame([(2, 20), (1, 10)], "lsn long, ts long")
    ids = F.struct(F.col("lsn").alias("id"))
    found = sinks.records(events, "p", ids, F.lit("s"), F.lit("t"), ids, value_schema={"type": "struct"}, ts_ms=F.col("ts"), dedup_id=F.concat(F.lit("d"), F.col("lsn").cast("string")))
    sinks.write_batch(found, Keep)
    assert [json.loads(x) for x in out.read_text().splitlines()] == [["p.s.t", 10, "d1", 1], ["p.s.t", 20, "d2", 2]]
    sent = []
    sinks.SqsSink(lambda **k: sent.append(k), "q").emit("t", None, "v", 1, "D")
    assert sent[0]["MessageDeduplicationId"] == "D"


def test_transactions_of_equal_positions(spark, tmp_path):
    from tidelog.streaming.transactions import committed

    rows = [(1, 10, "I", "a"), (1, 10, "I", None), (1, 10, "U", "b"), (1, 11, "C", None)]
    spark.createDataFrame(rows, "xid long, lsn long, kind string, body string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("xid long, lsn long, kind string, body string").parquet(str(tmp_path / "in"))
    q = committed(stream).writeStream.outputMode("append").format("memory").queryName("ties").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.kind, r.body) for r in spark.table("ties").collect()] == [("I", "a"), ("I", None), ("U", "b")]
