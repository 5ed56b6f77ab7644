"""Schema descriptors of events (what the envelope carries beside the payload), and the envelope itself.

A descriptor is a small dict that is known when the plan is built; it enters a plan as one JSON
literal, so no row computes it. Fields stand in their order. Of built descriptors optional ones say so
and others say nothing, as the format has it; those of keys and messages always say which.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.convert import TYPES, default_value
from tidelog.operators.catalog import ColumnDef

# Names of the schemas, by which consumers know them.
SOURCE_NAME = "io.debezium.connector.postgresql.Source"
MESSAGE_NAME = "io.debezium.connector.postgresql.Message"
MESSAGE_KEY_NAME = "io.debezium.connector.postgresql.MessageKey"
MESSAGE_VALUE_NAME = "io.debezium.connector.postgresql.MessageValue"
EVENT_NAME = "com.timescale.Event"
TYPE_NAMES = {
    "json": "io.debezium.data.Json", "jsonb": "io.debezium.data.Json", "uuid": "io.debezium.data.Uuid", "xml": "io.debezium.data.Xml",
    "enum": "io.debezium.data.Enum", "ltree": "io.debezium.data.Lree",
}
#: Descriptor types of Spark's simple types.
OF_SPARK = {"smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32", "double": "float64", "boolean": "boolean", "string": "string", "binary": "bytes"}

SPARK_TYPES = {
    "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(), "float32": T.FloatType(), "float64": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "bytes": T.BinaryType(),
}


def descriptor(kind: str, *, fields: list[dict] | None = None, keys: dict | None = None, values: dict | None = None, field: str = "", name: str = "", index: int = -1, optional: bool = False, default: str | None = None, **parameters) -> dict:
    """A descriptor; what is not set is left out. A default is what its literal reads as: boolean, integer, float or text."""
    found: dict = {"type": kind}
    for key, value, there in (
        ("keySchema", keys, keys is not None), ("valueSchema", values, values is not None), ("fields", fields, fields is not None), ("field", field, field != ""),
        ("name", name, name != ""), ("index", index, index > -1), ("optional", True, optional),
    ):
        if there:
            found[key] = value
    if default is not None:
        found["default"] = default_value(default)
    return found | parameters


def type_schema(kind: str, *, enum: list[str] | None = None, composite: list[ColumnDef] | None = None, **more) -> dict:
    """The descriptor of a database type's event value; `[]` at the end makes an array. Enums name their labels, composites their fields."""
    if kind.endswith("[]"):
        return descriptor("array", values=type_schema(kind[:-2], enum=enum, composite=composite), **more)
    if composite is not None:
        return descriptor("struct", fields=[column_schema(c, i) for i, c in enumerate(composite)], name=f"{kind}.Type", **more)
    if enum is not None:
        return descriptor("string", name=TYPE_NAMES["enum"], allowed=enum, **more)
    if kind in ("geometry", "geography"):
        return descriptor("struct", fields=[descriptor("string", field="wkb", index=0), descriptor("int32", field="srid", index=1)], **more)
    if kind == "hstore":
        return descriptor("map", keys=descriptor("string"), values=descriptor("string", optional=True), **more)
    named = {"name": TYPE_NAMES[kind]} if kind in TYPE_NAMES else {}
    return descriptor(OF_SPARK[TYPES[kind][0]], **named, **more)


def column_schema(c: ColumnDef, index: int = -1) -> dict:
    """A column's descriptor: its type, name, place, default, whether it may be null, and a declared length."""
    base = c.type.rstrip("[]")
    length = c.modifiers if base in ("bit", "varbit") and c.modifiers > 1 else c.modifiers - 4 if base in ("char", "varchar", "bpchar") and c.modifiers > 5 else None
    return type_schema(c.type, field=c.name, index=index, default=c.default, optional=c.nullable, **({} if length is None else {"length": length}))


def table_schema(schema: str, table: str, columns: list[ColumnDef], **more) -> dict:
    return descriptor("struct", fields=[column_schema(c, i) for i, c in enumerate(columns)], **more)


def key_schema(prefix: str, schema: str, table: str, columns: list[ColumnDef]) -> dict:
    """The primary key's columns, each with its place in the key."""
    keys = [c for c in columns if c.is_pk]
    inner = lambda c: {"type": type_schema(c.type)["type"], "optional": False}
    return {"type": "struct", "name": f"{prefix}.{schema}.{table}.Key", "optional": False, "fields": [{"name": c.name, "index": i, "schema": inner(c)} for i, c in enumerate(keys)]}


def _simple(field: str, kind: str, optional: bool) -> dict:
    return {"type": kind, "optional": optional, "field": field}


def event_key_schema() -> dict:
    """The key of compression events: schema and table."""
    return {"type": "struct", "name": EVENT_NAME, "optional": False, "fields": [_simple("schema", "string", False), _simple("table", "string", False)]}


def source_schema() -> dict:
    text, number = (lambda f: descriptor("string", field=f)), (lambda f: descriptor("int64", field=f))
    return descriptor(
        "struct", field="source", name=SOURCE_NAME,
        fields=[
            text("version"), text("connector"), text("name"), text("ts_ms"), descriptor("boolean", field="snapshot", default="false"),
            text("schema"), text("table"), number("txId"), number("lsn"), number("xmin"),
        ],
    )


def envelope_schema(prefix: str, schema: str, table: str, columns: list[ColumnDef]) -> dict:
    """The descriptor of a table's events: both images, source, op, tsdb_op and ts_ms."""
    at = f"{prefix}.{schema}.{table}"
    image = lambda field: table_schema(schema, table, columns, field=field, name=f"{at}.Value")
    ends = [descriptor("string", field="op"), descriptor("string", field="tsdb_op"), descriptor("int64", field="ts_ms")]
    return descriptor("struct", name=f"{at}.Envelope", fields=[image("before"), image("after"), source_schema(), *ends])


def message_block_schema() -> dict:
    return {"version": 1, "name": MESSAGE_NAME, "fields": [_simple("prefix", "string", False), _simple("content", "string", True)]}


def message_key_schema() -> dict:
    return {"version": 1, "name": MESSAGE_KEY_NAME, "fields": [_simple("prefix", "string", True)]}


def message_value_schema() -> dict:
    block = {"field": "message", "optional": False, "message": message_block_schema()}
    return {"version": 1, "name": MESSAGE_VALUE_NAME, "fields": [_simple("op", "string", False), _simple("ts_ms", "int64", True), source_schema(), block]}


def message_envelope_schema(prefix: str) -> dict:
    fields = [message_value_schema(), source_schema(), _simple("op", "string", False), _simple("tsdb_op", "string", True), _simple("ts_ms", "int64", True)]
    return {"type": "struct", "fields": fields, "optional": False, "name": f"{prefix}.message.Envelope"}


def schema_text(schema: dict) -> str:
    return json.dumps(schema, separators=(",", ":"), ensure_ascii=False)


def enveloped(schema: dict, payload: Column) -> Column:
    """{"schema": ..., "payload": ...} as JSON, explicit nulls kept; the schema is a literal."""
    return F.concat(F.lit('{"schema":' + schema_text(schema) + ',"payload":'), F.to_json(payload, {"ignoreNullFields": "false"}), F.lit("}"))


def message_key(prefix: Column) -> Column:
    return F.struct(prefix.alias("prefix"))


def event_key(schema: Column, table: Column) -> Column:
    return F.struct(schema.alias("schema"), table.alias("table"))


def spark_schema(schema: dict) -> T.DataType:
    """The Spark type of what a descriptor describes, its places and defaults as metadata."""
    kind = schema["type"]
    if kind == "struct":
        made = []
        for f in schema["fields"]:
            inner, name = f.get("schema", f), f.get("field") or f["name"]
            made.append(T.StructField(name, spark_schema(inner), inner.get("optional", False), {k: f[k] for k in ("index", "default", "length") if k in f}))
        return T.StructType(made)
    if kind == "array":
        return T.ArrayType(spark_schema(schema["valueSchema"]))
    if kind == "map":
        return T.MapType(spark_schema(schema["keySchema"]), spark_schema(schema["valueSchema"]))
    return SPARK_TYPES[kind]
