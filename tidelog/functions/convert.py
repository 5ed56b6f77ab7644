"""Converters: one Column builder for each database type. Nulls stay null; arrays convert element-wise."""

from __future__ import annotations

import base64
import json as json_lib
import re
import struct
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Database type -> (Spark type of its event value, converter name or None where the value is passed on).
TYPES: dict[str, tuple[str, str | None]] = {
    "bool": ("boolean", None), "int2": ("smallint", None), "int4": ("int", None), "int8": ("bigint", None), "float4": ("float", "float4"), "float8": ("double", "float8"),
    "numeric": ("double", "numeric"), "char": ("string", None), "varchar": ("string", None), "text": ("string", None), "name": ("string", None), '"char"': ("string", "qchar"),
    "timestamp": ("bigint", "timestamp"), "timestamptz": ("string", "timestamptz"), "date": ("int", "date"), "time": ("string", "time"), "timetz": ("string", "timetz"),
    "interval": ("bigint", "interval"), "bytea": ("string", "bytea"), "json": ("string", "json"), "jsonb": ("string", "json"), "uuid": ("string", "uuid"),
    "oid": ("bigint", "oid"), "xid": ("bigint", "oid"), "cid": ("bigint", "oid"), "cidr": ("string", None), "inet": ("string", "inet"), "macaddr": ("string", "macaddr"), "macaddr8": ("string", "macaddr"),
    "int4range": ("string", "int_range"), "int8range": ("string", "int_range"), "numrange": ("string", "num_range"), "tsrange": ("string", "ts_range"), "tstzrange": ("string", "tstz_range"),
    "daterange": ("string", "date_range"), "bit": ("string", None), "varbit": ("string", "bits"), "xml": ("string", None), "point": ("string", "point"), "box": ("string", "box"),
    "line": ("string", "line"), "lseg": ("string", "lseg"), "path": ("string", "path"), "polygon": ("string", "polygon"), "circle": ("string", "circle"), "ltree": ("string", None),
    "hstore": ("map<string,string>", "hstore"), "enum": ("string", "enum"), "geometry": ("struct<wkb:string,srid:int>", "ewkb"), "geography": ("struct<wkb:string,srid:int>", "ewkb"),
}


def _digits(c: Column) -> tuple[Column, Column, Column, Column]:
    """Sign, digits without trailing zeros, exponent of the first digit, and the text itself."""
    s = c.cast("double").cast("string")
    sign = F.when(s.startswith("-"), "-").otherwise("")
    plain = F.regexp_replace(s, "^-", "")
    mantissa, exponent = F.split_part(plain, F.lit("E"), F.lit(1)), F.when(plain.contains("E"), F.split_part(plain, F.lit("E"), F.lit(2)).cast("int")).otherwise(0)
    whole, frac = F.split_part(mantissa, F.lit("."), F.lit(1)), F.split_part(mantissa, F.lit("."), F.lit(2))
    every = F.concat(whole, frac)
    lead = F.length(F.regexp_extract(every, "^(0*)", 1))
    digits = F.regexp_replace(F.regexp_replace(every, "^0+", ""), "0+$", "")
    return sign, digits, exponent + F.length(whole) - 1 - lead, s


def _once(c: Column, body) -> Column:
    """body(parts of c's digits), the digits taken apart once and not at each use."""
    sign, d, e, s = _digits(c)
    parts = F.struct(sign.alias("sign"), d.alias("d"), e.alias("e"), s.alias("s"))
    return F.element_at(F.transform(F.array(parts), lambda x: F.when(x["s"].isNotNull(), body(x["sign"], x["d"], x["e"], x["s"]))), 1)


def _plain(sign: Column, d: Column, e: Column, s: Column) -> Column:
    n = F.length(d)
    text = (
        F.when(n == 0, "0")
        .when(e < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), d))
        .when(e >= n - 1, F.concat(d, F.repeat(F.lit("0"), e - n + 1)))
        .otherwise(F.concat(F.substr(d, F.lit(1), e + 1), F.lit("."), F.substr(d, e + 2, n)))
    )
    odd = F.when(s == "Infinity", "+Inf").when(s == "-Infinity", "-Inf").when(s == "NaN", "NaN")
    return F.coalesce(odd, F.concat(F.when(n == 0, "").otherwise(sign), text))


def _short(sign: Column, d: Column, e: Column, s: Column) -> Column:
    power = F.concat(F.when(e < 0, "e-").otherwise("e+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
    long = F.concat(sign, F.substr(d, F.lit(1), F.lit(1)), F.when(F.length(d) > 1, F.concat(F.lit("."), F.substr(d, F.lit(2), F.length(d)))).otherwise(""), power)
    return F.when((F.length(d) > 0) & ((e < -4) | (e >= 6)) & ~s.isin("NaN", "Infinity", "-Infinity"), long).otherwise(_plain(sign, d, e, s))


def f64_text(c: Column) -> Column:
    """A double as its shortest decimal, never with an exponent: 12, 0.5, 100000000000000000000."""
    return _once(c, _plain)


def g_text(c: Column) -> Column:
    """A double as %g writes its shortest form: an exponent from 1e+06 on and below 1e-04."""
    return _once(c, _short)


def float4(c: Column) -> Column:
    return c.cast("float")


def float8(c: Column) -> Column:
    return c.cast("double")


numeric = float8


def date(c: Column) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(c.cast("date"))


def qchar(c: Column) -> Column:
    """The "char" type: a code point."""
    return F.char(c)


def wall_clock(c: Column) -> Column:
    """The clock reading of a timestamp, without zone."""
    return c.cast("timestamp_ntz")


def utc_clock(c: Column) -> Column:
    """The clock reading in UTC of an instant, whatever the session's zone; a timestamp without zone is UTC already."""
    since = F.make_dt_interval(secs=(F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))
    return F.when(F.typeof(c) == "timestamp", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since).otherwise(wall_clock(c))


def timestamp(c: Column) -> Column:
    """Milliseconds since the epoch of a timestamp without zone, read as UTC."""
    t = wall_clock(c)
    seconds = F.unix_date(t.cast("date")).cast("bigint") * 86_400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return seconds * 1000 + F.floor(F.date_part(F.lit("SECOND"), t) % 1 * 1000).cast("bigint")


def micros_of_day(c: Column) -> Column:
    """Microseconds since midnight of a timestamp's clock reading."""
    t = wall_clock(c)
    return (F.hour(t) * 3600 + F.minute(t) * 60).cast("bigint") * 1_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint")


def timestamptz(c: Column) -> Column:
    """RFC 3339 in UTC with a trimmed fraction."""
    return F.concat(timestamp_text(utc_clock(c)), F.lit("Z"))


def timestamp_text(c: Column) -> Column:
    """A timestamp without zone as text, its fraction trimmed."""
    return F.replace(wall_clock(c).cast("string"), F.lit(" "), F.lit("T"))


def time(micros: Column) -> Column:
    """Microseconds of a day as HH:MM:SS.ffffff."""
    s = (micros / 1_000_000).cast("bigint")
    return F.format_string("%02d:%02d:%02d.%06d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60, micros % 1_000_000)


def timetz(micros: Column, zone_seconds: Column) -> Column:
    """A time with zone, brought to UTC within the day."""
    return time(F.pmod(micros + zone_seconds.cast("bigint") * 1_000_000, F.lit(86_400_000_000)))


def timetz_text(text: Column) -> Column:
    """HH:MM:SS.ffffffZhh:mm (the zone is added) as UTC time."""
    part = lambda i: F.regexp_extract(text, r"^(\d+):(\d+):(\d+)(?:\.(\d+))?(?:Z|([+-]))?(?:(\d+):(\d+))?$", i)
    n = lambda i: F.coalesce(F.try_to_number(F.nullif(part(i), F.lit("")), F.lit("999999999")).cast("bigint"), F.lit(0))
    micros = ((n(1) * 60 + n(2)) * 60 + n(3)) * 1_000_000 + F.rpad(part(4), 6, "0").cast("bigint")
    return timetz(micros, (n(6) * 60 + n(7)) * 60 * F.when(part(5) == "-", -1).otherwise(1))


def _big_endian(raw: Column, start: int, size: int) -> Column:
    """A signed number of `size` bytes."""
    half = 1 << (8 * size - 1)
    n = F.conv(F.hex(F.substring(raw, start, size)), 16, 10).cast("decimal(20,0)")
    return F.when(n >= F.lit(str(half)).cast("decimal(20,0)"), n - F.lit(str(2 * half)).cast("decimal(20,0)")).otherwise(n).cast("bigint")


def timetz_binary(raw: Column) -> Column:
    """The twelve bytes of a time with zone: microseconds, then seconds of the zone (added). Other lengths are an error."""
    wrong = F.raise_error(F.concat(F.lit("a time with zone has 12 bytes, not "), F.length(raw).cast("string")))
    return F.when(raw.isNull(), F.lit(None).cast("string")).when(F.length(raw) == 12, timetz(_big_endian(raw, 1, 8), _big_endian(raw, 9, 4))).otherwise(wrong.cast("string"))


def interval(months: Column, days: Column, micros: Column) -> Column:
    """Microseconds; a month counts a twelfth of 365.25 days."""
    return micros + days * 86_400_000_000 + F.round(months * (365.25 / 12) * 86_400_000_000.0).cast("bigint")


def bytea(c: Column) -> Column:
    return F.lower(F.hex(c))


def uuid(c: Column) -> Column:
    """Sixteen bytes as 8-4-4-4-12."""
    return F.regexp_replace(F.lower(F.hex(c)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def bits(raw: Column, length: Column) -> Column:
    """A bit string from its bytes and its number of bits."""
    every = F.array_join(F.transform(F.sequence(F.lit(1), F.length(raw)), lambda i: F.lpad(F.conv(F.hex(F.substring(raw, i, F.lit(1))), 16, 2), 8, "0")), "")
    return F.substr(every, F.lit(1), length)


def _json_number(x: float) -> str:
    if x != x or x in (float("inf"), float("-inf")):
        raise ValueError("not a JSON number")
    sign, digits, power = Decimal(repr(x)).as_tuple()
    text = "".join(map(str, digits)).rstrip("0")
    if not text:
        return "-0" if sign else "0"
    first = len(digits) + power - 1  # exponent of the first digit
    if -7 < first < 21:
        text = format(Decimal((sign, tuple(map(int, text)), first + 1 - len(text))), "f")
        return text
    return ("-" if sign else "") + text[0] + ("." + text[1:] if text[1:] else "") + f"e{first:+03d}".replace("e-0", "e-")


#: Characters that JSON text of events writes as escapes.
_ESCAPES = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t"} | {c: f"\\u{ord(c):04x}" for c in [*map(chr, range(32)), *"<>&\u2028\u2029"] if c not in "\n\r\t"}
_ESCAPED = re.compile('[\\x00-\\x1f"\\\\<>&\u2028\u2029\ud800-\udfff]')


def _json_text(v) -> str:
    if isinstance(v, str):
        return '"' + _ESCAPED.sub(lambda m: _ESCAPES.get(m[0], "\ufffd"), v) + '"'
    if isinstance(v, dict):
        return "{" + ",".join(f"{_json_text(k)}:{_json_text(v[k])}" for k in sorted(v)) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(_json_text, v)) + "]"
    return {None: "null", True: "true", False: "false"}[v] if v is None or isinstance(v, bool) else _json_number(float(v))


def _no_constant(name: str):
    raise ValueError(name)


def json_object(text: str | None) -> str | None:
    """An object as compact text: keys sorted at each depth, numbers as doubles, < > & escaped. Anything else as it stands."""
    if text is None or not text.lstrip().startswith("{"):
        return text
    try:
        return _json_text(json_lib.loads(text, parse_constant=_no_constant))
    except (ValueError, RecursionError, OverflowError):
        return text


def json(c: Column) -> Column:
    """Objects as compact text with sorted keys (`json_object`), in Arrow batches: no built-in function keeps the types of nested members."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(json_object, na_action="ignore")

    return F.pandas_udf(run, T.StringType())(c.cast("string"))


def oid(c: Column) -> Column:
    return c.cast("bigint")


def macaddr(c: Column) -> Column:
    return F.lower(c)


def inet(c: Column) -> Column:
    """Always with a prefix length."""
    return F.when(c.contains("/"), c).when(c.contains(":"), F.concat(c, F.lit("/128"))).otherwise(F.concat(c, F.lit("/32")))


def enum(c: Column) -> Column:
    return c.cast("string")


def hstore(text: Column) -> Column:
    """key=>value pairs, quoted or not, as a map."""
    pairs = F.regexp_extract_all(text, F.lit(r'("(?:[^"\\]|\\.)*"|[^,=>\s]+)\s*=>\s*("(?:[^"\\]|\\.)*"|[^,\s]+)'), F.lit(0))
    part = lambda p, i: F.regexp_replace(F.regexp_replace(F.regexp_extract(p, r'^("(?:[^"\\]|\\.)*"|[^,=>\s]+)\s*=>\s*(.*)$', i), '^"|"$', ""), r"\\(.)", "$1")
    value = lambda p: F.when(F.lower(F.regexp_extract(p, r"=>\s*(.*)$", 1)) == "null", F.lit(None)).otherwise(part(p, 2))
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(part(p, 1), value(p))))


def point(p: Column) -> Column:
    return F.concat(F.lit("("), f64_text(p["x"]), F.lit(","), f64_text(p["y"]), F.lit(")"))


def box(a: Column, b: Column) -> Column:
    """Upper right corner first."""
    corner = lambda f: F.struct(f(a["x"], b["x"]).alias("x"), f(a["y"], b["y"]).alias("y"))
    return F.concat(point(corner(F.greatest)), F.lit(","), point(corner(F.least)))


def line(a: Column, b: Column, c: Column) -> Column:
    return F.concat(F.lit("{"), f64_text(a), F.lit(","), f64_text(b), F.lit(","), f64_text(c), F.lit("}"))


def lseg(a: Column, b: Column) -> Column:
    return F.concat(F.lit("["), point(a), F.lit(","), point(b), F.lit("]"))


def _points(ps: Column) -> Column:
    return F.array_join(F.transform(ps, point), ",")


def path(ps: Column, closed: Column) -> Column:
    return F.concat(F.when(closed, "(").otherwise("["), _points(ps), F.when(closed, ")").otherwise("]"))


def polygon(ps: Column) -> Column:
    return F.concat(F.lit("("), _points(ps), F.lit(")"))


def circle(p: Column, r: Column) -> Column:
    return F.concat(F.lit("<"), point(p), F.lit(","), f64_text(r), F.lit(">"))


def range_text(r: Column, fmt) -> Column:
    """STRUCT<lo, hi, lo_inc, hi_inc, is_empty> as text: unbounded ends are empty, an empty range is `empty`."""
    low, high = F.when(r["lo_inc"] & r["lo"].isNotNull(), "[").otherwise("("), F.when(r["hi_inc"] & r["hi"].isNotNull(), "]").otherwise(")")
    end = lambda v: F.coalesce(fmt(v), F.lit(""))
    return F.when(F.coalesce(r["is_empty"], F.lit(False)), "empty").otherwise(F.concat(low, end(r["lo"]), F.lit(","), end(r["hi"]), high))


def _closed_open(r: Column, one) -> Column:
    """Discrete ranges in their canonical form [lo, hi)."""
    lo, hi = F.when(r["lo_inc"], r["lo"]).otherwise(one(r["lo"])), F.when(r["hi_inc"], one(r["hi"])).otherwise(r["hi"])
    return F.struct(lo.alias("lo"), hi.alias("hi"), F.lit(True).alias("lo_inc"), F.lit(False).alias("hi_inc"), (F.coalesce(r["is_empty"], F.lit(False)) | F.coalesce(lo >= hi, F.lit(False))).alias("is_empty"))


def int_range(r: Column) -> Column:
    return range_text(_closed_open(r, lambda v: v + 1), lambda v: v.cast("string"))


def num_range(r: Column) -> Column:
    return range_text(r, g_text)


def ts_range(r: Column) -> Column:
    return range_text(r, timestamp_text)


def tstz_range(r: Column) -> Column:
    return range_text(r, timestamptz)


def date_range(r: Column) -> Column:
    return range_text(_closed_open(r, lambda v: F.date_add(v, 1)), lambda v: v.cast("string"))


# Flags and codes of geometry types in EWKB, and what WKB adds to a code for its dimensions.
EWKB_Z, EWKB_M, EWKB_SRID = 0x80000000, 0x40000000, 0x20000000
POINT, LINE, POLYGON, MULTI_POINT, MULTI_LINE, MULTI_POLYGON, COLLECTION = range(1, 8)
WKB_Z, WKB_M = 1000, 2000


def wkb_of(raw: bytes) -> tuple[bytes, int]:
    """Big-endian WKB and SRID of EWKB of any of the seven types, in either byte order, with Z and M."""
    out: list[bytes] = []
    srid = 0

    def geometry(at: int) -> int:
        nonlocal srid
        order = "<" if raw[at] == 1 else ">"
        number = lambda k: struct.unpack_from(order + "I", raw, k)[0]
        code, at = number(at + 1), at + 5
        kind, dims = code & 0xFFFF, 2 + bool(code & EWKB_Z) + bool(code & EWKB_M)
        if not POINT <= kind <= COLLECTION:
            raise ValueError(f"geometry type {kind} is not supported")
        if code & EWKB_SRID:
            srid, at = struct.unpack_from(order + "i", raw, at)[0], at + 4
        out.append(b"\0" + struct.pack(">I", kind + WKB_Z * bool(code & EWKB_Z) + WKB_M * bool(code & EWKB_M)))

        def points(n: int, at: int) -> int:
            values = np.frombuffer(raw, order + "f8", n * dims, at)
            out.append(values.astype(">f8").tobytes())
            return at + 8 * n * dims

        def counted(at: int) -> tuple[int, int]:
            out.append(struct.pack(">I", number(at)))
            return number(at), at + 4

        if kind == POINT:
            return points(1, at)
        n, at = counted(at)
        if kind == LINE:
            return points(n, at)
        for _ in range(n):
            at = points(*counted(at)) if kind == POLYGON else geometry(at)
        return at

    end = geometry(0)
    if end != len(raw):
        raise ValueError(f"{len(raw) - end} bytes after a geometry's end")
    return b"".join(out), srid


def ewkb(raw: Column) -> Column:
    """EWKB as big-endian WKB in base64, and the SRID; in Arrow batches, as its parts nest."""

    def run(values: pd.Series) -> pd.DataFrame:
        found = [(None, None) if v is None else wkb_of(v) for v in values]
        return pd.DataFrame({"wkb": [None if b is None else base64.b64encode(b).decode() for b, _ in found], "srid": pd.array([n for _, n in found], "Int32")})

    shape = T.StructType([T.StructField("wkb", T.StringType()), T.StructField("srid", T.IntegerType())])
    return F.when(raw.isNotNull(), F.pandas_udf(run, shape)(raw))


def ltree_binary(raw: Column) -> Column:
    """A version byte (1, or it is an error), then the path."""
    wrong = F.raise_error(F.lit("a path of labels begins with version 1")).cast("string")
    return F.when(raw.isNull(), F.lit(None).cast("string")).when((F.length(raw) > 1) & (F.hex(F.substring(raw, 1, 1)) == "01"), F.decode(F.substring(raw, F.lit(2), F.length(raw)), "UTF-8")).otherwise(wrong)


def array_text(text: Column, delimiter: str = ",") -> Column:
    """The elements of an array's text form {a,"b c",NULL}, with its type's delimiter; one dimension."""
    d = re.escape(delimiter)
    each = F.regexp_extract_all(F.regexp_extract(text, r"(?s)^\s*\{(.*)\}\s*$", 1), F.lit(rf'(?s)"(?:[^"\\]|\\.)*"|[^{d}"\s](?:[^{d}"]*[^{d}"\s])?'), F.lit(0))
    plain = lambda x: F.regexp_replace(F.regexp_replace(x, '(?s)^"(.*)"$', "$1"), r"(?s)\\(.)", "$1")
    return F.transform(each, lambda x: F.when(F.lower(x) != "null", plain(x)))


def array_of(c: Column, convert) -> Column:
    """Element-wise conversion; null elements stay null."""
    return F.transform(c, lambda x: F.when(x.isNotNull(), convert(x)))


def composite(fields: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def field_length(kind: str, modifier: Column) -> Column:
    """Declared length of a column: bit types their modifier if over 1, character types the modifier less 4 if over 5; else none."""
    if kind.rstrip("[]") in ("bit", "varbit"):
        return F.when(modifier > 1, modifier)
    if kind.rstrip("[]") in ("char", "varchar", "bpchar"):
        return F.when(modifier > 5, modifier - 4)
    return F.lit(None).cast("int")


# Literals that are booleans.
BOOLEANS = {"1": True, "t": True, "T": True, "TRUE": True, "true": True, "True": True, "0": False, "f": False, "F": False, "FALSE": False, "false": False, "False": False}


def default_value(text: str) -> bool | int | float | str:
    """A default literal by the rules of `default_kind`."""
    if text in BOOLEANS:
        return BOOLEANS[text]
    if re.fullmatch(r"[+-]?\d+", text) and -(1 << 63) <= int(text) < 1 << 63:
        return int(text)
    return float(text) if re.fullmatch(r"(?i)[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)", text) else text


def fnv1_64(text: Column) -> Column:
    """struct(hi, lo): the halves of the 64-bit FNV-1a hash of a text's bytes, in numbers that never overflow."""
    low = 0xFFFFFFFF
    byte = lambda i: F.conv(F.hex(F.substring(text.cast("binary"), i, F.lit(1))), 16, 10).cast("bigint")

    def step(h: Column, i: Column) -> Column:  # times 2**40 + 435
        x = h["lo"].bitwiseXOR(byte(i))
        small = x * 435
        return F.struct((h["hi"] * 435 + F.shiftright(small, 32) + x * 256).bitwiseAND(low).alias("hi"), small.bitwiseAND(low).alias("lo"))

    start = F.struct(F.lit(0xCBF29CE4).cast("bigint").alias("hi"), F.lit(0x84222325).cast("bigint").alias("lo"))
    places = F.when(F.octet_length(text) > 0, F.sequence(F.lit(1), F.octet_length(text))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, start, step)


def partition_of(text: Column, n: int) -> Column:
    """The hash modulo n: which of n snapshot workers a table belongs to."""
    h = fnv1_64(text)
    return ((h["hi"] % n * ((1 << 32) % n) + h["lo"] % n) % n).cast("int")


def default_kind(text: Column) -> Column:
    """What a default literal is: boolean, then integer, then float, then string."""
    number = r"(?i)^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf|infinity|nan)$"
    return F.when(text.isin(*BOOLEANS), "boolean").when(text.rlike(r"^[+-]?\d+$"), "integer").when(text.rlike(number), "float").otherwise("string")


def spark_type(kind: str) -> T.DataType:
    """Spark type of a database type's event value; `[]` at the end makes an array."""
    if kind.endswith("[]"):
        return T.ArrayType(spark_type(kind[:-2]))
    return T._parse_datatype_string(TYPES[kind][0])


def version_number(text: Column, parts: int = 2) -> Column:
    """maj.min(.rel) as one number: two digits for each of the following parts."""
    n = lambda i: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(text, r"(\d+)\.(\d+)(?:\.(\d+))?", i), F.lit("")), F.lit("99999")).cast("int"), F.lit(0))
    return n(1) * 10000 + n(2) * 100 + n(3) if parts == 3 else n(1) * 10000 + n(2)
