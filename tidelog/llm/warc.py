"""WARC archives: writing, reading, and assembling transactions.

Writing. Each page becomes a request, a response (or revisit) and a metadata record; request and
metadata name the response by WARC-Concurrent-To. A record ends with two line breaks, so Spark's
text writer, with that as its line separator, writes the archives to any file system it knows.
Of pages with equal payloads of `least` bytes or more, the smallest id is the response and the
others are revisits that refer to it. Reading splits archives by Content-Length, never by a
pattern that a payload may hold, and checks each stored payload against its digest. Assembly joins
request and metadata to their response by the concurrent-to identifiers and emits one nested row
for each capture.

Equal payloads are found by digest with partial aggregation by (digest, salt of id and url), then by
digest; what a group's first row is goes back by (digest, salt), so a payload that a third of the
pages share is spread over many tasks. Archives are read as streams, chunk by chunk between double
line breaks, so a task holds one record and never a file, whatever the file's size.

Defined cases: a null html is an empty payload; a null url gives records without a target; line
breaks in a url are percent-encoded; rows that repeat id and payload are numbered and stay
separate captures, the first one being the response; null ids come last: rows without an id revisit
the group's smallest id, and where no row has an id one is the response and the others revisit it
(refers_to is null then); pages of any length are one record each; an empty table gives no captures;
columns other than id, url and html, whatever their names, are not archived.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import bound_batches, discard, materialise, scratch

END = "\r\n\r\n"
SALTS = 4096  #: only those that occur are rows
RECORD = "record_id string, type string, concurrent_to string, refers_to string, uri string, payload_bytes long, payload_digest string, payload binary, fields map<string,string>"


def _urn(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *[p.cast("string") for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _record(kind: Column | str, record_id: Column, headers: list[Column], content_type: str, block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit("WARC-Date: 2024-01-01T00:00:00Z"), *headers, F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def write(df: DataFrame, path: str, id_col: str = "page_id", url: str = "url", html: str = "html", *, least: int = 100, per_file: int = 6000) -> None:
    """Archives of all rows of df under path, gzip-compressed."""
    body = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    target = F.regexp_replace(F.regexp_replace(F.col(f"`{url}`").cast("string"), "\r", "%0D"), "\n", "%0A")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), target.alias("url"), body.alias("html")).withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "bytes": F.octet_length("html").cast("bigint")})
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
    runs = rows.filter(F.col("bytes") >= least).groupBy("digest", "salt").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("low"), F.count("*").alias("n"))
    group = Window.partitionBy("digest")  # a row for each salt
    groups = runs.withColumns({"first": F.min(F.struct("low.none", "low.id", "salt")).over(group), "n": F.sum("n").over(group)}).filter("n > 1")
    groups = groups.select(F.col("digest").alias("_d"), F.col("salt").alias("_s"), "first")
    joined = rows.join(groups, (F.col("digest") == F.col("_d")) & (F.col("salt") == F.col("_s")), "left")
    joined = joined.withColumn("copy", F.row_number().over(Window.partitionBy("digest", "salt").orderBy(F.col("id").asc_nulls_last(), "url")))
    again = F.col("first").isNotNull() & ~((F.col("salt") == F.col("first.salt")) & (F.col("copy") == 1))
    own = F.col("digest"), F.col("salt"), F.col("copy")
    rows = joined.withColumns({"again": F.coalesce(again, F.lit(False)), "rid": _urn("response", *own)})
    uri = F.concat(F.lit("WARC-Target-URI: "), F.col("url"))  # null without url: concat_ws leaves it out
    to = F.concat(F.lit("WARC-Concurrent-To: "), F.col("rid"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END), F.when(F.col("again"), F.lit("")).otherwise(F.col("html")))
    refers = F.when(F.col("again"), F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), _urn("response", F.col("digest"), F.col("first.salt"), F.lit(1))))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"))
    main = _record(F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response")), F.col("rid"), [uri, digest, refers], "application/http;msgtype=response", http)
    host, rest = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1)
    ask = F.concat(F.lit("GET "), F.coalesce(F.when(rest != "", rest), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(END))
    request = _record("request", _urn("request", *own), [uri, to], "application/http;msgtype=request", ask)
    about = _record("metadata", _urn("metadata", *own), [uri, to], "application/warc-fields", F.concat(F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("\r\n")))
    records = rows.select(F.explode(F.array(request, main, about)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 3 * per_file).text(path)


def parse(chunks):
    """The records of some archives, one after another: (headers with lower-case names, block), from their bytes cut at double line breaks.

    A block that ends in a line break shifts the cuts, so chunks are put together again first; line breaks between records are skipped.
    """
    end = END.encode()
    head, held, size, n = None, [], 0, 0
    for chunk in chunks:
        held += [chunk, end]
        size += len(chunk) + len(end)
        while size >= (n + len(end) if head is not None else 1):
            data = b"".join(held)
            if head is None:
                data = data.lstrip(b"\r\n")
                if not data:
                    held, size = [], 0
                    break
                if data[:5] != b"WARC/":
                    raise ValueError("no record where one should begin")
                top, _, data = data.partition(end)  # a chunk ends in one
                head = {}
                for line in top.decode("utf-8", "replace").split("\r\n")[1:]:
                    name, _, value = line.partition(":")
                    head[name.strip().lower()] = value.strip()
                n = int(head["content-length"])
            else:
                if data[n : n + len(end)] != end:
                    raise ValueError(f"{head.get('warc-record-id')}: the record does not end where its length says")
                yield head, data[:n]
                head, data = None, data[n + len(end) :]
            held, size = [data], len(data)
    if head is not None:
        raise ValueError(f"{head.get('warc-record-id')}: the record is cut off")


def _fields(head: dict, block: bytes) -> dict:
    """A record's row."""
    kind, fields, body = head.get("warc-type"), {}, None
    n, digest = None, (head.get("warc-payload-digest") or "").rpartition(":")[2] or None
    if kind == "metadata":
        fields = dict((k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if x))
    elif kind in ("request", "response", "revisit"):
        top, _, body = block.partition(END.encode())
        lines = top.decode("utf-8", "replace").split("\r\n")
        fields = {"": lines[0]} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(fields.get("content-length", len(body)))
        if kind == "response":
            found = hashlib.sha256(body).hexdigest()
            if digest not in (None, found) or n != len(body):
                raise ValueError(f"{head.get('warc-record-id')}: the payload does not match its digest")
            digest = found
    return {
        "record_id": head.get("warc-record-id"), "type": kind, "concurrent_to": head.get("warc-concurrent-to"), "refers_to": head.get("warc-refers-to"),
        "uri": head.get("warc-target-uri"), "payload_bytes": n, "payload_digest": digest, "payload": body, "fields": list(fields.items()),
    }


def read(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """One row for each record under path (columns as in RECORD); payloads only if asked for."""

    def run(batches):
        rows: list[dict] = []
        size = 0
        for head, block in parse(chunk for b in batches for chunk in b.column(0).to_pylist()):
            rows.append(_fields(head, block) | ({} if payload else {"payload": None}))
            size += 1024 + (len(block) if payload else 0)
            if size > 8 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    s = pa.string()
    schema = pa.schema([("record_id", s), ("type", s), ("concurrent_to", s), ("refers_to", s), ("uri", s), ("payload_bytes", pa.int64()), ("payload_digest", s), ("payload", pa.binary()), ("fields", pa.map_(s, s))])
    bound_batches(spark)
    chunks = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path)
    return chunks.select(F.col("value").cast("binary").alias("chunk")).mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: capture_id, response, request and metadata (null where an archive has none)."""
    cols = records.columns
    main = records.filter(F.col("type").isin("response", "revisit")).select(F.col("record_id").alias("capture_id"), F.struct(*cols).alias("response"))
    ask = records.filter("type = 'request'").select(F.col("concurrent_to").alias("capture_id"), F.struct(*cols).alias("request"))
    about = records.filter("type = 'metadata'").select(F.col("concurrent_to").alias("capture_id"), F.struct(*cols).alias("metadata"))
    return main.join(ask, "capture_id", "left").join(about, "capture_id", "left")


def round_trip(df: DataFrame) -> DataFrame:
    """Write df's pages, read the archives back and list the captures."""
    spark = df.sparkSession
    path = scratch(spark, "warc")
    write(df, path)
    records = materialise(read(spark, path, payload=False).drop("payload"), "warc-records")
    discard(spark, path)
    page = lambda fields: fields["page-id"].try_cast("long")
    flat = assemble(records).select(page(F.col("metadata.fields")).alias("page_id"), "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("_to"))
    named = records.filter("type = 'metadata'").select(F.col("concurrent_to").alias("_c"), page(F.col("fields")).alias("refers_to"))
    return flat.join(named, F.col("_to") == F.col("_c"), "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM f
"""
