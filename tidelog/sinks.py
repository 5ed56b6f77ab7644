"""Sinks: records (topic, key, value, ts_ms) to brokers. Clients are handed in, so tests need no broker.

A sink writes a micro-batch partition by partition; records of a topic keep their order, as the
caller partitions by topic and sorts by position. Delivery is at least once.
"""

from __future__ import annotations

import base64
import json
import sys
import time
import urllib.request
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETRIES = 8


def json_text(c: Column) -> Column:
    """JSON with explicit nulls."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def records(
    events: DataFrame, prefix: str, key: Column, schema: Column, name: Column, value: Column, *, key_schema: dict | None = None, value_schema: dict | None = None, ts_ms: Column | None = None, dedup_id: Column | None = None,
) -> DataFrame:
    """topic, key and value as JSON (in an envelope where a schema is given), lsn, and ts_ms and dedup_id where they are given."""
    from tidelog.schema import enveloped

    text = lambda c, s: json_text(c) if s is None else enveloped(s, c)
    more = [c.alias(n) for n, c in (("ts_ms", ts_ms), ("dedup_id", dedup_id)) if c is not None]
    return events.select(F.concat_ws(".", F.lit(prefix), schema, name).alias("topic"), text(key, key_schema).alias("key"), text(value, value_schema).alias("value"), "lsn", *more)


def sqs_dedup_id(lsn: Column, xid: Column, body: Column) -> Column:
    """Upper-case hex SHA-256 of lsn-txid-body; a missing txid is left out."""
    return F.upper(F.sha2(F.concat_ws("-", lsn, xid.cast("string"), body).cast("binary"), 256))


def with_retry(call: Callable[[], None], retries: int = RETRIES, first_wait: float = 0.1, sleep=time.sleep) -> int:
    """Calls again after a failure, waiting twice as long each time; how often it failed."""
    for n in range(retries + 1):
        try:
            call()
            return n
        except Exception:
            if n == retries:
                raise
            sleep(first_wait * 2**n)
    return retries


class Sink:
    def emit(self, topic: str, key: str | None, value: str, ts_ms: int | None = None, dedup_id: str | None = None) -> None:
        raise NotImplementedError


class StdoutSink(Sink):
    """The payload as a line of JSON; no key, no schema."""

    def emit(self, topic, key, value, ts_ms=None, dedup_id=None):
        sys.stdout.write(json.dumps(json.loads(value).get("payload", json.loads(value))) + "\n")


class ClientSink(Sink):
    """send(topic, key, value, ts_ms) of a client: Kafka, or another broker with that shape."""

    def __init__(self, send):
        self.send = send

    def emit(self, topic, key, value, ts_ms=None, dedup_id=None):
        self.send(topic, key, value, ts_ms)


class NatsSink(Sink):
    def __init__(self, publish):
        self.publish = publish

    def emit(self, topic, key, value, ts_ms=None, dedup_id=None):
        self.publish(subject=topic, headers={"key": key}, data=value)


class RedisSink(Sink):
    def __init__(self, xadd):
        self.xadd = xadd

    def emit(self, topic, key, value, ts_ms=None, dedup_id=None):
        self.xadd(topic, {"key": key, "envelope": value})


class KinesisSink(Sink):
    """The topic is the partition key; the record's key is not sent."""

    def __init__(self, put, stream: str):
        self.put, self.stream = put, stream

    def emit(self, topic, key, value, ts_ms=None, dedup_id=None):
        self.put(StreamName=self.stream, PartitionKey=topic, Data=value)


class SqsSink(Sink):
    def __init__(self, send, queue: str):
        self.send, self.queue = send, queue

    def emit(self, topic, key, value, ts_ms=None, dedup_id=None):
        self.send(QueueUrl=self.queue, MessageGroupId=topic, MessageDeduplicationId=dedup_id, MessageBody=value)


class HttpSink(Sink):
    def __init__(self, url: str, auth: tuple | None = None, opener=urllib.request.urlopen):
        self.url, self.opener, self.headers = url, opener, {"Content-Type": "application/json"}
        if auth and auth[0] == "basic":
            self.headers["Authorization"] = "Basic " + base64.b64encode(f"{auth[1]}:{auth[2]}".encode()).decode()
        elif auth and auth[0] == "header":
            self.headers[auth[1]] = auth[2]

    def emit(self, topic, key, value, ts_ms=None, dedup_id=None):
        with self.opener(urllib.request.Request(self.url, value.encode(), self.headers)) as r:
            if not 200 <= r.status < 300:
                raise OSError(f"status {r.status}")


SINKS: dict[str, Callable[..., Sink]] = {"stdout": StdoutSink, "kafka": ClientSink, "nats": NatsSink, "redis": RedisSink, "kinesis": KinesisSink, "sqs": SqsSink, "http": HttpSink}


def register(name: str, factory: Callable[..., Sink]) -> bool:
    """The first registration of a name wins."""
    return SINKS.setdefault(name, factory) is factory


def write_batch(batch: DataFrame, make_sink: Callable[[], Sink], retries: int = RETRIES) -> None:
    """For foreachBatch: each topic in order of position."""

    more = [c for c in ("ts_ms", "dedup_id") if c in batch.columns]

    def each(rows):
        sink = make_sink()
        for r in rows:
            with_retry(lambda r=r: sink.emit(r["topic"], r["key"], r["value"], **{c: r[c] for c in more}), retries)

    batch.repartition("topic").sortWithinPartitions("topic", "lsn").foreachPartition(each)
