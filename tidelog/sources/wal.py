"""Sources of the log: a folder of decoded messages for batch replay, and a streaming source with positions as offsets."""

from __future__ import annotations

import glob
import heapq
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from tidelog.model import WAL


def replay(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WAL).parquet(path)


class LogStream(DataSource):
    """format("tidelog"): streams (lsn, body) of JSON lines files in `path`, ordered by (lsn, seq) across files. Offsets are positions.

    A trigger reads `batch` messages and on to the end of the last one's position, so that no position is split. Relation messages up to `startlsn`
    come first: later rows need them. Files are put into the folder whole, and in the log's order: one put there when larger positions have
    already been read is not looked at any more.
    """

    @classmethod
    def name(cls):
        return "tidelog"

    def schema(self):
        return "lsn bigint, body string"

    def simpleStreamReader(self, schema):
        return LogReader(self.options)


class LogReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.path, self.batch = options["path"], int(options.get("batch", "1000"))
        self.start = int(options.get("startlsn", "0"))

    def initialOffset(self):
        return {"lsn": self.start, "relations": True}  # relation messages up to lsn are still to come

    def _rows(self, start):
        for name in sorted(glob.glob(f"{self.path}/*.json")):
            with open(name) as f:
                for line in f:
                    m = json.loads(line)
                    if m["lsn"] > start["lsn"] or start.get("relations") and m.get("msg_type") == "R":
                        yield m["lsn"], m.get("seq") or 0, line.rstrip("\n")

    def read(self, start):
        found = (r[0] for r in self._rows(start))
        first = heapq.nsmallest(self.batch, found) if self.batch > 0 else sorted(found)
        if not first:
            return iter([]), start
        end = {"lsn": max(first[-1], start["lsn"])}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start, end):
        rows = [] if start == end else sorted((r for r in self._rows(start) if r[0] <= end["lsn"]), key=lambda r: r[:2])
        return iter([(lsn, body) for lsn, _, body in rows])

    def commit(self, end):
        """Positions up to end are confirmed; a replication slot would be told so here."""
