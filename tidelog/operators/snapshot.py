"""Initial snapshots: key-range pages between a low and a high watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.convert import partition_of


def after(keys: list[str], low: tuple) -> Column:
    """(keys) > low as tuples, with a bound on the first key that reaches the scan."""
    return (F.struct(*keys) > F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, low, strict=True)])) & (F.col(keys[0]) >= F.lit(low[0]))


def up_to(keys: list[str], high: tuple) -> Column:
    return (F.struct(*keys) <= F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, high, strict=True)])) & (F.col(keys[0]) <= F.lit(high[0]))


def page(df: DataFrame, keys: list[str], low: tuple | None, high: tuple, limit: int) -> DataFrame:
    """The next rows above low and up to high, in key order."""
    rows = df.filter(up_to(keys, high))
    return (rows if low is None else rows.filter(after(keys, low))).orderBy(*keys).limit(limit)


def high_watermark(df: DataFrame, keys: list[str]) -> DataFrame:
    """The largest key, by partial aggregation rather than a sort. No row for an empty table."""
    return df.agg(F.max(F.struct(*keys)).alias("k")).filter("k IS NOT NULL").select("k.*")


def pages(df: DataFrame, keys: list[str], limit: int):
    """The pages of a whole table, one after another, and their low watermarks; nothing for an empty table."""
    top = high_watermark(df, keys).first()
    if top is None:
        return
    high, low = tuple(top[k] for k in keys), None
    while low != high:
        rows = page(df, keys, low, high, limit)
        last = rows.agg(F.max(F.struct(*keys)).alias("k")).first()["k"]
        if last is None:
            return
        low = tuple(last[k] for k in keys)
        yield rows, low


def read_events(df: DataFrame, keys: list[str], created: Column | None = None) -> DataFrame:
    """Snapshot rows as read events; as create events where a log position created their chunk."""
    op = F.lit("r") if created is None else F.when(created.isNull(), "r").otherwise("c")
    return df.select(op.alias("op"), F.lit(True).alias("snapshot"), F.struct(*keys).alias("key"), F.struct(*df.columns).alias("after"))


def ranges(df: DataFrame, keys: list[str], n: int) -> list[tuple[tuple | None, tuple]]:
    """About n key ranges (low, high] that cover a table, from quantiles of its leading key; [] for an empty table. Two passes, whatever the table's size."""
    top = high_watermark(df, keys).first()
    if top is None:
        return []
    high = tuple(top[k] for k in keys)
    cuts = df.agg(F.percentile_approx(keys[0], [i / n for i in range(1, n)], 10_000).alias("q")).first()["q"] if n > 1 else []
    lows: list[tuple | None] = [None]
    out = []
    for cut in sorted(set(cuts)):
        if cut < high[0]:  # all rows of a leading key stay together
            out.append((lows[-1], (cut,)))
            lows.append((cut,))
    return [*out, (lows[-1], high)]


def range_rows(df: DataFrame, keys: list[str], low: tuple | None, high: tuple) -> DataFrame:
    """The rows of one range; its bounds on the leading key reach the scan."""
    rows = df.filter(F.col(keys[0]) <= F.lit(high[0]))
    return rows if low is None else rows.filter(F.col(keys[0]) > F.lit(low[0]))


def tasks(tables: DataFrame, workers: int = 5) -> DataFrame:
    """tables with the worker that snapshots each: by the hash of its canonical name, so a table always meets the same one."""
    return tables.withColumn("worker", partition_of(F.col("canonical"), workers))


def sequence(tables: DataFrame, watermarks: DataFrame) -> DataFrame:
    """The order of a snapshot's tables and what is done with each: hypertables first, then by name.

    watermarks (canonical, low, high) is what an earlier run left: complete tables are skipped, begun ones resumed above low, others started.
    """
    state = watermarks.select("canonical", "low", "high")
    found = tables.join(state, "canonical", "left")
    action = F.when(F.col("high").isNull(), "start").when(F.col("low").eqNullSafe(F.col("high")), "skip").otherwise("resume")
    place = F.row_number().over(Window.orderBy(F.when(F.col("kind") == "hypertable", 0).otherwise(1), "canonical"))  # a row for each table
    return found.select("canonical", "kind", place.alias("place"), action.alias("action"), F.when(action == "resume", F.col("low")).alias("above"))


def chunk_snapshots(changes: DataFrame, selected: DataFrame) -> DataFrame:
    """Chunks that the log adds to selected hypertables, uncompressed ones only: each is snapshotted as of the position that made it, its rows as creates."""
    added = changes.filter("op = 'c' AND compressed_chunk_id IS NULL AND NOT dropped")
    return added.join(selected.select("hypertable_id"), "hypertable_id", "left_semi").select("id", "hypertable_id", "lsn")


def drained(log: DataFrame, snapshots: DataFrame, chunk: str) -> DataFrame:
    """When a chunk's log rows leave: those that come while its snapshot (chunk, started_lsn, finished_lsn, snapshot_lsn) runs wait for its end and are
    dropped where the snapshot has seen them; others pass at once. Adds released_lsn."""
    found = log.join(snapshots, chunk, "left")
    waits = F.coalesce((F.col("lsn") >= F.col("started_lsn")) & (F.col("lsn") < F.col("finished_lsn")), F.lit(False))
    seen = waits & (F.col("server_wal_end") < F.col("snapshot_lsn"))
    return found.filter(~seen).withColumn("released_lsn", F.when(waits, F.col("finished_lsn")).otherwise(F.col("lsn"))).drop("started_lsn", "finished_lsn", "snapshot_lsn")


# Start modes.
NEVER, INITIAL_ONLY, ALWAYS = "never", "initial_only", "always"


def start_action(mode: Column, has_offset: Column, in_snapshot: Column, created_slot: Column) -> Column:
    """What a start does: snapshot (from the new slot's), resume (the snapshot that the state names), replicate, or an error.

    always takes a whole snapshot and so needs a new slot; initial_only takes one where no state is and resumes one that was begun, which a new
    slot cannot serve; never goes straight to the log.
    """
    always = F.when(created_slot, "snapshot").otherwise("error: always needs a new slot")
    initial = F.when(~has_offset, F.when(created_slot, "snapshot").otherwise("replicate")).when(in_snapshot, F.when(created_slot, "error: state of another slot").otherwise("resume")).otherwise("replicate")
    return F.when(mode == ALWAYS, always).when(mode == INITIAL_ONLY, initial).otherwise("replicate")


def start(mode: str, offset: dict | None, created_slot: bool, snapshot_name: str = "") -> tuple[str, str]:
    """(action, name of the snapshot) by the rules of `start_action`; offset: {"snapshot": bool, "snapshot_name": str | None} or None."""
    begun = offset is not None and offset.get("snapshot", False) and offset.get("snapshot_name") is not None
    if mode == ALWAYS:
        if not created_slot:
            raise ValueError("start mode always needs a new replication slot")
        return "snapshot", snapshot_name
    if mode == INITIAL_ONLY and (offset is None or begun):
        if begun and created_slot:
            raise ValueError("start mode initial_only found the state of another replication slot")
        name = offset["snapshot_name"] if begun else snapshot_name
        return ("resume" if begun else "snapshot", name) if name else ("replicate", "")
    return "replicate", ""


# What a page of a table is asked for in SQL, where a source takes SQL only.


def tuple_text(keys: list[str]) -> str:
    return f"({','.join(keys)})"


def order_text(keys: list[str], descending: bool = False) -> str:
    return ",".join(f"{k} {'DESC' if descending else 'ASC'}" for k in keys)


def literal_text(value, kind: str) -> str:
    """A value as a literal of SQL, by its descriptor type."""
    if value is None:
        return "NULL"
    if kind == "array":
        return "'{" + ",".join("NULL" if v is None else str(v) for v in value) + "}'"
    if kind == "bytes":
        return f"bytea '\\x{value.hex().upper()}'"
    if kind == "boolean":
        return "TRUE" if value else "FALSE"
    if kind.startswith("int"):
        return str(int(value))
    if kind.startswith("float"):
        return repr(float(value))
    text = value.isoformat() if hasattr(value, "isoformat") else str(value)
    return "'" + text.replace("'", "''") + "'"


def after_text(keys: list[str], kinds: list[str], low: tuple) -> str:
    """The condition of the rows above a low watermark."""
    return f"{tuple_text(keys)} > ({','.join(literal_text(v, k) for v, k in zip(low, kinds, strict=True))})"
