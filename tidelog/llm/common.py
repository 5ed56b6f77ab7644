"""Helpers shared by the operators."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words everywhere in this subpackage: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only where it is unset (local runs)."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file:///tmp/checkpoints/tidelog"
        spark.conf.set("spark.checkpoint.dir", at)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written to the shared folder as Parquet and read back, and its path: later plans neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    return materialised(df, name)[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes tables of the shared folder that no later plan reads."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


#: Arrow batches between Spark and Python hold this much at most: whole texts make batches by row count far too large.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000


def bound_batches(spark: SparkSession, most_bytes: int = BATCH_BYTES) -> None:
    """Lowers the session's limits of Arrow batches where they are higher."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", most_bytes), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = re.sub(r"\D", "", str(spark.conf.get(key)))
        if not now or int(now) > most or int(now) <= 0:
            spark.conf.set(key, str(most))


#: The driver keeps a description of each plan; one with a literal table has megabytes of digits.
PLAN_CHARS = 1 << 18


def bound_plan_strings(spark: SparkSession) -> None:
    """Lowers the session's limit of the descriptions of plans where it is higher."""
    key = "spark.sql.maxPlanStringLength"
    if not re.fullmatch(r"\d+", now := str(spark.conf.get(key))) or int(now) > PLAN_CHARS:
        spark.conf.set(key, str(PLAN_CHARS))


def free_name(taken: list[str], wish: str) -> str:
    """wish, or wish with underscores in front where a column of that name exists."""
    low = {c.lower() for c in taken}
    while wish.lower() in low:
        wish = "_" + wish
    return wish


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, inside interpreted higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_slices(batches, column: int, most: int):
    """Record batches cut into slices whose text column holds about `most` bytes at most (a longer text is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(column)
        size = np.diff(np.frombuffer(col.buffers()[1], dtype=np.int32 if pa.types.is_string(col.type) else np.int64, count=len(col) + col.offset + 1)[col.offset :])
        ends = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


#: pyarrow's own conversions from and to Python and numpy load pandas where it is installed, which takes 29 MB of each Python worker; to_arrow and to_numpy work on buffers.
NUMBERS = {pa.int32(): np.int32, pa.int64(): np.int64, pa.float64(): np.float64}


def to_arrow(values: np.ndarray | list, kind: pa.DataType) -> pa.Array:
    """An array of numbers or booleans (from numpy), or of texts or bytes (a list; None: null)."""
    if isinstance(values, np.ndarray):
        own = np.packbits(values, bitorder="little") if pa.types.is_boolean(kind) else np.ascontiguousarray(values, NUMBERS[kind])
        return pa.Array.from_buffers(kind, len(values), [None, pa.py_buffer(own)])
    raw = [b"" if v is None else v.encode() if isinstance(v, str) else v for v in values]
    ends = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(v) for v in raw], out=ends[1:])
    if ends[-1] >= 1 << 31:
        raise ValueError("an Arrow array of texts holds less than 2 GB")
    valid = pa.py_buffer(np.packbits([v is not None for v in values], bitorder="little")) if None in values else None
    return pa.Array.from_buffers(kind, len(raw), [valid, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(b"".join(raw))])


def to_numpy(a: pa.Array) -> np.ndarray:
    """The numbers or booleans of an array without nulls."""
    stop = a.offset + len(a)
    if pa.types.is_boolean(a.type):
        return np.unpackbits(np.frombuffer(a.buffers()[1], np.uint8), bitorder="little")[a.offset : stop].astype(bool) if len(a) else np.zeros(0, bool)
    return np.frombuffer(a.buffers()[1], NUMBERS[a.type], stop)[a.offset :] if len(a) else np.zeros(0, NUMBERS[a.type])


def list_lengths(a: pa.ListArray) -> np.ndarray:
    """The length of each list (an array of none may come without offsets)."""
    return np.diff(to_numpy(a.offsets)).astype(np.int64) if len(a) else np.zeros(0, np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i]+1, ... lengths[i] of them, for all i in turn."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def give_back() -> None:
    """Returns a Python worker's free memory to the system; workers stay alive between tasks."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library
