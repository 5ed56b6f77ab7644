"""Open transactions in a stream: rows are held until their commit, their transaction's size limit, or a time-out."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "xid long, lsn long, kind string, body string, held boolean"


def committed(stream: DataFrame, most: int = 10_000, timeout_ms: int = 60_000) -> DataFrame:
    """(xid, lsn, kind, body) rows, kind C being a commit: a transaction's rows leave in order once its commit, the size limit or the time-out is reached; later rows pass straight through. Rows of one position keep the order they came in; a transaction that stays silent
    for another time-out is forgotten."""

    def out(xid, rows, held):
        return pd.DataFrame([(xid, n, k, b, held) for n, k, b in sorted(rows, key=lambda r: r[0]) if k != "C"], columns=["xid", "lsn", "kind", "body", "held"])

    def step(key, frames, state: GroupState):
        text, through = state.get if state.exists else ("[]", False)
        rows, xid = [tuple(r) for r in json.loads(text)], int(key[0])
        if state.hasTimedOut:
            if through:
                state.remove()
            else:
                state.update(("[]", True))
                state.setTimeoutDuration(timeout_ms)
            yield out(xid, rows, True)
            return
        for f in frames:
            rows += [(int(n), str(k), None if b is None else str(b)) for n, k, b in zip(f["lsn"], f["kind"], f["body"], strict=True)]
        if any(k == "C" for _, k, _ in rows):
            if state.exists:
                state.remove()
            yield out(xid, rows, not through)
        elif through or len(rows) > most:
            state.update(("[]", True))
            state.setTimeoutDuration(timeout_ms)
            yield out(xid, rows, not through)
        else:
            state.update((json.dumps(rows), False))
            state.setTimeoutDuration(timeout_ms)

    return stream.groupBy("xid").applyInPandasWithState(step, OUT, "open string, through boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)
