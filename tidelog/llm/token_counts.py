"""Token counts by a linear longest-match automaton.

A word is MARK + its characters; from the left, the longest piece of the vocabulary is taken again
and again, and a word that cannot be covered counts as one unknown token. The automaton is the
vocabulary's trie with failure links: where a node has no child for the next character, it says
how many tokens its string pops (precomputed) and in which node to go on, so each character is
read once and no piece is built. All distinct words of a slice of texts step together.

Defined cases: null, empty and white-space texts have 0 tokens; texts of any length are counted
whole; repeated rows give repeated rows; other columns are passed on.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import bound_batches, free_name, text_slices
from tidelog.llm.words import MARK, SLICE_BYTES, Trie, WordCache, code_points, distinct_words


class Automaton:
    """fail[v]: where to go on from node v (-1: nowhere); pops[v]: tokens popped on the way."""

    def __init__(self, pieces: tuple[str, ...]):
        self.trie = t = Trie(pieces)
        self.fail, self.pops = np.full(len(t.links), -1, np.int64), np.zeros(len(t.links), np.int64)
        todo = deque([0])
        while todo:
            u = todo.popleft()
            for c, v in t.links[u].items():
                todo.append(v)
                if t.ends[v] >= 0:
                    self.fail[v], self.pops[v] = 0, 1
                    continue
                z, n = self.fail[u], self.pops[u]
                while z >= 0 and c not in t.links[z]:
                    n += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.pops[v] = t.links[z][c], n

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word."""
        codes, lens = code_points([MARK + w for w in words])
        starts = np.cumsum(lens) - lens
        node, n, bad = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        order = np.argsort(-lens, kind="stable")
        longest = lens[order]
        for i in range(int(lens.max(initial=0))):
            live = order[: np.searchsorted(-longest, -i, side="left")]
            live = live[~bad[live]]
            if not len(live):
                break
            c, at = codes[starts[live] + i], node[live]
            nxt = self.trie.child(at, c)
            miss = np.flatnonzero(nxt < 0)
            while len(miss):
                n[live[miss]] += self.pops[at[miss]]
                at[miss] = self.fail[at[miss]]
                lost = at[miss] < 0
                bad[live[miss[lost]]] = True
                miss = miss[~lost]
                nxt[miss] = self.trie.child(at[miss], c[miss])
                miss = miss[nxt[miss] < 0]
            node[live] = np.maximum(nxt, 0)
        rest = np.flatnonzero(~bad & (node > 0))
        while len(rest):
            n[rest] += self.pops[node[rest]]
            node[rest] = self.fail[node[rest]]
            bad[rest[node[rest] < 0]] = True
            rest = rest[node[rest] > 0]
        return np.where(bad, 1, n)


def count_tokens(df: DataFrame, text: str, pieces: tuple[str, ...]) -> DataFrame:
    """df's other columns, n_words and n_tokens."""
    kept = [f for f in df.schema.fields if f.name != text]
    names = [f.name for f in kept]
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(pieces)  # the vocabulary: a fixed size

    def run(batches):
        auto = Automaton(shared.value)
        cache = WordCache(lambda ws: auto.counts(ws).astype(float)[:, None], 1)
        for part in text_slices(batches, 0, SLICE_BYTES):
            words, refs, per = distinct_words(part.column(0))
            n = cache.get(words)[:, 0][refs] if words else np.zeros(0)
            sums = np.bincount(np.repeat(np.arange(len(per)), per), weights=n, minlength=len(per))
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(per, pa.int64()), pa.array(sums.astype(np.int64))], names=[f"c{i}" for i in range(len(names) + 2)])

    types = T.StructType([T.StructField(f"c{i}", t) for i, t in enumerate([*(f.dataType for f in kept), T.LongType(), T.LongType()])])
    out = df.select(F.col(f"`{text}`").cast("string").alias("t"), *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]).mapInArrow(run, types)
    return out.toDF(*names, free_name(names, "n_words"), free_name(names, "n_tokens"))
