"""Approximate nearest neighbours by inner product: inverted file, product-quantised residuals, exact reranking.

Coarse centroids and code books are fitted by k-means on a bounded sample (about `sample` vectors, or
16 for each cell, chosen by hash of the id; cells grow with the square root of the rows, up to
MOST_CELLS, so the sample never exceeds 16 * MOST_CELLS); every vector is indexed: its cell, and one code for each part of
its residual. A query probes the cells with the largest inner products; how many is set on the
sample, so that `recall` of its true neighbours lie in probed cells. Within a cell, asymmetric
distance tables estimate the inner products, and every vector's quantisation error bounds how far its
estimate can be off: reranked, by exact inner products in double precision, are all vectors whose
bound reaches the k-th safe one, so that of probed cells no true neighbour is lost. A cell of many vectors is cut into parts by hash of the id, so a very common vector is
spread over many tasks and no task holds more than about `part` vectors.

Defined cases: vectors that are null, empty, zero, or hold nulls or non-finite numbers take no
part, nor do rows without id; vectors of different lengths have no inner product, so those of each
length are searched among themselves; ties go to the smaller id; a query's own id is never a
candidate; rows that repeat id and vector count as one; of queries that share an id, the one with the
least vector asks; fewer candidates than k give fewer rows; an empty table gives an empty table; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def kmeans(x: np.ndarray, k: int, turns: int, rng) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(turns):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(axis=1) / 2
    return np.concatenate([(x[i : i + 4096] @ c.T - half).argmax(axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


MOST_CELLS = 16_384


def n_cells(total: int) -> int:
    return max(1, min(math.isqrt(total) // 2, MOST_CELLS))


class Model:
    """Centroids, code books (parts x codes x width) and the number of cells to probe."""

    def __init__(self, x: np.ndarray, total: int, recall: float, k: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.dim = x.shape[1]
        self.centroids = kmeans(x, min(n_cells(total), len(x)), 8, rng)
        parts = next(m for m in (8, 4, 2, 1) if self.dim % m == 0)
        cell = nearest(x, self.centroids)
        rest = x - self.centroids[cell]
        w = self.dim // parts
        books = [kmeans(rest[:, i * w : (i + 1) * w], 256, 6, rng) for i in range(parts)]
        most = max(map(len, books))
        self.books = np.stack([np.concatenate([b, np.repeat(b[:1], most - len(b), axis=0)]) for b in books])
        asked = rng.choice(len(x), min(256, len(x)), replace=False)
        scores = x[asked] @ x.T
        scores[np.arange(len(asked)), asked] = -np.inf
        true = np.argpartition(-scores, min(k, len(x) - 1), axis=1)[:, :k]
        rank = np.argsort(np.argsort(-(x[asked] @ self.centroids.T), axis=1), axis=1)  # of each cell for each query
        need = np.take_along_axis(rank, cell[true], axis=1).ravel()
        self.probes = int(np.quantile(need, recall, method="higher")) + 1

    def encode(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest, w = x - self.centroids[cell], self.books.shape[2]
        return np.stack([nearest(rest[:, i * w : (i + 1) * w], b) for i, b in enumerate(self.books)], axis=1).astype(np.uint8)

    def errors(self, x: np.ndarray, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Length of what cell and codes leave out of each vector, and a little for rounding: times a query's length it bounds the error of an estimate."""
        rest = x - self.centroids[cell]
        off = np.linalg.norm(rest - self.books[np.arange(codes.shape[1]), codes].reshape(rest.shape), axis=1)
        return off + 1e-12 * (np.linalg.norm(x, axis=1) + np.linalg.norm(rest, axis=1) + off)

    def probed(self, q: np.ndarray) -> np.ndarray:
        return np.argsort(-(q @ self.centroids.T), axis=1, kind="stable")[:, : self.probes]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of each query's parts with all codes: queries x parts x codes."""
        w = self.books.shape[2]
        return np.einsum("qpw,pcw->qpc", q.reshape(len(q), -1, w), self.books)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy().reshape(len(col), dim)


def _once(ids: np.ndarray, vecs: np.ndarray, codes: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows by id, those that repeat an id and its vector once."""
    if len(np.unique(ids)) < len(ids):
        seen: set[tuple[int, bytes]] = set()
        own = [i for i, key in enumerate(zip(ids.tolist(), map(bytes, vecs), strict=True)) if not (key in seen or seen.add(key))]
        ids, vecs, codes, offs = ids[own], vecs[own], codes[own], offs[own]
    return ids, vecs, codes, offs


def search(df: DataFrame, id_col: str, vec_col: str, queries: Column, *, k: int = 20, sample: int = 16_384, part: int = 4096, recall: float = 0.99) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which `queries` holds."""
    spark = df.sparkSession
    out_type = "query_id long, rank int, vec_id long, score double"
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("q")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()  # a row for each length of vectors
    if not dims:
        return spark.createDataFrame([], out_type)
    each = [_search(rows.filter(F.size("v") == r["d"]), r["d"], r["n"], k, sample, part, recall) for r in sorted(dims)]
    return reduce(DataFrame.unionByName, each)


def _search(rows: DataFrame, dim: int, total: int, k: int, sample: int, part: int, recall: float) -> DataFrame:
    spark = rows.sparkSession
    sample = max(sample, 16 * n_cells(total))
    drawn = rows if total <= sample else rows.filter(F.pmod(F.xxhash64("id"), F.lit(total)) < sample)
    got = drawn.select("v", "id").limit(2 * sample).toArrow().combine_chunks().sort_by("id")
    x = np.array(got["v"].to_pylist(), np.float64).reshape(-1, dim)
    if not len(x):
        x = np.array(rows.select("v").limit(sample).toArrow()["v"].to_pylist(), np.float64).reshape(-1, dim)
    model = spark.sparkContext.broadcast(Model(x, total, recall, k))  # centroids and code books: a fixed size

    def index(batches):
        m = model.value
        for b in batches:
            v = _matrix(b.column(1), dim)
            cell = nearest(v, m.centroids)
            codes = m.encode(v, cell)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(m.errors(v, cell, codes), pa.float64()), pa.array(list(m.probed(v).astype(np.int32)) if len(v) else [], pa.list_(pa.int32()))], names=["id", "v", "q", "cell", "codes", "off", "probes"])

    indexed = rows.mapInArrow(index, "id long, v array<double>, q boolean, cell int, codes binary, off double, probes array<int>")
    from tidelog.llm.common import materialise

    indexed = materialise(indexed.withColumn("probes", F.when(F.col("q"), F.col("probes"))), "ann-index")
    sizes = {r["cell"]: r["n"] for r in indexed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row for each cell
    n_parts = F.from_json(F.lit(json.dumps([max(1, math.ceil(sizes.get(c, 0) / part)) for c in range(max(sizes) + 1)])), "array<int>")
    spread = F.get(n_parts, F.col("cell"))
    held = indexed.select("cell", F.pmod(F.xxhash64("id"), spread).cast("int").alias("part"), F.lit(0).alias("kind"), "id", "v", "codes", "off")
    asked = indexed.filter("q").groupBy("id").agg(F.min(F.struct("v", "probes")).alias("x"))  # one query for each id
    asked = asked.select("id", "x.v", F.explode("x.probes").alias("cell")).filter(spread.isNotNull())
    asked = asked.select("cell", F.explode(F.sequence(F.lit(0), spread - 1)).alias("part"), F.lit(1).alias("kind"), "id", "v", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("off"))
    keyed = held.unionByName(asked).repartition("cell", "part").sortWithinPartitions("cell", "part", "kind", "id")

    def answer(batches):
        m = model.value
        key, ids, vecs, codes, offs = None, [], [], [], []
        block = None

        def ranked(q_ids, q):
            ids_, v_, c_, off = block
            adc = (q @ m.centroids[key[0]])[:, None] + np.zeros((1, len(ids_)))
            t = m.tables(q)
            for i in range(c_.shape[1]):
                adc += t[:, i, :][:, c_[:, i]]
            same = q_ids[:, None] == ids_[None, :]
            adc[same] = -np.inf
            slack = np.linalg.norm(q, axis=1)[:, None] * off
            most = min(k, len(ids_))
            bar = np.partition(adc - slack, len(ids_) - most, axis=1)[:, len(ids_) - most]  # k vectors reach it for certain
            may = ~(adc + slack < bar[:, None]) & ~same
            for i, q_id in enumerate(q_ids.tolist()):
                own = np.flatnonzero(may[i])
                s = np.einsum("d,nd->n", q[i], v_[own])
                order = np.lexsort((ids_[own], -s))[:k]
                yield q_id, s[order], ids_[own][order]

        for b in batches:
            cells, parts, kinds = (b.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]) | (parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1])]).tolist() + [b.num_rows]
            out = []
            for s, e in zip(cuts, cuts[1:], strict=False):
                sub = b.slice(s, e - s)
                if (cells[s], parts[s]) != key:
                    key, ids, vecs, codes, offs, block = (cells[s], parts[s]), [], [], [], [], None
                if kinds[s] == 0:
                    ids.append(sub.column(3).to_numpy())
                    vecs.append(_matrix(sub.column(4), dim))
                    codes.append(np.frombuffer(b"".join(sub.column(5).to_pylist()), np.uint8).reshape(e - s, -1))
                    offs.append(sub.column(6).to_numpy())
                    continue
                if block is None:
                    if not ids:
                        continue
                    block = _once(np.concatenate(ids), np.concatenate(vecs), np.concatenate(codes), np.concatenate(offs))
                for i in range(0, e - s, 64):
                    one = sub.slice(i, 64)
                    out += ranked(one.column(3).to_numpy(), _matrix(one.column(4), dim))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([-o[1] for o in out], pa.list_(pa.float64())), pa.array([o[2] for o in out], pa.list_(pa.int64()))], names=["query_id", "s", "i"])

    found = keyed.mapInArrow(answer, "query_id long, s array<double>, i array<long>")
    lists = found.groupBy("query_id").agg(F.flatten(F.collect_list(F.arrays_zip("s", "i"))).alias("l"))
    best = lists.select("query_id", F.posexplode(F.slice(F.array_sort("l"), 1, k)).alias("p", "x"))
    return best.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score"))
