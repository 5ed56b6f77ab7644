"""N-gram Jaccard self-join by a MinHash LSH forest and exact verification.

Texts are sets of shingles of five words (white-space words as they are; a text of one to four
words is one shingle). Texts with equal sets are one node. A node's MinHash signature gives a key
of DEPTH values to each of TREES tries; a trie is its keys in sorted order, so the nodes below any
prefix are neighbours, and comparing neighbours gives the length of the prefix that they share.
Prefixes are shortened from DEPTH on until the recall reaches the target: both the recall of a
pair at the threshold, and the share of the clearly similar neighbour pairs (found in many trees at
the least depth) that the longer prefix also finds.

Candidates are the components of nodes that share such prefixes (each node of a run of equal prefixes
is tied to the run's first). Each component is verified
exactly: all its pairs are counted by their common shingles. Only texts of candidates are exchanged. A component of many nodes is cut into
blocks, and each pair of blocks is a task of bounded size; links are counted there and never
listed, only spanning edges of the links found leave a task. So no pair list grows with the square
of a group.

Result: one row for each row of the input, with its class (connected by links; named by its
smallest id) and its number of links, copies included.

Defined cases: a null, empty or white-space text has no shingle, is a class of its own and has no
links; rows that repeat a text are linked to each other; a null id keeps a null class unless its
class has another id; an empty table gives an empty table; other columns, whatever their names, are
not read (`keep_rows` passes them on); a text of any length is read whole, one at a time where it is long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import bound_batches, discard, give_back, materialise, materialised, text_slices, to_arrow
from tidelog.llm.components import components
from tidelog.llm.words import SLICE_BYTES, distinct_words

N = 5
TREES, DEPTH, LEAST_DEPTH = 24, 8, 5
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1 << 19
BITMAP_BITS = 1 << 15  #: of one row of Spark's bitmap functions
FILTER_BITS = 2048 * BITMAP_BITS

_rng = np.random.default_rng(20240117)
_A = _rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_C = _rng.integers(0, 1 << 63, N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of some texts, sorted within each text, and their number by text."""
    import xxhash

    words, refs, per = distinct_words(texts)
    if not words:
        return np.zeros(0, np.uint64), np.zeros(len(per), np.int64)
    w = np.fromiter((xxhash.xxh64_intdigest(x) for x in words), np.uint64, len(words))[refs]
    owner = np.repeat(np.arange(len(per)), per)
    place = np.arange(len(w)) - np.repeat(np.cumsum(per) - per, per)
    left = np.repeat(per, per) - place
    h = np.zeros(len(w), np.uint64)
    padded = np.concatenate([w, np.zeros(N, np.uint64)])
    for i in range(N):  # a short text's only shingle stops at its last word
        h += np.where(left > i, padded[i : i + len(w)] * _C[i], np.uint64(i + 1))
    use = (left >= N) | (place == 0)
    h, owner = _mixed(h[use]), owner[use]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
    return h[new], np.bincount(owner[new], minlength=len(per))


def signatures(h: np.ndarray, per: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value: texts with shingles x (TREES * DEPTH)."""
    n = per[per > 0]
    starts = np.cumsum(n) - n
    hi, lo = (h >> np.uint64(32)).astype(np.uint32), h.astype(np.uint32)
    out = np.empty((len(n), TREES * DEPTH), np.uint16)
    at = 0
    while at < len(n):  # some texts at a time, about 2**16 shingles
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + (1 << 16))))
        s = slice(int(starts[at]), int(starts[to]) if to < len(n) else len(h))
        x, y, cut = hi[s], lo[s], starts[at:to] - starts[at]
        for i in range(TREES * DEPTH):
            low = np.minimum.reduceat((x * _A[i]) ^ (y * _B[i]), cut)
            out[at:to, i] = (low * np.uint32(0x9E3779B1)) >> np.uint32(16)
        at = to
    return out


def sketch(df: DataFrame, id_col: str, text: str, carry: bool = False) -> DataFrame:
    """rid, id, text, node (null without shingles), n_shingles and sig of each row, and _row (the other columns) if carry, written to the shared folder."""

    def run(batches):
        for part in text_slices(batches, 0, SLICE_BYTES):
            h, per = shingles(part.column(0))
            sig = iter(signatures(h, per)) if len(h) else iter(())
            ends = np.cumsum(per).tolist()
            nodes, sigs = [], []
            for n, e in zip(per.tolist(), ends, strict=True):
                nodes.append(hashlib.blake2b(h[e - n : e].tobytes(), digest_size=16).digest() if n else None)
                sigs.append(next(sig).tobytes() if n else None)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), to_arrow(nodes, pa.binary()), to_arrow(per, pa.int64()), to_arrow(sigs, pa.binary()), *part.columns[3:]], names=["text", "id", "rid", "node", "n_shingles", "sig", *part.schema.names[3:]])
        give_back()

    bound_batches(df.sparkSession)
    rows = df.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{id_col}`").cast("long").alias("id"), F.monotonically_increasing_id().alias("rid"), *([F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text]).alias("_row")] if carry else []))
    return materialise(rows.mapInArrow(run, T.StructType([*T.StructType.fromDDL("text string, id long, rid long, node binary, n_shingles long, sig binary").fields, *rows.schema.fields[3:]])), "ngram-sketch")


def _lcp(tree: np.ndarray, keys: np.ndarray) -> np.ndarray:
    same = (keys[1:] == keys[:-1]) & (tree[1:] == tree[:-1])[:, None]
    return np.cumprod(same, axis=1).sum(axis=1)


def neighbours(nodes: DataFrame) -> DataFrame:
    """prev, node, lcp: neighbours in the tries that share LEAST_DEPTH values or more; and h5, h6, ...: the first node of the run that shares 5, 6, ... values with node."""
    width = 2 * DEPTH
    rows = nodes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.select("tree", F.expr(f"substring(sig, tree * {width} + 1, {width})").alias("key"), "node")
    rows = rows.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    depths = range(LEAST_DEPTH, DEPTH + 1)
    fields = [("prev", pa.binary()), ("node", pa.binary()), ("lcp", pa.int32()), ("tree", pa.int32()), ("key", pa.binary()), *((f"h{d}", pa.binary()) for d in depths)]

    def run(batches):
        last, first = None, None
        schema = pa.schema(fields)
        for b in batches:
            tree, key, node = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            if not tree:
                continue
            first = first or (tree[0], key[0], node[0])
            if last:
                tree, key, node = [last[0], *tree], [last[1], *key], [last[2], *node]
            lcp = _lcp(np.array(tree), np.frombuffer(b"".join(key), np.uint16).reshape(-1, DEPTH))
            hit = np.flatnonzero(lcp >= LEAST_DEPTH) + 1
            heads, ends = [], []
            for k, d in enumerate(depths):
                at = np.maximum.accumulate(np.where(np.r_[True, lcp < d], np.arange(len(node)), 0))
                own = lambda i, k=k: last[3][k] if last and not i else node[i]  # noqa: B023, E731
                heads.append([own(i) for i in at[hit].tolist()])
                ends.append(own(int(at[-1])))
            last = (tree[-1], key[-1], node[-1], ends)
            hits = hit.tolist()
            cols = [to_arrow([node[i - 1] for i in hits], pa.binary()), to_arrow([node[i] for i in hits], pa.binary()), to_arrow(lcp[hit - 1], pa.int32()), pa.nulls(len(hits), pa.int32()), pa.nulls(len(hits), pa.binary())]
            yield pa.RecordBatch.from_arrays([*cols, *(to_arrow(h, pa.binary()) for h in heads)], schema=schema)
        if last:  # the rows at both ends of the partition meet their neighbours on the driver
            yield pa.RecordBatch.from_arrays([pa.nulls(2, pa.binary()), to_arrow([first[2], last[2]], pa.binary()), pa.nulls(2, pa.int32()), to_arrow(np.array([first[0], last[0]]), pa.int32()), to_arrow([first[1], last[1]], pa.binary()), *(pa.nulls(2, pa.binary()) for _ in depths)], schema=schema)

    found = materialise(rows.mapInArrow(run, T.StructType([T.StructField(n, {"lcp": T.IntegerType(), "tree": T.IntegerType()}.get(n, T.BinaryType())) for n, _ in fields])), "ngram-neighbours")
    ends = sorted({(r["tree"], bytes(r["key"]), bytes(r["node"])) for r in found.filter("prev IS NULL").select("tree", "key", "node").collect()})  # two rows for each partition
    extra = []
    if len(ends) > 1:
        lcp = _lcp(np.array([e[0] for e in ends]), np.frombuffer(b"".join(e[1] for e in ends), np.uint16).reshape(-1, DEPTH))
        extra = [(*map(bytearray, (x[2], y[2])), int(n), *[bytearray(x[2])] * len(depths)) for x, y, n in zip(ends, ends[1:], lcp, strict=False) if n >= LEAST_DEPTH]
    edges = found.filter("prev IS NOT NULL").drop("tree", "key")
    return edges.unionByName(nodes.sparkSession.createDataFrame(extra, edges.schema)) if extra else edges


def recall_at(similarity: float, depth: int) -> float:
    return 1 - (1 - similarity**depth) ** TREES


def depth_for(edges: DataFrame, similarity: float, target: float) -> int:
    """The longest prefix that reaches the target recall, shortened step by step."""
    pairs = edges.groupBy(F.least("prev", "node").alias("a"), F.greatest("prev", "node").alias("b")).agg(F.max("lcp").alias("lcp"), F.count("*").alias("trees"))
    clear = pairs.filter(F.col("trees") >= int(TREES * similarity**LEAST_DEPTH)).groupBy("lcp").count().collect()  # a row for each length
    per = {r["lcp"]: r["count"] for r in clear}
    depth = DEPTH
    while depth > LEAST_DEPTH:
        seen = sum(n for k, n in per.items() if k >= depth) / sum(per.values()) if per else 1.0
        if recall_at(similarity, depth) >= target and seen >= target:
            break
        depth -= 1
    return depth


def verify(members: DataFrame, similarity: float) -> DataFrame:
    """node, links, root for the members (comp, i, j, side, node, copies, text) of each pair of blocks."""

    def linked(side, same, nodes, copies, texts):
        h, per = shingles(to_arrow(texts, pa.string()))
        owner = np.repeat(np.arange(len(per)), per)
        order = np.argsort(h, kind="stable")
        h, owner = h[order], owner[order]
        new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
        col = np.cumsum(new) - 1
        shared = np.bincount(col) > 1 if len(col) else np.zeros(0, bool)
        number = np.cumsum(shared) - 1
        use = shared[col] if len(col) else np.zeros(0, bool)
        col, owner = number[col[use]] if len(col) else col, owner[use]
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        common = np.zeros((len(left), len(right)), np.float32)
        step = 4096
        for c in range(0, int(col.max(initial=-1)) + 1, step):
            s = slice(int(np.searchsorted(col, c)), int(np.searchsorted(col, c + step)))
            bits = np.zeros((len(side), step), np.float32)
            bits[owner[s], col[s] - c] = 1
            common += bits[left] @ bits[right].T
        total = per[left][:, None] + per[right][None, :] - common
        hit = (common >= similarity * total - 1e-6) & (common > 0) & (left[:, None] != right[None, :])
        links = np.zeros(len(side), np.int64)
        np.add.at(links, left, hit @ copies[right])
        if left is not right:
            np.add.at(links, right, hit.T @ copies[left])
        root = np.arange(len(side))
        new_left, new_right = np.ones(len(left), bool), np.ones(len(right), bool)
        for x in range(len(left)):  # breadth first: each row and each column of hit is read once
            if not new_left[x]:
                continue
            front, new_left[x] = np.array([x]), False
            while len(front):
                out = np.flatnonzero(hit[front].any(axis=0) & new_right)
                new_right[out] = False
                root[right[out]] = left[x]
                front = np.flatnonzero(hit[:, out].any(axis=1) & new_left)
                new_left[front] = False
                root[left[front]] = left[x]
            root[left[x]] = left[x]
        return links, [nodes[x] for x in root.tolist()]

    def run(batches):
        key, held = None, []

        def flush():
            if len(held) > 1:
                side = np.array([x[0] for x in held])
                links, roots = linked(side, key[1] == key[2], [x[1] for x in held], np.array([x[2] for x in held], np.int64), [x[3] for x in held])
                some = np.flatnonzero(links).tolist()
                if some:
                    yield pa.RecordBatch.from_arrays([to_arrow([held[x][1] for x in some], pa.binary()), to_arrow(links[some], pa.int64()), to_arrow([roots[x] for x in some], pa.binary())], names=["node", "links", "root"])

        for b in batches:
            keys = list(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
            rows = list(zip(*(b.column(i).to_pylist() for i in range(3, 7)), strict=True))
            for k, r in zip(keys, rows, strict=True):
                if k != key:
                    yield from flush()
                    key, held = k, []
                held.append(r)
        yield from flush()
        held.clear()
        give_back()

    placed = members.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    return placed.select("comp", "i", "j", "side", "node", "copies", "text").mapInArrow(run, "node binary, links long, root binary")


def of_members(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The rows whose rid is in members, and a few others: those that a filter of FILTER_BITS bits lets pass.

    The filter is a table of bitmaps of a fixed size at most (8 MB), so it is broadcast whatever the size of the corpus; it only saves
    the exchange of texts that have no candidate, and lets more of them pass when it is full.
    """
    bit = F.pmod(F.xxhash64("rid"), F.lit(FILTER_BITS))
    of_bit = (bit / BITMAP_BITS).cast("int"), (bit % BITMAP_BITS).cast("bigint")
    bits = materialise(members.select(of_bit[0].alias("_bucket"), of_bit[1].alias("_bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map")), "ngram-filter")
    tested = rows.withColumns({"_b": of_bit[0], "_at": of_bit[1]}).join(F.broadcast(bits), F.col("_b") == F.col("_bucket"))
    byte = F.conv(F.hex(F.expr("substring(_map, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return tested.filter(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1).select(*rows.columns)


def classes_of(df: DataFrame, id_col: str, text: str, similarity: float, target: float, carry: bool = False) -> tuple[DataFrame, DataFrame]:
    """The sketch, and of each node (_n) class_id, n_links, copies, and if carry the rid of its class's first row: of smallest id, null last."""
    spark = df.sparkSession
    rows = sketch(df, id_col, text, carry)
    head = [F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("head")] if carry else []
    nodes, at_nodes = materialised(rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("first_id"), F.min("rid").alias("rid"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), *head), "ngram-nodes")
    edges = neighbours(nodes)
    depth = depth_for(edges, similarity, target)
    comps = components(edges.filter(F.col("lcp") >= depth).select(F.col("node").alias("a"), F.col(f"h{depth}").alias("b"))).withColumnRenamed("node", "_n")
    members, at_members = materialised(nodes.drop("sig", "head").join(comps, F.col("node") == F.col("_n")).drop("_n"), "ngram-members")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy("comp").agg(blocks.alias("blocks")).withColumnRenamed("comp", "_c")
    placed = members.join(sizes, F.col("comp") == F.col("_c")).drop("_c").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = of_members(rows.select("rid", "text"), members).withColumnRenamed("rid", "_r")
    whole = texts.join(placed.select("rid", "comp", "node", "copies", "block", "blocks").hint("merge"), F.col("_r") == F.col("rid"))  # the same plan at any size
    pairs = whole.select("comp", "node", "copies", "text", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "copies", "text")
    found, at_found = materialised(verify(pairs, similarity), "ngram-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    info = nodes.select("node", "first_id", "copies", *(["head"] if carry else [])).join(links.withColumnRenamed("node", "_l"), F.col("node") == F.col("_l"), "left")
    info = info.join(classes.withColumnRenamed("node", "_k"), F.col("node") == F.col("_k"), "left").withColumn("comp", F.coalesce("comp", "node"))
    names = info.groupBy("comp").agg(F.min("first_id").alias("class_id"), *([F.min("head").getField("rid").alias("keep_rid")] if carry else [])).withColumnRenamed("comp", "_p")
    info = info.join(names, F.col("comp") == F.col("_p")).select(F.col("node").alias("_n"), "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "copies", *(["keep_rid"] if carry else []))
    info = materialise(info, "ngram-info")
    discard(spark, at_nodes, at_members, at_found)
    return rows, info


def join(df: DataFrame, id_col: str = "doc_id", text: str = "text", *, similarity: float = 0.8, target: float = 0.999) -> DataFrame:
    """doc_id, class_id, n_links, n_copies (rows with the same shingles) and n_shingles of each row."""
    rows, info = classes_of(df, id_col, text, similarity, target)
    out = rows.select("id", "node", "n_shingles").join(info, F.col("node") == F.col("_n"), "left")
    return out.select(F.col("id").alias("doc_id"), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("n_copies"), "n_shingles")


def keep_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text", *, similarity: float = 0.8, target: float = 0.999) -> DataFrame:
    """One row of df of each class: that of the smallest id, null last, and the first of those. Rows without shingles stay."""
    rows, info = classes_of(df, id_col, text, similarity, target, True)
    gone = rows.select("rid", "node").join(info, F.col("node") == F.col("_n")).filter(F.col("rid") != F.col("keep_rid")).select(F.col("rid").alias("_gone"))
    kept = rows.join(gone, F.col("rid") == F.col("_gone"), "left_anti")
    return kept.select(*[F.col("text").cast(df.schema[c].dataType).alias(c) if c == text else F.col(f"_row.`{c}`") for c in df.columns])
