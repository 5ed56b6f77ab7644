"""Byte-level BPE: encoding and decoding of whole texts with a rank file.

Method. Each task cuts the texts of its partition into blocks, splits them with the tokenizer's
pattern and lists the distinct words that are new in a block. Spark higher-order functions fold the ranked
merges over the byte array of each such word; ranks come from a literal map (a perfect hash in
two literal arrays, so a look-up is two array reads). A second pass strings the ids of the
words together by document; decoding joins the binary pieces of the ids. Nothing is shuffled:
memory is bounded by one block and the words a task remembers, and a lost task is rerun from its input split alone.

A bounded list of frequent words (`cached` at most, from `sample_rows` documents at most) is
folded first, by the same fold, and handed to every task; it only saves work.

Defined cases: a null or empty text has no ids (hash of no bytes); a text of any length is one
block at least, and one word of any length is cut where no token reaches across (`Cutter`); repeated rows give repeated rows; an empty table gives an empty table; all other
columns of the input are passed on, result columns get leading underscores where names clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections import defaultdict
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import bound_batches, bound_plan_strings, free_name, give_back, let, list_lengths, materialise, ragged, text_slices, to_arrow, to_numpy

BLOCK_BYTES = 1 << 19  #: a task holds several forms of a block at a time: its Arrow buffers twice, Spark's rows, both Python workers
BATCH_BLOCKS = 4  #: blocks' worth of text in an Arrow batch
SHIFT = 17  #: ids are below 2**17
RANK_SHIFT = 41  #: offsets in a word are below 2**24
NONE = 1 << SHIFT
MOST_WORDS = 200_000  #: words that a task remembers
LONG = 64  #: characters: longer words are cut where no token reaches across
MOST_FOLD = 256  #: bytes that are folded in one array, as the fold's work grows with the square


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def rank_map(path: str) -> tuple[str, str, int, int]:
    """All pairs of ids that merge, as a perfect hash: (slots, displacements) as JSON, and their sizes.

    The pair k = a << 17 | b is at slot (k + displacement[k mod buckets]) mod slots, which then holds k << 17 | merged id.
    """
    ranks = load_ranks(path)
    if max(ranks.values()) >= 1 << SHIFT:
        raise ValueError("ids must be below 2**17")
    found = [(a << SHIFT | b, r) for tok, r in ranks.items() for i in range(1, len(tok)) if (a := ranks.get(tok[:i])) is not None and (b := ranks.get(tok[i:])) is not None]
    n_disp, n_slots = len(found) // 2 + 1, int(len(found) / 0.85) | 1
    by_bucket: dict[int, list[tuple[int, int]]] = {}
    for k, r in found:
        by_bucket.setdefault(k % n_disp, []).append((k, r))
    while any(len({k % n_slots for k, _ in own}) < len(own) for own in by_bucket.values()):  # keys of a bucket must differ
        n_slots += 2
    slots, disp = [1 << 52] * n_slots, [0] * n_disp
    free = bytearray(b"\x01") * n_slots
    for q, own in sorted(by_bucket.items(), key=lambda x: (-len(x[1]), x[0])):
        head, rest = own[0][0] % n_slots, [k - own[0][0] for k, _ in own[1:]]
        begin = q * 7919 % n_slots if rest else 0
        tries = chain(range(begin, n_slots), range(begin))
        at = next((t for t in tries if free[t] and all(free[(t + x) % n_slots] for x in rest)), -1) if rest else free.find(1)
        if at < 0:
            raise ValueError("the rank map has no perfect hash of this form")
        disp[q] = (at - head) % n_slots
        for k, r in own:
            s = (k + disp[q]) % n_slots
            free[s], slots[s] = 0, k << SHIFT | r
    return json.dumps(slots, separators=(",", ":")), json.dumps(disp, separators=(",", ":")), n_slots, n_disp


def merge_fold(word: Column, path: str) -> Column:
    """array<bigint> of ids for a word: the pair of lowest rank, leftmost first, merges until no pair does.

    A place of the word holds merged << 41 | offset << 17 | id: its id, its first byte's offset, and the id that it would merge to with
    its right neighbour (NONE: does not merge), so the least number is the merge that is due. `word` has these numbers for the word's
    bytes; a merge looks up its two new pairs only.
    """
    slots_json, disp_json, n_slots, n_disp = rank_map(path)
    slots, disp = F.from_json(F.lit(slots_json), "array<bigint>"), F.from_json(F.lit(disp_json), "array<bigint>")
    none, id_bits, low_bits = F.lit(NONE), (1 << SHIFT) - 1, (1 << RANK_SHIFT) - 1

    def look(k: Column) -> Column:  # the slot of another pair differs above the id's bits
        held = F.get(slots, ((k + F.get(disp, (k % n_disp).cast("int"))) % n_slots).cast("int"))
        return F.shiftleft(F.least(held.bitwiseXOR(F.shiftleft(k, SHIFT)), none), RANK_SHIFT)

    def step(places: Column) -> Column:
        def merge(low: Column) -> Column:
            def at(p: Column) -> Column:
                left, new = F.get(places, p - 2), F.shiftright(low, RANK_SHIFT)
                pairs = F.array(F.shiftleft(left.bitwiseAND(id_bits), SHIFT).bitwiseOR(new), F.shiftleft(new, SHIFT).bitwiseOR(F.get(places, p + 1).bitwiseAND(id_bits)))

                def join(found: Column) -> Column:
                    before = F.when(p > 1, F.array(F.get(found, 0).bitwiseOR(left.bitwiseAND(low_bits)))).otherwise(F.slice(places, 1, 0))
                    after = F.when(p + 1 < F.size(places), F.get(found, 1)).otherwise(F.lit(NONE << RANK_SHIFT))
                    here = F.array(after.bitwiseOR(low.bitwiseAND(low_bits - id_bits)).bitwiseOR(new))
                    return F.concat(F.slice(places, F.lit(1), F.greatest(p - 2, F.lit(0))), before, here, F.slice(places, p + 2, F.size(places)))

                return let(F.transform(pairs, look), join)

            return F.when(low < F.lit(NONE << RANK_SHIFT), let(F.array_position(places, low).cast("int"), at)).otherwise(places)

        return let(F.array_min(places), merge)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(word) - 1, F.lit(1))), word, lambda s, _: step(s), lambda s: F.transform(s, lambda x: x.bitwiseAND(id_bits)))


def byte_table(ranks: dict[bytes, int]) -> np.ndarray:
    """[a, b]: merged << 41 | id of byte a before byte b (b = 256: at the end of a word)."""
    out = np.full((256, 257), NONE, np.int64)
    for tok, r in ranks.items():
        if len(tok) == 2:
            out[tok[0], tok[1]] = r
    return out << RANK_SHIFT | np.array([ranks[bytes([i])] for i in range(256)], np.int64)[:, None]


#: For texts of ASCII and Latin letters only, where the built-in engine's classes are those of the tokenizer's usual pattern.
USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|[ \t-\r]+(?!\S)|[ \t-\r]+"
BEYOND = "[^\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"


def splitter(pattern: str):
    """A function from a text to its list of words."""
    import re

    import regex

    full = regex.compile(pattern).findall
    if pattern != USUAL:
        return full
    plain, beyond = re.compile(PLAIN).findall, re.compile(BEYOND).search
    return lambda text: full(text) if beyond(text) else plain(text)


def _byte_lists(words: list[str | bytes | int], byte_ids: np.ndarray) -> pa.ListArray:
    """The places of words (text), parts of words (bytes), and single tokens (ids)."""
    raw = [w.encode() if isinstance(w, str) else w if isinstance(w, bytes) else b"." for w in words]
    offsets = np.zeros(len(raw) + 1, np.int32)
    np.cumsum([len(w) for w in raw], out=offsets[1:])
    flat = np.frombuffer(b"".join(raw), np.uint8)
    after = np.append(flat[1:], 0).astype(np.int64)
    after[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = 256
    lens = np.diff(offsets).astype(np.int64)
    place = np.arange(len(flat)) - np.repeat(offsets[:-1].astype(np.int64), lens)
    places = byte_ids[flat, after] | place << SHIFT
    whole = [(i, w) for i, w in enumerate(words) if isinstance(w, int)]
    if whole:
        places[offsets[[i for i, _ in whole]]] = NONE << RANK_SHIFT | np.array([w for _, w in whole], np.int64)
    return pa.ListArray.from_arrays(to_arrow(offsets, pa.int32()), to_arrow(places, pa.int64()))


class Cutter:
    """Cuts a long word where no token can reach across, which leaves its ids as they are.

    Whatever stands on both sides of a merge is part of a token of the vocabulary: two bytes that are a token, or three bytes that some token
    has in a row, one of them across the place. Where neither is so nothing merges across, and the parts on both sides are encoded apart. A
    part that stays longer than MOST_FOLD bytes (long runs of one sign and the like) is merged here by a heap of its pairs, and its ids are
    handed on one by one.
    """

    def __init__(self, pieces: list[bytes]):
        self.pieces, self.ranks = pieces, {}
        self.pairs = np.zeros(1 << 16, bool)
        self.pairs[[t[0] << 8 | t[1] for t in pieces if len(t) == 2]] = True
        self.threes = np.array(sorted({t[k] << 16 | t[k + 1] << 8 | t[k + 2] for t in pieces for k in range(len(t) - 2)} | {-1}))

    def __call__(self, word: str) -> list[bytes | int]:
        raw = word.encode()
        b = np.frombuffer(raw, np.uint8).astype(np.int64)
        joined = self.pairs[b[:-1] << 8 | b[1:]]  # place i: between bytes i and i + 1
        three = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
        held = self.threes[np.searchsorted(self.threes, three, side="right") - 1] == three
        joined[:-1] |= held
        joined[1:] |= held
        cuts = [0, *(np.flatnonzero(~joined) + 1).tolist(), len(raw)]
        out: list[bytes | int] = []
        for start, stop in zip(cuts, cuts[1:], strict=False):
            out += [raw[start:stop]] if stop - start <= MOST_FOLD else self.merged(raw[start:stop])
        return out

    def merged(self, raw: bytes) -> list[int]:
        """Ids of raw: the least pair, leftmost first, merges until none does."""
        self.ranks = self.ranks or {t: r for r, t in enumerate(self.pieces) if t}
        n, get = len(raw), self.ranks.get
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        none = len(self.pieces)
        due = [get(raw[i : i + 2], none) for i in range(n - 1)] + [none]
        heap = [(r, i) for i, r in enumerate(due) if r < none]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if due[i] != r:
                continue  # merged since, or another pair by now
            j = after[i]
            end[i], after[i], due[j] = end[j], after[j], none
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0:
                    due[k] = get(raw[k : end[after[k]]], none) if after[k] < n else none
                    if due[k] < none:
                        heapq.heappush(heap, (due[k], k))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[raw[i : end[i]]])
            i = after[i]
        return out


def _cache(df: DataFrame, path: str, pattern: str, cached: int, sample_rows: int, byte_ids: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Frequent words of a bounded sample with their ids: words, ids of all words in turn, offsets."""
    rows = df.count()
    sample = df if rows <= sample_rows else df.filter(F.pmod(F.xxhash64(df.columns[0]), F.lit(rows)) < sample_rows)

    def count_words(batches):
        find, n = splitter(pattern), {}
        for part in text_slices(batches, 0, BLOCK_BYTES):
            for text in part.column(0).to_pylist():
                for w in find(text or ""):
                    if len(w) <= LONG:
                        n[w] = n.get(w, 0) + 1
            if len(n) > 500_000:
                yield pa.RecordBatch.from_arrays([to_arrow(list(n), pa.string()), to_arrow(np.fromiter(n.values(), np.int64, len(n)), pa.int64())], names=["w", "n"])
                n = {}
        yield pa.RecordBatch.from_arrays([to_arrow(list(n), pa.string()), to_arrow(np.fromiter(n.values(), np.int64, len(n)), pa.int64())], names=["w", "n"])

    counted = sample.select(df.columns[0]).mapInArrow(count_words, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    top = counted.filter("n > 1").orderBy(F.desc("n"), "w").limit(cached)

    def as_bytes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _byte_lists(b.column(0).to_pylist(), byte_ids)], names=["w", "b"])

    cores = max(2, df.sparkSession.sparkContext.defaultParallelism)
    listed = materialise(top.select("w").repartition(4 * cores), "bpe-words")  # a plan with the rank map has no exchange: Spark describes it once, not at each new stage
    got = listed.mapInArrow(as_bytes, "w string, b array<bigint>").select("w", merge_fold(F.col("b"), path).cast("array<int>").alias("ids")).toArrow().combine_chunks()
    if not got.num_rows:
        return [], np.zeros(0, np.uint32), np.zeros(1, np.int64)
    words, ids = got["w"].to_pylist(), got["ids"].combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    lengths = np.diff(ids.offsets.to_numpy()).astype(np.int64)
    return words, ids.flatten().to_numpy().astype(np.uint32), np.concatenate([[0], np.cumsum(lengths)])


def encode(df: DataFrame, text: str, path: str, pattern: str, *, with_ids: bool = False, with_decoded: bool = False, cached: int = 400_000, sample_rows: int = 20_000) -> DataFrame:
    """df's other columns, then n_tokens, ids_sha256, decoded_sha256 (with_ids: ids array<int>; with_decoded: decoded binary)."""
    spark = df.sparkSession
    bound_batches(spark, BATCH_BLOCKS * BLOCK_BYTES)
    bound_plan_strings(spark)
    ranks = load_ranks(path)
    byte_ids = byte_table(ranks)
    kept = [f for f in df.schema.fields if f.name != text]
    names = [f.name for f in kept]
    out_n, out_ids, out_dec, out_list, out_raw = (free_name(names, w) for w in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"))
    whole = df.select(F.col(f"`{text}`").cast("string").alias("t"), *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)])
    carried = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kept)] + [T.StructField("row", T.IntegerType())])

    pieces = [b""] * (max(ranks.values()) + 1)
    for tok, r in ranks.items():
        pieces[r] = tok
    words, flat, offsets = _cache(whole.select("t"), path, pattern, cached, sample_rows, byte_ids) if cached else ([], np.zeros(0, np.uint32), np.zeros(1, np.int64))
    listed = spark.sparkContext.broadcast(pa.array(words, pa.string()))  # a list is several times as large while it is packed
    known = spark.sparkContext.broadcast((flat, offsets, np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])))

    del words, flat, offsets, pieces
    give_back()  # the driver keeps the broadcast form only

    def split(batches):
        find, cut = splitter(pattern), None
        fixed = listed.value.to_pylist()
        known_words: defaultdict[str | bytes | int, int] = defaultdict()

        def forget():
            known_words.clear()
            known_words.update(zip(fixed, range(len(fixed)), strict=True))
            known_words.default_factory = count(len(fixed)).__next__  # a new word gets the next number

        forget()
        for part in text_slices(batches, 0, BLOCK_BYTES):
            if len(known_words) > len(fixed) + MOST_WORDS:
                forget()
            before, counts, refs = len(known_words), [], [np.zeros(0, np.int32)]
            for t in part.column(0).to_pylist():
                ws = find(t) if t else ()
                if ws and max(map(len, ws)) > LONG:
                    if cut is None:
                        _, _, table, ends = known.value
                        cut = Cutter([table[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)])
                    ws = [k for w in ws for k in (cut(w) if len(w) > LONG else (w,))]
                counts.append(len(ws))
                refs.append(np.fromiter(map(known_words.__getitem__, ws), np.int32, len(ws)))
            new = list(islice(known_words, before, None))
            rows = pa.StructArray.from_arrays([*part.columns[1:], to_arrow(np.arange(part.num_rows), pa.int32())], names=[f"c{i}" for i in range(part.num_columns - 1)] + ["row"])
            one = lambda a: pa.ListArray.from_arrays(to_arrow(np.array([0, len(a)]), pa.int32()), a)
            yield pa.RecordBatch.from_arrays([one(rows), one(to_arrow(np.array(counts), pa.int32())), one(to_arrow(np.concatenate(refs), pa.int32())), one(_byte_lists(new, byte_ids)), to_arrow(np.array([before - len(fixed)]), pa.int32())], names=["rows", "counts", "refs", "words", "before"])
        known_words.clear()
        give_back()

    def assemble(batches):
        flat, offsets, table, ends = known.value
        starts0, lens0 = offsets[:-1], np.diff(offsets)
        pool, starts, lens = flat, starts0, lens0
        for batch in batches:
            for i in range(batch.num_rows):
                rows, counts, refs, ids = (batch.column(k).slice(i, 1).flatten() for k in range(4))
                own = to_numpy(ids.flatten()).astype(np.uint32)
                own_lens = list_lengths(ids)
                if not batch.column(4)[i].as_py():
                    pool, starts, lens = flat, starts0, lens0
                starts = np.concatenate([starts, len(pool) + np.cumsum(own_lens) - own_lens])
                lens, pool = np.concatenate([lens, own_lens]), np.concatenate([pool, own])
                refs, counts = to_numpy(refs), to_numpy(counts)
                ids_sha, dec_sha, n_tok, id_lists, raw = [], [], [], [], []
                at = 0
                for n in counts.tolist():
                    r = refs[at : at + n]
                    at += n
                    tokens = pool[ragged(starts[r], lens[r])]
                    n_tok.append(len(tokens))
                    ids_sha.append(hashlib.sha256(tokens.astype("<u4").tobytes()).hexdigest())
                    decoded = table[ragged(ends[tokens], ends[tokens + 1] - ends[tokens])].tobytes()
                    dec_sha.append(hashlib.sha256(decoded).hexdigest())
                    if with_ids:
                        id_lists.append(tokens.astype(np.int32))
                    if with_decoded:
                        raw.append(decoded)
                cols = [rows.field(k) for k in range(rows.type.num_fields - 1)] + [to_arrow(np.array(n_tok), pa.int64()), to_arrow(ids_sha, pa.string()), to_arrow(dec_sha, pa.string())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(to_arrow(np.cumsum([0, *n_tok]), pa.int32()), to_arrow(np.concatenate(id_lists), pa.int32())))
                if with_decoded:
                    cols.append(to_arrow(raw, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[f"o{k}" for k in range(len(cols))])
        del pool, starts, lens
        give_back()

    blocks = T.StructType([T.StructField("rows", T.ArrayType(carried)), T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("refs", T.ArrayType(T.IntegerType())), T.StructField("words", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("before", T.IntegerType())])
    done = [T.StructField(f"o{i}", f.dataType) for i, f in enumerate(kept)] + [T.StructField(f"o{len(kept)}", T.LongType()), T.StructField(f"o{len(kept) + 1}", T.StringType()), T.StructField(f"o{len(kept) + 2}", T.StringType())]
    for kind in [T.ArrayType(T.IntegerType())] * with_ids + [T.BinaryType()] * with_decoded:
        done.append(T.StructField(f"o{len(done)}", kind))
    folded = whole.mapInArrow(split, blocks).select("rows", "counts", "refs", F.transform("words", lambda w: merge_fold(w, path).cast("array<int>")).alias("words"), "before")
    final = [*names, out_n, out_ids, out_dec, *[out_list] * with_ids, *[out_raw] * with_decoded]
    return folded.mapInArrow(assemble, T.StructType(done)).toDF(*final)
