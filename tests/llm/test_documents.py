"""Operators over documents: brute force on the small tables, and defined results on awkward rows."""

import hashlib
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tidelog.llm import bpe, exact_dedup, langid, mixing, ngram_join, queries, sharding, token_counts
from tidelog.llm.words import load_pieces

SF = "/root/testdata/sf0.001"
PIECES = load_pieces(P.path("piece_bpe_32k.model"))
RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def same_sql(spark, oracle, name):
    from tests.conftest import same_rows

    same_rows(spark, oracle, queries.QUERIES[name], queries.ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, oracle, name):
    same_sql(spark, oracle, name)


def check_bpe(df):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    got = bpe.encode(df.select("doc_id", "text", F.col("text").alias("whole")), "text", RANKS, P.PATTERN, with_ids=True, with_decoded=True, cached=500, sample_rows=5).collect()
    for r in got:
        ids = enc.encode_ordinary(r.whole or "")
        assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == (r.whole or "").encode()
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256((r.whole or "").encode()).hexdigest()
    return len(got)


def test_bpe(spark, awkward, nothing):
    assert check_bpe(docs(spark)) == docs(spark).count()
    assert check_bpe(awkward.filter("doc_id <> 6 OR doc_id IS NULL")) == awkward.count() - 1
    assert check_bpe(nothing) == 0
    assert bpe.encode(awkward, "text", RANKS, P.PATTERN, cached=0).columns[-3:] == ["_n_tokens", "ids_sha256", "decoded_sha256"]


def test_bpe_in_small_blocks(spark):
    """Blocks and Arrow batches stay small beside what a task holds of them, and texts over many blocks keep their ids."""
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    rows = [(i, " ".join(f"w{(i * 7919 + k) % 50_021} the" for k in range(60_000))) for i in range(6)]
    assert sum(len(t) for _, t in rows) > 5 * bpe.BLOCK_BYTES
    assert check_bpe(own.createDataFrame(rows, "doc_id int, text string").coalesce(1)) == 6
    assert bpe.BLOCK_BYTES <= 1 << 20 and int(own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 2 << 20


def test_bpe_of_long_words(spark):
    import random
    import time

    r = random.Random(4)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    letters = lambda n: "".join(r.choices(signs[:52], k=n))
    english = "".join(r.choices("the quick brown fox jumps over a lazy dog and then some other words follow it".split(), k=20_000))
    texts = ["a" * 100_000, letters(100_000), letters(1_000_000), "=" * 50_000, " " * 30_000 + "x", "ab" * 20_000, english, "é" * 9_000, "".join(r.choices(signs, k=70)), "a" * 1_000_000, "".join(r.choices("一二三四五六七", k=5_000))]
    began = time.time()
    got = {r.i: r for r in bpe.encode(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text", RANKS, P.PATTERN, cached=0, with_ids=True).collect()}
    print(time.time() - began)
    for i, t in enumerate(texts):
        if len(set(t[:2000])) > 2 or len(t) <= 30_000:
            assert got[i].ids == enc.encode_ordinary(t), i
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert got[0].ids == enc.encode_ordinary("a" * 100_000)


def test_splitter():
    import regex

    full, fast = regex.compile(P.PATTERN).findall, bpe.splitter(P.PATTERN)
    for t in ("I'LL don't  stop\n\n now_ _a1 é×ü÷ ½ x²", "\x1c\x85 a\x0b\x0c b", "Ⅷ 1234abc  ", "tab\t\tend \r\n"):
        assert fast(t) == full(t)


def test_sharding(spark, awkward, nothing):
    for df in (docs(spark), awkward):
        rows = sharding.shard(df, "doc_id", "text", 24).collect()
        n, counts = len(rows), Counter(r.shard for r in rows)
        assert n == df.count() and max(counts[i] for i in range(24)) - min(counts[i] for i in range(24)) <= 1
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
            assert sharding.row_of(r.shard, r.slot, n, 24, 20240229) == r.row_no
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shard(docs(spark).repartition(7), "doc_id", "text", 24).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in sharding.shard(docs(spark), "doc_id", "text", 24).collect()}
    assert sharding.shard(nothing, "doc_id", "text").count() == 0


def test_permutation(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        want = [sharding.image_of(i, n, 7) for i in range(n)]
        assert sorted(want) == list(range(n))
        assert [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 7)).collect()] == want


def test_token_counts(spark, awkward, nothing):
    vocabulary = set(PIECES)

    def greedy(word):
        s, n, i = "▁" + word, 0, 0
        while i < len(s):
            j = next((j for j in range(min(len(s), i + 40), i, -1) if s[i:j] in vocabulary), None)
            if j is None:
                return 1
            n, i = n + 1, j
        return n

    for df in (docs(spark), awkward):
        for r in token_counts.count_tokens(df.select("doc_id", "text", F.col("text").alias("whole")), "text", PIECES).collect():
            assert (r.n_words, r.n_tokens) == (len(words(r.whole)), sum(map(greedy, words(r.whole))))
    assert token_counts.count_tokens(nothing, "text", PIECES).count() == 0


def test_exact_dedup(spark, awkward, nothing):
    groups = defaultdict(list)
    for r in awkward.collect():
        groups[normal(r.text)].append(r.doc_id)
    got = exact_dedup.mark(awkward).collect()
    assert len(got) == awkward.count() and sum(r.kept for r in got) == len(groups)
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = digest[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None)
    kept = exact_dedup.keep_rows(awkward)
    assert kept.columns == awkward.columns and sorted(normal(r.text) for r in kept.collect()) == sorted(groups)
    assert exact_dedup.mark(nothing).count() == 0 and exact_dedup.keep_rows(nothing).count() == 0


def test_mixing(spark, awkward, nothing):
    got = mixing.plan(awkward).collect()
    assert len(got) == awkward.count() and all(0 <= r.taken <= 2 * r.size for r in got)
    rows = mixing.mixed_rows(docs(spark)).collect()
    plan = mixing.plan(docs(spark)).collect()
    taken = Counter()
    for r in rows:
        taken[r.doc_id] += len(words(r.text))
    assert taken == Counter({r.doc_id: r.taken for r in plan if r.taken})
    per, target = Counter(), {}
    by_id = {r.doc_id: r.source for r in docs(spark).collect()}
    for r in plan:
        per[by_id[r.doc_id]] += r.taken
        target[by_id[r.doc_id]] = r.target
    assert all(abs(per[s] - t) <= 0.05 * t + 1 for s, t in target.items())
    assert mixing.plan(nothing).count() == 0 and mixing.mixed_rows(nothing).count() == 0
    assert mixing.mixed_rows(awkward).columns == awkward.columns


def test_quotas_are_highest_quotients(spark):
    t = spark.createDataFrame([("a", 1000, 530.0), ("b", 900, 240.0), ("c", 800, 230.0), (None, 7, 0.0)], "source string, source_size long, target double").withColumn("rank", F.col("source_size")).withColumn("weight", F.lit(1))
    got = {(r.source, r.shard): r.quota for r in mixing.quotas(t, shards=4).collect()}
    block = 3  # floor(230 / 64)
    seats = round(1000 / block)
    order = sorted(((-v / (2 * j + 1), s) for s, v in (("a", 530.0), ("b", 240.0), ("c", 230.0)) for j in range(seats)))[:seats]
    assert {s: sum(got[s, k] for k in range(4)) for s in "abc"} == Counter(s for _, s in order) and got[None, 0] == 0


def brute_links(rows):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    links, root = Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and len(x & y) >= 0.8 * len(x | y):
                links[ids[a]] += 1
                links[ids[b]] += 1
                p, q = find(ids[a]), find(ids[b])
                root[max(p, q)] = min(p, q)
    return links, {i: find(i) for i in ids}


def test_ngram_join(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    links, classes = brute_links(rows)
    got = {r.doc_id: (r.n_links, r.class_id) for r in ngram_join.join(docs(spark)).collect()}
    assert got == {i: (links[i], classes[i]) for i, _ in rows}
    odd = ngram_join.join(awkward).collect()
    assert len(odd) == awkward.count()
    assert {(r.class_id, r.n_links) for r in odd if r.doc_id in (1, 2)} == {(1, 2)} and {(r.class_id, r.n_links) for r in odd if r.doc_id in (6, 7)} == {(6, 1)}
    assert all(r.n_links == 0 for r in odd if r.doc_id in (3, 4, 5))
    assert ngram_join.join(nothing).count() == 0
    kept = ngram_join.keep_rows(awkward)
    assert kept.columns == awkward.columns and 2 not in {r.doc_id for r in kept.select("doc_id").collect()}


def test_near_copies_of_repeated_and_null_ids(spark):
    long = lambda w, *more: " ".join([*(f"{w}{i}" for i in range(80)), *more])
    rows = [(1, long("a")), (5, long("a", "x")), (5, long("clean")), (7, long("b")), (7, long("b", "y")), (None, long("c")), (None, long("c", "z")), (None, long("a", "q")), (None, None), (None, "")]
    got = ngram_join.keep_rows(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    texts = [(r.doc_id, r.text) for r in got]
    assert len(texts) == 6 and {(1, long("a")), (5, long("clean")), (None, None), (None, "")} <= set(texts)
    assert sum(i == 7 for i, _ in texts) == 1 and sum(i is None and bool(x) for i, x in texts) == 1


def test_ngram_blocks(spark, monkeypatch):
    """A group cut into many blocks gives the same links."""
    base = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join([*base[:k], f"x{k}", *base[k + 1 :]])) for k in range(40)] + [(100 + k, " ".join(base[: 50 + k])) for k in range(10)]
    links, classes = brute_links(rows)
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 4)
    got = {r.doc_id: (r.n_links, r.class_id) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (links[i], classes[i]) for i, _ in rows}


def test_langid(spark, awkward, nothing):
    truth = {r.doc_id: r.lang for r in docs(spark).collect()}
    out = langid.identify(docs(spark), "doc_id", "text", "lang", PIECES).collect()
    held = [r for r in out if r.held_out]
    assert len(out) == len(truth) and held and sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
    odd = langid.identify(awkward, "doc_id", "text", "lang", PIECES, keep=["doc_id"]).collect()
    assert len(odd) == awkward.count() and all(0 <= r.score <= 1 for r in odd)
    assert all((r.lang_pred, r.score) == ("und", 0) for r in odd if r.doc_id in (3, 4, 5, 9))
    assert langid.identify(nothing, "doc_id", "text", "lang", PIECES).count() == 0


def test_langid_by_brute_force(spark):
    """Prediction and score of whole texts, every word summed over all its segmentations one place at a time, long words too."""
    import math

    df = docs(spark).filter("doc_id < 60").unionByName(docs(spark).limit(1).selectExpr("cast(-1 as bigint) doc_id", "repeat('wordwithoutend', 400) text", "lang", "source", "n_chars"))
    counts = langid.training_counts(df, "doc_id", "text", "lang", ~langid.held_out(F.col("doc_id")), 1500, 15_000)
    langs, p = langid.fit(counts, PIECES)
    number = {x: i for i, x in enumerate(PIECES)}
    known: dict[str, list[float]] = {}

    def log_sum(xs):
        top = max(xs)
        return top + math.log(sum(math.exp(x - top) for x in xs))

    def of_word(w):
        if w not in known:
            s, out = "▁" + w, []
            for k in range(len(langs)):
                a = [0.0]
                for j in range(1, len(s) + 1):
                    arcs = [a[i] + math.log(p[number[s[i:j]], k]) for i in range(max(0, j - 20), j) if s[i:j] in number]
                    if s[j - 1] not in number:
                        arcs.append(a[j - 1] + math.log(p[-1, k]))
                    a.append(log_sum(arcs))
                out.append(a[-1])
            known[w] = out
        return known[w]

    assert max(map(len, PIECES)) <= 20
    texts = {r.doc_id: r.text for r in df.collect()}
    got = langid.identify(df, "doc_id", "text", "lang", PIECES, keep=["doc_id"]).collect()
    assert len(got) == len(texts)
    for r in got:
        ws = [x for x in map(langid.letters, words(texts[r.doc_id])) if x]
        if not ws:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        total = [sum(of_word(w)[k] for w in ws) for k in range(len(langs))]
        best = max(range(len(langs)), key=lambda k: total[k])
        assert r.lang_pred == langs[best] and abs(r.score - 1 / sum(math.exp(x - total[best]) for x in total)) < 1e-6


def test_forward_sums_all_segmentations():
    from tidelog.llm.words import MARK, Trie

    pieces = (MARK, "a", "b", "ab", MARK + "a", "ba")
    p = np.array([0.1, 0.2, 0.15, 0.25, 0.2, 0.1, 1e-7])[:, None]

    def total(s):
        return 1.0 if not s else sum(p[pieces.index(s[:k]), 0] * total(s[k:]) for k in range(1, len(s) + 1) if s[:k] in pieces) + (p[-1, 0] * total(s[1:]) if s[0] not in pieces else 0)

    for w in ("a", "ab", "abab", "bca", "ba"):
        assert np.isclose(np.exp(langid.Lattice(Trie(pieces), [w], len(pieces)).log_prob(p)[0, 0]), total(MARK + w))
        for window in (1, 2, 3, 4096):
            assert np.isclose(np.exp(langid.long_log_prob(Trie(pieces), w, p, len(pieces), 2, window)[0]), total(MARK + w))


def test_near_copies_in_one_large_group(spark):
    """5,000 near copies in several blocks: one class, all links, one row kept; extra columns of any name pass through."""
    base = [f"w{i}" for i in range(300)]
    rows = [(k, " ".join([*base[: k % 290], f"x{k}", *base[k % 290 + 1 :]]), "a", k) for k in range(5000)] + [(9000, "some other text that has no copy here", "b", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone string, rid long").repartition(8)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(df).collect()}
    assert got == {k: (0, 4999) for k in range(5000)} | {9000: (9000, 0)}
    assert sorted(r.doc_id for r in ngram_join.keep_rows(df.filter("doc_id < 30 OR doc_id = 9000")).collect()) == [0, 9000]


def test_components_of_hubs_and_chains(spark):
    from tidelog.llm.components import components

    edges = [(0, k) for k in range(1, 3000)] + [(k, k + 1) for k in range(10_000, 10_300)] + [(20_000, 20_000)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(3000), 0) | dict.fromkeys(range(10_000, 10_301), 10_000)


def test_conversions_load_no_pandas():
    """pandas takes 29 MB of each Python worker, and workers stay: the conversions of the pipeline's stages work without it."""
    code = """
import sys
import numpy as np, pyarrow as pa
from tidelog.llm.common import list_lengths, to_arrow, to_numpy
from tidelog.llm.words import distinct_words
from tidelog.llm import bpe
for kind, a in ((pa.int32(), np.arange(9)), (pa.int64(), np.arange(0)), (pa.float64(), np.array([0.5, np.nan])), (pa.bool_(), np.arange(11) % 3 == 0), (pa.bool_(), np.zeros(0, bool))):
    got = to_arrow(a, kind)
    got.validate(full=True)
    assert got.type == kind and got.null_count == 0 and repr(to_numpy(got).tolist()) == repr(a.tolist()) and repr(got.to_pylist()) == repr(a.tolist())
    assert repr(to_numpy(got.slice(1)).tolist()) == repr(a[1:].tolist())
for kind, a in ((pa.string(), ["é", None, "", "a\\0b"]), (pa.string(), []), (pa.binary(), [None, b"", b"xy"]), (pa.binary(), [None])):
    got = to_arrow(a, kind)
    got.validate(full=True)
    assert got.to_pylist() == a and got.null_count == a.count(None)
assert list_lengths(pa.ListArray.from_buffers(pa.list_(pa.int32()), 0, [None, pa.py_buffer(b"")], children=[to_arrow(np.arange(0), pa.int32())])).tolist() == []
words, refs, per = distinct_words(to_arrow(["x", None, " b  a\\tb ", "", "a"], pa.string()).slice(1))
assert ([words[i] for i in refs], per.tolist()) == (["b", "a", "b", "a"], [0, 3, 0, 1])
assert bpe._byte_lists(["ab", 7], np.zeros((256, 257), np.int64)).to_pylist() == [[0, 1 << 17], [1 << 58 | 7]]
assert "pandas" not in sys.modules
"""
    subprocess.run([sys.executable, "-c", code], check=True)


def test_stages_load_no_pandas():
    code = """
import sys
import pyarrow as pa
from pyspark.sql import SparkSession
import corpus_pipeline
from tidelog.llm.common import to_arrow
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
sf = "/root/testdata/sf0.001"
docs = spark.read.parquet(sf + "/documents.parquet")
for name, stage in corpus_pipeline.STAGES:
    assert stage(spark, docs, sf).collect(), name
def loaded(batches):
    list(batches)
    yield pa.RecordBatch.from_arrays([to_arrow([name for name in ("pandas", "tidelog.llm.bpe") if name in sys.modules], pa.string())], names=["x"])
found = {r[0] for r in spark.range(8).repartition(8).mapInArrow(loaded, "x string").collect()}
assert found == {"tidelog.llm.bpe"}, found
"""
    subprocess.run([sys.executable, "-c", code], check=True)
