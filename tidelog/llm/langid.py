"""Language identification by segmentation-marginalised unigrams.

For each language a piece of a fixed public vocabulary has a probability; a word's probability is
the sum over all its segmentations into pieces (forward algorithm), a text's the product over its
words. Words are lower-cased letters of white-space tokens, with MARK in front; a character that
no piece covers is a piece of small fixed probability. Probabilities are fitted by expectation
maximisation (forward-backward) on word counts per language from a bounded sample: about
`sample_docs` labelled texts a language (chosen by hash of the id) and their `top_words` commonest
words. Prediction is a map over all texts: nothing is shuffled.

Defined cases: `und` with score 0 for a null text or one without a letter; without labelled rows
every text is `und`; words of any length are summed over all their segmentations (those of over
LETTERS letters, which are rare, give no training counts); ties go to the language first in code point
order; texts of any length are scored whole; repeated rows give repeated rows; an empty table gives
an empty table; other columns are passed on, result columns get leading underscores where names clash.
Of more than MOST_LANGS different labels the most frequent are learned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import bound_batches, free_name, give_back, text_slices, to_arrow
from tidelog.llm.words import MARK, SLICE_BYTES, Trie, WordCache, code_points, distinct_words

SCALE = 16.0  #: keeps forward values near 1: every character counts this much more
UNKNOWN = 1e-7
LETTERS = 40  #: longer words are summed by themselves, and are not learned from
FIT_WORDS = 4000  #: words whose lattice the driver holds at once while it fits
MOST_LANGS = 1000  #: the most frequent values of the language column are learned


def letters(word: str) -> str:
    w = word.lower()
    return w if w.isalpha() else "".join(c for c in w if c.isalpha())


def matches(trie: Trie, codes: np.ndarray, room: np.ndarray, starts: int, n_pieces: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and piece of all pieces that begin at the first `starts` places; room: code points from a place to its word's end."""
    node, at = np.zeros(starts, np.int64), np.arange(starts)
    found = []
    step = 0
    while len(at):
        node = trie.child(node, codes[at + step])
        hit = node >= 0
        if step == 0:  # a character that is no piece is an arc of its own all the same
            piece = np.where(hit, trie.ends[np.maximum(node, 0)], -1)
            found.append((at, np.ones(len(at), np.int64), np.where(piece >= 0, piece, n_pieces)))
            at, node = at[hit], node[hit]
        else:
            at, node = at[hit], node[hit]
            end = trie.ends[node]
            full = end >= 0
            found.append((at[full], np.full(int(full.sum()), step + 1, np.int64), end[full]))
        step += 1
        more = room[at] > step
        at, node = at[more], node[more]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


class Lattice:
    """All pieces at all places of some words: arcs (word, begin, end, piece), by end and word."""

    def __init__(self, trie: Trie, words: list[str], n_pieces: int):
        codes, lens = code_points([MARK + w for w in words])
        first = np.cumsum(lens) - lens
        place = np.arange(len(codes)) - np.repeat(first, lens)
        owner = np.repeat(np.arange(len(words)), lens)
        at, length, self.piece = matches(trie, codes, np.repeat(lens, lens) - place, len(codes), n_pieces)
        order = np.lexsort((owner[at], place[at] + length))
        at, length, self.piece = at[order], length[order], self.piece[order]
        self.n, self.lens, self.width = len(words), lens, int(lens.max(initial=0)) + 1
        self.begin = owner[at] * self.width + place[at]
        self.end = self.begin + length
        self.length = length
        ends = place[at] + length
        self.cuts = np.searchsorted(ends, np.arange(self.width + 1))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Forward values (places x languages) under p (pieces x languages)."""
        a = np.zeros((self.n * self.width, p.shape[1]))
        a[np.arange(self.n) * self.width] = 1.0
        for j in range(1, self.width):
            s = slice(self.cuts[j], self.cuts[j + 1])
            if s.start == s.stop:
                continue
            w = a[self.begin[s]] * p[self.piece[s]] * (SCALE ** self.length[s])[:, None]
            end = self.end[s]
            heads = np.flatnonzero(np.r_[True, end[1:] != end[:-1]])
            a[end[heads]] = np.add.reduceat(w, heads)
        return a

    def log_prob(self, p: np.ndarray) -> np.ndarray:
        a = self.forward(p)[np.arange(self.n) * self.width + self.lens]
        return np.log(np.maximum(a, 1e-300)) - (self.lens * np.log(SCALE))[:, None]

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts (pieces x languages), words weighted by counts (words x languages)."""
        a = self.forward(p)
        last = np.arange(self.n) * self.width + self.lens
        b = np.zeros_like(a)
        b[last] = counts / np.maximum(a[last], 1e-300)
        out = np.zeros_like(p)
        for j in range(self.width - 1, 0, -1):
            s = slice(self.cuts[j], self.cuts[j + 1])
            if s.start == s.stop:
                continue
            w = b[self.end[s]] * p[self.piece[s]] * (SCALE ** self.length[s])[:, None]
            for k in range(p.shape[1]):
                out[:, k] += np.bincount(self.piece[s], weights=w[:, k] * a[self.begin[s], k], minlength=len(p))
                b[:, k] += np.bincount(self.begin[s], weights=w[:, k], minlength=len(b))
        return out


def long_log_prob(trie: Trie, word: str, p: np.ndarray, n_pieces: int, longest: int, window: int = 4096) -> np.ndarray:
    """Lattice.log_prob of one word of any length: the same sums, forward from window to window, values scaled to 1 again and again."""
    codes, _ = code_points([MARK + word])
    n, log = len(codes), np.zeros(p.shape[1])
    a = np.zeros((window + longest + 1, p.shape[1]))
    a[0] = 1.0
    for start in range(0, n, window):
        own = codes[start : start + window + longest]
        here = min(window, n - start)
        at, length, piece = matches(trie, own, np.minimum(len(own), n - start) - np.arange(len(own)), here, n_pieces)
        order = np.argsort(at, kind="stable")
        at, length, weight = at[order], length[order], p[piece[order]] * (SCALE ** length[order])[:, None]
        cuts = np.searchsorted(at, np.arange(here + 1)).tolist()
        for j in range(here):
            if j % 16 == 0:
                top = a[j : j + longest].max(axis=0)
                a[j:] /= top
                log += np.log(top)
            s = slice(cuts[j], cuts[j + 1])
            a[j + length[s]] += a[j] * weight[s]  # pieces that begin at one place end at different ones
        if start + window < n:
            a[: longest + 1], a[longest + 1 :] = a[window : window + longest + 1].copy(), 0
        else:
            log += np.log(a[here])
    return log - n * np.log(SCALE)


def word_log_probs(trie: Trie, words: list[str], p: np.ndarray, n_pieces: int, longest: int) -> np.ndarray:
    """Log probability of each word in each language, words of any length."""
    out = np.zeros((len(words), p.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    short = [i for i in order if len(words[i]) <= LETTERS]
    for i in range(0, len(short), 8192):
        part = short[i : i + 8192]
        out[part] = Lattice(trie, [words[k] for k in part], n_pieces).log_prob(p)
    for i in order[len(short) :]:
        out[i] = long_log_prob(trie, words[i], p, n_pieces, longest)
    return out


def fit(counts: dict[str, dict[str, int]], pieces: tuple[str, ...], turns: int = 3) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (the last row: a character of no piece), from word counts by language."""
    langs = sorted(counts)
    words = sorted({w for c in counts.values() for w in c})
    n = np.array([[counts[k].get(w, 0) for k in langs] for w in words], float).reshape(len(words), len(langs))
    trie = Trie(pieces)
    p = np.full((len(pieces) + 1, len(langs)), 1.0 / (len(pieces) + 1))
    p *= (0.2 ** np.array([len(x) for x in pieces] + [1]))[:, None] * 5  # short pieces first; any start will do
    for _ in range(turns):
        got = np.full_like(p, 0.05)
        for i in range(0, len(words), FIT_WORDS):
            lat = Lattice(trie, words[i : i + FIT_WORDS], len(pieces))
            got += lat.expected(p, n[i : i + FIT_WORDS])
        got[-1] = 0
        p = got / got.sum(axis=0)
        p[-1] = UNKNOWN
    return langs, p


def training_counts(df: DataFrame, id_col: str, text: str, lang: str, train: Column, sample_docs: int, top_words: int) -> dict[str, dict[str, int]]:
    """Word counts of the commonest words by language, from about sample_docs training texts of each. Bounded by languages x top_words."""
    marked = df.filter(train & F.col(f"`{lang}`").isNotNull())
    by_lang = marked.groupBy(F.col(f"`{lang}`").cast("string").alias("l")).count()
    per = {r[0]: r[1] for r in by_lang.orderBy(F.desc("count"), "l").limit(MOST_LANGS).collect()}  # a row for each language
    if not per:
        return {}
    share = F.create_map(*[x for k, v in sorted(per.items()) for x in (F.lit(k), F.lit(int(1_000_000 * min(1.0, sample_docs / v)) + 1))])
    taken = marked.select(F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{lang}`").cast("string").alias("l"), F.pmod(F.xxhash64(f"`{id_col}`"), F.lit(1_000_000)).alias("h"))
    taken = taken.filter(F.col("t").isNotNull() & (F.col("h") < share[F.col("l")])).select("t", "l")

    def count(batches):
        for part in text_slices(batches, 0, SLICE_BYTES):
            found: dict[tuple[str, str], int] = {}
            lang_of = part.column(1).to_pylist()
            for k in set(lang_of):
                words, refs, _ = distinct_words(part.column(0).filter(to_arrow(np.array([x == k for x in lang_of], bool), pa.bool_())))
                for w, n in zip(words, np.bincount(refs, minlength=len(words)).tolist(), strict=True):
                    w = letters(w)
                    if 0 < len(w) <= LETTERS:
                        found[k, w] = found.get((k, w), 0) + n
            yield pa.RecordBatch.from_arrays([to_arrow([k for k, _ in found], pa.string()), to_arrow([w for _, w in found], pa.string()), to_arrow(np.fromiter(found.values(), np.int64, len(found)), pa.int64())], names=["l", "w", "n"])

    totals = taken.mapInArrow(count, "l string, w string, n long").groupBy("l", "w").agg(F.sum("n").alias("n"))
    best = totals.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy(F.desc("n"), "w"))).filter(F.col("r") <= top_words)
    counts: dict[str, dict[str, int]] = {}
    for r in best.select("l", "w", "n").toArrow().to_pylist():
        counts.setdefault(r["l"], {})[r["w"]] = r["n"]
    return counts


def predict(df: DataFrame, text: str, langs: list[str], p: np.ndarray, pieces: tuple[str, ...]) -> DataFrame:
    """df's columns, lang_pred and score (the language's share of the probability of the text)."""
    names = df.columns
    shared = df.sparkSession.sparkContext.broadcast((langs, p, pieces))  # vocabulary x languages

    def run(batches):
        langs, p, pieces = shared.value
        trie = Trie(pieces)
        trie.links = None  # the arrays are enough here

        longest = max(map(len, pieces), default=1)

        def scores(words):  # log probability by language, then the number of letters
            plain = [letters(w) for w in words]
            some = [i for i, w in enumerate(plain) if w]
            out = np.zeros((len(words), len(langs) + 1))
            out[:, -1] = [len(w) for w in plain]
            if some and langs:
                out[some, :-1] = word_log_probs(trie, [plain[i] for i in some], p, len(pieces), longest)
            return out

        cache = WordCache(scores, len(langs) + 1)
        for part in text_slices(batches, 0, SLICE_BYTES):
            words, refs, per = distinct_words(part.column(0))
            own = np.repeat(np.arange(len(per)), per)
            each = cache.get(words) if words else np.zeros((0, len(langs) + 1))
            sums = np.stack([np.bincount(own, weights=each[refs, k], minlength=len(per)) for k in range(len(langs) + 1)], axis=1)
            log, n = sums[:, :-1], sums[:, -1]
            if langs:
                best = log.argmax(axis=1)
                share = 1 / np.exp(np.minimum(log - log.max(axis=1, keepdims=True), 0)).sum(axis=1)
            pred = [langs[best[i]] if langs and n[i] else "und" for i in range(len(per))]
            score = np.where(n > 0, share, 0.0) if langs else np.zeros(len(per))
            yield pa.RecordBatch.from_arrays([*part.columns[1:], to_arrow(pred, pa.string()), to_arrow(score, pa.float64())], names=[f"c{i}" for i in range(len(names) + 2)])
        del cache, trie, p
        give_back()

    types = T.StructType([T.StructField(f"c{i}", t) for i, t in enumerate([*(f.dataType for f in df.schema.fields), T.StringType(), T.DoubleType()])])
    out = df.select(F.col(f"`{text}`").cast("string").alias("t"), *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]).mapInArrow(run, types)
    return out.toDF(*names, free_name(names, "lang_pred"), free_name(names, "score"))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(df: DataFrame, id_col: str, text: str, lang: str, pieces: tuple[str, ...], *, keep: list[str] | None = None, sample_docs: int = 1500, top_words: int = 15_000) -> DataFrame:
    """Fit on the rows that are not held out, predict all: the columns in keep (default: all), held_out, lang_pred, score."""
    bound_batches(df.sparkSession)
    counts = training_counts(df, id_col, text, lang, ~held_out(F.col(f"`{id_col}`")), sample_docs, top_words)
    langs, p = fit(counts, pieces) if counts else ([], np.zeros((len(pieces) + 1, 0)))
    give_back()  # the driver is done fitting
    keep = df.columns if keep is None else keep
    flagged = df.select(*[F.col(f"`{c}`") for c in keep], held_out(F.col(f"`{id_col}`")).alias(free_name(keep, "held_out")), *([] if text in keep else [F.col(f"`{text}`")]))
    out = predict(flagged, text, langs, p, pieces)
    return out if text in keep else out.drop(text)
