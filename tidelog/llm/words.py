"""Word lists of text batches, and a trie over a vocabulary whose transitions work on whole arrays at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidelog.llm.common import list_lengths, to_arrow, to_numpy

SLICE_BYTES = 2 << 20
MARK = "▁"
EMPTY = to_arrow([""], pa.string())[0]


@lru_cache(maxsize=4)
def load_pieces(model_file: str) -> tuple[str, ...]:
    """The ordinary pieces of a sentencepiece model: no control, unknown or byte pieces."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return tuple(m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i)))


def distinct_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of some texts, the word numbers of all texts in turn, and each text's number of words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, EMPTY))
    flat = lists.flatten()
    full = pc.not_equal(flat, EMPTY)
    lens = list_lengths(lists)
    owner = np.repeat(np.arange(len(lens)), lens)[to_numpy(full)]
    coded = flat.filter(full).dictionary_encode()
    return coded.dictionary.to_pylist(), to_numpy(coded.indices), np.bincount(owner, minlength=len(lens))


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of some words in turn, and each word's length."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), lens


class Trie:
    """Nodes 0 (the root) on; child() follows one code point from each of many nodes."""

    def __init__(self, pieces: tuple[str, ...]):
        nodes, ends = [{}], [-1]
        for k, p in enumerate(pieces):
            at = 0
            for c in map(ord, p):
                nxt = nodes[at].get(c)
                if nxt is None:
                    nxt = nodes[at][c] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = nxt
            if at and ends[at] < 0:
                ends[at] = k
        self.ends = np.array(ends, np.int64)  #: piece that ends in a node, or -1
        self.links = nodes
        keys = np.array([n << 21 | c for n, d in enumerate(nodes) for c in d], np.int64)
        kids = np.array([k for d in nodes for k in d.values()], np.int64)
        size = 1 << max(4, int(len(keys) * 3).bit_length())
        self.mask, self.keys, self.kids = size - 1, np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        at, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):  # open addressing, all keys at once: one key for each free slot, the rest move on
            self.probes += 1
            free = self.keys[at[todo]] < 0
            _, first = np.unique(at[todo][free], return_index=True)
            win = todo[free][first]
            self.keys[at[win]], self.kids[at[win]] = keys[win], kids[win]
            todo = np.setdiff1d(todo, win, assume_unique=True)
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * 0x9E3779B1) >> 15) & self.mask

    def child(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The node reached from each node by each code point, or -1."""
        keys = nodes << 21 | codes
        at = self._slot(keys)
        got = self.keys[at]
        out = np.where(got == keys, self.kids[at], -1)
        open_ = np.flatnonzero((got != keys) & (got >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            got = self.keys[at[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self.kids[at[open_[hit]]]
            open_ = open_[~hit & (got >= 0)]
        return out


class WordCache:
    """Rows of numbers by word, computed in bulk for words not seen before; forgets all beyond `most` words."""

    def __init__(self, compute, width: int, most: int = 150_000):
        self.compute, self.most, self.at, self.rows = compute, most, {}, np.zeros((0, width))

    def get(self, words: list[str]) -> np.ndarray:
        if len(self.at) > self.most:
            self.at, self.rows = {}, self.rows[:0]
        new = [w for w in words if w not in self.at]
        if new:
            base = len(self.at)
            self.at.update((w, base + i) for i, w in enumerate(new))
            self.rows = np.concatenate([self.rows, self.compute(new)])
        return self.rows[np.fromiter((self.at[w] for w in words), np.int64, len(words))]
