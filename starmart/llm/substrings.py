"""Substring dedup: repeated word windows found by backward search in compressed FM-indexes.

``anchors`` brings all windows that can be equal to one shard. A shard writes its cuttings one after
another, sorts their suffixes, keeps the Burrows-Wheeler transform as a wavelet tree (matrix form,
bit vectors with rank counts), and streams the cuttings through it: a window's words, from the last
to the first, narrow the interval of suffixes that start with them. The matching statistics are
followed up to the window's length; an interval that is not empty there holds all places of the
window, and the smallest document among them decides.

A word is removed if a window that covers it also starts in a document with a smaller key. Windows
are judged on the input. Null texts have no words; a null key is behind all others; rows with equal
keys do not remove each other's words. An empty table gives no rows.
"""

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starmart.llm.anchors import Task, Units, Words, search

WINDOW = 13
GRAM = 4
BATCH_BYTES = 4 << 20
CHUNK = 1 << 16  # windows searched at once
LAST = np.iinfo(np.int64).max


class WaveletMatrix:
    """Rank of any symbol in a sequence, from one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.n, self.levels = len(symbols), max(1, int(n_symbols - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(bit) // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int32)[:-1]]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        self.begin = self._walk(np.arange(n_symbols), np.zeros(n_symbols, dtype=np.int64))

    def _walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            word = place >> 6
            inside = self.words[k][word] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1))
            ones = self.counts[k][word] + np.bitwise_count(inside)
            place = np.where(symbol >> level & 1, self.zeros[k] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._walk(symbol, place) - self.begin[symbol]


def suffix_order(first: np.ndarray, length: int) -> np.ndarray:
    """The order of all suffixes of a sequence of numbers by their first ``length`` numbers or more, by doubling.

    Backward search for up to ``length`` symbols needs no more: it never asks which of two suffixes that
    begin alike comes first.
    """
    n = len(first)
    rank = first.astype(np.int64)
    size = 1
    while True:
        behind = np.zeros(n, dtype=np.int64)
        behind[: n - size] = rank[size:] + 1
        key = rank * (int(rank.max()) + 2) + behind
        order = np.argsort(key)
        size *= 2
        if size >= length:
            return order
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order


class FMIndex:
    """Where sequences of words occur in a collection of cuttings."""

    def __init__(self, sequences: list[list[bytes]], length: int = WINDOW):
        """Ready for searches of up to ``length`` words."""
        known: dict[bytes, int] = {}
        numbers = [known.setdefault(w, len(known) + 1) for s in sequences for w in s]
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.symbols = np.zeros(self.begins[-1], dtype=np.int64)  # 0 ends a cutting
        inside = np.ones(len(self.symbols), dtype=bool)
        inside[self.begins[1:] - 1] = False
        self.symbols[inside] = numbers
        first = self.symbols + len(sequences)
        first[~inside] = np.arange(len(sequences))  # ends are all different and come first
        self.order = suffix_order(first, length)
        self.n_symbols = len(known) + 1
        counts = np.bincount(self.symbols, minlength=self.n_symbols)
        self.smaller = np.concatenate([[0], np.cumsum(counts)])
        self.tree = WaveletMatrix(self.symbols[self.order - 1], self.n_symbols)

    def intervals(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Backward search for the sequences of ``length`` symbols at ``starts`` of the collection.

        Where an interval has come down to one suffix, that is the sequence itself, and it is not
        followed further: its size is right, its place is that of a shorter sequence.
        """
        last = self.symbols[starts + length - 1]
        low, high = self.smaller[last], self.smaller[last + 1]
        going = np.arange(len(starts))
        for i in range(length - 2, -1, -1):
            going = going[high[going] - low[going] > 1]
            symbol = self.symbols[starts[going] + i]
            low[going] = self.smaller[symbol] + self.tree.rank(symbol, low[going])
            high[going] = self.smaller[symbol] + self.tree.rank(symbol, high[going])
        return low, high


def first_documents(cuttings: list[bytes], values: list[int], window: int = WINDOW) -> list[np.ndarray]:
    """For each window of each cutting, the smallest value of a cutting with that window."""
    sequences = [c.split(b" ") for c in cuttings]
    index = FMIndex(sequences, window)
    lengths = np.diff(index.begins) - 1
    own = np.repeat(np.array(values, dtype=np.int64), lengths + 1)
    owner = np.concatenate([own[index.order], [LAST]])
    counts = lengths - window + 1
    starts = np.repeat(index.begins[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    found = np.zeros(len(starts), dtype=np.int64)
    for a in range(0, len(starts), CHUNK):
        part = starts[a : a + CHUNK]
        low, high = index.intervals(part, window)
        answer = own[part]  # of a window that stands nowhere else
        several = np.flatnonzero(high - low > 1)
        if len(several):
            each, at, place = np.unique(low[several], return_index=True, return_inverse=True)
            edges = np.stack([each, high[several][at]], axis=1).ravel()
            answer[several] = np.minimum.reduceat(owner, edges)[::2][place]
        found[a : a + CHUNK] = answer
    return np.split(found, np.cumsum(counts)[:-1])


def _own(key) -> int:
    return LAST if key is None else int(key)


def _wanted(windows: np.ndarray, own: np.ndarray) -> np.ndarray:
    return windows < own


def dedupe(df: DataFrame, key: str = "doc_id", text: str = "text", digests: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Remove words covered by windows of smaller documents.

    ``key`` must be an integer column. Returns ``key``, ``n_words``, ``n_removed`` and ``kept``: the
    text itself where nothing is removed, else the words left, joined by a space. With ``digests``
    it is ``kept_sha256`` of the words left, joined by a space. Columns named in ``carry`` follow
    unchanged; others are not read.
    """
    kind = df.schema[key].dataType.simpleString()
    name = "kept_sha256" if digests else "kept"
    key_type = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32()}.get(kind, pa.int64())

    def finish(keys: list, units: Units, marked: np.ndarray) -> pa.Table:
        gone = marked > 0
        removed, kept = [], []
        for a, b in zip(units.offsets[:-1].tolist(), units.offsets[1:].tolist()):
            n = int(gone[a:b].sum())
            words = units.words[a:b] if not n else [units.words[i] for i in (a + np.flatnonzero(~gone[a:b])).tolist()]
            joined = b" ".join(words)
            removed.append(n)
            whole = joined if n else units.texts[len(removed) - 1]
            kept.append(hashlib.sha256(joined).hexdigest() if digests else whole.decode("utf-8", "replace"))
        return pa.table({
            key: pa.array(keys, key_type), "n_words": pa.array(np.diff(units.offsets), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), name: pa.array(kept, pa.string()),
        })

    task = Task(Words, WINDOW, GRAM, BATCH_BYTES, min, _own, first_documents, _wanted)
    return search(df, key, text, task, finish, f"{key} {kind}, n_words long, n_removed long, {name} string", carry)
