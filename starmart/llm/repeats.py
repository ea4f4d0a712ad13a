"""Suffix-array dedup by prefix-free parsing: every 200 bytes that occur twice go.

``anchors`` brings all windows that can be equal to one shard. A shard cuts its cuttings into
phrases where a rolling hash triggers, each phrase with the trigger behind it, so that no phrase's
end is the start of another's. Suffixes are sorted twice on little input: those of the different
phrases (the dictionary), and those of the sequence of phrase numbers (the parse). The corpus order
follows from both: a position's rank is that of the rest of its phrase, then that of the parse
behind it. Windows with a common start of 200 bytes are then neighbours and are compared.
A cutting none of whose window hashes occurs again is left out of the order beforehand.

Texts are UTF-8 bytes; a match never crosses documents, but may lie in one document twice. Null
texts are empty. Rows with equal keys are separate documents, so equal rows remove each other. An
empty table gives no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starmart.llm.anchors import Bytes, Task, Units, gram_hashes, search

WINDOW = 200
GRAM = 16
BATCH_BYTES = 2 << 20
TRIGGER = 8  # bytes of a trigger
PHRASE = 24  # bytes between triggers, on average


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many suffixes are smaller than each one, read up to its sequence's end.

    ``symbols`` are positive; ``ends`` is, for each place, one behind its sequence's last place.
    Suffixes are ranked by as many symbols as fit a number, then by twice as many in each round,
    in which only those take part that are not told apart yet and have symbols left.
    """
    n, bits = len(symbols), int(symbols.max()).bit_length()
    size = min(n, 63 // bits)
    key = np.zeros(n, dtype=np.int64)
    for i in range(size):
        key <<= bits
        key[: n - i] |= np.where(np.arange(i, n) < ends[: n - i], symbols[i:], 0)
    _, place, counts = np.unique(key, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[place]
    class_size = counts[place]
    places = np.flatnonzero(class_size > 1)
    while True:
        # Classes in which some suffix has symbols left.
        going = places[places + size < ends[places]]
        open_class = np.zeros(n, dtype=bool)
        open_class[rank[going]] = True
        places = places[open_class[rank[places]]]
        if not len(places):
            return rank
        behind = places + size
        second = np.where(behind < ends[places], rank[np.minimum(behind, n - 1)] + 1, 0)
        first = rank[places]
        order = np.argsort(first * (n + 2) + second)
        places, first, second = places[order], first[order], second[order]
        new_class = np.concatenate([[True], first[1:] != first[:-1]])
        new_part = new_class | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(places))
        start_of_class = np.maximum.accumulate(np.where(new_class, at, 0))
        parts = np.flatnonzero(new_part)
        sizes = np.diff(np.concatenate([parts, [len(places)]]))
        part = np.cumsum(new_part) - 1
        rank[places] = first + parts[part] - start_of_class
        places = places[sizes[part] > 1]
        size *= 2


def may_repeat(cuttings: list[bytes], window: int = WINDOW) -> list[int]:
    """The cuttings with a window whose hash is another's too; no other can hold a repeated one."""
    lengths = np.array([len(c) for c in cuttings], dtype=np.int64)
    begins, n_windows = np.cumsum(lengths) - lengths, lengths - window + 1
    first = np.cumsum(n_windows) - n_windows
    places = np.repeat(begins - first, n_windows) + np.arange(n_windows.sum())
    hashes = gram_hashes(np.frombuffer(b"".join(cuttings), dtype=np.uint8).astype(np.uint64), window)[places]
    slot = (hashes >> np.uint64(64 - int(8 * len(places)).bit_length())).astype(np.int64)
    several = np.flatnonzero(np.bincount(slot)[slot] > 1)  # spares most of the others the sort
    if not len(several):
        return []
    several = several[np.argsort(hashes[several])]
    ordered = hashes[several]
    same = np.concatenate([[False], ordered[1:] == ordered[:-1], [False]])
    again = np.zeros(len(places), dtype=bool)
    again[several[same[1:] | same[:-1]]] = True
    return np.flatnonzero(np.logical_or.reduceat(again, first)).tolist()


def repeated_windows(cuttings: list[bytes], counts: list[int], window: int = WINDOW) -> list[np.ndarray]:
    """For each window of each cutting, 1 if it occurs elsewhere too; ``counts``: how often each cutting does.

    Only cuttings that may hold a repeated window are put in order.
    """
    chosen = may_repeat(cuttings, window)
    found = [np.full(len(c) - window + 1, int(n > 1), dtype=np.int64) for c, n in zip(cuttings, counts)]
    for i, windows in zip(chosen, in_corpus_order([cuttings[i] for i in chosen], window) if chosen else ()):
        found[i] |= windows
    return found


def in_corpus_order(cuttings: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each window of each cutting, 1 if it is the same as a neighbour in the order of all suffixes."""
    joined = b"".join(cuttings)
    data = np.frombuffer(joined, dtype=np.uint8)
    lengths = np.array([len(c) for c in cuttings], dtype=np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths

    # Phrases: from a trigger (or a cutting's start) to the end of the next trigger.
    trigger = np.zeros(len(data), dtype=bool)
    trigger[: len(data) - TRIGGER + 1] = gram_hashes(data.astype(np.uint64), TRIGGER) >> np.uint64(1) < np.uint64((1 << 63) // PHRASE)
    near = (ends[:, None] - np.arange(1, TRIGGER)[None, :]).ravel()
    trigger[near[near >= 0]] = False  # a trigger lies in one cutting
    trigger[begins] = True
    starts = np.flatnonzero(trigger)
    cutting = np.searchsorted(ends, starts, side="right")
    stops = np.concatenate([starts[1:], [len(data)]])
    last = np.concatenate([cutting[1:] != cutting[:-1], [True]])
    stops_with_trigger = np.where(last, stops, stops + TRIGGER)

    # Dictionary, and rank of each suffix of its phrases. A phrase that ends a cutting is marked.
    known: dict[tuple[bytes, bool], int] = {}
    number = np.array(
        [known.setdefault((joined[a:b], c), len(known)) for a, b, c in zip(starts.tolist(), stops_with_trigger.tolist(), last.tolist())], dtype=np.int64
    )
    phrases = list(known)
    sizes = np.array([len(p) + e for p, e in phrases], dtype=np.int64)
    phrase_ends = np.cumsum(sizes)
    phrase_begins = phrase_ends - sizes
    letters = np.frombuffer(b"".join(p + b"\0" * e for p, e in phrases), dtype=np.uint8).astype(np.int64) + 2
    letters[phrase_ends[[e for _, e in phrases]] - 1] = 1
    in_dictionary = suffix_ranks(letters, np.repeat(phrase_ends, sizes))

    # Parse: phrases in order, numbered by their rank, and rank of what follows each of them.
    parse = in_dictionary[phrase_begins[number]] + 1
    parse_ends = np.repeat(np.flatnonzero(last) + 1, np.diff(np.concatenate([[-1], np.flatnonzero(last)])))
    in_parse = suffix_ranks(parse, parse_ends)
    behind = np.where(last, 0, np.concatenate([in_parse[1:], [0]]) + 1)

    # Corpus order of all windows.
    n_windows = lengths - window + 1
    places = np.repeat(begins, n_windows) + np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    phrase = (np.cumsum(trigger) - 1)[places]
    rank = in_dictionary[phrase_begins[number[phrase]] + places - starts[phrase]]
    order = np.argsort(rank * (len(starts) + 2) + behind[phrase])

    # Neighbours with the same window.
    ordered, eight = places[order], np.zeros(len(data), dtype=np.uint64)
    for i in range(8):  # the eight bytes from each place on
        part = data[i : i + (len(data) - i) // 8 * 8].view(np.uint64)
        eight[i : i + 8 * len(part) : 8] = part
    same = np.zeros(len(ordered) + 1, dtype=bool)
    alike, a, b = np.arange(len(ordered) - 1), ordered[:-1], ordered[1:]
    for i in [window - 8, *range(0, window - 8, 8)]:
        equal = eight[a + i] == eight[b + i]
        alike, a, b = alike[equal], a[equal], b[equal]
    same[alike + 1] = True
    found = np.zeros(len(ordered), dtype=np.int64)
    found[order] = same[:-1] | same[1:]
    return np.split(found, np.cumsum(n_windows)[:-1])


def _one(key) -> int:
    return 1


def _add(a: int, b: int) -> int:
    return a + b


def _wanted(windows: np.ndarray, own: np.ndarray) -> np.ndarray:
    return windows > 0


def dedupe(df: DataFrame, key: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """Remove bytes covered by windows that also start elsewhere.

    Returns ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes left), or with
    ``digests`` its ``kept_sha256``. Other columns are not read.
    """
    kind = df.schema[key].dataType.simpleString()
    name, result = ("kept_sha256", "string") if digests else ("kept", "binary")
    key_type = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "string": pa.string()}.get(kind, pa.int64())

    def finish(keys: list, units: Units, marked: np.ndarray) -> pa.Table:
        gone = marked > 0
        data = np.frombuffer(units.joined, dtype=np.uint8)
        removed, spans, kept = [], [], []
        for a, b in zip(units.offsets[:-1].tolist(), units.offsets[1:].tolist()):
            part = gone[a:b]
            n = int(part.sum())
            removed.append(n)
            spans.append(int(part[0]) + int((part[1:] & ~part[:-1]).sum()) if n else 0)
            left = units.joined[a:b] if not n else data[a:b][~part].tobytes()
            kept.append(hashlib.sha256(left).hexdigest() if digests else left)
        return pa.table({
            key: pa.array(keys, key_type), "n_bytes": pa.array(np.diff(units.offsets), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()), name: pa.array(kept, pa.string() if digests else pa.binary()),
        })

    task = Task(Bytes, WINDOW, GRAM, BATCH_BYTES, _add, _one, repeated_windows, _wanted)
    return search(df, key, text, task, finish, f"{key} {kind}, n_bytes long, n_removed long, n_spans long, {name} {result}")
