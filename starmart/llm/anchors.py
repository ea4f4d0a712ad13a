"""Finding where windows of texts repeat, without comparing texts with all others.

A window is a run of ``window`` units (words or bytes) of one text. Its anchor is the smallest hash
among the short grams in it, so equal windows have equal anchors wherever they stand. Texts are
dealt into batches by a hash of the row, and batches talk to buckets of anchors:

1. each batch sends the different anchors of its windows to their buckets,
2. a bucket answers with a bit for each anchor that occurs more than once anywhere,
3. the batch cuts the runs of windows under such anchors out of its texts and sends each different
   cutting once to the anchor's bucket, where all windows with that anchor meet,
4. the bucket indexes the cuttings, finds each window's other places and answers,
5. the batch marks the windows in its texts.

Anchors are only a filter and a route: what is indexed and compared are the texts themselves.
A batch holds about ``batch_bytes`` of text (or one longer text). What many texts share reaches a
bucket at most once from a batch. The texts are shuffled once and that exchange is used three times.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import as_bytes, bounded_batches

RUN = 1024  # windows of a cutting at most
ANSWERED = 1 << 17  # windows answered at once

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def sliding(values: np.ndarray, size: int, function: np.ufunc) -> np.ndarray:
    """Minimum or maximum of each run of ``size`` values, in a constant number of steps a value."""
    n = len(values)
    if size == 1:
        return values.copy()
    padded = np.concatenate([values, np.full(-n % size, values[-1], dtype=values.dtype)]).reshape(-1, size)
    before = function.accumulate(padded, axis=1).ravel()[size - 1 : n]
    after = function.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()[: n - size + 1]
    return function(before, after)


def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` units: a polynomial, put together from those of halves."""
    def polynomial(size: int) -> np.ndarray:
        if size == 1:
            return units + np.uint64(1)
        half = size // 2
        of_half = polynomial(half)
        n = len(units) - 2 * half + 1
        out = of_half[:n] * np.uint64(pow(int(_ODD), half, 1 << 64))
        out += of_half[half : half + n]
        if size % 2:
            out = out[:-1] * _ODD
            out += units[size - 1 :] + np.uint64(1)
        return out

    return mix(polynomial(gram)) | np.uint64(1)


@dataclass
class Anchored:
    """The windows of a batch: runs with one anchor, and the different anchors in order."""

    starts: np.ndarray  # of runs, as places in the batch's units
    ends: np.ndarray  # one behind the last window's start
    anchors: np.ndarray  # index into ``values``
    values: np.ndarray
    repeated: np.ndarray  # anchors that stand at several places of the batch


def anchored(units: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Anchored:
    n = len(units) - window + 1
    begins, stops = offsets[:-1], offsets[1:] - window + 1
    some = stops > begins
    if n < 1 or not some.any():
        none = np.zeros(0, dtype=np.int64)
        return Anchored(none, none, none, none.astype(np.uint64), none.astype(bool))
    edge = np.zeros(n + 1, dtype=np.int8)
    edge[begins[some]] = 1
    edge[stops[some]] -= 1
    valid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    hashes = gram_hashes(units, gram)
    width = window - gram + 1
    least = np.where(valid, sliding(hashes, width, np.minimum), np.uint64(0))
    gap = np.zeros(width - 1, dtype=np.uint64)
    chosen = hashes[sliding(np.concatenate([gap, least, gap]), width, np.maximum) == hashes]
    del hashes
    values, counts = np.unique(chosen, return_counts=True)
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    starts = np.concatenate([[0], change])
    ends = np.concatenate([change, [n]])
    long = np.flatnonzero(ends - starts > RUN)
    if len(long):
        more = [np.arange(starts[i], ends[i], RUN) for i in long.tolist()]
        starts = np.sort(np.concatenate([starts, *[m[1:] for m in more]]))
        ends = np.concatenate([starts[1:], [n]])
    value = least[starts]
    keep = value != 0
    starts, ends, value = starts[keep], ends[keep], value[keep]
    return Anchored(starts, ends, np.searchsorted(values, value), values, counts > 1)


class Units:
    """The units of a batch's texts."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        sizes, hashes = self.read()
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.hashes = hashes

    def read(self) -> tuple[list[int], np.ndarray]:
        raise NotImplementedError

    def cut(self, a: int, b: int) -> bytes:
        raise NotImplementedError


class Words(Units):
    """Words between ASCII white space."""

    def read(self) -> tuple[list[int], np.ndarray]:
        import xxhash

        words = [t.split() for t in self.texts]
        self.words = [w for ws in words for w in ws]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), dtype=np.uint64, count=len(self.words))
        return [len(w) for w in words], hashes

    def cut(self, a: int, b: int) -> bytes:
        return b" ".join(self.words[a:b])


class Bytes(Units):
    def read(self) -> tuple[list[int], np.ndarray]:
        self.joined = b"".join(self.texts)
        return [len(t) for t in self.texts], np.frombuffer(self.joined, dtype=np.uint8).astype(np.uint64)

    def cut(self, a: int, b: int) -> bytes:
        return self.joined[a:b]


@dataclass
class Task:
    """What distinguishes one search from another; travels to the executors."""

    units: type
    window: int
    gram: int
    batch_bytes: int
    fold: Callable  # of a cutting's own value over documents: min or sum
    own: Callable  # a document's own value from its id
    find: Callable  # index: (cuttings, values) -> per cutting the value of each window
    wanted: Callable  # (window values, own values) -> which windows to answer


class Batch:
    """One batch's cuttings, the same whenever it is computed from the same rows and bits."""

    def __init__(self, task: Task, texts: list[bytes]):
        self.task, self.units = task, task.units(texts)
        self.runs = anchored(self.units.hashes, self.units.offsets, task.window, task.gram)
        self.units.hashes = None

    def buckets(self, n: int) -> list[tuple[int, np.ndarray]]:
        """Places in ``values`` of each bucket's anchors."""
        bucket = ((self.runs.values >> np.uint64(1)) % np.uint64(n)).astype(np.int64)  # the lowest bit is always set
        order = np.argsort(bucket, kind="stable")
        found, first = np.unique(bucket[order], return_index=True)
        return list(zip(found.tolist(), np.split(order, first[1:])))

    def cuttings(self, bits: dict[int, bytes], n: int) -> dict[int, tuple[dict[bytes, int], list[tuple[int, int]]]]:
        """For each bucket the different cuttings, and (run, cutting) of each run cut."""
        runs = self.runs
        wanted = np.zeros(len(runs.values), dtype=bool)
        of = np.zeros(len(runs.values), dtype=np.int64)
        for bucket, places in self.buckets(n):
            if bucket in bits:
                wanted[places] = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(places)).astype(bool)
                of[places] = bucket
        cut = np.flatnonzero(wanted[runs.anchors])
        out: dict[int, tuple[dict[bytes, int], list[tuple[int, int]]]] = {}
        size, take = self.task.window - 1, self.units.cut
        for run, bucket, a, b in zip(cut.tolist(), of[runs.anchors[cut]].tolist(), runs.starts[cut].tolist(), runs.ends[cut].tolist()):
            known, places = out.setdefault(bucket, ({}, []))
            places.append((run, known.setdefault(take(a, b + size), len(known))))
        return out

    def documents(self) -> np.ndarray:
        """The document of each run."""
        return np.searchsorted(self.units.offsets, self.runs.starts, side="right") - 1


def _bits(table: pa.Table) -> dict[int, bytes]:
    return dict(zip(table.column("bucket").to_pylist(), table.column("bits").to_pylist()))


def _ranges(packets: list[list[np.ndarray]], owns: list[list[int]], wanted: Callable) -> list[bytes]:
    """Of each packet, (cutting, first window, windows, value) of the runs of wanted windows of equal value."""
    lengths = np.array([len(w) for windows in packets for w in windows], dtype=np.int64)
    of_packet = np.repeat(np.arange(len(packets)), [len(windows) for windows in packets])
    in_packet = np.concatenate([np.arange(len(windows)) for windows in packets])
    values = np.concatenate([w for windows in packets for w in windows])
    cutting = np.repeat(np.arange(len(lengths)), lengths)
    asked = wanted(values, np.repeat(np.array([v for own in owns for v in own], dtype=np.int64), lengths))
    if not asked.any():
        return [b""] * len(packets)
    at = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | (asked[1:] != asked[:-1]) | (cutting[1:] != cutting[:-1])]))
    size = np.diff(np.concatenate([at, [len(values)]]))
    keep = asked[at]
    at, size = at[keep], size[keep]
    start = np.cumsum(lengths) - lengths
    out = np.stack([in_packet[cutting[at]], at - start[cutting[at]], size, values[at]], axis=1)
    cuts = np.searchsorted(of_packet[cutting[at]], np.arange(1, len(packets)))
    return [part.tobytes() for part in np.split(out, cuts)]


def search(df: DataFrame, key: str, text: str, task: Task, finish: Callable, schema: str, carry: Sequence[str] = ()) -> DataFrame:
    """Search all texts for repeated windows.

    ``finish(keys, units, marked)`` makes a batch's result rows, a table of ``schema``, one row per
    text in order; ``marked`` is an array with the number of marked windows over each unit. The
    columns named in ``carry`` are passed on with each row.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    columns = [F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")]
    if carry:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carry"))
    source = df.select(*columns)
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // task.batch_bytes))
    # The place in a batch must not depend on how rows arrive, so a batch is sorted by key and text.
    source = source.withColumn("batch", F.pmod(F.xxhash64("key", "text"), F.lit(n)))

    def ordered(table: pa.Table) -> tuple[list, list[bytes], list[int]]:
        keys, texts = table.column("key").to_pylist(), as_bytes(table.column("text"))
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, 0 if keys[i] is None else keys[i], texts[i]))
        return [keys[i] for i in order], [texts[i] for i in order], order

    def read(table: pa.Table) -> tuple[list, list[bytes]]:
        return ordered(table)[:2]

    def ask(table: pa.Table) -> pa.Table:
        batch = Batch(task, read(table)[1])
        values, repeated = batch.runs.values, batch.runs.repeated
        rows = [(bucket, values[p].tobytes(), np.packbits(repeated[p]).tobytes()) for bucket, p in batch.buckets(n)]
        columns = list(zip(*rows)) or [(), (), ()]
        number = table.column("batch")[0].as_py()
        return pa.table({
            "bucket": pa.array(columns[0], pa.int64()), "batch": pa.array([number] * len(rows), pa.int64()),
            "values": pa.array(columns[1], pa.binary()), "repeated": pa.array(columns[2], pa.binary()),
        })

    def answer(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(v, dtype=np.uint64) for v in table.column("values").to_pylist()]
        known = [np.unpackbits(np.frombuffer(r, np.uint8), count=len(p)).astype(bool) for r, p in zip(table.column("repeated").to_pylist(), parts)]
        values, place, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        many = counts > 1
        many |= np.bincount(place, weights=np.concatenate(known), minlength=len(values)) > 0
        bits = np.split(many[place], np.cumsum([len(p) for p in parts])[:-1])
        asked = [i for i, b in enumerate(bits) if b.any()]
        return pa.table({
            "batch": table.column("batch").take(pa.array(asked, pa.int64())), "bucket": table.column("bucket").take(pa.array(asked, pa.int64())),
            "bits": pa.array([np.packbits(bits[i]).tobytes() for i in asked], pa.binary()),
        })

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        kinds = [("bucket", pa.int64()), ("batch", pa.int64()), ("bits", pa.binary()), ("cuttings", pa.list_(pa.binary())), ("own", pa.list_(pa.int64()))]
        if not table.num_rows or not answers.num_rows:
            return pa.table({k: pa.array([], t) for k, t in kinds})
        keys, texts = read(table)
        batch, bits = Batch(task, texts), _bits(answers)
        documents = batch.documents().tolist()
        number, rows = table.column("batch")[0].as_py(), []
        for bucket, (known, places) in batch.cuttings(bits, n).items():
            own: list = [None] * len(known)
            for run, i in places:
                value = task.own(keys[documents[run]])
                own[i] = value if own[i] is None else task.fold(own[i], value)
            rows.append((bucket, number, bits[bucket], list(known), own))
        columns = list(zip(*rows)) or [()] * 5
        return pa.table({k: pa.array(c, t) for c, (k, t) in zip(columns, kinds)})

    def look(table: pa.Table) -> pa.Table:
        """Index a bucket's cuttings and answer each batch, as runs of windows of equal value."""
        packets = table.column("cuttings").to_pylist()
        owns = table.column("own").to_pylist()
        known: dict[bytes, int] = {}
        values: list[int] = []
        for cuttings, own in zip(packets, owns):
            for c, v in zip(cuttings, own):
                i = known.setdefault(c, len(known))
                if i == len(values):
                    values.append(v)
                else:
                    values[i] = task.fold(values[i], v)
        found = task.find(list(known), values)
        rows: list[bytes] = []
        group: list[list[np.ndarray]] = []
        windows = 0
        for p, cuttings in enumerate(packets):
            group.append([found[known[c]] for c in cuttings])
            windows += sum(map(len, group[-1]))
            if windows > ANSWERED or p + 1 == len(packets):
                rows += _ranges(group, owns[len(rows) : p + 1], task.wanted)
                group, windows = [], 0
        return pa.table({
            "batch": table.column("batch"), "bucket": table.column("bucket"), "bits": table.column("bits"), "ranges": pa.array(rows, pa.binary()),
        })

    def mark(table: pa.Table, answers: pa.Table) -> pa.Table:
        keys, texts, order = ordered(table)
        batch, bits = Batch(task, texts), _bits(answers)
        ranges = dict(zip(answers.column("bucket").to_pylist(), answers.column("ranges").to_pylist()))
        size = int(batch.units.offsets[-1])
        edge = np.zeros(size + 1, dtype=np.int64)
        documents, starts, lasts = batch.documents().tolist(), batch.runs.starts.tolist(), batch.runs.ends.tolist()
        opened: list[int] = []
        closed: list[int] = []
        for bucket, (known, places) in (batch.cuttings(bits, n) if bits else {}).items():
            by_cutting: dict[int, list] = {}
            for i, a, s, x in np.frombuffer(ranges[bucket], dtype=np.int64).reshape(-1, 4).tolist():
                by_cutting.setdefault(i, []).append((a, s, x))
            lowest: dict[int, int] = {}
            for run, i in places:
                own = task.own(keys[documents[run]])
                lowest[i] = task.fold(lowest[i], own) if i in lowest else own
            for run, i in places:
                own, first = task.own(keys[documents[run]]), starts[run]
                if task.fold is min and lowest[i] < own:
                    # The whole cutting stands in a smaller document of this batch.
                    opened.append(first)
                    closed.append(lasts[run] - 1 + task.window)
                    continue
                for a, s, x in by_cutting.get(i, ()):
                    opened.append(first + a)
                    closed.append(first + a + s - 1 + task.window)
        np.add.at(edge, np.array(opened, dtype=np.int64), 1)
        np.add.at(edge, np.array(closed, dtype=np.int64), -1)
        result = finish(keys, batch.units, np.cumsum(edge[:-1]))
        return result.append_column("carry", table.column("carry").take(pa.array(order, pa.int64()))) if carry else result

    asked = source.groupBy("batch").applyInArrow(ask, "bucket long, batch long, values binary, repeated binary")
    answered = asked.groupBy("bucket").applyInArrow(answer, "batch long, bucket long, bits binary")
    sent = source.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(
        cut, "bucket long, batch long, bits binary, cuttings array<binary>, own array<long>"
    )
    found = sent.groupBy("bucket").applyInArrow(look, "batch long, bucket long, bits binary, ranges binary")
    if carry:
        kind = source.schema["carry"].dataType.simpleString()
        result = source.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(mark, f"{schema}, carry {kind}")
        return result.select(*[c for c in result.columns if c != "carry"], *[F.col("carry").getField(c).alias(c) for c in carry])
    return source.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(mark, schema)
