"""Filter interaction audit by truth-table survival words.

Of five filters, each document fails a set; it survives exactly those of the 32 subsets of filters
that hold none of these. Its survival word has one bit per subset, and adding up each bit over
documents gives the survivors of every subset. All figures of every order of filters follow from
these 32 counts. Bits are added by carry-save adders: of three words, one word keeps the sums and
one, of twice the weight, the carries, for all 32 places at once, so a count costs some five word
operations a document and an open group only a few words of each weight.

Counts are per part (here language) and label; a task holds at most ``OPEN_GROUPS`` of them and
sends on what it has when more appear, so a dirty part column cannot fill it.

Filter E needs the whole table: texts are compared by their sha256, narrow rows are written once, and
the smallest id per text is found by an aggregation. Texts with more than one row in ``HOT_SHARE``
of the table, of which there can be no more than ``HOT_SHARE``, are looked up in a broadcast table
of them, the others by a join in which no key is large; so no group of copies lands in one task.

Nulls: a null text is empty; a null part is the empty string; a null id is neither smaller than
another id nor larger, and has no label. Each row is a document, repeated rows too: of rows with
one id and text none fails E for another. Rows of ``labels`` with one id count as one, which is good
or toxic if any of them is. An empty table gives no rows. Other columns of the input are not read.
"""

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import as_bytes, bounded_batches, pieces, written

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
# The survival word of each set of failed filters: bit s is set where s and the set share no filter.
SURVIVAL = [sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)]
OPEN_GROUPS = 4096
HOT_SHARE = 1024
UPPER, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that start no code point


def fails(text: bytes, few_words: int = 200, distinct_pct: int = 50, upper_pct: int = 3) -> int:
    """Which of the filters A to D a text (UTF-8) fails, as bits 0 to 3."""
    words = text.split()
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text.translate(None, CONTINUATION))
    few = len(words) < few_words
    repeated = 100 * len(set(words)) < distinct_pct * len(words)
    symbols = len(text.translate(None, SYMBOLS)) < len(text)
    return few | repeated << 1 | (100 * upper > upper_pct * points) << 2 | symbols << 3


class Counter:
    """Positional popcount of 32-bit words by carry-save adders; words of weight 2^i wait in level i."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def add(self, words: np.ndarray) -> None:
        level = 0
        while len(words):
            if level == len(self.levels):
                self.levels.append(np.empty(0, dtype=np.uint32))
            words = np.concatenate([self.levels[level], words])
            carries = []
            while len(words) > 2:
                third = len(words) // 3
                a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
                either = a ^ b
                carries.append((a & b) | (either & c))
                words = np.concatenate([either ^ c, words[3 * third :]])
            self.levels[level] = words
            words = np.concatenate(carries) if carries else np.empty(0, dtype=np.uint32)
            level += 1

    def counts(self) -> list[int]:
        """Words with bit s set, for each s."""
        bits = np.arange(SUBSETS, dtype=np.uint32)
        totals = np.zeros(SUBSETS, dtype=np.int64)
        for level, words in enumerate(self.levels):
            totals += ((words[:, None] >> bits) & 1).astype(np.int64).sum(axis=0) << level
        return totals.tolist()


def facts(df: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """One narrow row per document: ``key``, ``part``, failed filters A to D, sha256 of the text."""
    bounded_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = as_bytes(batch.column("text"))
            failed = pa.array([fails(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("part"), failed, digests], names=["key", "part", "failed", "digest"])

    source = df.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    return source.mapInArrow(rows, f"key {kind}, part string, failed int, digest binary")


def with_copies(rows: DataFrame) -> DataFrame:
    """Set bit 4 (filter E) of ``failed`` where the text also has a smaller key. ``rows``: a written table."""
    firsts = rows.groupBy(F.col("digest").alias("_digest")).agg(F.count(F.lit(1)).alias("_n"), F.min("key").alias("_first"))
    firsts = written(firsts.filter("_n > 1 and _first is not null"), "audit-copies")
    many = rows.count() // HOT_SHARE
    hot = F.broadcast(firsts.filter(F.col("_n") > many).select(F.col("_digest").alias("_hot"), F.col("_first").alias("_hot_first")))
    rows = rows.join(hot, F.col("digest") == F.col("_hot"), "left")
    # Rows of hot texts have their answer; the join spreads them by key, as they match nothing.
    cold = firsts.filter(F.col("_n") <= many).select("_digest", "_first", F.lit(0).cast("long").alias("_spread"))
    rows = rows.withColumn("_to", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(F.xxhash64("key").bitwiseOR(F.lit(1))).cast("long"))
    rows = rows.join(cold, (F.col("digest") == F.col("_digest")) & (F.col("_to") == F.col("_spread")), "left")
    copy = F.coalesce(F.col("key") > F.coalesce("_hot_first", "_first"), F.lit(False))
    return rows.select("key", "part", F.col("failed").bitwiseOR(F.when(copy, F.lit(16)).otherwise(F.lit(0))).alias("failed"), "digest")


def with_labels(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Add ``good`` and ``toxic``; rows without key are spread over the join by their digest."""
    known = labels.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_key")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("_good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("_toxic"), F.lit(0).cast("long").alias("_spread")
    )
    rows = rows.withColumn("_to", F.when(F.col("key").isNull(), F.xxhash64("digest").bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long")))
    joined = rows.join(known, (F.col("key") == F.col("_key")) & (F.col("_to") == F.col("_spread")), "left")
    return joined.select("part", "failed", F.coalesce("_good", F.lit(False)).alias("good"), F.coalesce("_toxic", F.lit(False)).alias("toxic"))


def survivors(rows: DataFrame) -> DataFrame:
    """Survivors of each subset of filters: ``part``, ``good``, ``toxic`` and 32 sums ``s0`` to ``s31``.

    ``rows``: ``part``, ``failed`` (bits of failed filters), ``good``, ``toxic``.
    """
    names = [f"s{s}" for s in range(SUBSETS)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        survival = np.array(SURVIVAL, dtype=np.uint32)
        groups: dict[tuple, Counter] = {}

        def sums() -> pa.RecordBatch:
            found = [(*group, *counter.counts()) for group, counter in groups.items()]
            kinds = [pa.string(), pa.bool_(), pa.bool_(), *[pa.int64()] * SUBSETS]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names=["part", "good", "toxic", *names])

        for batch in batches:
            parts = pc.dictionary_encode(batch.column("part"))
            flags = batch.column("good").to_numpy(zero_copy_only=False) * 2 + batch.column("toxic").to_numpy(zero_copy_only=False)
            group = parts.indices.to_numpy().astype(np.int64) * 4 + flags
            words = survival[batch.column("failed").to_numpy()]
            order = np.argsort(group, kind="stable")
            group, words = group[order], words[order]
            starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
            for a, b in zip(starts, [*starts[1:], len(group)]):
                g = int(group[a])
                groups.setdefault((parts.dictionary[g // 4].as_py(), bool(g & 2), bool(g & 1)), Counter()).add(words[a:b])
                if len(groups) > OPEN_GROUPS:
                    yield sums()
                    groups.clear()
        if groups:
            yield sums()

    made = rows.select("part", "failed", "good", "toxic").mapInArrow(counted, f"part string, good boolean, toxic boolean, {', '.join(f'{n} long' for n in names)}")
    return made.groupBy("part", "good", "toxic").agg(*[F.sum(n).alias(n) for n in names])


def _orders() -> Column:
    """All orders of the filters, step by step: which filter, and the subsets before and after it."""
    steps = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            i = FILTERS.index(name)
            steps.append(F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step"), F.lit(i).alias("filter"), F.lit(before).alias("before"), F.lit(before | 1 << i).alias("after")))
            before |= 1 << i
    return F.array(*steps)


def audit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """What each filter removes at each step of every order, per part.

    Returns ``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant`` (fails its
    filter, removed earlier), ``unique_fails`` (fails its filter only), ``good_lost``, ``toxic_lost``
    and ``shapley`` (removed by its filter, summed over all orders).
    """
    rows = with_labels(with_copies(written(facts(df, key, text, part), "audit")), labels, key)
    of_labels = survivors(rows)

    def sums(rows_of: Column | None = None) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(rows_of, F.col(f"s{s}")) if rows_of is not None else F.col(f"s{s}")), F.lit(0)) for s in range(SUBSETS)])

    per_part = of_labels.groupBy("part").agg(sums().alias("all"), sums(F.col("good")).alias("good"), sums(F.col("toxic")).alias("toxic"))
    # Of the 120 orders, |s|! * (4 - |s|)! have exactly the filters s before a given one.
    factorial = [1, 1, 2, 6, 24]
    every = SUBSETS - 1

    def over_orders(i: int) -> Column:
        terms = [
            (F.col("all")[s] - F.col("all")[s | 1 << i]) * (factorial[bin(s).count("1")] * factorial[4 - bin(s).count("1")])
            for s in range(SUBSETS)
            if not s >> i & 1
        ]
        return sum(terms[1:], terms[0])

    five = range(len(FILTERS))
    per_part = per_part.withColumns({
        "_fails": F.array(*[F.col("all")[0] - F.col("all")[1 << i] for i in five]),
        "_alone": F.array(*[F.col("all")[every & ~(1 << i)] - F.col("all")[every] for i in five]),
        "_shapley": F.array(*[over_orders(i) for i in five]),
    })
    steps = per_part.withColumn("o", F.explode(_orders()))
    before, after, i = F.col("o.before"), F.col("o.after"), F.col("o.filter")

    def lost(counts: str) -> Column:
        return F.get(counts, before) - F.get(counts, after)

    return steps.select(
        "part", "o.filter_order", "o.step",
        F.get("all", after).alias("kept"), lost("all").alias("removed"), (F.get("_fails", i) - lost("all")).alias("redundant"),
        F.get("_alone", i).alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("_shapley", i).alias("shapley"),
    )
