"""Exact Jaccard self-join of shingle sets with a token-group matrix, and its connected components.

A document's set are the hashes of its different 5-word shingles. Documents with equal sets are one
class. Two classes link when 100 * common >= 75 * union; then each holds all but a quarter of its
shingles in common with the other, so in any order of all shingles they have one in common among
the first n - ceil(0.75 n) + 1 of each. The order puts shingles that few documents have first.

1. How many documents have a shingle is asked of buckets of shingles, for half of all shingles (the
   half comes first in the order). Most texts end here, as their first shingles are theirs alone.
2. Each class votes for the smallest class behind each of its first shingles and is compared with
   the two it votes for most. Classes linked so form groups: similar documents, known connected.
3. Token-group matrix: for each first shingle the groups that have it, large groups cut into parts
   whose members have about ``PART`` shingles. A class asks for the parts of other groups with a
   member that can still link, given how many shingles both have left behind the common one and in
   how many bits their sketches differ; where
   the overlap with a part's union of shingles is as large as a link with its members' sizes needs,
   the part is opened and compared exactly. Of two groups the smaller one asks.
4. Components of all links, by alternating large and small stars.

So near copies in thousands cost one or two comparisons each, and only what is left between
different groups is searched further; no pair of classes is left out that could link.

Texts with fewer than five words have their whole sequence as only shingle. Null and empty texts
have an empty set and link with nothing. Rows of one key count as one document; a row with a null
key links with nothing and has a null component. An empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.anchors import mix
from starmart.llm.common import as_bytes, bounded_batches, pieces, written

SHINGLE = 5
PERCENT = 75
PART = 1 << 20  # shingles of a part's members, about
VOTES = 2
BATCH_BYTES = 4 << 20
PAIRS = 1 << 20  # compared at once within a posting list
SKETCH = [f"sketch{i}" for i in range(8)]  # columns of 64 bits each


def shingles(text: bytes) -> np.ndarray:
    """Sorted hashes of the different shingles."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    out = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(out)])
    return np.unique(out)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common values of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def sketch(values: np.ndarray) -> np.ndarray:
    """Whether an even or odd number of shingles falls on each bit.

    Two sketches differ in no more bits than their sets in shingles.
    """
    bits = 64 * len(SKETCH)
    odd = np.bincount((values >> np.uint64(7)).astype(np.int64) % bits, minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    n = common(a, b)
    return n > 0 and 100 * n >= PERCENT * (len(a) + len(b) - n)


def _first(n: int) -> int:
    """How many shingles in order must be looked at."""
    return n - (PERCENT * n + 99) // 100 + 1


def _sets(table: pa.Table | pa.RecordBatch, column: str = "text") -> list[np.ndarray]:
    return [shingles(t) for t in as_bytes(table.column(column))]


def _keys_and_sets(table: pa.Table) -> tuple[list, list[bytes], list[np.ndarray]]:
    keys, texts = table.column("key").to_pylist(), as_bytes(table.column("text"))
    order = sorted(range(len(keys)), key=lambda i: (keys[i], texts[i]))
    texts = [texts[i] for i in order]
    return [keys[i] for i in order], texts, [shingles(t) for t in texts]


def _known_half(values: np.ndarray) -> np.ndarray:
    return values >> np.uint64(63) == 0


def _split(values: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (values % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, first[1:]))


def _short(values: np.ndarray, n: int) -> np.ndarray:
    return ((values // np.uint64(n)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def survivors(docs: DataFrame, n: int) -> DataFrame:
    """Documents that can have a partner: ``key``, ``set_key``, ``n``, ``first``, ``places``, the sketch
    and ``text``.

    ``first`` has those of the first shingles in order that other documents may have too, and
    ``places`` their places in the order of the document's shingles.
    """
    source = docs.select("key", "text", F.pmod(F.xxhash64("key", "text"), F.lit(n)).alias("batch"))

    def batch_values(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        return np.unique(every[_known_half(every)], return_counts=True)

    def ask(table: pa.Table) -> pa.Table:
        values, counts = batch_values(_keys_and_sets(table)[2])
        number = table.column("batch")[0].as_py()
        rows = [(b, number, _short(values[p], n).tobytes(), np.minimum(counts[p], 65535).astype(np.uint16).tobytes()) for b, p in _split(values, n)]
        columns = list(zip(*rows)) or [()] * 4
        kinds = [("bucket", pa.int64()), ("batch", pa.int64()), ("values", pa.binary()), ("counts", pa.binary())]
        return pa.table({k: pa.array(c, t) for c, (k, t) in zip(columns, kinds)})

    def answer(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(v, dtype=np.uint32) for v in table.column("values").to_pylist()]
        counts = np.concatenate([np.frombuffer(c, dtype=np.uint16) for c in table.column("counts").to_pylist()])
        _, place = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(place, weights=counts)
        level = np.minimum(255, np.ceil(4 * np.log2(total))).astype(np.uint8)[place]
        cut = np.split(level, np.cumsum([len(p) for p in parts])[:-1])
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "levels": pa.array([c.tobytes() for c in cut], pa.binary())})

    def keep(table: pa.Table, answers: pa.Table) -> pa.Table:
        keys, texts, sets = _keys_and_sets(table) if table.num_rows else ([], [], [])
        values = batch_values(sets)[0]
        levels = np.zeros(len(values), dtype=np.uint8)
        by_bucket = dict(zip(answers.column("bucket").to_pylist(), answers.column("levels").to_pylist()))
        for b, p in _split(values, n):
            levels[p] = np.frombuffer(by_bucket[b], dtype=np.uint8)
        rows = []
        for key, text, own in zip(keys, texts, sets):
            if not len(own):
                continue
            known = own[_known_half(own)]
            level = levels[np.searchsorted(values, known)]
            order = np.argsort(level, kind="stable")
            first = _first(len(own))
            places = np.flatnonzero(level[order[:first]] > 0)
            chosen = known[order[places]]
            if first > len(known):
                chosen = np.concatenate([chosen, own[len(known) :][: first - len(known)]])  # sorted: the other half is behind
                places = np.concatenate([places, np.arange(len(known), first)])
            if len(chosen):
                row = (key, hashlib.md5(own.tobytes()).digest(), len(own), chosen.tobytes(), places.astype(np.int32).tobytes())
                rows.append((*row, *sketch(own).tolist(), text.decode("utf-8", "replace")))
        columns = list(zip(*rows)) or [()] * (6 + len(SKETCH))
        kinds = [("key", pa.int64()), ("set_key", pa.binary()), ("n", pa.int64()), ("first", pa.binary()), ("places", pa.binary()), *[(c, pa.int64()) for c in SKETCH], ("text", pa.string())]
        return pa.table({k: pa.array(c, t) for c, (k, t) in zip(columns, kinds)})

    asked = source.groupBy("batch").applyInArrow(ask, "bucket long, batch long, values binary, counts binary")
    answered = asked.groupBy("bucket").applyInArrow(answer, "batch long, bucket long, levels binary")
    return source.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(
        keep, f"key long, set_key binary, n long, first binary, places binary, {', '.join(f'{c} long' for c in SKETCH)}, text string"
    )


def postings(rows: DataFrame, n: int, columns: list[str]) -> DataFrame:
    """Packed posting lists: ``bucket``, ``tokens`` and of each token the long ``columns`` and ``places``."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> Iterator[pa.RecordBatch]:
            parts = [np.frombuffer(f, dtype=np.uint64) for b in held for f in b.column("first").to_pylist()]
            sizes = [len(p) for p in parts]
            tokens = np.concatenate(parts)
            numbers = [np.repeat(np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]), sizes) for c in columns]
            numbers.append(np.concatenate([np.frombuffer(x, dtype=np.int32) for b in held for x in b.column("places").to_pylist()]))
            rows = [(bucket, tokens[p].tobytes(), *(x[p].astype(np.int64).tobytes() for x in numbers)) for bucket, p in _split(tokens, n)]
            kinds = [pa.int64(), *[pa.binary()] * (2 + len(columns))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["bucket", "tokens", *columns, "places"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.nbytes for b in held) > 32 << 20:
                yield from packed()
                held = []
        if held:
            yield from packed()

    names = ", ".join(f"{c} binary" for c in [*columns, "places"])
    return rows.select("first", "places", *columns).mapInArrow(pack, f"bucket long, tokens binary, {names}")


def _unpack(table: pa.Table, columns: list[str]) -> list[np.ndarray]:
    """Token and columns of a bucket, ordered by token."""
    tokens = np.concatenate([np.frombuffer(t, dtype=np.uint64) for t in table.column("tokens").to_pylist()])
    order = np.argsort(tokens, kind="stable")
    return [tokens[order], *(np.concatenate([np.frombuffer(x, dtype=np.int64) for x in table.column(c).to_pylist()])[order] for c in columns)]


def votes(table: pa.Table) -> pa.Table:
    """For each class of a bucket how often another class is the smallest behind its shingles."""
    tokens, ids = _unpack(table, ["key"])
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    smallest = np.repeat(np.minimum.reduceat(ids, starts), np.diff(np.concatenate([starts, [len(tokens)]])))
    other = smallest < ids
    pairs, counts = np.unique(np.stack([ids[other], smallest[other]], axis=1), axis=0, return_counts=True)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1]), "votes": pa.array(counts)})


def matrix_pairs(table: pa.Table) -> pa.Table:
    """Classes of a bucket and the parts of other groups behind their shingles."""
    tokens, ids, sizes, groups, weights, parts, places, *bits = _unpack(table, ["key", "n", "group", "weight", "part", "places", *SKETCH])
    sketches = np.stack(bits, axis=1).view(np.uint64)
    left = sizes - places  # shingles from this one on
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    ends = np.concatenate([starts[1:], [len(tokens)]])
    mixed = np.minimum.reduceat(groups, starts) < np.maximum.reduceat(groups, starts)
    found: set[tuple[int, int, int]] = set()
    for a, b in zip(starts[mixed].tolist(), ends[mixed].tolist()):
        g, m, s, part, rest = groups[a:b], weights[a:b], sizes[a:b], parts[a:b], left[a:b]
        # The largest group (of equal ones the smallest key) is only asked.
        largest = g[np.lexsort((g, -m))[0]]
        asking = np.flatnonzero(g != largest)
        step = max(1, PAIRS // (b - a))
        for i in range(0, len(asking), step):
            at = asking[i : i + step]
            gi, mi, si = g[at, None], m[at, None], s[at, None]
            asks = (gi != g) & ((mi < m) | ((mi == m) & (gi > g))) & (100 * s >= PERCENT * si) & (100 * si >= PERCENT * s)
            # The first common shingle of a linked pair has enough left behind it on both sides.
            asks &= (100 + PERCENT) * np.minimum(rest[at, None], rest) >= PERCENT * (si + s)
            q, c = np.nonzero(asks)
            differ = np.bitwise_count(sketches[a + at[q]] ^ sketches[a + c]).sum(axis=1, dtype=np.int64)
            near = (100 + PERCENT) * differ <= (100 - PERCENT) * (s[at[q]] + s[c])
            q, c = q[near], c[near]
            found.update(zip(ids[a + at[q]].tolist(), g[c].tolist(), part[c].tolist()))
    columns = list(zip(*sorted(found))) or [(), (), ()]
    return pa.table({k: pa.array(c, pa.int64()) for k, c in zip(("query", "group", "part"), columns)})


def open_parts(members: pa.Table, queries: pa.Table) -> pa.Table:
    """Links of queries with members of one part, where the part's union allows one."""
    links = []
    if members.num_rows and queries.num_rows:
        sets = sorted(zip(members.column("key").to_pylist(), _sets(members)), key=lambda x: x[0])
        union = np.unique(np.concatenate([s for _, s in sets]))
        smallest = min(len(s) for _, s in sets)
        for query, own in zip(queries.column("query").to_pylist(), _sets(queries, "query_text")):
            # A link needs (100 + PERCENT) * common >= PERCENT * (both sizes), and a member as large as this.
            least = max(smallest, -(-PERCENT * len(own) // 100))
            if (100 + PERCENT) * common(own, union) < PERCENT * (len(own) + least):
                continue
            other = next((key for key, s in sets if linked(own, s)), None)
            if other is not None:
                links.append((query, other))
    columns = list(zip(*links)) or [(), ()]
    return pa.table({k: pa.array(c, pa.int64()) for k, c in zip(("a", "b"), columns)})


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose texts link."""
    a, b = (texts.select(F.col("key").alias(x), F.col("text").alias(f"text_{x}")) for x in ("a", "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            for x, y in zip(as_bytes(batch.column("text_a")), as_bytes(batch.column("text_b"))):
                if last[0] != y:
                    last = (y, shingles(y))
                keep.append(linked(shingles(x), last[1]))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(check, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``key`` and ``component`` (the smallest key) of all keys that have an edge ``a``, ``b``."""
    def settled(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = written(edges, "edges")
    state = settled(edges)
    while True:
        # Large star: larger neighbours of a key go to its smallest one.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Small star: a key and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = written(small.filter("a <> b").distinct(), "edges")
        new = settled(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("b").alias("key")).distinct().select("key", F.col("key").alias("component"))
    return edges.select(F.col("a").alias("key"), F.col("b").alias("component")).unionByName(roots)


def join(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Classes and components of all documents: ``key``, ``n_shingles``, ``class_id`` (the smallest
    key with an equal set) and ``component_id`` (the smallest key reachable by links).

    ``key`` must be an integer column; other columns are not read.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    kind = df.schema[key].dataType.simpleString()
    docs = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = _sets(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(t) for t in as_bytes(batch.column("text"))], pa.int64())],
                ["key", "n", "set_key", "bytes"],
            )

    rows = written(docs.mapInArrow(measure, "key long, n long, set_key binary, bytes long"), "sets")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    n = max(1, -(-total // BATCH_BYTES))
    classes = rows.filter("set_key is not null and key is not null").groupBy("set_key").agg(F.min("key").alias("class_id"))
    classes = written(classes, "classes")

    found = survivors(docs.filter("key is not null"), n)
    texts = found.join(classes.select("set_key", F.col("class_id").alias("key")), ["set_key", "key"])
    texts = written(texts.dropDuplicates(["key", "set_key"]).select("key", "n", "first", "places", *SKETCH, "text"), "classes-with-partners")

    voted = postings(texts, n, ["key"]).groupBy("bucket").applyInArrow(votes, "a long, b long, votes long")
    voted = voted.groupBy("a", "b").agg(F.sum("votes").alias("votes"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("votes", (-F.col("b")).alias("b"))), asc=False), 1, VOTES)
    chosen = voted.groupBy("a").agg(best.alias("best")).select("a", F.explode("best").alias("c")).select("a", (-F.col("c.b")).alias("b"))
    # Rows of one key count as one document, so the classes of its rows belong together.
    own = rows.filter("set_key is not null").join(classes, "set_key").groupBy("key").agg(F.collect_set("class_id").alias("c")).filter("size(c) > 1")
    own = own.select("c", F.array_min("c").alias("b")).select(F.explode("c").alias("a"), "b").filter("a <> b")
    links = written(compare(chosen, texts).unionByName(own), "links")

    groups = components(links)
    grouped = texts.join(groups, "key", "left").withColumn("group", F.coalesce("component", "key"))
    counted = grouped.groupBy("group").agg(F.sum("n").alias("weight"))
    part = F.pmod(F.xxhash64("key"), F.lit(1).cast("long") + F.floor(F.col("weight") / PART))
    grouped = grouped.join(counted, "group").select("key", "n", "first", "places", "group", "weight", part.alias("part"), *SKETCH)
    grouped = written(grouped, "groups")
    packed = postings(grouped, n, ["key", "n", "group", "weight", "part", *SKETCH])
    asked = packed.groupBy("bucket").applyInArrow(matrix_pairs, "query long, group long, part long")
    asked = written(asked.distinct(), "asked")
    opened = grouped.select("key", "group", "part").join(asked.select("group", "part").distinct(), ["group", "part"])
    members = opened.join(texts.select("key", "text"), "key").select("group", "part", "key", "text")
    queries = asked.join(texts.select(F.col("key").alias("query"), F.col("text").alias("query_text")), "query")
    queries = queries.select(F.col("group").alias("query_group"), F.col("part").alias("query_part"), "query", "query_text")
    more = members.groupBy("group", "part").cogroup(queries.groupBy("query_group", "query_part")).applyInArrow(open_parts, "a long, b long")
    reached = components(links.unionByName(more))
    classes = classes.join(reached, F.col("class_id") == F.col("key"), "left").select(
        "set_key", "class_id", F.coalesce("component", "class_id").alias("component")
    )
    placed = rows.join(classes, "set_key", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return placed.select(
        F.col("key").cast(kind).alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("class_id", "key").cast(kind).alias("class_id"), component.cast(kind).alias("component_id"),
    )
