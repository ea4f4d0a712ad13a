"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Learning: over all labelled rows of the learning part, each term's documents are counted by label;
the terms that speak for label 1 (odds of at least ``LEAST_ODDS`` to 1 that are ``LEAST_Z`` standard
errors from even; at most ``MOST_TERMS``, the surest) are the vocabulary. Labelled texts with a term of it are examples;
a bounded sample, at most ``MOST_EXAMPLES`` of each label, those with the smallest hash of their
key and text, goes into the index, and votes are weighed so that the sample stands for all of them.

Index: an inverted list per term, cut into blocks of ``BLOCK`` examples, with the largest weight
of the term in each block. A query adds these up to a bound for each block, opens blocks from the
highest bound down and stops when no bound reaches its k-th similarity; so the neighbours are
exactly those of brute force.

Score: neighbours vote with the square of their cosine, against the share of label 1 among
labelled rows without any term, which counts as ``PRIOR_VOTES``. A text without terms gets that
share. Only the text is an input. Whole texts are read.

Nulls: a null text is empty; a null key is never learned from; null labels are left out; of
several labels of a key the highest counts. Equal texts have equal scores; neighbours of equal
similarity are taken in the index's order. Without labelled rows every score is 0.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import as_bytes, bounded_batches, pieces, sent_if_small, written

LEAST_Z = 3.0
LEAST_ODDS = 3.0
MOST_TERMS = 4096
MOST_EXAMPLES = 2048
BLOCK = 64
NEIGHBOURS = 24
PRIOR_VOTES = 0.5
MOST_LABELS_SENT = 1_000_000  # more labels are joined by a shuffle
REMEMBERED = 20_000  # different term counts whose scores a task remembers
FLUSH = 300_000  # terms that a task counts before it hands counts on

# ASCII letters in lower case; what is no letter, digit or part of a UTF-8 character ends a term.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Model:
    """Vocabulary and example index; its size is bounded by the constants above."""

    vocabulary: dict[bytes, int]
    idf: np.ndarray
    prior: float
    ids: list
    labels: np.ndarray
    votes: np.ndarray  # weight of an example's vote
    starts: np.ndarray  # of the postings of (term, block)
    examples: np.ndarray
    weights: np.ndarray
    largest: np.ndarray  # of a term in a block
    answers: dict = field(default_factory=dict)

    @property
    def blocks(self) -> int:
        return self.largest.shape[1]

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights (length 1) of a text."""
        t = np.array(sorted(counts), dtype=np.int64)
        w = (1.0 + np.log([counts[i] for i in t.tolist()])) * self.idf[t] if len(t) else np.zeros(0)
        return t, w / np.sqrt((w * w).sum()) if len(t) else w

    def neighbours(self, t: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest examples and their cosines, exactly."""
        bounds = w @ self.largest[t] if len(t) else np.zeros(self.blocks)
        order = np.argsort(-bounds, kind="stable")
        best, score, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        for block in order.tolist():
            if bounds[block] <= 0 or bounds[block] < least - 1e-12:
                break
            cell = t * self.blocks + block
            first = self.starts[cell]
            sizes = self.starts[cell + 1] - first
            at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            sums = np.bincount(self.examples[at] - block * BLOCK, weights=np.repeat(w, sizes) * self.weights[at], minlength=BLOCK)
            found = np.flatnonzero(sums > 0)
            best, score = np.concatenate([best, found + block * BLOCK]), np.concatenate([score, sums[found]])
            if len(best) > NEIGHBOURS:
                nearest = np.lexsort((best, -np.round(score, 12)))[:NEIGHBOURS]
                best, score = best[nearest], score[nearest]
                least = score[-1]
        nearest = np.lexsort((best, -np.round(score, 12)))
        return best[nearest], score[nearest]

    def score(self, counts: dict[int, int]) -> tuple[float, list]:
        """Score and evidence; many short texts have the same few terms, which are looked up once."""
        known = tuple(sorted(counts.items()))
        found = self.answers.get(known)
        if found is None:
            if len(self.answers) >= REMEMBERED:
                self.answers.clear()
            found = self.answers[known] = self._score(counts)
        return found

    def _score(self, counts: dict[int, int]) -> tuple[float, list]:
        best, cosine = self.neighbours(*self.vector(counts)) if counts and len(self.labels) else ([], np.zeros(0))
        if not len(best):
            return self.prior, []
        vote = cosine**2 * self.votes[best]
        share = (float((vote * self.labels[best]).sum()) + PRIOR_VOTES * self.prior) / (float(vote.sum()) + PRIOR_VOTES)
        evidence = [{"id": self.ids[i], "similarity": round(float(c), 6), "label": int(self.labels[i])} for i, c in zip(best[:3], cosine[:3])]
        return min(1.0, max(0.0, share)), evidence

    def count(self, text: bytes) -> dict[int, int]:
        known = Counter(filter(self.vocabulary.__contains__, terms(text)))
        return {self.vocabulary[k]: n for k, n in known.items()}


def held_out(key: Column) -> Column:
    """Rows that labels are not learned from; null keys are among them."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5, F.lit(0)) == 0


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from the labelled rows that are not held out."""
    spark = documents.sparkSession
    bounded_batches(spark)
    known = labels.filter(F.col(label).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(F.when(F.col(label) > 0, 1).otherwise(0)).alias("label"))
    docs = documents.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    docs = docs.filter(~held_out(F.col("id")))
    learned = docs.join(sent_if_small(known, MOST_LABELS_SENT), F.col("id") == F.col("_key")).select("id", "label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents of each term by label; the empty term counts all documents."""
        found: tuple[Counter, Counter] = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            each = list(found[0].keys() | found[1].keys())
            counts = [pa.array([found[v][t] for t in each], pa.int64()) for v in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(each, pa.binary()), *counts], ["term", "n0", "n1"])

        for batch in pieces(batches, "text"):
            for t, v in zip(as_bytes(batch.column("text")), batch.column("label").to_pylist()):
                found[v].update(set(terms(t)))
                found[v][b""] += 1
            if len(found[0]) + len(found[1]) > FLUSH:
                yield rows()
                found = (Counter(), Counter())
        yield rows()

    sums = learned.mapInArrow(count, "term binary, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sums = written(sums.filter("n1 > 1 or term = X''"), "toxicity-terms")
    total = sums.filter("term = X''").first()
    n0, n1 = (total.n0, total.n1) if total else (0, 0)
    a, b = F.col("n1") + 0.5, F.col("n0") + 0.5
    odds = F.log(a / (n1 - F.col("n1") + 0.5)) - F.log(b / (n0 - F.col("n0") + 0.5))
    z = odds / F.sqrt(1 / a + 1 / b)
    chosen = sums.filter("term <> X''").select("term", (F.col("n0") + F.col("n1")).alias("n"), z.alias("z"), odds.alias("odds"))
    chosen = chosen.filter((F.col("z") >= LEAST_Z) & (F.col("odds") >= float(np.log(LEAST_ODDS))))
    chosen = chosen.orderBy(F.desc("z"), "term").limit(MOST_TERMS).collect()
    vocabulary = {bytes(r.term): i for i, r in enumerate(chosen)}
    idf = np.array([np.log((1 + n0 + n1) / (1 + r.n)) + 1 for r in chosen])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = []
            for i, v, h, t in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "hash")), as_bytes(batch.column("text"))):
                known = Counter(filter(vocabulary.__contains__, terms(t)))
                if known:
                    rows.append((i, v, h, [vocabulary[k] for k in known], list(known.values())))
            columns = list(zip(*rows)) or [[], [], [], [], []]
            kinds = [batch.schema.field("id").type, pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "label", "hash", "terms", "counts"])

    kind = docs.schema["id"].dataType.simpleString()
    hashed = learned.withColumn("hash", F.xxhash64("id", "text"))
    with_terms = written(hashed.mapInArrow(candidates, f"id {kind}, label int, hash long, terms array<int>, counts array<int>"), "toxicity-examples")
    sizes = {r.label: r.n for r in with_terms.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = [r for v in (0, 1) for r in with_terms.filter(F.col("label") == v).orderBy("hash", "id").limit(MOST_EXAMPLES).collect()]
    in_sample = Counter(r.label for r in sample)
    without = (n0 + n1) - sum(sizes.values())
    prior = (n1 - sizes.get(1, 0)) / without if without > 0 else (n1 / (n0 + n1) if n0 + n1 else 0.0)
    return build(vocabulary, idf, prior, sample, {v: sizes[v] / n for v, n in in_sample.items()})


def build(vocabulary: dict[bytes, int], idf: np.ndarray, prior: float, sample: list, stands_for: dict[int, float]) -> Model:
    """The index of a sample of examples (rows with id, label, terms, counts)."""
    model = Model(vocabulary, idf, prior, [], np.zeros(0), np.zeros(0), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros((len(vocabulary), 0)))
    vectors = [(r, *model.vector(dict(zip(r.terms, r.counts)))) for r in sample]
    # Examples with the same strongest term lie together, which keeps the bounds of blocks apart.
    vectors.sort(key=lambda x: (int(x[1][np.argmax(x[2])]), x[1].tolist(), str(x[0].id)))
    blocks = -(-len(vectors) // BLOCK)
    term = np.concatenate([t for _, t, _ in vectors]) if vectors else np.zeros(0, np.int64)
    example = np.repeat(np.arange(len(vectors)), [len(t) for _, t, _ in vectors])
    weight = np.concatenate([w for *_, w in vectors]) if vectors else np.zeros(0)
    cell = term * blocks + example // BLOCK if blocks else term
    order = np.lexsort((example, cell))
    model.largest = np.zeros((len(vocabulary), blocks))
    np.maximum.at(model.largest.reshape(-1), cell, weight)
    model.starts = np.searchsorted(cell[order], np.arange(len(vocabulary) * blocks + 1))
    model.examples, model.weights = example[order], weight[order]
    model.ids = [r.id for r, *_ in vectors]
    model.labels = np.array([r.label for r, *_ in vectors], dtype=float)
    mean = sum(stands_for.get(r.label, 1.0) for r, *_ in vectors) / max(1, len(vectors))
    model.votes = np.array([stands_for.get(r.label, 1.0) / mean for r, *_ in vectors])
    return model


def score(documents: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of ``documents`` with ``score``, ``predicted`` and ``evidence`` (up to three
    nearest examples), which replace columns of these names."""
    spark = documents.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    kept = [c for c in documents.columns if c.lower() not in ("score", "predicted", "evidence")]
    kind = documents.schema[key].dataType.simpleString()
    one = F.col(f"`{text}`").cast("string")
    source = documents.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), one.alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in pieces(batches, "text"):
            results = [m.score(m.count(t)) for t in as_bytes(batch.column("text"))]
            shares = pa.array([s for s, _ in results], pa.float64())
            predicted = pa.array([int(s >= 0.5) for s, _ in results], pa.int32())
            row = batch.schema.field("row").type
            id_type = row.field(row.get_field_index(key)).type
            evidence = pa.array([e for _, e in results], pa.list_(pa.struct([("id", id_type), ("similarity", pa.float64()), ("label", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column("row"), shares, predicted, evidence], ["row", "score", "predicted", "evidence"])

    row_kind = source.schema["row"].dataType.simpleString()
    rows = source.mapInArrow(scored, f"row {row_kind}, score double, predicted int, evidence array<struct<id:{kind},similarity:double,label:int>>")
    return rows.select(*[F.col("row").getField(c).alias(c) for c in kept], "score", "predicted", "evidence")
