"""Quality rules and n-gram perplexity.

Rules count words, symbols, repeated lines and repeated 5-word windows of a text. The perplexity is
that of a modified Kneser-Ney model over characters (``ORDER``-grams, one model per language),
which a text made of other scripts, capitals, symbols or lists fits badly and a monotonous one too
well. A text's log-perplexity is its negative log-probability per word. How far it strays from the
language's median shrinks with the root of the number of words, so the band is set on that
distance times the root: ``WIDTH`` quartile distances beyond its quartiles, upper and lower. Short
texts are then not rejected by chance.

Counting: tasks count the n-grams of chunks of ``1 << CHUNK_BITS`` rows, Spark sums them;
continuation counts, counts of counts, discounts and back-off weights are aggregations of that
table. The model is Spark tables of every counted n-gram and context, and grows with the corpus.

Looking up: the different n-grams of each chunk are dealt by a hash to buckets, which join them to
their probabilities; each chunk's answers then go, in sorted arrays, to the task that has its rows.

Disk: every table, each order's probabilities included, is written by a query of its own, whose shuffle files are removed when it ends, and
the rows, which are the most, go to their tasks in ``ROUNDS`` rounds of chunks, a query each. Tables
are removed once the last query that reads them has ended; those of a model from ``fit`` stay.

Nulls: a null text is empty, a null language is a language of its own. Texts without characters
have no perplexity and fail the rules. Equal rows get equal results. A language
with a single text keeps it, as it is its own median.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import common
from starmart.llm.common import as_bytes, bounded_batches, new_folder, pieces, remove_folder, sent_if_small, shuffles_removed

ORDER = 5
BITS = 12  # of a character's code in an n-gram
CHUNK_BITS = 13  # of the rows in a chunk
WIDTH = 2.5
ROUNDS = 3  # in which chunks are judged; each reads the input and sends its own chunks' rows
FLUSH = 2_000_000  # n-grams that a task holds before it hands counts on

# The rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 10
REPEAT_WINDOW = 5
MOST_REPEATED = 20  # percent

_SPACE = b" \t\n\v\f\r"
_NO_START = _SPACE + bytes(range(0x80, 0xC0))  # white space and continuation bytes


def written(df: DataFrame, name: str, within: str | None = None) -> DataFrame:
    """A written table whose shuffle files go as soon as it is there."""
    with shuffles_removed(df.sparkSession):
        return common.written(df, name, within=within)


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words in windows that occur twice or more in the text, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        mixed = (mixed ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    _, place, count = np.unique(mixed, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[place] > 1)
    if not len(starts):
        return 0
    ends = starts + window
    return int(window + np.minimum(ends[1:] - ends[:-1], window).sum())


def rules(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    seen: set[bytes] = set()
    repeated = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip(_SPACE):
            seen.add(line)
    return len(words), len(text.translate(None, _NO_START)), len(text) - len(text.translate(None, SYMBOLS)), repeated, repeated_words(words)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams ending at each character of the texts, packed, and where each text's begin."""
    gap = "\0" * (ORDER - 1)
    decoded = [t.decode("utf-8", "replace").replace("\0", "\x01") for t in texts]
    codes = np.frombuffer((gap + gap.join(decoded) + gap).encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    half = np.uint64(1 << (BITS - 1))
    codes = np.where(codes < half, codes, half + (codes * np.uint64(2654435761) >> np.uint64(7)) % half)
    packed = np.zeros(len(codes) - ORDER + 1, dtype=np.uint64)
    for i in range(ORDER):
        packed = packed << np.uint64(BITS) | codes[i : len(codes) - ORDER + 1 + i]
    lengths = np.array([len(d) for d in decoded], dtype=np.int64)
    return packed[codes[ORDER - 1 :] != 0].astype(np.int64), np.concatenate([[0], np.cumsum(lengths)])


def _chunked(df: DataFrame, lang: str, text: str, *more: Column) -> DataFrame:
    """``chunk``, ``lang``, ``text`` and ``more``, in chunks of rows that lie together."""
    named = [F.col(f"`{c}`").cast("string").alias(n) for c, n in ((lang, "lang"), (text, "text"))]
    return df.select(F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS).alias("chunk"), *named, *more)


def same_in_every_scan(df: DataFrame) -> bool:
    """A plan without a shuffle reads files or held rows, whose splits and order do not change."""
    return "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def _buckets(n: int) -> int:
    """The smallest prime from ``n``: packed characters modulo a prime are even."""
    n = max(n, 3)
    while any(n % i == 0 for i in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def count_grams(source: DataFrame, within: str | None = None) -> DataFrame:
    """``chunk``, ``lang``, ``grams`` and ``n``: the different n-grams of the highest order in a
    chunk in arrays; a chunk with many, or read by two tasks, has several rows."""
    bounded_batches(source.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(place, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

        def rows() -> Iterator[pa.RecordBatch]:
            for (chunk, name), parts in held.items():
                keys, n = merged(parts)
                for i in range(0, len(keys), 100_000):
                    columns = [pa.array([x[i : i + 100_000].tolist()], pa.list_(pa.int64())) for x in (keys, n)]
                    yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([name], pa.string()), *columns], ["chunk", "lang", "grams", "n"])

        for batch in pieces(batches, "text"):
            by_name: dict = {}
            for chunk, name, t in zip(batch.column("chunk").to_pylist(), batch.column("lang").to_pylist(), as_bytes(batch.column("text"))):
                by_name.setdefault((chunk, name), []).append(t)
            if any(k[0] not in {c for c, _ in by_name} for k in held):
                yield from rows()
                held, size = {}, 0
            for name, texts in by_name.items():
                keys, n = np.unique(grams(texts)[0], return_counts=True)
                parts = held.setdefault(name, [])
                parts.append((keys, n))
                size += len(keys)
            if size > FLUSH:
                held = {name: [merged(parts)] for name, parts in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > FLUSH // 2:
                    yield from rows()
                    held, size = {}, 0
        yield from rows()

    source = source.select("chunk", "lang", "text")
    return written(source.mapInArrow(count, "chunk long, lang string, grams array<long>, n array<long>"), "quality-chunks", within)


class Model:
    """Tables of each order's n-grams with their discounted count (``lang``, ``gram``, ``left``), of
    contexts with their count and the weight of the lower order (``lang``, ``context``, ``total``,
    ``weight``), and of the number of characters of each language (``lang``, ``characters``)."""

    def __init__(self, counts: dict[int, DataFrame], contexts: dict[int, DataFrame], characters: DataFrame):
        self.counts, self.contexts, self.characters = counts, contexts, characters

    def log_probabilities(self, wanted: DataFrame, within: str | None = None) -> DataFrame:
        """``lang``, ``gram`` and ``log_p``, the natural logarithm of the probability of the
        n-gram's last character, of the different ``lang`` and ``gram`` of ``wanted``. Each lower
        order is a written table."""
        lower = None
        for n in range(1, ORDER + 1):
            part = wanted.select("lang", F.col("gram").bitwiseAND(F.lit((1 << BITS * n) - 1)).alias("gram")).distinct()
            part = part.withColumns({"_context": F.shiftright("gram", BITS), "_suffix": F.col("gram").bitwiseAND(F.lit((1 << BITS * (n - 1)) - 1))})
            for table, mine, its in ((self.counts[n], "gram", "gram"), (self.contexts[n], "_context", "context"), (lower, "_suffix", "gram")):
                if table is not None:
                    table = table.withColumnsRenamed({"lang": "_lang", its: "_its"})
                    part = part.join(table, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col(mine) == F.col("_its")), "left").drop("_lang", "_its")
            if lower is None:
                characters = self.characters.withColumnRenamed("lang", "_lang")
                part = part.join(sent_if_small(characters), F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
                part = part.withColumn("p", F.coalesce(1.0 / (F.col("characters") + 1.0), F.lit(0.5))).drop("characters")
            p = F.coalesce(F.col("left") / F.col("total"), F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("p")
            lower = part.select("lang", "gram", p.alias("p"))
            lower = written(lower, "quality-lower", within) if n < ORDER else lower
        return lower.select("lang", "gram", F.log("p").alias("log_p"))

    def log_probability(self, name, gram: np.ndarray) -> np.ndarray:
        """The same for an array of n-grams of a language."""
        spark = self.counts[1].sparkSession
        wanted = spark.createDataFrame([(name, g) for g in gram.tolist()], "lang string, gram long")
        found = {r.gram: r.log_p for r in self.log_probabilities(wanted).collect()}
        return np.array([found[g] for g in gram.tolist()])


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count all texts and make the model."""
    return _model(_counted(count_grams(_chunked(df, lang, text))))


def _discounts(table: DataFrame) -> DataFrame:
    """Modified Kneser-Ney: what counts of 1, 2 and more give up (``d1`` to ``d3``), per language (``_lang``)."""
    ones = [F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)]
    counts = table.groupBy(F.col("lang").alias("_lang")).agg(*ones, F.count(F.lit(1)).alias("different"))
    y = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

    def discount(i: int) -> Column:
        given = i - (i + 1) * F.col("_y") * F.col(f"n{i + 1}") / F.nullif(f"n{i}", F.lit(0))
        return F.coalesce(F.least(F.lit(i - 0.01), F.greatest(F.lit(0.1), given)), F.lit(0.5))

    held = [F.when(F.col(f"n{i}") > 0, discount(i)).otherwise(0.5).alias(f"d{i}") for i in (1, 2, 3)]
    return counts.withColumn("_y", y).select("_lang", "different", *held)


def _counted(chunks: DataFrame, within: str | None = None) -> DataFrame:
    """``lang``, ``gram`` and ``n`` of each different n-gram of the highest order."""
    pairs = chunks.select("lang", F.explode(F.arrays_zip("grams", "n")).alias("_pair"))
    return written(pairs.groupBy("lang", F.col("_pair.grams").alias("gram")).agg(F.sum("_pair.n").alias("n")), "quality-grams", within)


def _model(table: DataFrame, within: str | None = None) -> Model:
    counts, weights = {}, {}
    for order in range(ORDER, 0, -1):
        discounts = written(_discounts(table), "quality-discounts", within)
        discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        named = table.join(sent_if_small(discounts), F.col("lang").eqNullSafe(F.col("_lang")))
        named = named.select("lang", "gram", "n", F.shiftright("gram", BITS).alias("context"), (F.col("n") - discount).alias("left"))
        contexts = named.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("left").alias("given"))
        contexts = written(contexts.withColumn("weight", 1.0 - F.col("given") / F.col("total")), "quality-contexts", within)
        counts[order] = named.select("lang", "gram", "left")
        weights[order] = contexts.select("lang", "context", "total", "weight")
        if order > 1:
            # A shorter n-gram counts the different characters it follows.
            table = table.groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
            table = written(table, "quality-grams", within)
    return Model(counts, weights, discounts.select(F.col("_lang").alias("lang"), F.col("different").alias("characters")))


def _answers(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """``chunk``, ``lang``, ``grams`` and ``log_p`` in arrays, by ``found``'s ``log_p`` of each n-gram."""
    buckets = _buckets(chunks.count())
    found = found.withColumn("bucket", F.col("gram") % buckets)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, name, each in zip(*(batch.column(c) for c in ("chunk", "lang", "grams"))):
                each = each.values.to_numpy()
                at = each % buckets
                order = np.argsort(at, kind="stable")
                ends = np.searchsorted(at[order], np.arange(buckets + 1))
                sizes = np.diff(ends)
                used = np.flatnonzero(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.append(ends[used], len(each)), pa.int32()), pa.array(each[order]))
                n = len(used)
                names = pa.array([name.as_py()] * n, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([chunk.as_py()] * n, pa.int64()), names, lists], ["bucket", "chunk", "lang", "grams"])

    def look(asked: pa.Table, known: pa.Table) -> pa.Table:
        names = np.array(known.column("lang").to_pylist(), dtype=object)
        gram, log_p = known.column("gram").to_numpy(), known.column("log_p").to_numpy()
        tables = {}
        for name in set(names.tolist()):
            at = np.flatnonzero(names == name)
            at = at[np.argsort(gram[at])]
            tables[name] = (gram[at], log_p[at])
        answers = []
        for name, each in zip(asked.column("lang").to_pylist(), (x.values.to_numpy() for x in asked.column("grams"))):
            place = np.searchsorted(tables[name][0], each)
            assert (tables[name][0][place] == each).all()
            answers.append(tables[name][1][place].tolist())
        return pa.table([asked.column("chunk"), asked.column("lang"), asked.column("grams"), pa.array(answers, pa.list_(pa.float64()))], ["chunk", "lang", "grams", "log_p"])

    dealt = chunks.select("chunk", "lang", "grams").mapInArrow(split, "bucket long, chunk long, lang string, grams array<long>")
    return dealt.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(look, "chunk long, lang string, grams array<long>, log_p array<double>")


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def losses(table: tuple | None, texts: list[bytes]) -> list[float]:
    """Negative log-probability of each text by sorted n-grams and their logarithms."""
    gram, starts = grams(texts)
    if not len(gram):
        return [0.0] * len(texts)
    each, place = np.unique(gram, return_inverse=True)
    at = np.searchsorted(table[0], each) if table else np.zeros(0)
    if not table or at[-1] == len(table[0]) or (table[0][at] != each).any():
        raise RuntimeError("the input had other rows when its n-grams were counted")
    sums = np.concatenate([[0.0], np.cumsum(-table[1][at][place])])
    return (sums[starts[1:]] - sums[starts[:-1]]).tolist()


def assess(df: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rules and verdict of each whole text.

    Returns ``key``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, ``log_perplexity``, and the language's
    ``lower`` and ``upper`` for as many words. Other columns are not read.
    """
    bounded_batches(df.sparkSession)
    # Both scans must have the same rows in the same chunks: behind a shuffle they are written once.
    source = _chunked(df, lang, text, F.col(f"`{key}`").alias("key"))
    spark = df.sparkSession
    for_rows, for_model, for_answers = (new_folder(spark, f"quality-for-{x}") for x in ("rows", "model", "answers"))
    source = source if same_in_every_scan(df) else written(source, "quality-rows", for_rows)
    chunks = count_grams(source, for_answers)
    tasks = max(1, chunks.select("chunk").distinct().count())
    if model:
        wanted = written(chunks.select("lang", F.explode("grams").alias("gram")).distinct(), "quality-wanted", for_model)
    else:
        counted = _counted(chunks, for_model)
        model, wanted = _model(counted, for_model), counted.select("lang", "gram")
    found = written(model.log_probabilities(wanted, for_model), "quality-answers", for_answers)
    remove_folder(spark, for_model)
    answers = written(_answers(chunks, found), "quality-looked-up", for_rows)
    remove_folder(spark, for_answers)
    kind = df.schema[key].dataType.simpleString()
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a chunk as compressed batches."""
        for batch in pieces(batches, "text"):
            chunk = batch.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), batch.num_rows]
            parts = [_packed(batch.slice(a, b - a).select(["key", "lang", "text"])) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(chunk[cuts[:-1]]), pa.array(parts, pa.binary())], ["chunk", "rows"])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's answers come before its rows."""
        now, parts, tables = None, {}, {}
        for batch in batches:
            for i, (chunk, name, rows) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("chunk", "lang", "rows")))):
                if chunk != now:
                    now, parts, tables = chunk, {}, {}
                if rows is None:
                    parts.setdefault(name, []).append(tuple(batch.column(c)[i].values.to_numpy() for c in ("grams", "log_p")))
                    continue
                for name in list(parts):
                    each, log_p = (np.concatenate(x) for x in zip(*parts.pop(name)))
                    first = np.unique(each, return_index=True)[1]
                    tables[name] = (each[first], log_p[first])
                for part in pa.ipc.open_stream(rows):
                    yield scored(part, tables)

    def scored(batch: pa.RecordBatch, tables: dict) -> pa.RecordBatch:
        texts, names = as_bytes(batch.column("text")), batch.column("lang").to_pylist()
        found = [0.0] * len(texts)
        for name in set(names):
            at = [i for i, x in enumerate(names) if x == name]
            for i, result in zip(at, losses(tables.get(name), [texts[i] for i in at])):
                found[i] = result
        columns = [pa.array(c, pa.int64()) for c in zip(*map(rules, texts))]
        columns.append(pa.array(found, pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("lang"), *columns], ["key", "lang", *numbers, "loss"])

    kinds = ", ".join(f"{n} long" for n in numbers)

    def round_of_chunks(i: int) -> DataFrame:
        own = F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == i
        rows = source.filter(own).select("chunk", "key", "lang", "text").mapInArrow(packed, "chunk long, rows binary")
        both = answers.filter(own).withColumn("rows", F.lit(None).cast("binary")).unionByName(rows, allowMissingColumns=True)
        both = both.repartition(tasks, "chunk").sortWithinPartitions("chunk", F.col("rows").isNotNull())
        return written(both.mapInArrow(judged, f"key {kind}, lang string, {kinds}, loss double"), "quality")

    found = reduce(DataFrame.unionAll, [round_of_chunks(i) for i in range(ROUNDS)])
    remove_folder(spark, for_rows)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    words = F.nullif(F.col("n_words"), F.lit(0))
    found = found.withColumns({"base_failed": failed, "log_perplexity": F.col("loss") / words})

    def quartiles(rows: DataFrame, column: str) -> DataFrame:
        q = F.percentile_approx(column, [0.25, 0.5, 0.75], 10_000)
        return rows.filter("not base_failed").groupBy(F.col("lang").alias("_lang")).agg(q.alias("_q"))

    def beside(rows: DataFrame, bands: DataFrame) -> DataFrame:
        return rows.join(sent_if_small(bands), F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")

    rows = beside(found, quartiles(found, "log_perplexity")).withColumn("_median", F.col("_q")[1]).drop("_q")
    rows = rows.withColumn("_stray", (F.col("log_perplexity") - F.col("_median")) * F.sqrt(words))
    rows = beside(rows, quartiles(rows, "_stray"))
    width = WIDTH * (F.col("_q")[2] - F.col("_q")[0])
    rows = rows.withColumns({
        "lower": F.col("_median") + (F.col("_q")[0] - width) / F.sqrt(words),
        "upper": F.col("_median") + (F.col("_q")[2] + width) / F.sqrt(words),
    })
    inside = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return rows.select(F.col("key").alias(key), *numbers, "base_failed", kept.alias("kept"), "log_perplexity", "lower", "upper")
