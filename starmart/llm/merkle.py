"""Document fingerprints: a Merkle tree over paragraphs and sections, with built-in functions only.

A text is cut into sections (at empty lines), these into paragraphs (lines), without loss. A
paragraph's hash is the md5 of its text, a section's that of its paragraphs' hashes, and the root
is the sha256 of the sections' hashes: equal roots mean equal texts. Below a paragraph lie its
pieces: sentences, or 32 characters where no sentence ends earlier. A piece is a long: 52 bits of
hash and 12 bits of length. The likeness of two trees is the share of characters that lie in
pieces both have: 2 * common / (all of one + all of the other), each different piece once.

Fingerprint: ``root:`` and the sections, joined by ``;``; of each the paragraphs, joined by ``,``;
of each the first 12 digits of its hash and its pieces, 16 digits each, joined by ``.``.

Null texts are empty. An empty text has one empty paragraph and no pieces; two texts without
pieces have likeness 1, one with and one without 0. Equal rows have equal fingerprints.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = r"[^.!?]{0,32}[.!?]+|[^.!?]{1,32}"
BUCKETS_PER_TASK = 8


def _piece(p: Column) -> Column:
    digest = F.xxhash64(p).bitwiseAND(F.lit(~0xFFF))
    return digest.bitwiseOR(F.least(F.length(p), F.lit(0xFFF)).cast("long"))


def tree(text: Column) -> Column:
    """Array of sections; each is an array of paragraphs with ``hash`` and ``pieces``."""
    def paragraph(p: Column) -> Column:
        pieces = F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), _piece)
        return F.struct(F.md5(p.cast("binary")).alias("hash"), pieces.alias("pieces"))

    return F.transform(F.split(text, "\n\n", -1), lambda s: F.transform(F.split(s, "\n", -1), paragraph))


def section_hash(section: Column) -> Column:
    return F.md5(F.concat_ws(",", F.transform(section, lambda p: p["hash"])).cast("binary"))


def root(sections: Column) -> Column:
    return F.sha2(F.concat_ws(";", F.transform(sections, section_hash)).cast("binary"), 256)


def fingerprint(sections: Column) -> Column:
    """The tree as text."""
    def paragraph(p: Column) -> Column:
        return F.concat_ws(".", F.substring(p["hash"], 1, 12), F.transform(p["pieces"], lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")))

    branches = F.concat_ws(";", F.transform(sections, lambda s: F.concat_ws(",", F.transform(s, paragraph))))
    return F.concat(root(sections), F.lit(":"), branches)


def leaves(sections: Column) -> Column:
    """All different pieces of a tree."""
    return F.array_distinct(F.flatten(F.transform(sections, lambda s: F.flatten(F.transform(s, lambda p: p["pieces"])))))


def _characters(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda n, x: n + x.bitwiseAND(F.lit(0xFFF).cast("long")))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two trees by their ``leaves``, 0 to 1."""
    both = _characters(a) + _characters(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * _characters(F.array_intersect(a, b)) / both)


def differences(a: Column, b: Column) -> Column:
    """Where ``a`` was edited against ``b`` (both trees): array of (section, paragraph), from 0.

    Only branches whose hash the other tree lacks are opened.
    """
    others = F.transform(b, section_hash)
    paragraphs = F.flatten(F.transform(b, lambda s: F.transform(s, lambda p: p["hash"])))
    none = F.array().cast("array<struct<section:int,paragraph:int>>")

    def inside(section: Column, i: Column) -> Column:
        marked = F.transform(section, lambda p, j: F.when(~F.array_contains(paragraphs, p["hash"]), F.struct(i.alias("section"), j.alias("paragraph"))))
        return F.when(F.array_contains(others, section_hash(section)), none).otherwise(F.filter(marked, lambda x: x.isNotNull()))

    return F.when(root(a) == root(b), none).otherwise(F.flatten(F.transform(a, inside)))


def with_next(df: DataFrame, key: str, text: str, value) -> DataFrame:
    """Rows ``key``, ``text``, ``value(text)`` of each document and of the next one in descending order.

    ``next_text`` and ``next_value`` are those of the following document; after the last comes the
    first. Nulls are last, equal keys are in order of their text. Documents are dealt into ranges
    of the key, each range also gets the first document of the range behind it, and the next row is
    found within the range; so no task sees more than its ranges.
    """
    spark = df.sparkSession
    docs = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    ranges = BUCKETS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbers = docs.select(F.col("key").cast("double").alias("key")).filter("key is not null")
    cuts = sorted(set(numbers.approxQuantile("key", [i / ranges for i in range(1, ranges)], 0.1 / ranges)))
    above = F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: c > F.col("key").cast("double"))
    docs = docs.withColumn("_range", F.when(F.col("key").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(above)))

    # The first key of each range, and the range before it: one row per range.
    firsts = docs.groupBy("_range").agg(F.max("key").alias("_first"))
    around = Window.orderBy("_range")
    firsts = firsts.withColumn("_to", F.lag("_range").over(around))
    firsts = firsts.withColumn("_to", F.coalesce("_to", F.max("_range").over(Window.partitionBy()))).withColumnRenamed("_range", "_of")
    heads = docs.join(F.broadcast(firsts), (F.col("_range") == F.col("_of")) & F.col("key").eqNullSafe(F.col("_first")))
    heads = heads.groupBy("_to").agg(F.min("text").alias("text"))
    rows = docs.select("_range", F.lit(0).alias("_borrowed"), "key", "text").unionByName(
        heads.select(F.col("_to").alias("_range"), F.lit(1).alias("_borrowed"), F.lit(None).cast(docs.schema["key"].dataType).alias("key"), "text")
    )
    rows = rows.repartition("_range").withColumn("value", value(F.col("text")))
    following = Window.partitionBy("_range").orderBy("_borrowed", F.desc_nulls_last("key"), "text")
    rows = rows.withColumn("_next", F.lead(F.struct("text", "value")).over(following)).filter("_borrowed = 0")
    return rows.select("key", "text", "value", F.col("_next.text").alias("next_text"), F.col("_next.value").alias("next_value"))


def compare_with_edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint each text and an edited one, whose second half is the start of the next document.

    Returns ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next`` and ``edits``, the paragraphs of the edited text that differ.
    """
    rows = with_next(df, key, text, tree)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("key", n.cast("long").alias("n_chars"), edited.alias("edited"), "value", F.col("next_value"))
    rows = rows.withColumn("edited_value", tree(F.col("edited")))
    rows = rows.withColumns({"a": leaves(F.col("value")), "b": leaves(F.col("edited_value")), "c": leaves(F.col("next_value"))})
    return rows.select(
        F.col("key").alias(key),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("value")).alias("fingerprint"),
        fingerprint(F.col("edited_value")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"),
        differences(F.col("edited_value"), F.col("value")).alias("edits"),
    )
