"""License scans by diagonal voting, with built-in functions only.

Every text is read as words in lower case, and each run of ``WINDOW`` words (a gram) is hashed. One
Spark join of all rolling hashes with the templates' positions finds where grams of a text and of a
template agree, word for word. A text position less its template position is the diagonal: what is
copied in one piece lies on one diagonal, so hits are added up by template and diagonal. Inserted
or missing words move what follows to a neighbouring diagonal; diagonals at most ``DRIFT`` words
apart are merged into a span, which is verified: it must hold a stated share of the template's
grams, each counted once, and be hardly longer than the template.

A template is ``(label, share, base, text)``. Base templates are phrases that must stand whole on one
diagonal; their places are counted. The templates are a parameter of the caller, so the side that
is broadcast is as large as their words, whatever the corpus holds.

What leaves a task is one row per text and the hits, both without text. Rows with equal key and
text are scanned as one and returned as often as they came, so neither null keys nor copies can
pile up. A null text is empty: no words, no labels, score 0. Very long texts are one row, with hits
in proportion. An empty table gives no rows. Other columns of the input are not read.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 3  # words in a gram
DRIFT = 3  # words between diagonals that are merged
STRETCH = 1.5  # a span may have so many times the words of its template

Template = tuple[str, float, bool, str]

# Phrases and opening words of published licenses with their labels. Short texts that
# tell versions apart must stand whole; of longer notices a share of their grams is enough.
TEMPLATES: tuple[Template, ...] = (
    ("mit", 1.0, True, "under the mit license"),
    ("apache-2", 1.0, True, "apache license version 2"),
    ("cc-by-nc", 1.0, True, "cc by nc"),
    ("gpl-2", 1.0, False, "gnu general public license version 2"),
    ("gpl-3", 1.0, False, "gnu general public license version 3"),
    ("lgpl", 1.0, False, "gnu lesser general public license"),
    ("agpl-3", 1.0, False, "gnu affero general public license version 3"),
    ("cc-by", 1.0, False, "creative commons attribution 4 0 international"),
    ("cc-by-sa", 1.0, False, "creative commons attribution sharealike 4 0 international"),
    (
        "mit", 0.6, False,
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    (
        "apache-2", 0.6, False,
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "www.apache.org licenses LICENSE-2.0",
    ),
    (
        "bsd", 0.6, False,
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    (
        "isc", 0.6, False,
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    (
        "mpl-2", 0.6, False,
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file",
    ),
    ("unlicense", 0.6, False, "This is free and unencumbered software released into the public domain"),
    (
        "cc0", 0.6, False,
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    ),
)


def words(text: Column) -> Column:
    """The words of a text, ``A`` to ``Z`` in lower case."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def grams(found: Column, window: int = WINDOW) -> Column:
    """Each run of ``window`` words, joined by a space; none for fewer words."""
    starts = F.slice(found, 1, F.greatest(F.size(found) - (window - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.concat_ws(" ", w, *[F.get(found, i + j) for j in range(1, window)]))


def positions(spark: SparkSession, templates: Sequence[Template], window: int = WINDOW) -> DataFrame:
    """Template positions by gram: ``hash``, ``template``, ``at``; the empty gram stands for a text itself."""
    texts = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t[3]).alias("text")) for i, t in enumerate(templates)])
    rows = spark.range(1).select(F.explode(texts).alias("t")).select("t.template", words(F.col("t.text")).alias("words"))
    rows = rows.select("template", F.posexplode(grams(F.col("words"), window)).alias("at", "gram"))
    itself = spark.range(1).select(F.lit(None).cast("int").alias("template"), F.lit(0).alias("at"), F.lit("").alias("gram"))
    return rows.unionByName(itself).select(F.xxhash64("gram").alias("hash"), F.col("gram").alias("of"), "template", "at")


def hits(df: DataFrame, key: str, text: str, templates: Sequence[Template], window: int = WINDOW) -> DataFrame:
    """Votes: one row per text, template and diagonal with the template positions ``seen`` there.

    Texts themselves are rows without template, ``n`` of each.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("key", F.md5(F.col("text").cast("binary")).alias("digest"), words(F.col("text")).alias("words"))
    all_grams = F.concat(F.array(F.lit("")), grams(F.col("words"), window))
    # The words end here: what goes beside each gram is short. An outer explode, though no array is
    # empty: for an inner one Spark filters empty arrays before it has the words, building all twice.
    rows = rows.select("key", "digest", F.size("words").cast("long").alias("n_words"), all_grams.alias("grams"))
    rolling = rows.select("key", "digest", "n_words", F.posexplode_outer("grams").alias("place", "gram"))
    known = F.broadcast(positions(df.sparkSession, templates, window))  # as many rows as the templates have words
    found = rolling.join(known, (F.xxhash64("gram") == F.col("hash")) & (F.col("gram") == F.col("of")))
    # The empty gram has place 0, so grams are counted from 1.
    diagonal = F.when(F.col("template").isNotNull(), F.col("place") - 1 - F.col("at")).otherwise(F.lit(0))
    votes = found.groupBy("key", "digest", "n_words", "template", diagonal.alias("diagonal"))
    return votes.agg(F.count(F.lit(1)).alias("n"), F.collect_set("at").alias("seen"))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Labels of every whole text.

    Returns ``key``; ``n_words``; ``n_base``, the places of base phrases, with ``first_word`` and
    ``last_word``, their smallest and largest start (words from 0; else null); ``base_labels`` and
    ``labels``, distinct, sorted, joined by commas; ``score``, the largest share of a template's
    grams in a span; and ``spans``, the verified ones as (label, first, last, share).
    """
    if any(len(t) != 4 or not 0 < t[1] <= 1 for t in templates):
        raise ValueError("a template is (label, share of 0 to 1, base, text)")
    spark = df.sparkSession
    sizes = positions(spark, templates).filter("template is not null").groupBy("template").agg(F.count(F.lit(1)).alias("n"))
    known = {r.template: r.n for r in sizes.collect()}  # one row per template
    if len(known) < len(templates):
        raise ValueError(f"a template needs {WINDOW} words")

    def of(template: Column, values: Sequence) -> Column:
        return F.when(template.isNotNull(), F.element_at(F.array(*map(F.lit, values)), template + 1))

    template = F.col("template")
    size = of(template, [known[i] for i in range(len(templates))])
    votes = hits(df, key, text, templates).repartition("key", "digest")
    order = Window.partitionBy("key", "digest", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT
    votes = votes.withColumn("_new", F.coalesce(apart.cast("int"), F.lit(0)))
    votes = votes.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    whole = of(template, [t[2] for t in templates]) & (F.size("seen") == size)
    merged = votes.groupBy("key", "digest", "n_words", "template", "_run").agg(
        F.sum("n").alias("n"),
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("covered"),
        F.min(F.col("diagonal") + F.array_min("seen")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("seen") + (WINDOW - 1)).alias("last"),
        F.count_if(whole).alias("places"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_place"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_place"),
    )
    label = of(template, [t[0] for t in templates])
    share = F.col("covered") / size
    short = F.col("last") - F.col("first") + 1 <= STRETCH * (size + (WINDOW - 1))
    base = of(template, [t[2] for t in templates])
    verified = F.when(base, F.col("places") > 0).otherwise((share >= of(template, [t[1] for t in templates])) & short)
    spans = merged.withColumns({"_label": F.when(verified, label), "_base": F.when(F.col("places") > 0, label), "_share": share})
    span = F.struct(F.col("_label").alias("label"), "first", "last", F.col("_share").alias("share"))
    joined = lambda labels: F.concat_ws(",", F.sort_array(F.collect_set(labels)))
    texts = spans.groupBy("key", "digest", "n_words").agg(
        F.max(F.when(template.isNull(), F.col("n"))).alias("_copies"),
        F.coalesce(F.sum(F.when(template.isNotNull(), F.col("places"))), F.lit(0)).alias("n_base"),
        F.min("first_place").cast("long").alias("first_word"),
        F.max("last_place").cast("long").alias("last_word"),
        joined("_base").alias("base_labels"),
        joined("_label").alias("labels"),
        F.coalesce(F.max("_share"), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(F.col("_label").isNotNull(), span))).alias("spans"),
    )
    copies = texts.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    return copies.select(F.col("key").alias(key), *made)
