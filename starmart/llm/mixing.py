"""Mixing sources to target weights by systematic sampling, with built-in functions only.

Each source has a target size; a document's expected copies are its source's target divided by
the source's size. The documents of a source are put in order of size, their expected copies are
summed up from the first on, one random offset is added, and a copy is emitted for each integer
that the sum crosses. In order of size, the words taken differ from the target by no more than
the size of the largest document, about.

The order is made for all sources at once: rows are range-partitioned by (source, size, key), so a
source with a third of all rows is spread over many tasks; a row's place in its source is its
place in the range plus what earlier ranges hold of the source.

Nulls: a null text has no words; the null source is a source of its own, last in order; null keys
come first among equals. Equal rows are taken independently, in any order among themselves. A
source without words has target 0 and nothing is taken of it. An empty table gives no rows.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import sent_if_small, word_count, written

OFFSET_BITS = 20  # of the random offset, so that sums stay exact in a double


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Target of each source. ``sizes``: one row per source with ``source``, ``source_size``.

    Sources take ``weights`` in turn, in code point order, null last. All targets add up to
    ``share`` of all sizes; none is above ``most`` times its source, and what a source cannot take
    goes to the others by weight. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    weighed = weighed.withColumn("_cap", F.lit(most) * F.col("source_size"))
    # Sources reach their cap in the order of cap per weight, so those at their cap come first.
    by_cap = Window.orderBy(F.col("_cap") / F.col("_weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    ranked = weighed.withColumns({
        "_rank": F.row_number().over(by_cap),
        "_left": F.lit(share) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_weights": F.sum("_weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)),
    }).withColumn("_each", F.col("_left") / F.col("_weights"))
    below = F.col("_each") * F.col("_weight") <= F.col("_cap")
    chosen = ranked.withColumn("_first", F.min(F.when(below, F.struct("_rank", "_each"))).over(everything))
    target = F.when(F.col("_rank") >= F.col("_first._rank"), F.col("_first._each") * F.col("_weight")).otherwise(F.col("_cap"))
    return chosen.select("source", "source_size", target.alias("target"))


def mix(
    df: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """How often the mix takes each row.

    Returns the columns named in ``keep`` (all by default) and ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken`` (copies times size), which replace columns of these names.
    Equal input and seed give equal results, however it is partitioned.
    """
    made = {"size", "source_size", "target", "copies", "taken"}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.col(f"`{source}`").cast("string").alias("source"),
        word_count(F.col(f"`{text}`").cast("string")).alias("size"),
        F.col(f"`{key}`").alias("_key"),
        F.xxhash64(F.col(f"`{text}`").cast("string")).alias("_tie"),
    )
    order = ["source", "size", "_key", "_tie"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = written(ordered.withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}), "mix")

    # One row for each source and range that it reaches into.
    parts = ordered.groupBy("source", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_from"), F.sum("size").alias("_size"))
    parts = written(parts, "mix-parts")
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    goals = targets(parts.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, share, most)
    named = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))))
    digits = OFFSET_BITS // 4
    goals = goals.withColumn("_offset", F.conv(F.substring(named, 1, digits), 16, 10).cast("double") / float(1 << OFFSET_BITS))
    goals = goals.withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    g, p = goals.alias("g"), parts.alias("p")
    parts = p.join(g, F.col("p.source").eqNullSafe(F.col("g.source"))).select(
        F.col("p.source").alias("_source"), F.col("p._range").alias("_in"), "_from", "_before", "source_size", "target", "_offset", "_rate"
    )
    placed = ordered.join(
        sent_if_small(parts), F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_in"))
    ).withColumn("_at", F.col("_place") - F.col("_from") + F.col("_before"))
    up_to = F.floor(F.col("_rate") * (F.col("_at") + 1) + F.col("_offset"))
    copies = (up_to - F.floor(F.col("_rate") * F.col("_at") + F.col("_offset"))).cast("long")
    return placed.withColumn("copies", copies).select(
        *[F.col("_row").getField(c).alias(c) for c in kept], "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def emit(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per copy, with ``columns`` only."""
    copy = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    return mixed.filter(F.col("copies") > 0).select(*columns, copy).drop("_copy")
