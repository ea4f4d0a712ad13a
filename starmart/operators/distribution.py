"""Global order at scale: running sums, positions and medians without a one-task sort.

The rows are range-partitioned by the order columns, sorted within each range and written once with
their range and place in it; the sums of the earlier ranges become the offset of a range. The write
fixes the split, so that sums and rows see the same one. A range split samples its input first, so
the last stage upstream runs twice; earlier stages do not, as their shuffle files are there.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import cut_lineage


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    weight: Column | None = None,
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Add the running sum of ``weight`` (1 by default, giving positions 1..n) over a total order.

    ``total`` names a column for the sum over all rows.

    ``order`` must be total for the result to be repeatable; it also lets equal leading values
    fall into several ranges, so a frequent value does not end up in one task. Positions follow from
    range and place alone; sums of a weight need a window within each range.
    """
    placed = {"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    weights = {"_weight": F.lit(1).cast("long") if weight is None else weight}
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = cut_lineage(ranges.withColumns({**placed, **weights}))
    sums = ranges.groupBy("_range").agg(F.sum("_weight").alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    columns = ["_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")]
    if total:
        everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        columns.append(F.sum("_sum").over(everything).alias(total))
    offsets = sums.select(*columns)
    inside = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    within = F.col("_place") + 1 if weight is None else F.sum("_weight").over(inside)
    return (
        ranges.join(F.broadcast(offsets), "_range")  # one row per range
        .withColumn(name, F.col("_offset") + within)
        .drop("_range", "_place", "_weight", "_offset")
    )


def positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Number the rows 1..n in a total order."""
    return prefix_sums(df, order, name=name)


def exact_median(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Exact median of a numeric column per group, or of all rows without keys.

    Equal values are counted first and the middle is found by global position, so no task ever
    holds the values of a group. NULLs do not take part; the result is a double.
    """
    group = list(keys)
    counts = df.filter(F.col(column).isNotNull()).groupBy(*group, column).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumnRenamed(column, "_value")
    ordering = [F.asc_nulls_first(k) for k in group] + [F.asc("_value")]
    ranked = prefix_sums(counts, ordering, F.col("_n"), "_end", None if group else "_size")
    ranked = ranked.withColumn("_start", F.col("_end") - F.col("_n"))
    span = [F.min("_start").alias("_first"), F.sum("_n").alias("_size")]
    if group:
        spans = ranked.groupBy(*group).agg(*span)
        spans = spans.select(*[F.col(k).alias(f"_{k}") for k in group], "_first", "_size")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in group]
        ranked = ranked.join(spans, same).drop(*[f"_{k}" for k in group])
    else:
        ranked = ranked.withColumn("_first", F.lit(0))
    low = F.col("_first") + F.floor((F.col("_size") - 1) / 2)
    high = F.col("_first") + F.floor(F.col("_size") / 2)

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_start") <= place) & (place < F.col("_end")), F.col("_value").cast("double")))

    middle = ranked.filter((F.col("_start") <= high) & (F.col("_end") > low))
    medians = [((at(low) + at(high)) / 2).alias(name)]
    return middle.groupBy(*group).agg(*medians) if group else middle.agg(*medians)
