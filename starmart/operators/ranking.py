"""Sorting, top-k, ranks and tiles."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.distribution import prefix_sums
from starmart.session import cut_lineage

_RANKS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def order(df: DataFrame, keys: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Sort by ``(column, "asc" or "desc", "first" or "last")``; the NULL side is always explicit."""
    return df.orderBy(*[getattr(F.col(c), f"{direction}_nulls_{nulls}")() for c, direction, nulls in keys])


def top_per_group(
    df: DataFrame, partition: Sequence[str], ordering: Sequence[Column], n: int = 1, how: str = "row_number",
    name: str | None = None,
) -> DataFrame:
    """First n rows of each group; with rank or dense_rank ties are kept.

    Spark cuts every task to its own first n before the shuffle, so a large group shrinks early.
    """
    rank = name or "_rank"
    ranked = df.withColumn(rank, _RANKS[how]().over(Window.partitionBy(*partition).orderBy(*ordering)))
    ranked = ranked.filter(F.col(rank) <= n)
    return ranked if name else ranked.drop(rank)


def top_overall(
    df: DataFrame, ordering: Sequence[Column], n: int, name: str | None = None, how: str = "row_number",
    by: str | None = None,
) -> DataFrame:
    """First n rows of the whole frame, numbered in column ``name`` if given.

    ``row_number`` takes the top n first and numbers only those. ``dense_rank`` finds the first n
    distinct values of column ``by`` in ``ordering`` (which may use that column only; descending
    with NULLs last if empty) and joins them back, so any number of ties is kept without gathering
    the rows in one task. NULL counts as a value.
    """
    if how == "dense_rank":
        keys = list(ordering) or [F.desc_nulls_last(by)]
        values = df.select(by).distinct().orderBy(*keys).limit(n)
        ranked = values.withColumn(name or "_rank", F.row_number().over(Window.orderBy(*keys)))
        ranked = ranked.withColumnRenamed(by, "_value")
        kept = df.join(ranked, F.col(by).eqNullSafe(F.col("_value"))).drop("_value")
        return kept if name else kept.drop("_rank")
    first = df.orderBy(*ordering).limit(n)
    if name is None:
        return first
    return first.withColumn(name, F.row_number().over(Window.orderBy(*ordering)))


def with_ties(df: DataFrame, ordering: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of the whole frame and all that are level with the last of them.

    Every task keeps its own first n with their ties before one task joins them.
    """
    return top_per_group(df, [], ordering, n, how="rank")


def rank_columns(
    df: DataFrame, partition: Sequence[str], ranks: Mapping[str, Sequence[Column]], how: str = "dense_rank"
) -> DataFrame:
    """Several ranks within the same groups, each with its own order.

    A group is ranked by one task, so the frame should be aggregated to its entities (clubs of a
    league), as every report does.
    """
    for name, ordering in ranks.items():
        df = df.withColumn(name, _RANKS[how]().over(Window.partitionBy(*partition).orderBy(*ordering)))
    return df


def top_by_any(df: DataFrame, partition: Sequence[str], orders: Mapping[str, tuple[str, str]], n: int) -> DataFrame:
    """The rows of each group that are among the first n values in any of several orders, with all dense ranks.

    ``orders`` names each rank with its column and ``asc`` or ``desc``; NULL comes last. Every order is
    cut by itself: its different values are limited in each task before they meet, and the rows with
    one of these values are taken. Only then do the taken rows get their rank in the other orders, as
    one more than the different values before theirs, so no group is ever sorted as a whole.
    """
    keys = [f"_g{i}" for i in range(len(partition))]
    renamed = [F.col(c).alias(k) for c, k in zip(partition, keys)]
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(partition, keys)]
    values, taken = {}, df
    for name, (column, direction) in orders.items():
        order = F.asc_nulls_last("_v") if direction == "asc" else F.desc_nulls_last("_v")
        values[name] = df.select(*renamed, F.col(column).alias("_v")).distinct()
        first = top_per_group(values[name], keys, [order], n, "dense_rank", f"_r_{name}")
        taken = taken.join(first, [*same, F.col(column).eqNullSafe(F.col("_v"))], "left").drop(*keys, "_v")
    among = reduce(lambda a, b: a | b, [F.col(f"_r_{name}").isNotNull() for name in orders])
    taken = cut_lineage(taken.filter(among).drop(*[f"_r_{name}" for name in orders]))
    for name, (column, direction) in orders.items():
        own = taken.select(*[F.col(c).alias(f"_{k}") for c, k in zip(partition, keys)], F.col(column).alias("_own")).distinct()
        group = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        before = F.col("_v") < F.col("_own") if direction == "asc" else F.col("_v") > F.col("_own")
        before = F.coalesce(before, F.col("_v").isNotNull() & F.col("_own").isNull())
        ranked = values[name].join(own, group).groupBy(*[f"_{k}" for k in keys], "_own")
        ranked = ranked.agg((F.count_if(before) + 1).cast("int").alias(name))
        back = [F.col(c).eqNullSafe(F.col(f"_{k}")) for c, k in zip(partition, keys)]
        taken = taken.join(ranked, [*back, F.col(column).eqNullSafe(F.col("_own"))]).drop(*[f"_{k}" for k in keys], "_own")
    return taken


def tile_of(position: Column, total: Column, n: int) -> Column:
    """Tile 1..n of a 1-based position; the first ``total % n`` tiles hold one row more."""
    small = F.floor(total / n)
    extra = total % n
    in_large = position <= extra * (small + 1)
    return (
        F.when(in_large, F.floor((position - 1) / (small + 1)) + 1)
        .otherwise(extra + F.floor((position - 1 - extra * (small + 1)) / F.nullif(small, F.lit(0))) + 1)
        .cast("int")
    )


def tiers(df: DataFrame, ordering: Sequence[Column], n: int, name: str = "tier") -> DataFrame:
    """NTILE(n) over the whole frame in a total order, without sorting it in one task."""
    placed = prefix_sums(df, ordering, name="_position", total="_total")
    return placed.withColumn(name, tile_of(F.col("_position"), F.col("_total"), n)).drop("_position", "_total")


def extremes(df: DataFrame, column: str, n: int, key: str) -> DataFrame:
    """The n lowest and n highest rows by a column, each key once."""
    low = df.orderBy(F.asc_nulls_last(column), F.asc(key)).limit(n)
    high = df.orderBy(F.desc_nulls_last(column), F.asc(key)).limit(n)
    return low.union(high).dropDuplicates([key])


def arg_max(df: DataFrame, column: str, tie_break: str, keep: Sequence[str]) -> DataFrame:
    """The row with the highest value; the smallest ``tie_break`` among equals."""
    return df.orderBy(F.desc_nulls_last(column), F.asc(tie_break)).limit(1).select(*keep)


def best_per_group(df: DataFrame, partition: Sequence[str], ordering: Sequence[Column]) -> DataFrame:
    return top_per_group(df, partition, ordering)


def kpi_ranking(df: DataFrame, key: str, kpis: Mapping[str, bool]) -> DataFrame:
    """Rank every row on every KPI; ``True`` marks a KPI where lower is better.

    Equal values are counted first and put in a total order over all KPIs; a rank is the place of the
    first of its value less that of the first of its KPI, so no task ever ranks a whole KPI.
    """
    values = [F.col(k).cast("double").alias(k) for k in kpis]
    long = df.select(key, *values).unpivot([key], list(kpis), "kpi", "value")
    lower_better = [k for k, lower in kpis.items() if lower]
    signed = F.when(F.col("kpi").isin(lower_better), F.col("value")).otherwise(-F.col("value"))
    long = cut_lineage(long.withColumn("_signed", signed))  # used twice
    counts = long.groupBy(F.col("kpi").alias("_kpi"), F.col("_signed").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    placed = prefix_sums(counts, [F.asc("_kpi"), F.asc_nulls_last("_value")], F.col("_n"), "_end")
    placed = placed.withColumn("_start", F.col("_end") - F.col("_n"))
    starts = placed.groupBy(F.col("_kpi").alias("_of")).agg(F.min("_start").alias("_first"))
    ranked = placed.join(F.broadcast(starts), F.col("_kpi") == F.col("_of"))  # one row per KPI
    ranked = ranked.select("_kpi", "_value", (F.col("_start") - F.col("_first") + 1).cast("int").alias("kpi_rank"))
    same = (F.col("kpi") == F.col("_kpi")) & F.col("_signed").eqNullSafe(F.col("_value"))
    return long.join(ranked, same).drop("_signed", "_kpi", "_value")
