"""Comparisons along time. Aggregate to one row per period first: these order the periods of a
group in one task, which suits the rows of a calendar and not those of a fact."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import ratio


def period_change(
    df: DataFrame,
    partition: Sequence[str],
    period: str,
    column: str,
    previous: str = "previous",
    change: str | None = None,
    following: str | None = None,
    digits: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Value of the previous period, change in percent and, if named, the following value.

    The previous period is the previous row, so a gap is bridged; ``strict`` compares only with
    the period exactly one before and leaves NULL otherwise.
    """
    window = Window.partitionBy(*partition).orderBy(F.asc_nulls_last(period))

    def neighbour(step, distance: int) -> Column:
        value = step(column).over(window)
        if not strict:
            return value
        return F.when(step(period).over(window) == F.col(period) + distance, value)

    result = df.withColumn(previous, neighbour(F.lag, -1))
    if following:
        result = result.withColumn(following, neighbour(F.lead, 1))
    if change:
        result = result.withColumn(
            change, ratio(F.col(column) - F.col(previous), F.col(previous), digits, factor=100)
        )
    return result


def running_total(df: DataFrame, partition: Sequence[str], period: str, column: str, name: str) -> DataFrame:
    """Sum up to and including the period; equal periods share one value."""
    window = Window.partitionBy(*partition).orderBy(F.asc_nulls_last(period))
    return df.withColumn(name, F.sum(column).over(window))


def moving_avg(
    df: DataFrame, partition: Sequence[str], period: Sequence[str], column: str, rows: int, name: str,
    digits: int | None = None,
) -> DataFrame:
    """Average over the last ``rows`` rows, the current one included."""
    window = (
        Window.partitionBy(*partition)
        .orderBy(*[F.asc_nulls_last(p) for p in period])
        .rowsBetween(1 - rows, 0)
    )
    return df.withColumn(name, ratio(F.sum(column).over(window), F.count(column).over(window), digits))


def vs_group(df: DataFrame, partition: Sequence[str], column: str, prefix: str, digits: int = 12) -> DataFrame:
    """Add ``<prefix>_avg``, ``_max``, ``_min`` of the group and ``_deviation`` from its average.

    The average is exact to ``digits``. The statistics are aggregated and joined back: a window would hold a whole group in one task.
    """
    keys = list(partition)
    stats = df.groupBy(*keys).agg(
        ratio(F.sum(column), F.count(column), digits).alias(f"{prefix}_avg"),
        F.max(column).alias(f"{prefix}_max"),
        F.min(column).alias(f"{prefix}_min"),
    )
    renamed = stats.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = df.join(renamed, same, "left").drop(*[f"_{k}" for k in keys])
    return joined.withColumn(f"{prefix}_deviation", F.col(column) - F.col(f"{prefix}_avg"))


def with_mean(df: DataFrame, partition: Sequence[str], column: str, name: str) -> DataFrame:
    """The mean of a column as a reference line, per group or over all rows."""
    if not partition:
        return df.withColumn(name, df.agg(ratio(F.sum(column), F.count(column))).scalar())
    keys = list(partition)
    means = df.groupBy(*keys).agg(ratio(F.sum(column), F.count(column)).alias(name))
    renamed = means.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(renamed, same, "left").drop(*[f"_{k}" for k in keys])
