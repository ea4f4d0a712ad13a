"""Sums, exact distinct counts and lists of distinct values per group, from one scan."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tally(
    df: DataFrame, keys: Sequence[str], sums: Sequence[str], distinct: Mapping[str, str], lists: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per group of ``keys``: the ``sums``, a count of distinct values per entry of ``distinct``
    (name to column), and an array of distinct values per entry of ``lists``.

    The rows are grouped by the keys and each counted column on its own, as grouping sets, with sums
    combined before the shuffle; few values repeat often, so of columns such as a club little is left
    to shuffle. Counted values then fall together to one row per group, while listed ones stay rows,
    and only these are put into arrays. A list must be bounded by a dimension. NULL is no value; NULL
    keys are a group.
    """
    lists = dict(lists or {})
    columns = list(dict.fromkeys([*distinct.values(), *lists.values()]))
    if not columns or set(columns) & set(keys):
        raise ValueError("tally needs counted columns besides its keys")
    own = df.select(*keys, *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)], *[F.col(c).alias(f"_s{i}") for i, c in enumerate(sums)])
    values = [F.col(f"_c{i}") for i in range(len(columns))]
    groups = [F.col(k) for k in keys]
    added = [F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))]
    once = own.groupingSets([[*groups, v] for v in values], *groups, *values).agg(F.grouping_id().alias("_set"), *added)
    every = (1 << len(columns)) - 1
    sets = [every ^ (1 << (len(columns) - 1 - i)) for i in range(len(columns))]

    # Values that are listed keep their rows; the others are counted away.
    listed = [i for i, c in enumerate(columns) if c in lists.values()]
    known = F.coalesce(*[v.isNotNull() for v in values]) if len(values) == 1 else F.greatest(*[v.isNotNull() for v in values])
    fewer = once.groupBy(*keys, "_set", *[f"_c{i}" for i in listed]).agg(
        F.count_if(known).alias("_n"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))]
    )

    def of(column: str) -> Column:
        return F.col("_set") == sets[columns.index(column)]

    # Every set adds up all rows, so the sums are those of any one of them.
    totals = [F.sum(F.when(F.col("_set") == sets[0], F.col(f"_s{i}"))).alias(name) for i, name in enumerate(sums)]
    counts = [F.coalesce(F.sum(F.when(of(c), F.col("_n"))), F.lit(0)).alias(name) for name, c in distinct.items()]
    arrays = [F.sort_array(F.collect_list(F.when(of(c), F.col(f"_c{columns.index(c)}")))).alias(name) for name, c in lists.items()]
    return fewer.groupBy(*keys).agg(*totals, *counts, *arrays)
