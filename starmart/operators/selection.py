"""Row selection: slice, dice and sentinel exclusion. All predicates reach the scan."""

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slice_(df: DataFrame, column: str, value) -> DataFrame:
    """Fix one dimension at one value."""
    return df.filter(F.col(column) == F.lit(value))


def dice(df: DataFrame, predicates: Mapping[str, object | Sequence | Callable[[Column], Column]]) -> DataFrame:
    """Keep the sub-cube given by a value, a list of values or a predicate per column."""
    for name, wanted in predicates.items():
        column = F.col(name)
        if callable(wanted):
            condition = wanted(column)
        elif isinstance(wanted, (list, tuple, set, frozenset)):
            condition = column.isin(list(wanted))
        else:
            condition = column == F.lit(wanted)
        df = df.filter(condition)
    return df


def any_of(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    """Keep rows that meet at least one condition."""
    return df.filter(reduce(lambda a, b: a | b, conditions))


def known(df: DataFrame, key: str, sentinel: int = -1) -> DataFrame:
    """Drop the rows that point to the unknown member."""
    return df.filter(F.col(key) != F.lit(sentinel))


def lookup_key(dim: DataFrame, column: str, pattern: str, key: str) -> Column:
    """The lowest key whose text matches, as a scalar to compare with.

    Spark runs it as one subquery, however often the returned column is used.
    """
    return dim.filter(F.col(column).ilike(pattern)).agg(F.min(key).alias(key)).scalar()
