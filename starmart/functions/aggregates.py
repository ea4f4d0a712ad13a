"""Aggregate expressions that combine map-side before the shuffle."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.columns import ColumnOrName, as_column, ratio

BITMAP_IDS = 32768  # ids in one of Spark's bitmaps, which takes 4 KB
MOST_BITMAPS = 64  # of a group and column: ids to 2,097,152, 256 KB


@dataclass(frozen=True)
class Mergeable:
    """An aggregate in parts that can be merged: each part is an aggregate over rows and the one that
    merges its values; ``finish`` makes the result of all parts.

    Subtotals at several levels then follow from the groups of the finest one.
    """

    parts: tuple[tuple[Column, Callable[[Column], Column]], ...]
    finish: Callable[[Sequence[Column]], Column] = lambda values: values[0]

    def over_rows(self) -> Column:
        """The aggregate itself, over rows."""
        return self.finish([part for part, _ in self.parts])

    def over_parts(self, columns: Sequence[Column]) -> Column:
        """The aggregate over the columns of its parts."""
        return self.finish([merge(c) for (_, merge), c in zip(self.parts, columns)])


def total(column: ColumnOrName) -> Mergeable:
    return Mergeable(((F.sum(as_column(column)), F.sum),))


def number(condition: Column | None = None) -> Mergeable:
    """Rows, or those that meet a condition."""
    counted = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return Mergeable(((counted, lambda c: F.coalesce(F.sum(c), F.lit(0))),))


def lowest(column: ColumnOrName) -> Mergeable:
    return Mergeable(((F.min(as_column(column)), F.min),))


def highest(column: ColumnOrName) -> Mergeable:
    return Mergeable(((F.max(as_column(column)), F.max),))


def quotient(above: Mergeable, below: Mergeable, digits: int | None = None, factor: int = 1) -> Mergeable:
    """The ``ratio`` of two merged aggregates."""
    n = len(above.parts)
    return Mergeable((*above.parts, *below.parts), lambda v: ratio(above.finish(v[:n]), below.finish(v[n:]), digits, factor))


@dataclass(frozen=True)
class DistinctIds:
    """An exact number of different whole numbers of any span, held as words of 64 neighbours with a bit for each.

    A word is a key of the grouping, so no group, task or row holds all of a group's ids, and ids that
    lie close together take little.
    """

    column: Column

    def over_rows(self) -> Column:
        return F.countDistinct(self.column)

    def words(self, df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
        """``keys``, ``_word`` and ``_bits``: the ids of each group of rows."""
        value = self.column.cast("long")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        grouped = df.filter(value.isNotNull()).groupBy(*keys, F.shiftright(value, 6).alias("_word"))
        return grouped.agg(F.bit_or(bit).alias("_bits"))

    def counted(self) -> Column:
        """Their number, over the words of a group."""
        return F.sum(F.bit_count("_bits"))


def distinct_ids(column: ColumnOrName, most: int | None = None, least: int = 1) -> Mergeable | DistinctIds:
    """Exact number of different ids; NULL does not count.

    With ``most``, of ids from ``least`` to ``most``, by bitmaps that are united when merged: for dense
    keys of a dimension and few groups, as each group holds a bit per id. Values outside of the span
    raise. Without ``most``, of any whole numbers, by words of 64 ids that are grouped like rows.
    """
    if most is None:
        return DistinctIds(as_column(column))
    column = as_column(column).cast("long")
    bitmaps = -(-(most - least + 1) // BITMAP_IDS)
    if not 0 < bitmaps <= MOST_BITMAPS:
        raise ValueError(f"ids must span at most {MOST_BITMAPS * BITMAP_IDS}")
    outside = F.raise_error(F.lit("an id is out of its span")).cast("long")
    inside = F.when(column.between(least, most), column - (least - 1)).when(column.isNotNull(), outside)

    def bitmap(i: int) -> Column:
        return F.bitmap_construct_agg(F.when(F.bitmap_bucket_number(inside) == i + 1, F.bitmap_bit_position(inside)))

    def counted(values: Sequence[Column]) -> Column:
        counts = [F.bitmap_count(v) for v in values]
        return sum(counts[1:], counts[0])

    return Mergeable(tuple((bitmap(i), F.bitmap_or_agg) for i in range(bitmaps)), counted)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(column: ColumnOrName, condition: Column) -> Column:
    """Sum over the rows that meet the condition; NULL when none does."""
    return F.sum(F.when(condition, as_column(column)))


def avg_where(column: ColumnOrName, condition: Column) -> Column:
    """Double average over the rows that meet the condition."""
    kept = F.when(condition, as_column(column))
    return F.sum(kept).cast("double") / F.nullif(F.count(kept), F.lit(0))


def sum_case(condition: Column, column: ColumnOrName | None = None) -> Column:
    """Sum of the column, or of ones, where the condition holds and 0 elsewhere."""
    value = F.lit(1) if column is None else as_column(column)
    return F.sum(F.when(condition, value).otherwise(0))


def n_distinct(column: ColumnOrName) -> Column:
    return F.countDistinct(as_column(column))


def n_distinct_where(column: ColumnOrName, condition: Column) -> Column:
    return F.countDistinct(F.when(condition, as_column(column)))


def string_list(column: ColumnOrName, separator: str = ", ") -> Column:
    """The distinct values of a short list, sorted and joined.

    The set lives in one aggregation buffer, so it is for attributes whose number of values per
    group is bounded by a dimension (the clubs of a player, say).
    """
    return F.array_join(F.array_sort(F.collect_set(as_column(column))), separator)
