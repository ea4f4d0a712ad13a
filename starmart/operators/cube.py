"""Grouping: aggregate, roll up, cube, grouping sets, pivot, drill down, shares."""

from collections.abc import Collection, Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import BITMAP_IDS, MOST_BITMAPS, DistinctIds, Mergeable, distinct_ids, n_distinct

Aggregates = Mapping[str, Column | Mergeable | DistinctIds]


def _named(aggs: Aggregates) -> list[Column]:
    return [(a.over_rows() if isinstance(a, (Mergeable, DistinctIds)) else a).alias(name) for name, a in aggs.items()]


def _beside(keys: Sequence[str], frames: Sequence[DataFrame], counts: Collection[str]) -> DataFrame:
    """Frames with a row per group of ``keys`` and columns of their own as one; absent ``counts`` are 0.

    The groups are put under each other and grouped, so many of them are no matter for a join side.
    """
    both = frames[0]
    for frame in frames[1:]:
        both = both.unionByName(frame, allowMissingColumns=True)
    values = {c: F.any_value(c, True) for c in both.columns if c not in keys}
    return both.groupBy(*keys).agg(*[(F.coalesce(v, F.lit(0)) if c in counts else v).alias(c) for c, v in values.items()])


def finest(df: DataFrame, keys: Sequence[str | Column], aggs: Aggregates) -> tuple[DataFrame, dict[str, Column]]:
    """The groups of ``keys`` with the parts of mergeable aggregates, and what merges them.

    Subtotals over these groups read each row once, where grouping sets over rows repeat every row
    for every set. Without any mergeable aggregate, the rows as they are; aggregates of both kinds
    mix only if the plain ones are about the grouping itself (``grouping``, ``grouping_id``).
    """
    own = {name: a for name, a in aggs.items() if isinstance(a, Mergeable)}
    if not own:
        return df, dict(aggs)
    parts = {name: [f"_{name}_{i}" for i in range(len(a.parts))] for name, a in own.items()}
    columns = [part.alias(n) for name, a in own.items() for (part, _), n in zip(a.parts, parts[name])]
    grouped = df.groupBy(*keys).agg(*columns) if keys else df.agg(*columns)
    return grouped, {name: a.over_parts([F.col(n) for n in parts[name]]) if name in own else a for name, a in aggs.items()}


def _of_any_span(aggs: Aggregates) -> dict[str, DistinctIds]:
    return {name: a for name, a in aggs.items() if isinstance(a, DistinctIds)}


def aggregate(
    df: DataFrame, keys: Sequence[str | Column], aggs: Aggregates, having: Column | None = None
) -> DataFrame:
    """Group by ``keys`` (none for one total row), aggregate, and keep groups that meet ``having``."""
    result = df.groupBy(*keys).agg(*_named(aggs)) if keys else df.agg(*_named(aggs))
    return result if having is None else result.filter(having)


def roll_up(df: DataFrame, levels: Sequence[str], aggs: Aggregates, fixed: Sequence[str] = ()) -> DataFrame:
    """Subtotals from the finest level up to the total; ``fixed`` keys stay in every level."""
    sets = [[*levels[:n], *fixed] for n in range(len(levels), -1, -1)]
    if fixed or _of_any_span(aggs):
        return grouping_sets(df, sets, aggs)
    df, merged = finest(df, levels, aggs)
    return df.rollup(*levels).agg(*_named(merged))


def cube(df: DataFrame, keys: Sequence[str], aggs: Aggregates) -> DataFrame:
    """Subtotals for every subset of the keys."""
    if _of_any_span(aggs):
        return grouping_sets(df, [s for n in range(len(keys), -1, -1) for s in combinations(keys, n)], aggs)
    df, merged = finest(df, keys, aggs)
    return df.cube(*keys).agg(*_named(merged))


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], aggs: Aggregates) -> DataFrame:
    """Subtotals for the listed key sets, from one scan, and one more for each :class:`DistinctIds`."""
    keys = list(dict.fromkeys(k for one in sets for k in one))
    own = _of_any_span(aggs)
    if not own:
        df, merged = finest(df, keys, aggs)
        return df.groupingSets([[F.col(k) for k in one] for one in sets], *[F.col(k) for k in keys]).agg(*_named(merged))

    # The grouping's number tells subtotals from groups whose key is NULL.
    rest = {name: a for name, a in aggs.items() if name not in own}
    level = {"_level": F.grouping_id(*[F.col(k) for k in keys])} if keys else {"_level": F.lit(0)}
    frames = [grouping_sets(df, sets, {**rest, **{n: F.max(c) if not keys else c for n, c in level.items()}})]
    for name, ids in own.items():
        words = ids.words(df, keys)
        if keys:
            every = [F.col(k) for k in (*keys, "_word")]
            words = words.groupingSets([[F.col(k) for k in (*one, "_word")] for one in sets], *every)
            # The word is in every set, so its bit, the last one, is 0.
            words = words.agg(F.shiftright(F.grouping_id(*every), 1).alias("_level"), F.bit_or("_bits").alias("_bits"))
        else:
            words = words.withColumn("_level", F.lit(0))
        frames.append(words.groupBy(*keys, "_level").agg(ids.counted().alias(name)))
    return _beside([*keys, "_level"], frames, own).select(*keys, *aggs)


def level_label(column: str, total: str, text: Column | None = None) -> Column:
    """The key of a detail row, or ``total`` where the key is summed over.

    Uses the grouping flag, so a real NULL key is not mistaken for a subtotal. Valid inside ``agg``
    of a roll-up, cube or grouping sets.
    """
    return F.when(F.grouping(column) == 1, F.lit(total)).otherwise(F.col(column) if text is None else text)


def pivot(
    df: DataFrame,
    rows: Sequence[str],
    column: str,
    values: Mapping[object, str],
    cell: str | Column | None = None,
    total: str | None = None,
    counted: bool = False,
) -> DataFrame:
    """Turn the listed values of one column into columns, in one aggregation.

    Cells are sums of ``cell``, or row counts with ``counted``. ``values`` maps each value to its
    column name; ``total`` adds the row total over all values, listed or not.
    """
    cell = F.lit(1) if counted else (F.col(cell) if isinstance(cell, str) else cell)
    one = F.count if counted else F.sum
    aggs = {name: one(F.when(F.col(column) == F.lit(value), cell)) for value, name in values.items()}
    if total:
        aggs[total] = one(cell)
    return aggregate(df, rows, aggs)


def pivot_matrix(df: DataFrame, row: str, column: str, value: Column | str, columns: Mapping[str, str]) -> DataFrame:
    """One value per (row, column) laid out as a matrix; ``columns`` gives order and names."""
    value = F.col(value) if isinstance(value, str) else value
    return aggregate(
        df, [row], {name: F.max(F.when(F.col(column) == F.lit(key), value)) for key, name in columns.items()}
    )


def drill_down(
    df: DataFrame, hierarchy: Sequence[str], path: Sequence, aggs: Aggregates, having: Column | None = None
) -> DataFrame:
    """Aggregate one level below a position in a hierarchy.

    ``path`` fixes the upper levels: with hierarchy (year, quarter, month), an empty path lists
    years, ``(2023,)`` the quarters of 2023, ``(2023, 1)`` the months of its first quarter.
    """
    if len(path) >= len(hierarchy):
        raise ValueError("the path already reaches the lowest level")
    for level, value in zip(hierarchy, path):
        df = df.filter(F.col(level) == F.lit(value))
    return aggregate(df, hierarchy[: len(path) + 1], aggs, having)


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], aggs: Aggregates | None = None) -> DataFrame:
    """Exact distinct counts of several columns per group, with further aggregates; no row is repeated for it.

    Columns of whole numbers that span at most some two million, such as keys of a dimension, are
    counted by bitmaps, in one pass with ``aggs``. A look at the smallest and largest values decides.
    Whole numbers of a larger span are counted by words of 64 ids and other columns by Spark's distinct
    aggregate, each from a pass of its own over the column: beside it, every different value would
    be a group that holds all bitmaps.
    """
    whole = [c for c in dict.fromkeys(columns.values()) if df.schema[c].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")]
    spans = df.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in whole]).first() if whole else {}
    bounded = [c for c in whole if spans[c].low is not None and spans[c].high - spans[c].low < MOST_BITMAPS * BITMAP_IDS]
    near = {name: distinct_ids(c, spans[c].high, spans[c].low) for name, c in columns.items() if c in bounded}
    far = {name: c for name, c in columns.items() if c not in bounded}
    names = [*columns, *[n for n in aggs or {} if n not in columns]]
    if not far:
        return aggregate(df, keys, {**near, **(aggs or {})}).select(*keys, *names)
    first = {**near, **(aggs or {})} or {"_rows": F.count(F.lit(1))}
    frames = [aggregate(df, keys, first)]
    for name, c in far.items():
        if c in whole:
            ids = distinct_ids(c)
            frames.append(aggregate(ids.words(df, keys), keys, {name: ids.counted()}))
        else:
            frames.append(aggregate(df, keys, {name: n_distinct(c)}))
    return _beside(keys, frames, columns).select(*keys, *names)


def share_of_total(df: DataFrame, column: str, name: str, digits: int | None = None) -> DataFrame:
    """Percentage of each row in the column total; the total is one scalar subquery, not a join."""
    from starmart.functions import ratio

    total = df.agg(F.sum(column).alias("_total")).scalar()
    return df.withColumn(name, ratio(F.col(column), total, digits, factor=100))
