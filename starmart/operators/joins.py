"""Joins between facts and dimensions, and between aggregated facts.

No table is hinted for broadcast: Spark broadcasts a side only when its size, estimated or measured
at run time, is under spark.sql.autoBroadcastJoinThreshold, and shuffles both sides otherwise. The
estimate is the size of compressed files, which can be a hundredth of the rows, and a broadcast
once planned stays; ``counted_side`` keeps sides with many rows from it.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MOST_SENT = 100_000  # rows of a side that may be broadcast where the rows are counted


def counted_side(side: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """A join side that is merged, never sent whole through the driver, if it has more than ``MOST_SENT`` rows.

    Spark decides about smaller ones. ``rows`` are counted instead of the side itself, if they are
    easier to read and at least as many; a count ends early.
    """
    few = (side if rows is None else rows).limit(MOST_SENT + 1).count() <= MOST_SENT
    return side if few else side.hint("merge")


def star_join(
    fact: DataFrame,
    dimensions: Sequence[tuple[str, DataFrame, str, Mapping[str, str]]],
    how: str = "inner",
) -> DataFrame:
    """Join a fact to dimensions and take the named attributes from each.

    Every dimension is ``(fact column, dimension, dimension key, {attribute: output name})``; one
    dimension may appear several times under different roles. Only the key and the attributes asked
    for are read from the dimension; they replace fact columns of the same name.
    """
    joined = fact
    for position, (foreign_key, dim, key, attributes) in enumerate(dimensions):
        role_key = f"_{position}_{key}"
        role = dim.select(
            F.col(key).alias(role_key),
            *[F.col(source).alias(target) for source, target in attributes.items()],
        )
        joined = joined.drop(*[c for c in attributes.values() if c != foreign_key])
        joined = joined.join(role, F.col(foreign_key) == F.col(role_key), how).drop(role_key)
    return joined


def semi(df: DataFrame, column: str, other: DataFrame, key: str) -> DataFrame:
    """Rows whose value occurs in ``other``."""
    keys = other.select(F.col(key).alias("_key"))
    return df.join(keys, F.col(column) == F.col("_key"), "left_semi")


def orphans(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose value, NULL included, has no parent."""
    keys = dim.select(F.col(key).alias("_key"))
    return df.join(keys, F.col(column) == F.col("_key"), "left_anti")


def two_perspectives(df: DataFrame, roles: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Every row once per role, in one scan: the union of several views of the same fact."""
    views = F.array(*[F.struct(*[c.alias(name) for name, c in role.items()]) for role in roles])
    return df.select(F.inline(views))


def either_role(
    df: DataFrame,
    first: str,
    second: str,
    key: str,
    keep: Sequence[str],
) -> DataFrame:
    """Rows matching ``first = k OR second = k`` for each k, as one row per key and source row.

    A join on the disjunction compares every pair of rows; this emits both keys and leaves an
    equality. ``is_first`` and ``is_second`` say which side matched; a row with equal keys
    comes out once with both set, as the disjunction would give it.
    """
    same = F.col(first) == F.col(second)
    columns = [F.col(c) for c in keep]
    as_first = F.struct(
        F.col(first).alias(key), F.lit(True).alias("is_first"), same.alias("is_second"), *columns
    )
    as_second = F.struct(
        F.col(second).alias(key), F.lit(False).alias("is_first"), F.lit(True).alias("is_second"), *columns
    )
    known_pair = F.coalesce(same, F.lit(False))
    return df.select(
        F.inline(F.when(known_pair, F.array(as_first)).otherwise(F.array(as_first, as_second)))
    ).filter(F.col(key).isNotNull())


def balance(
    first: DataFrame,
    second: DataFrame,
    on: str,
    carry: Sequence[str] = (),
    measures: Sequence[str] = (),
) -> DataFrame:
    """Full outer join of two aggregates on one key; missing measures become 0.

    NULL keys never match each other. ``carry`` columns exist on both sides and come from whichever
    has a value.
    """
    both = [on, *carry]
    left = first.select(*[F.col(c).alias(f"_l_{c}") if c in both else F.col(c) for c in first.columns])
    right = second.select(*[F.col(c).alias(f"_r_{c}") if c in both else F.col(c) for c in second.columns])
    joined = left.join(right, F.col(f"_l_{on}") == F.col(f"_r_{on}"), "full")
    others = [c for c in [*first.columns, *second.columns] if c not in both]
    return joined.select(
        *[F.coalesce(f"_l_{c}", f"_r_{c}").alias(c) for c in both],
        *[F.coalesce(c, F.lit(0)).alias(c) if c in measures else F.col(c) for c in others],
    )


def drill_across(
    aggregates: Sequence[DataFrame], on: Sequence[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join facts that are already aggregated to the same conformed keys.

    ``null_safe`` (inner and left joins) also joins groups whose key is NULL.
    """
    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        if not null_safe:
            return a.join(b, list(on), how)
        renamed = b.withColumnsRenamed({k: f"_b_{k}" for k in on})
        same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in on]
        return a.join(renamed, same, how).drop(*[f"_b_{k}" for k in on])

    return reduce(join, aggregates)


def child_counts(
    parent: DataFrame, child: DataFrame, on: str, conditions: Mapping[str, Column]
) -> DataFrame:
    """Add counts of child rows per condition, 0 without children.

    The children are counted per key before the join, so parents are never multiplied.
    """
    counts = child.groupBy(on).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    joined = parent.join(counts, on, "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(0)) for name in conditions})


def restrict_to_top(df: DataFrame, ranked: DataFrame, key: str, n: int, order: Sequence[Column]) -> DataFrame:
    """Rows of ``df`` whose key is among the first n of ``ranked``, with the ranked attributes."""
    return df.join(ranked.orderBy(*order).limit(n), key)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
