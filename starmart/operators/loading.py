"""Steps that turn source rows into dimension and fact rows."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.functions import date_in, to_date_lenient
from starmart.operators.distribution import positions
from starmart.operators.joins import counted_side
from starmart.schemas import NULL_DEFAULTS, SENTINEL, TEXT_DEFAULTS
from starmart.session import cut_lineage

PIECE_ROWS = 1 << 20  # positions numbered by one task
SALTS = 64  # tasks that rows without a match are spread over, unless told otherwise


def select_available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def first_available(df: DataFrame, names: Sequence[str]) -> Column | None:
    """The first of several alternative source columns that exists, or None."""
    return next((F.col(n) for n in names if n in df.columns), None)


def detect_date_formats(df: DataFrame, columns: Sequence[str], formats: Sequence[str], rows: int | None = None) -> dict[str, str]:
    """The format of each text column that is not in ISO dates, if one of ``formats`` parses more of it.

    One pass counts what each format parses, in all rows, or in a sample of about ``rows``; the first
    listed wins ties.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return {}
    if rows is not None:
        total = df.count()
        df = df.sample(min(1.0, rows / total), 0) if total > rows else df
    counts = [F.count(to_date_lenient(c)).alias(f"{i} ") for i, c in enumerate(columns)]
    counts += [F.count(date_in(c, f)).alias(f"{i} {f}") for i, c in enumerate(columns) for f in formats]
    found = df.agg(*counts).first()
    best = {c: max(["", *formats], key=lambda f: found[f"{i} {f}"]) for i, c in enumerate(columns)}
    return {c: f for c, f in best.items() if f}


def iso_dates(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Texts in a column's own format as ISO dates; other text stays as it is."""
    return df.withColumns({c: F.coalesce(date_in(c, f).cast("string"), F.col(c)) for c, f in formats.items()}) if formats else df


def truncate_text(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Cut texts to a length per column; NULL stays NULL."""
    return df.withColumns({c: F.substring(c, 1, n) for c, n in limits.items() if c in df.columns})


def dedupe(df: DataFrame, key: Sequence[str], ordering: Sequence[Column]) -> DataFrame:
    """First row per key. Every task keeps at most one row of a key before the shuffle."""
    window = Window.partitionBy(*key).orderBy(*ordering)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in a critical column."""
    return df.dropna(subset=[c for c in columns if c in df.columns])


def apply_null_rules(df: DataFrame, rules: Mapping[str, Sequence[str]], is_dimension: bool) -> DataFrame:
    """Replace NULLs by the default of each column's category, in one projection."""
    defaults = {**NULL_DEFAULTS, "text": TEXT_DEFAULTS[is_dimension]}
    types = dict(df.dtypes)
    filled = {
        column: F.coalesce(F.col(column), F.lit(defaults[category]).cast(types[column]))
        for category, columns in rules.items()
        for column in columns
        if column in types
    }
    return df.withColumns(filled) if filled else df


def filter_fk(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Keep rows whose required key has a parent."""
    keys = dim.select(F.col(key).alias("_key"))
    return df.join(counted_side(keys), F.col(column) == F.col("_key"), "left_semi")


def redirect_fk(
    df: DataFrame, column: str, dim: DataFrame, key: str, sentinel: int = SENTINEL, salts: int = SALTS
) -> DataFrame:
    """Point an optional key without a parent to the unknown member; NULL stays NULL.

    Rows that are NULL or already redirected can be most of a table and need no match, so they are
    spread over ``salts`` places of the join by a hash of the row instead of meeting in one task.
    """
    keys = dim.select(F.col(key).alias("_key"), F.lit(0).alias("_key_salt"))
    parents = counted_side(keys.dropDuplicates(["_key"]), keys)
    unmatched = F.col(column).isNull() | (F.col(column) == sentinel)
    salt = F.when(unmatched, F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int") + 1).otherwise(0)
    joined = df.withColumn("_salt", salt).join(
        parents, (F.col(column) == F.col("_key")) & (F.col("_salt") == F.col("_key_salt")), "left"
    )
    target = (
        F.when(F.col(column).isNull(), F.col(column))
        .when(F.col("_key").isNull(), F.lit(sentinel).cast(df.schema[column].dataType))
        .otherwise(F.col(column))
    )
    return joined.withColumn(column, target).drop("_key", "_key_salt", "_salt")


def widen_by_role(
    df: DataFrame, key: str, role: str, value: str, roles: Mapping[str, str]
) -> DataFrame:
    """One row per key with the value of each role as a column; roles are trimmed before comparing."""
    return df.groupBy(key).agg(
        *[F.max(F.when(F.trim(role) == name, F.col(value))).alias(target) for name, target in roles.items()]
    )


def enrich(
    df: DataFrame, other: DataFrame, on: Sequence[str], columns: Sequence[str], ordering: Sequence[Column]
) -> DataFrame:
    """Add columns of a second fact; its first row per key is taken, so rows never multiply."""
    first = dedupe(other, on, ordering).select(*on, *columns)
    return df.join(counted_side(first, other), list(on), "left")


def lookup(df: DataFrame, dim: DataFrame, on: str, columns: Sequence[str], required: bool = False) -> DataFrame:
    """Take columns from a dimension, replacing source columns of the same name.

    With ``required``, rows without a parent go, as in :func:`filter_fk`; one join does both.
    """
    return df.drop(*columns).join(counted_side(dim.select(on, *columns)), on, "inner" if required else "left")


def derive_outcome(df: DataFrame, home: str, away: str) -> DataFrame:
    """Difference, total and the three outcome flags; a flag is false when a side is unknown."""
    difference = F.col(home) - F.col(away)
    return df.withColumns(
        {
            "goal_difference": difference,
            "total_goals": F.col(home) + F.col(away),
            "is_home_win": F.coalesce(difference > 0, F.lit(False)),
            "is_draw": F.coalesce(difference == 0, F.lit(False)),
            "is_away_win": F.coalesce(difference < 0, F.lit(False)),
        }
    )


def add_unknown_member(df: DataFrame, key: str, row: Mapping[str, object]) -> DataFrame:
    """Add the unknown-member row unless its key is already present; ``df`` is evaluated once."""
    values = {c: F.lit(row[c]).cast(t).alias(c) for c, t in df.dtypes if c in row}
    missing = [c for c in df.columns if c not in values]
    if missing:
        raise ValueError(f"the unknown member has no value for {missing}")
    one = df.sparkSession.range(1).select(*[values[c] for c in df.columns])
    both = df.withColumn("_added", F.lit(0)).unionByName(one.withColumn("_added", F.lit(1)))
    first = F.min("_added").over(Window.partitionBy(key))
    return both.withColumn("_first", first).filter(F.col("_added") == F.col("_first")).drop("_added", "_first")


def with_file_order_key(df: DataFrame, name: str, place: str) -> DataFrame:
    """Dense key 1..n in the order of ``place``: a position in source files (see ``source_order``) or a number.

    Rows are written once, as they are read more than once; see :func:`file_order_key`.
    """
    return file_order_key(cut_lineage(df), name, place)


def file_order_key(df: DataFrame, name: str, place: str, part: int = 0, parts: int = 1) -> DataFrame:
    """The key of :func:`with_file_order_key` for written rows, or for those of one of ``parts``.

    Positions name the piece of the source that a row is from, so no range split has to be found:
    each piece of at most ``PIECE_ROWS`` positions is numbered by itself, and what earlier pieces hold
    is added. Whole pieces are dealt to the parts.
    """
    piece = [f"{place}.file", f"{place}.block"] if isinstance(df.schema[place].dataType, StructType) else []
    row = F.col(f"{place}.row") if piece else F.col(place)
    names = [f"_piece_{i}" for i in range(len(piece) + 1)]
    columns = {**{n: F.col(c) for n, c in zip(names, piece)}, names[-1]: F.floor(row / PIECE_ROWS)}
    rows = df.withColumns(columns)
    counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)  # one row per piece
    offsets = counts.select(*names, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    if parts > 1:
        rows = rows.filter(F.pmod(F.xxhash64(*names), F.lit(parts)) == part)
    inside = F.row_number().over(Window.partitionBy(*names).orderBy(place))
    return rows.withColumn(name, inside).join(offsets, names).withColumn(name, F.col("_offset") + F.col(name)).drop(*names, "_offset")


def with_surrogate_key(df: DataFrame, name: str, ordering: Sequence[Column]) -> DataFrame:
    """Dense key 1..n in a total order, numbered range by range."""
    return positions(df, ordering, name)


