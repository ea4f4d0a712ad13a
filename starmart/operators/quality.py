"""Data-quality and reject reports. Each returns a DataFrame; nothing is printed or collected."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from starmart.functions import ratio
from starmart.operators.joins import counted_side, union_all


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    return union_all(
        *[
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def _orphan_rows(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """One row with the number of rows whose value, NULL included, has no parent.

    Rows are counted per value first, so only distinct values are shuffled for the join.
    """
    per_value = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    missing = per_value.join(counted_side(dim.select(F.col(key).alias("_key"))), F.col("_value") == F.col("_key"), "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))


def orphan_counts(checks: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Rows without a parent per check ``{name: (fact, column, dimension, key)}``.

    Keys are compared as values of the type both sides have in common, as ``=`` would; text that is no
    number has no parent among numbers. The checks of one fact share a scan: its rows are counted by
    each key on its own (grouping sets), and the distinct values, one column per type, meet the
    dimensions' keys in one join.
    """
    facts: dict[int, tuple[DataFrame, list]] = {}
    for name, (fact, column, dim, key) in checks.items():
        facts.setdefault(id(fact), (fact, []))[1].append((name, column, dim, key))
    parts = []
    for fact, own in facts.values():
        spark = fact.sparkSession
        kinds = [_common_type(spark, fact.schema[c].dataType, d.schema[k].dataType) for _, c, d, k in own]
        by_kind = {kind: [i for i, other in enumerate(kinds) if other == kind] for kind in kinds}
        typed = fact.select(*[F.col(c).try_cast(kind).alias(f"_k{i}") for i, ((_, c, *_), kind) in enumerate(zip(own, kinds))])
        columns = [F.col(f"_k{i}") for i in range(len(own))]
        counted = typed.groupingSets([[c] for c in columns], *columns).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"))
        # In the id of a set, the bit of its column is 0 and all others are 1; the first column has the highest.
        every = (1 << len(own)) - 1
        check = F.coalesce(*[F.when(F.col("_set") == every ^ (1 << (len(own) - 1 - i)), F.lit(name)) for i, (name, *_) in enumerate(own)])
        values = [F.coalesce(*[columns[i] for i in places]).alias(f"_v{n}") for n, places in enumerate(by_kind.values())]
        counted = counted.select(check.alias("check_name"), *values, "_n")

        def keys_of(i: int) -> DataFrame:
            name, _, dim, key = own[i]
            mine = F.col(key).try_cast(kinds[i])
            columns = [(mine if i in places else F.lit(None).cast(kind)).alias(f"_p{n}") for n, (kind, places) in enumerate(by_kind.items())]
            return dim.filter(mine.isNotNull()).select(F.lit(name).alias("_check"), *columns)

        same = F.col("check_name") == F.col("_check")
        for n in range(len(by_kind)):
            same = same & F.col(f"_v{n}").eqNullSafe(F.col(f"_p{n}"))
        keys = counted_side(union_all(*[keys_of(i) for i in range(len(own))]))
        missing = counted.join(keys, same, "left_anti")
        zeros = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(0).cast("long").alias("_n")) for name, *_ in own])
        names = spark.range(1).select(F.explode(zeros).alias("z")).select("z.*")
        parts.append(missing.select("check_name", "_n").unionByName(names))
    return union_all(*parts).groupBy("check_name").agg(F.sum("_n").alias("orphans"))


def _common_type(spark: SparkSession, one: DataType, other: DataType) -> DataType:
    """The type in which Spark compares values of two types."""
    same = spark.range(0).select(F.coalesce(F.lit(None).cast(one), F.lit(None).cast(other)).alias("same"))
    return same.schema["same"].dataType


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count of each column side by side, in one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])


def null_summary(df: DataFrame) -> DataFrame:
    """One row per column that has NULLs, with their number."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls").filter(F.col("nulls") > 0)


def null_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULL count of every column of every table, one scan per table."""
    audits = []
    for name, df in tables.items():
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        long = counts.unpivot([], df.columns, "column_name", "nulls")
        audits.append(long.select(F.lit(name).alias("table_name"), "column_name", "nulls"))
    return union_all(*audits)


def assert_no_nulls(df: DataFrame) -> None:
    """Raise if any column has a NULL."""
    found = null_summary(df).collect()  # at most one row per column
    if found:
        raise ValueError("NULLs left in " + ", ".join(f"{r.column_name} ({r.nulls})" for r in found))


def date_range(fact: DataFrame, date_key: str, dim_date: DataFrame) -> DataFrame:
    """First and last date of a fact and its number of years."""
    days = fact.select(F.col(date_key).alias("date_id")).distinct()
    return days.join(dim_date.select("date_id", "full_date", "year"), "date_id").agg(
        F.min("full_date").alias("first_date"),
        F.max("full_date").alias("last_date"),
        F.countDistinct("year").alias("years"),
    )


def fact_stats(df: DataFrame, measure: str, flags: Sequence[str], digits: int = 2) -> DataFrame:
    """Average and maximum of a measure and the number of rows per flag."""
    return df.agg(
        ratio(F.sum(measure), F.count(measure), digits).alias(f"avg_{measure}"),
        F.max(measure).alias(f"max_{measure}"),
        *[F.count_if(F.col(f)).alias(f"{f}_rows") for f in flags],
    )


def measure_totals(df: DataFrame, sums: Sequence[str], averages: Sequence[str] = ()) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(c).alias(f"total_{c}") for c in sums],
        *[ratio(F.sum(c), F.count(c)).alias(f"avg_{c}") for c in averages],
    )


def load_rate(pairs: Mapping[str, tuple[DataFrame, DataFrame]], digits: int = 1) -> DataFrame:
    """Source rows, loaded rows and percent loaded per table, plus a line ``TOTAL``."""
    counts = union_all(
        *[
            df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"
            )
            for name, pair in pairs.items()
            for side, df in zip(("source", "loaded"), pair)
        ]
    )
    source = F.sum(F.when(F.col("side") == "source", F.col("n")))
    loaded = F.sum(F.when(F.col("side") == "loaded", F.col("n")))
    return counts.rollup("table_name").agg(
        F.grouping("table_name").alias("_total"), source.alias("source_rows"), loaded.alias("loaded_rows"),
        ratio(loaded, source, digits, factor=100).alias("loaded_pct"),
    ).withColumn("table_name", F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("table_name"))).drop("_total")


def verify_derived(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows in total and, per stored column, rows that agree with the recomputed expression."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).eqNullSafe(expression)).alias(f"{c}_ok") for c, expression in rules.items()],
    )


def key_check(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and duplicated rows of a key, with the range of its first column."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.min(key[0]).alias("min_key"),
        F.max(key[0]).alias("max_key"),
        F.sum("_n").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.sum("_n") - F.count(F.lit(1))).alias("extra_rows"),
    )


def value_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), F.asc_nulls_last(column)).limit(n)


def reject_counts(
    df: DataFrame, rules: Mapping[str, Column | tuple[str, DataFrame, str]]
) -> DataFrame:
    """Rows failing each rule; a row may fail several.

    A rule is a condition, or ``(column, dimension, key)`` for a non-NULL value without a parent.
    """
    conditions = {name: rule for name, rule in rules.items() if isinstance(rule, Column)}
    parts = []
    if conditions:
        flags = df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
        parts.append(flags.unpivot([], list(conditions), "rule", "rejected"))
    for name, rule in rules.items():
        if name not in conditions:
            column, dim, key = rule
            missing = _orphan_rows(df.filter(F.col(column).isNotNull()), column, dim, key)
            parts.append(missing.select(F.lit(name).alias("rule"), F.col("orphans").alias("rejected")))
    return union_all(*parts)


def _with_validity(df: DataFrame, column: str, dim: DataFrame, key: str, flag: str) -> DataFrame:
    parents = dim.select(F.col(key).alias("_key")).dropDuplicates()
    return df.join(parents, F.col(column) == F.col("_key"), "left").withColumn(flag, F.col("_key").isNotNull()).drop("_key")


def reject_classes(df: DataFrame, first: str, second: str, dim: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """Rows with both keys valid, first invalid, second invalid and both invalid, with percent.

    As the classes overlap, shares need not add up to 100.
    """
    pairs = df.groupBy(first, second).agg(F.count(F.lit(1)).alias("_n"))
    pairs = _with_validity(pairs, first, dim, key, "_first_ok")
    pairs = _with_validity(pairs, second, dim, key, "_second_ok")
    first_ok, second_ok = F.col("_first_ok"), F.col("_second_ok")
    classes = {
        "both_valid": first_ok & second_ok,
        "first_invalid": ~first_ok,
        "second_invalid": ~second_ok,
        "both_invalid": ~first_ok & ~second_ok,
    }
    counted = pairs.agg(
        F.sum("_n").alias("_total"),
        *[F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0)).alias(name) for name, c in classes.items()],
    )
    long = counted.unpivot(["_total"], list(classes), "reject_class", "row_count")
    return long.withColumn("pct", ratio(F.col("row_count"), F.col("_total"), digits, factor=100)).drop("_total")


def reject_examples(
    df: DataFrame, rules: Mapping[str, tuple[str, DataFrame, str]], n: int, ordering: Sequence[Column],
    keep: Sequence[str],
) -> DataFrame:
    """The first n rejected rows with the reasons joined by ``AND``."""
    for name, (column, dim, key) in rules.items():
        df = _with_validity(df, column, dim, key, f"_ok_{name}")
    failed = [F.when(~F.col(f"_ok_{name}"), F.lit(name)) for name in rules]
    rejected = df.filter(reduce(lambda a, b: a | b, [~F.col(f"_ok_{name}") for name in rules]))
    reasons = rejected.withColumn("reason", F.concat_ws(" AND ", *failed))
    return reasons.orderBy(*ordering).limit(n).select(*keep, "reason")


def cascade_counts(child: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """Child rows lost with each rejected parent; counted per parent before the join."""
    per_parent = child.groupBy(key).agg(F.count(F.lit(1)).alias("lost_rows"))
    return per_parent.join(rejected.select(key), key, "left_semi")


def sentinel_audit(facts: Mapping[str, tuple[DataFrame, Sequence[str]]], sentinel: int = -1, digits: int = 1) -> DataFrame:
    """Rows on the unknown member and on real keys per foreign key, one scan per fact."""
    audits = []
    for name, (df, columns) in facts.items():
        counts = df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[F.count_if(F.col(c) == sentinel).alias(c) for c in columns],
        )
        long = counts.unpivot(["total_rows"], list(columns), "fk_column", "sentinel_rows")
        audits.append(long.select(F.lit(name).alias("table_name"), "fk_column", "sentinel_rows", "total_rows"))
    return union_all(*audits).withColumns(
        {
            "real_rows": F.col("total_rows") - F.col("sentinel_rows"),
            "unknown_pct": ratio(F.col("sentinel_rows"), F.col("total_rows"), digits, factor=100),
        }
    )


def sample_rows(df: DataFrame, condition: Column, n: int, ordering: Sequence[Column]) -> DataFrame:
    """The first n rows, in a given order, that meet a condition."""
    return df.filter(condition).orderBy(*ordering).limit(n)
