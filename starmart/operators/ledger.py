"""Reject ledger of a load: rows that fail a rule are marked, counted where they are dropped, and dropped.

Each rule marks the rows that no earlier rule has marked, so every row is lost to one rule, as if the
rules were filters in that order. The marks travel with the rows to the stage that writes them, where
one observation counts all rules: no row is read again for it, and as only a job's last stage counts,
a task that has to run twice is counted once.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starmart.operators.joins import counted_side
from starmart.operators.loading import SALTS

REJECT = "_reject"
ADDED = ""  # the mark of rows that a load adds; they are kept


def reject_where(df: DataFrame, rule: str, condition: Column) -> DataFrame:
    """Mark the rows that meet a condition; NULL does not."""
    failed = F.when(condition, F.lit(rule))
    return df.withColumn(REJECT, F.coalesce(F.col(REJECT), failed) if REJECT in df.columns else failed)


def reject_missing(df: DataFrame, rule: str, columns: Sequence[str]) -> DataFrame:
    """Mark the rows with a NULL in a critical column; columns the source lacks do not count."""
    present = [F.col(c).isNull() for c in columns if c in df.columns]
    failed = present[0] if present else F.lit(False)
    for one in present[1:]:
        failed = failed | one
    return reject_where(df, rule, failed)


def reject_orphans(
    df: DataFrame, rule: str, column: str, dim: DataFrame, key: str, take: Sequence[str] = (), salts: int = SALTS
) -> DataFrame:
    """Mark the rows whose key is NULL or has no parent; ``take`` adds columns of the parent, replacing own ones.

    Rows that are marked already or have no key need no parent and may be many, so they are spread
    over ``salts`` places of the join.
    """
    df = df.drop(*take)
    skipped = F.col(column).isNull()
    if REJECT in df.columns:
        skipped = skipped | F.col(REJECT).isNotNull()
    salt = F.when(skipped, F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int") + 1).otherwise(0)
    parents = dim.select(F.col(key).alias("_key"), F.lit(0).alias("_key_salt"), *[F.col(c).alias(f"_take_{c}") for c in take])
    joined = df.withColumn("_salt", salt).join(
        counted_side(parents.dropDuplicates(["_key"]), parents), (F.col(column) == F.col("_key")) & (F.col("_salt") == F.col("_key_salt")), "left"
    )
    marked = reject_where(joined, rule, F.col("_key").isNull())
    return marked.withColumnsRenamed({f"_take_{c}": c for c in take}).drop("_key", "_key_salt", "_salt")


def accepted(df: DataFrame) -> DataFrame:
    """The rows without a mark, and those a load adds."""
    return df.filter(F.coalesce(F.col(REJECT), F.lit(ADDED)) == ADDED).drop(REJECT) if REJECT in df.columns else df


def accepted_and_counted(df: DataFrame, rules: Sequence[str]) -> tuple[DataFrame, Observation]:
    """The accepted rows, and counts that fill while these are written: ``rows``, ``added`` and one per rule.

    To be put right before the write, with no shuffle in between.
    """
    observation = Observation()
    if REJECT not in df.columns:
        df = df.withColumn(REJECT, F.lit(None).cast("string"))
    marked = {rule: F.count_if(F.col(REJECT) == rule).alias(f"rule {rule}") for rule in rules}
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REJECT) == ADDED).alias("added"), *marked.values()]
    return accepted(df.observe(observation, *counts)), observation
