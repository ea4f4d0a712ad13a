"""Queries and check queries by key, as the driver calls them."""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from checks.operators import OPERATORS
from checks.reports import REPORTS
from checks.testmart import Tables, testmart

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles: the exact types stay inside the library."""
    decimals = {f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    if not decimals:
        return df
    return df.select(*[F.col(c).cast("double").alias(c) if c in decimals else F.col(c) for c in df.columns])


def _report(function, parameters, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(function(testmart(spark, sf_dir), **parameters))


def _operator(function, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(function(Tables(spark, sf_dir)))


def all_queries() -> dict[str, Query]:
    reports = {key: partial(_report, function, parameters) for key, (function, parameters, _) in REPORTS.items()}
    return {**reports, **{key: partial(_operator, function) for key, (function, _) in OPERATORS.items()}}


def all_oracles() -> dict[str, str]:
    checks = {**{key: r[2] for key, r in REPORTS.items()}, **{key: o[1] for key, o in OPERATORS.items()}}
    return {key: sql for key, sql in checks.items() if sql}
