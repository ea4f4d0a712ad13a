"""Linear trend and median thresholds of a result."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.distribution import exact_median


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x over the rows where both are known; NULL below two rows."""
    x_value, y_value = F.col(x).cast("double"), F.col(y).cast("double")
    complete = F.count(F.when(x_value.isNotNull() & y_value.isNotNull(), 1))
    return df.agg(
        F.when(complete >= 2, F.regr_slope(y_value, x_value)).alias("slope"),
        F.when(complete >= 2, F.regr_intercept(y_value, x_value)).alias("intercept"),
        complete.alias("n"),
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Median of each column as one row per column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "measure", "value")
    return exact_median(long, ["measure"], "value", "median")
