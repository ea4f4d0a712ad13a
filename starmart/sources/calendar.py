"""Generated calendar dimension."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import date_id, season_of

# The range of the warehouse calendar.
FIRST_DATE, LAST_DATE = "2000-01-01", "2030-12-31"


def calendar_columns(days: DataFrame, column: str = "full_date") -> DataFrame:
    """The thirteen calendar attributes of each date; weekdays count from Monday = 0."""
    day = F.col(column)
    return days.select(
        date_id(day).alias("date_id"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week"),
        F.dayofyear(day).alias("day_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        season_of(day).alias("season_start_year"),
    )


def date_dimension(spark: SparkSession, start: str = FIRST_DATE, end: str = LAST_DATE) -> DataFrame:
    """One row per day of the range, both ends included."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date")
    )
    return calendar_columns(days)
