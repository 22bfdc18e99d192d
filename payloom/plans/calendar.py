"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.functions.dates import calendar_columns


def date_series(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between two date columns of ``bounds``, ends included."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("data"))


def calendar_of(days: DataFrame) -> DataFrame:
    return days.select(*calendar_columns(F.col("data")))


def dim_calendar(
    spark: SparkSession, start: str = S.CALENDAR_START, end: str = S.CALENDAR_END
) -> DataFrame:
    """Calendar between two ISO dates."""
    n_days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    days = spark.range(0, n_days, 1, 1).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("data")
    )
    return calendar_of(days)
