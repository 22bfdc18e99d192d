"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order_desc: tuple[str, ...]) -> DataFrame:
    """First row per key by ``order_desc`` descending, NULLs first.

    Ties go to the larger remaining columns.  It is a ``max`` over one struct, so every
    task reduces a hot key to one row before the shuffle; a ranking window would send
    all rows of that key to one task.
    """
    rest = [c for c in df.columns if c != key and c not in order_desc]
    rank = []
    for c in order_desc:
        rank += [F.col(c).isNull().alias(f"_null_{c}"), F.col(c)]
    best = df.groupBy(key).agg(F.max(F.struct(*rank, *rest)).alias("_best"))
    return best.select(*(F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns))


def distinct_periods(df: DataFrame, column: str = "competencia") -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()
