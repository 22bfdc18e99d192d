"""Surrogate keys: assignment, the unknown member, and lookups from facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payloom.functions.text import null_name_salt

_BUCKET_HEX = 3  # 16**3 = 4096 buckets


def key_bucket(key: Column) -> Column:
    """Uniform bucket of a key; the keys are unique, so no bucket can be hot."""
    return F.substring(F.md5(key), 1, _BUCKET_HEX)


def assign_keys(new: DataFrame, current: DataFrame, key: str, sk: str) -> DataFrame:
    """Number the rows of ``new`` upward from the largest key of ``current``, without gaps.

    Rows are ranked inside 4096 hash buckets in parallel; the bucket counts, at most 4096
    rows, become offsets.  The result depends only on the key values, so a lost task
    recomputes the same numbers.  ``new`` must hold unique, non-NULL keys that
    ``current`` does not have; it is read twice, so an expensive one should be a stored
    table.
    """
    bucketed = new.withColumn("_bucket", key_bucket(F.col(key)))
    ranked = bucketed.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    )
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    start = current.select(F.coalesce(F.max(sk), F.lit(0))).scalar()
    return (
        ranked.join(F.broadcast(offsets), "_bucket")
        .withColumn(sk, (start + F.col("_offset") + F.col("_rank")).cast("bigint"))
        .drop("_bucket", "_rank", "_offset")
    )


_PERIOD_ROWS = 40  # bits for the rows of one period


def number_rows(rows: DataFrame, name: str, unique: list[str], period: str | None = None) -> DataFrame:
    """Adds 64-bit row numbers ``name`` that depend only on the rows of the same period.

    The upper bits are the days up to ``period`` (0 without one), the lower 40 count the rows
    of that period from 1, in order of a hash bucket and the columns ``unique``.  So loading
    a period again gives its rows the same numbers, and no two periods share one.  Rows are
    ranked inside 4096 buckets of each period in parallel, and prefix sums of the bucket
    sizes become offsets.  ``rows`` is read twice, so it should come from a stored table.
    """
    whole = F.xxhash64(*rows.columns)
    text = F.concat_ws("#", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in unique))
    days = F.lit(0) if period is None else F.coalesce(F.datediff(period, F.lit("0001-01-01")) + 1, F.lit(0))
    placed = rows.withColumns({"_days": days.cast("bigint"), "_bucket": key_bucket(text)})
    order = Window.partitionBy("_days", "_bucket").orderBy(*unique, whole)
    ranked = placed.withColumn("_rank", F.row_number().over(order))
    sizes = placed.groupBy("_days", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_days").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_days", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    number = F.shiftleft("_days", _PERIOD_ROWS) + F.col("_offset") + F.col("_rank")
    return ranked.join(offsets, ["_days", "_bucket"]).select(number.cast("bigint").alias(name), *rows.columns)


def with_unknown_member(dim: DataFrame, key: str, values: dict[str, object]) -> DataFrame:
    """Add the unknown member unless its key already exists."""
    spark = dim.sparkSession
    member = spark.range(0, 1, 1, 1).select(
        *(F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema)
    )
    taken = dim.where(F.col(key) == F.lit(values[key])).select(F.count(F.lit(1))).scalar()
    return dim.unionByName(member.where(taken == 0))


def lookup_surrogate_key(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str, unknown: int = 0
) -> DataFrame:
    """Left lookup of ``sk``; rows without a match, and NULL keys, point at ``unknown``.

    The dimension key is unique, so a hot fact key only makes the fact side uneven, which
    adaptive skew handling splits; NULL keys are spread beforehand.
    """
    salt = null_name_salt(F.col(fact_key), *(F.col(c) for c in facts.columns))
    keys = dim.select(F.col(dim_key).alias("_key"), F.col(sk).alias("_sk"))
    return (
        facts.withColumn("_key", salt)
        .join(keys, "_key", "left")
        .select(F.coalesce("_sk", F.lit(unknown)).alias(sk), *facts.columns)
    )


def enrich_inner(rows: DataFrame, dim: DataFrame, key: str, sk: str) -> DataFrame:
    """Inner lookup of ``sk`` by an equal key name."""
    return rows.join(dim.select(key, sk), key, "inner").select(sk, *rows.columns)
