"""Set-based writes: each takes the current rows and a batch and returns the new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_ignore(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Append the rows of ``new`` whose key is not there yet."""
    fresh = new.join(current.select(key), key, "left_anti").select(*current.columns)
    return current.unionByName(fresh)


def upsert(current: DataFrame, batch: DataFrame, key: str, policy: dict[str, str]) -> DataFrame:
    """Updated and new rows at once, in the columns of ``current``: one full outer join by ``key``.

    A matched row keeps the old values but for the columns in ``policy``: ``overwrite`` takes
    the batch value even when it is NULL, ``coalesce`` keeps the old value when the batch has
    none.  A new row takes what the batch has and NULL elsewhere.  Keys of the batch must be
    unique and not NULL; rows of ``current`` with a NULL key are kept as they are.
    """
    old = current.select(F.lit(True).alias("_old"), *(F.col(c).alias(f"_old_{c}") for c in current.columns))
    new = batch.select(F.lit(True).alias("_new"), *(F.col(c).alias(f"_new_{c}") for c in batch.columns))

    def value(c: str, kind: str) -> Column:
        before = F.col(f"_old_{c}")
        after = F.col(f"_new_{c}").cast(kind) if c in batch.columns else F.lit(None).cast(kind)
        if c == key or policy.get(c) == "coalesce":
            # without an old row the old value is NULL
            return F.coalesce(before, after) if c == key else F.coalesce(after, before)
        if policy.get(c) == "overwrite":
            return F.when(F.col("_new"), after).otherwise(before)
        return F.when(F.col("_old"), before).otherwise(after)

    joined = old.join(new, F.col(f"_old_{key}") == F.col(f"_new_{key}"), "full")
    return joined.select(*(value(c, kind).alias(c) for c, kind in current.dtypes))


def replace_by_period(current: DataFrame, batch: DataFrame, period: str = "competencia") -> DataFrame:
    """Replace whole periods: rows of any batch period, NULL included, leave first.

    This is the pure form.  Stored facts go to a load folder instead, and a commit record
    says which load holds which period.
    """
    periods = batch.select(F.col(period).alias("_period")).distinct()
    kept = current.join(periods, F.col(period).eqNullSafe(F.col("_period")), "left_anti")
    return kept.unionByName(batch.select(*current.columns))


def has_period(batch: DataFrame, period: str = "competencia") -> bool:
    """A batch without any dated row is not loaded at all; the search ends at the first dated row."""
    return not batch.select(period).where(F.col(period).isNotNull()).isEmpty()


def update_flagged(
    current: DataFrame, flagged: DataFrame, key: str, when: Column, changes: dict[str, Column]
) -> DataFrame:
    """Set ``changes`` on rows that meet ``when`` and whose key is in ``flagged``."""
    marks = flagged.select(key).distinct().withColumn("_hit", F.lit(True))
    hit = F.col("_hit") & when
    return current.join(marks, key, "left").select(
        *(
            F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in current.columns
        )
    )
