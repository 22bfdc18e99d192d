"""Projections onto fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def empty(spark: SparkSession, schema: dict[str, str]) -> DataFrame:
    """No rows of a schema; Catalyst folds it to an empty local table."""
    return spark.range(0, 0, 1, 1).select(
        *(F.lit(None).cast(kind).alias(name) for name, kind in schema.items())
    )


def conform(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Exactly the columns of ``schema``, in order; missing ones are typed NULLs.

    A value that its column cannot hold stops the job: whoever expects such values casts
    them first and keeps the rejects (`decimal_or_reject`).
    """
    present = dict(df.dtypes)

    def value(name: str, kind: str) -> Column:
        if name not in present:
            return F.lit(None).cast(kind).alias(name)
        return F.col(name) if present[name] == kind else F.col(name).cast(kind).alias(name)

    return df.select(*(value(name, kind) for name, kind in schema.items()))


def add_columns(df: DataFrame, schema: dict[str, str], drop: tuple[str, ...] = ()) -> DataFrame:
    """Additive evolution: append absent columns as NULL, keep the others, drop legacy ones.

    Applying it twice gives the same columns as applying it once.
    """
    present = df.columns
    kept = [F.col(c) for c in present if c not in drop]
    new = [F.lit(None).cast(k).alias(c) for c, k in schema.items() if c not in present]
    return df.select(*kept, *new)


def rename_paths(df: DataFrame, mapping: dict[str, str], root: str | None = None) -> DataFrame:
    """Select nested paths under new flat names; NULL parents give NULL."""
    prefix = f"{root}." if root else ""
    return df.select(*(F.col(prefix + path).alias(name) for path, name in mapping.items()))


def typed(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Replace the columns named in ``rules`` in one projection."""
    return df.select(*(rules[c].alias(c) if c in rules else F.col(c) for c in df.columns))
