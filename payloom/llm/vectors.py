"""Vectors as arrays: the valid rows of a table, and random directions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(v: Column) -> Column:
    """Not null, not zero, and no component that is null or not finite."""
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(ok & F.exists(v, lambda x: x != 0), F.lit(False))


def valid_rows(df: DataFrame, id_column: str, vector: str, *others: str) -> DataFrame:
    c = F.col(vector).cast("array<double>")
    return df.select(F.col(id_column).cast("long").alias("id"), c.alias("v"), *others).where(
        F.col("id").isNotNull() & valid(F.col("v"))
    )


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as a two-dimensional array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def direction(seed: int, size: int) -> np.ndarray:
    """A random direction that depends on the seed only."""
    drawn = np.random.default_rng(seed & ((1 << 63) - 1)).normal(size=size)
    return drawn / np.linalg.norm(drawn)
