"""Small helpers shared by the operators: inputs, bounded batches, components."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payloom.session import settle

#: Bytes of one Arrow batch that a Python task holds at a time.
BATCH_BYTES = 8 * 1024 * 1024

#: White space of the word rules: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def fold(c: Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % divisor


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    context = spark.sparkContext
    if not any(name.startswith("payloom-package") for name in map(os.path.basename, context._python_includes)):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(), "payloom-package")
        context.addPyFile(shutil.make_archive(base, "zip", root, "payloom"))


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, so long rows never pile up in a worker."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(work, schema)


def whole_groups(batches: Iterator[pa.RecordBatch], at_least: int) -> Iterator[pa.Table]:
    """Rows sorted by their first column, in tables of some ``at_least`` rows that split no group."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= at_least:
            rows = pa.Table.from_batches(held)
            key = rows.column(0).to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield rows.slice(0, cut).combine_chunks()
                held, n = rows.slice(cut).to_batches(), rows.num_rows - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def in_pairs_of_parts(df: DataFrame, n: Column, most: int, member: Column) -> DataFrame:
    """Split groups of more than ``most`` rows: adds ``lo``, ``hi`` and ``part``.

    A group of ``n`` rows becomes parts of about ``most`` rows, and every pair of parts meets
    in one task ``(lo, hi)``; inside it only rows of different parts are to be compared,
    unless ``lo = hi``.  So every pair of the group is met exactly once, in bounded tasks.
    """
    parts = F.greatest(F.lit(1), F.ceil(n / most)).cast("int")
    dealt = df.withColumn("_parts", parts).withColumn("part", F.pmod(F.xxhash64(member), F.col("_parts")).cast("int"))
    dealt = dealt.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return dealt.select(
        *df.columns, "part", F.least("part", "_with").alias("lo"), F.greatest("part", "_with").alias("hi")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, component)``, the smallest node id.

    Every round each node points at its smallest neighbour or itself, and the edges are
    rewritten by that pointer until none is left.  Minima are combined before the shuffle,
    so a node with very many neighbours is no hot task; each round is written to the
    shared folder, which also cuts the lineage.
    """
    edges = settle(edges.where("a != b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        points = settle(points.select("node", F.least("node", "low").alias("to")), "points")
        if labels is None:
            labels = points.select("node", F.col("to").alias("component"))
        else:
            onward = points.select(F.col("node").alias("component"), "to")
            labels = labels.join(onward, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
        labels = settle(labels, "labels")
        pa_, pb = (points.select(F.col("node").alias(c), F.col("to").alias(f"{c}2")) for c in ("a", "b"))
        moved = edges.join(pa_, "a").join(pb, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        edges = settle(moved.where("a != b").distinct(), "edges")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
