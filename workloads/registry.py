"""Query and oracle registration, table access and portable output types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf: plain(fn(spark, sf))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Output types every client prints alike: text, bigint and double."""

    def portable(name: str, kind: str):
        if kind in ("int", "smallint", "tinyint"):
            return F.col(name).cast("bigint").alias(name)
        if kind.startswith("decimal") or kind == "float":
            return F.col(name).cast("double").alias(name)
        if kind in ("date", "boolean"):
            return F.col(name).cast("string").alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        return name

    return df.select(*(portable(n, k) for n, k in df.dtypes))
