"""Constraint checks as one report ``(regra, chave, n)``; an empty report means clean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _report(df: DataFrame, rule: str | None, key: str) -> DataFrame:
    named = F.col("regra") if rule is None else F.lit(rule).alias("regra")
    return df.select(named, F.col(key).cast("string").alias("chave"), F.col("n").cast("bigint"))


def orphans(facts: DataFrame, fk: str, dim: DataFrame, pk: str, rule: str) -> DataFrame:
    """Foreign keys without a parent; counted per key first, so a hot key is one row.

    An anti join would be pushed below the count and shuffle every fact row; the outer
    join stays above it.
    """
    counted = facts.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    parents = dim.select(F.col(pk).alias("_pk"))
    found = counted.join(parents, F.col(fk) == F.col("_pk"), "left")
    return _report(found.where("_pk is null"), rule, fk)


def duplicates(df: DataFrame, key: str, rule: str) -> DataFrame:
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return _report(counted.where("n > 1"), rule, key)


def row_rules(df: DataFrame, required: dict[str, str], limits: dict[str, tuple[int, str]]) -> DataFrame:
    """Required columns and longest texts of a table, all in one scan.

    ``required`` maps a column to the rule it breaks by being NULL, ``limits`` to its longest
    text and the rule.  NULLs are counted together, long texts by text.
    """
    broken = [F.when(F.col(c).isNull(), F.struct(F.lit(rule).alias("regra"), F.lit(None).cast("string").alias("chave"))) for c, rule in required.items()]
    broken += [
        F.when(F.length(c) > most, F.struct(F.lit(rule).alias("regra"), F.col(c).cast("string").alias("chave")))
        for c, (most, rule) in limits.items()
    ]
    found = df.select(F.explode(F.array_compact(F.array(*broken))).alias("r"))
    return _report(found.groupBy("r.regra", "r.chave").agg(F.count(F.lit(1)).alias("n")), None, "chave")


def nulls(df: DataFrame, column: str, rule: str) -> DataFrame:
    return row_rules(df, {column: rule}, {})


def too_long(df: DataFrame, column: str, limit: int, rule: str) -> DataFrame:
    return row_rules(df, {}, {column: (limit, rule)})


def integrity_report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class BatchConflict(ValueError):
    """A batch breaks a key rule; nothing was published."""


def require_clean(report: DataFrame, place: str) -> None:
    """Fail before a table changes: the totals per rule, and where the whole report is stored.

    ``report`` should be a stored table, of which ``place`` is the name; rules are few.
    """
    totals = report.groupBy("regra").agg(F.count(F.lit(1)).alias("chaves")).orderBy("regra").collect()
    if totals:
        listed = "; ".join(f"{r.regra}: {r.chaves}" for r in totals)
        raise BatchConflict(f"{listed}; all keys are in {place}")
