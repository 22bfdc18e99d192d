"""From documents to token ids: quality filter, near-duplicates, source mix, BPE.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
gives the next stage's documents, which are written as Parquet and read again, so a lost
executor never costs more than the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payloom.llm import bpe, mixing, near_dup, quality
from payloom.llm.common import table
from payloom.llm.queries import vocabulary
from payloom.session import settle


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of this input."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate group (similarity 0.8 or more)."""
    return near_dup.distinct_documents(docs, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mixed(docs)


def bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and digests of ids and decoded text."""
    return bpe.digests(docs, vocabulary("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("bpe_ids", bpe_ids),
]

#: A trained classifier and BPE merges cannot be said in SQL; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
