"""The queries of the numbered operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm import (
    bpe,
    hard_negatives,
    lm_scoring,
    mixing,
    near_dup,
    quality,
    token_counts,
    token_files,
    toxicity,
    url_filter,
    vector_dedup,
    vector_search,
    whitening,
)
from payloom.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_ctw_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.code_length(lm_scoring.score(table(spark, sf_dir, "documents")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.deduplicate(table(spark, sf_dir, "embeddings"))


def op8_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.deduplicate(table(spark, sf_dir, "documents"), percent=85)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.read(token_files.write(docs, vocabulary("byte_bpe_50k.json")), dict(docs.dtypes)["doc_id"])


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), lambda vec_id: vec_id % 50 == 0)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe_round_trip,
        op2_nearest_neighbours,
        op3_source_mixing,
        op4_ctw_scoring,
        op5_token_counts,
        op6_quality_classifier,
        op7_embedding_near_dup,
        op8_minhash_near_dup,
        op9_token_files,
        op10_url_filter,
        op11_hard_negatives,
        op12_embedding_whitening,
        op13_toxicity,
    )
}
