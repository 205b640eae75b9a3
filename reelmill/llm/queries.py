"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, language_id, minhash, mixing, near_vectors, quality, suffix_dedup, token_records, toxicity
from .common import table
from .lz_fingerprint import fingerprint_documents


def op1_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.classify(docs, toxicity.train(docs, labels, ["quality", "toxic"]))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return bpe.digests(table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return token_records.token_digests(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), end_id=2)


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_documents(table(spark, sf_dir, "documents"), words=2, percent=80)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_bytes(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_lz_fingerprint, op2_toxicity, op3_byte_bpe, op4_language_id, op5_near_vectors, op6_mixing, op7_minhash, op8_token_records, op9_quality, op10_suffix_dedup, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op5_near_vectors": near_vectors.ORACLE_SQL, "op6_mixing": mixing.ORACLE_SQL, "op7_minhash": minhash.oracle_sql(80)}
