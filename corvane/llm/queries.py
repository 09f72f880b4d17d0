"""One query for each operator of this subpackage, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import annulus as _annulus
from corvane.llm import embed_dedup as _embed
from corvane.llm import exact_dedup as _exact
from corvane.llm import imatch as _imatch
from corvane.llm import licenses as _licenses
from corvane.llm import mixing as _mixing
from corvane.llm import oracles
from corvane.llm import packing as _packing
from corvane.llm import quality as _quality
from corvane.llm import secrets as _secrets
from corvane.llm import simhash_dedup as _simhash
from corvane.llm import spelling as _spelling
from corvane.llm import token_counts as _counts
from corvane.llm import toxicity as _toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embed.embedding_dedup(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack_documents(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), 4096, 1)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact.exact_dedup(_table(spark, sf_dir, "documents"), keep="max")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _licenses.license_scan(_table(spark, sf_dir, "documents")).drop("matches")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixing.mix(_table(spark, sf_dir, "documents")).drop("copies")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.3)


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _simhash.simhash_dedup(_table(spark, sf_dir, "documents"), words=3, radius=3, seed=42).drop("kept")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _secrets.scan_secrets(_table(spark, sf_dir, "documents")).drop("found")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), 512)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imatch.document_fingerprints(_table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annulus.centroid_clusters(_table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spelling.spelling_groups(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_embedding_dedup, op2_packing, op3_exact_dedup, op4_licenses, op5_mixing, op6_toxicity, op7_quality, op8_simhash_dedup, op9_secrets, op10_token_counts, op11_fingerprints, op12_centroid_clusters, op13_spelling_groups)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_dedup": oracles.EMBEDDING_DEDUP, "op3_exact_dedup": oracles.EXACT_DEDUP, "op4_licenses": oracles.license_sql(), "op5_mixing": oracles.MIXING,
        "op9_secrets": oracles.secret_sql(), "op11_fingerprints": oracles.fingerprint_sql(), "op12_centroid_clusters": oracles.cluster_sql(), "op13_spelling_groups": oracles.spelling_sql(),
    }
