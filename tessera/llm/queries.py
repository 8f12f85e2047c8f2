"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontamination, near_duplicates, packing, periodic_runs, privacy, quality, repeats, secrets, sharding, token_counts, toxicity,
               url_filter, whitening)
from .common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_hashed_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_previous_factor_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(table(spark, sf_dir, "documents"))


def op4_disclosure_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.personal_data(table(spark, sf_dir, "documents")).drop("actions")


def op5_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op7_pack_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_url_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op9_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op11_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_bounded_load_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rule=periodic_runs.repeat_tails)


def queries() -> dict[str, QueryFn]:
    found = (op1_token_counts, op2_hashed_ngram_quality, op3_previous_factor_repeats, op4_disclosure_privacy, op5_simhash_decontamination,
             op6_weighted_minhash, op7_pack_sum_of_squares, op8_url_language_model, op9_noisy_channel_toxicity, op10_secret_forest,
             op11_jacobi_davidson_whitening, op12_bounded_load_ring, op13_periodic_runs)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """None of these methods has an SQL form (tokenizers, trained models, hashes, classes); see tests/llm."""
    return {}
