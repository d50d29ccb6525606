"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paystrata.llm import (
    bpe, cover_dedup, decontaminate, divergence, html_text, merkle, ngram_join, pii, quality,
    secret_scan, suffix_dedup, toxicity, url_filter,
)
from paystrata.llm.oracles import ORACLES  # noqa: F401  (part of the contract)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file, which every machine has."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, folder, "documents"))


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(_table(spark, folder, "pages"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(_table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(_table(spark, folder, "documents"), vocabulary())


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(_table(spark, folder, "documents"), secret_scan.own_ledger(spark))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.judge(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.judge(_table(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_table(spark, folder, "pages"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audit(_table(spark, folder, "documents"))


def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cover_dedup.digest(_table(spark, folder, "documents"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_pii": op3_pii,
    "op4_quality_rules": op4_quality_rules,
    "op5_bpe": op5_bpe,
    "op6_secret_scan": op6_secret_scan,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_ngram_join": op9_ngram_join,
    "op10_html_extraction": op10_html_extraction,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_source_divergence": op13_source_divergence,
}
