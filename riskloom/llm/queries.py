"""Registered queries of the corpus operators; each reads whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import ann, decontam, divergence, hmm, html, licences, merkle, packing, pii, quality, secrets, simhash, suffixes
from riskloom.llm.common import table
from riskloom.llm.oracles import LLM_ORACLES as LLM_ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_skip_chain_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_digest(table(spark, folder, "documents"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_difference_cover_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents")).drop("kept")


def op5_hmm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.score(table(spark, folder, "documents"))


def op6_co_training_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_simhash_bk_trees(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_one_bit_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(table(spark, folder, "pages"))


def op10_secret_battery(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digest(table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest_digest(table(spark, folder, "documents"))


def op12_licence_index(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licence_digest(table(spark, folder, "documents"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


LLM_REGISTRY: dict[str, Query] = {
    "op1_skip_chain_pii": op1_skip_chain_pii,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_difference_cover_dedup": op4_difference_cover_dedup,
    "op5_hmm_scores": op5_hmm_scores,
    "op6_co_training_quality": op6_co_training_quality,
    "op7_simhash_bk_trees": op7_simhash_bk_trees,
    "op8_one_bit_neighbours": op8_one_bit_neighbours,
    "op9_page_text": op9_page_text,
    "op10_secret_battery": op10_secret_battery,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_licence_index": op12_licence_index,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": pipeline,
}
