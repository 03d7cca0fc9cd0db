"""The registered queries of the training-data operators: whole tables in, whole results out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from utterloom.llm import bestfit, decontam, html_extract, license_scan, line_dedup, oracles, packing, quality, secret_scan, simhash, url_filter
from utterloom.llm.common import table


#: A parameter of the queries; the file itself stays where it is.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, longest=1024, with_ids=False)


def op2_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_lines", "n_removed", "text")


def op3_license_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_markov_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_url_segmentation_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judged(table(spark, sf_dir, "documents")).select("doc_id", *counts, "base_failed", "kept")


def op7_best_fit_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op6_quality_divergence": oracles.QUALITY, "op9_fm_index_decontamination": oracles.DECONTAMINATION}
