"""The operators as queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forgelens.llm import alignment, decontaminate, language, licenses, mixing, personal, pitman_yor, quality, repair, repeats, sentences, simhash, topk
from forgelens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": lambda spark, d: topk.op1_exact_top_k(table(spark, d, "embeddings")),
    "op2_language_id": lambda spark, d: language.op2_language_id(table(spark, d, "documents")),
    "op3_simhash_near_dedup": lambda spark, d: simhash.op3_simhash_near_dedup(table(spark, d, "documents")),
    "op4_benchmark_decontamination": lambda spark, d: decontaminate.op4_benchmark_decontamination(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op5_license_scan": lambda spark, d: licenses.op5_license_scan(table(spark, d, "documents")),
    "op6_mixing_sources": lambda spark, d: mixing.op6_mixing_sources(table(spark, d, "documents")),
    "op7_suffix_array_dedup": lambda spark, d: repeats.op7_suffix_array_dedup(table(spark, d, "documents")),
    "op8_quality_classifier": lambda spark, d: quality.op8_quality_classifier(table(spark, d, "documents"), table(spark, d, "labels")),
    "op10_substring_dedup": lambda spark, d: sentences.op10_substring_dedup(table(spark, d, "documents")),
    "op11_personal_data": lambda spark, d: personal.op11_personal_data(table(spark, d, "documents")),
    "op12_conversation_repair": lambda spark, d: repair.op12_conversation_repair(table(spark, d, "conversations")),
    "op13_cross_tokenizer_alignment": lambda spark, d: alignment.op13_cross_tokenizer_alignment(table(spark, d, "documents")),
    "op9_lm_scoring": lambda spark, d: pitman_yor.op9_lm_scoring(table(spark, d, "documents")),
}

ORACLES: dict[str, str] = {
    "op1_exact_top_k": topk.OP1_SQL,
    "op5_license_scan": licenses.OP5_SQL,
    "op6_mixing_sources": mixing.OP6_SQL,
}
