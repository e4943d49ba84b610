"""Corpus preparation: reject by quality, keep one of each near-duplicate group, cut repeated
byte strings, cut benchmark passages, mix sources.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run``
writes each result as Parquet below spark.checkpoint.dir and reads it for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgelens.llm import pipeline_stages as stages
from forgelens.llm.common import table
from forgelens.sources.staging import stage

STAGES = [
    ("quality classifier", stages.keep_good),
    ("SimHash near-dedup", stages.keep_one_of_each_group),
    ("suffix-array dedup", stages.cut_repeated_strings),
    ("benchmark decontamination", stages.cut_benchmark_passages),
    ("mixing sources to target weights", stages.mix_sources),
]

# The classifier, the byte-level matching and the index searches have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
