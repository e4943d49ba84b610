"""The operators as stages of the corpus pipeline: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelens.llm import decontaminate, mixing, quality, repeats, simhash
from forgelens.llm.common import table
from forgelens.sources.staging import stage


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars, and all other columns in ``__row``, where names can't clash."""
    own = ["doc_id", "text", "n_chars"]
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(F.lit(0).alias("__"), *others).alias("__row"))


def _unpacked(packed: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from what became of ``_packed(docs)``."""
    own = {c: F.col(c) for c in ("doc_id", "text", "n_chars") if c not in changed} | changed
    return packed.select(*[own.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels, doesn't reject. Empty and null
    texts are scored like others."""
    machine = quality.train(docs, table(spark, sf_dir, "labels"))
    return _unpacked(quality.classify(_packed(docs), machine).where("predicted = 1"), docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group. Repeated rows of one id
    count as one document, of which the smallest text stays."""
    groups = simhash.near_duplicates(docs)
    first = stage(groups.where("doc_id <=> component_id").select(F.col("doc_id").alias("__id")).distinct())
    kept = docs.join(first, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    return kept


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings; characters cut in the middle go as a whole.
    ``n_chars`` follows the text where that changed. A document of which nothing is left goes,
    one that was empty or null before stays as it is."""
    cut = repeats.cut_repeats(_packed(docs).withColumn("__null", F.col("text").isNull())).where("n_bytes = 0 or n_removed < n_bytes")
    whole = F.col("kept").cast("string")
    valid = F.translate(F.make_valid_utf8(whole), "\ufffd", "")
    text = F.when(F.col("n_removed") > 0, valid).when(~F.col("__null"), whole)
    n_chars = F.when(F.col("n_removed") > 0, F.length(valid).cast("long")).otherwise(F.col("n_chars"))
    return _unpacked(cut, docs, text=text, n_chars=n_chars)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark passages; ``n_chars`` follows where that changed."""
    cut = decontaminate.cut_passages(_packed(docs).withColumn("__before", F.length("text")), table(spark, sf_dir, "benchmark"))
    n_chars = F.when(F.col("__before").eqNullSafe(F.length("text")), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return _unpacked(cut, docs, n_chars=n_chars)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with ``taken``, the words, and ``size``, all its words.
    Columns of these names are replaced."""
    mixed = mixing.mix(docs, carry=tuple(docs.columns)).where("taken > 0")
    own = [c for c in docs.columns if c not in ("size", "taken")]
    return mixed.select(*[F.col(f"row.`{c}`").alias(c) for c in own], "size", "taken")
