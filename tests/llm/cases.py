"""Documents with every awkward case, and the driver's ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "Morning light fell over the harbour. Boats came in with the tide. Nobody spoke until noon. Then the bells rang twice. "
OTHER = "Rain kept the streets empty all week. The baker closed his shop early. A letter lay unopened on the table. "
LONG = " ".join(f"word{i % 997} stands{i % 13}" for i in range(12_000))

ROWS = [
    (1, PASSAGE + OTHER, "en", "a", 1),
    (2, PASSAGE + "Other words follow here. And some more of them.", "en", "a", 2),
    (3, PASSAGE + OTHER, "en", "b", 3),
    (3, PASSAGE + OTHER, "en", "b", 3),
    (4, None, "en", None, None),
    (5, "", None, "b", 0),
    (6, "   \n\t ", "de", "c", 6),
    (7, "Wörter über Häuser, naïve façade. 12345 67890!", "de", None, 7),
    (8, LONG, "en", "a", None),
    (9, LONG + " end.", "en", "a", 9),
    (10, "a", None, "d", 1),
    (11, "ab" * 400, "xx", "d", 800),
    (12, "ab" * 400 + "x" + "ab" * 100, "xx", "d", 1001),
    (None, PASSAGE, None, None, None),
    (13, "zero\x00byte " * 30, "en", "e", 5),
    (14, OTHER + PASSAGE.upper(), "en", "b", 4),
    (15, "Ünïcödé " * 40, "fr", "ü", 8),
]


def awkward(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def driver_rows(spark: SparkSession, table: str = "documents", sf: str = "0.001") -> DataFrame:
    return spark.read.parquet(f"/root/testdata/sf{sf}/{table}.parquet")
