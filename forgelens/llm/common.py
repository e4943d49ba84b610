"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of(column: str) -> Column:
    """CRC-32 of an id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def held_out(column: str, parts: int, part: int) -> Column:
    """Whether the id falls into the held-out share; a null id never does."""
    return F.coalesce(crc_of(column) % parts == part, F.lit(False))


def append_columns(
    df: DataFrame,
    uses: list[str],
    adds: T.StructType,
    rows: Callable[[Iterator[pa.RecordBatch]], Iterator[list]],
) -> DataFrame:
    """``df`` with the columns ``adds``, computed in Arrow batches from the columns ``uses``.

    ``rows`` yields, for each batch, one list of arrays in the order of ``adds``. A column
    of ``df`` that has the name of an added one is replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in adds.fieldNames()]
    schema = T.StructType([*kept, *adds.fields])
    source = df.select(*[F.col(f"`{f.name}`") for f in kept], *[F.col(f"`{u}`").alias(f"__use_{i}") for i, u in enumerate(uses)])
    width, names = len(kept), [f.name for f in kept]
    new = adds.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            used = pa.RecordBatch.from_arrays(batch.columns[width:], names=uses)
            made = next(rows(iter([used])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *map(pa.array, made)], names=[*names, *new])

    return source.mapInArrow(run, schema)
