"""Curated marts: candidates with the attributes of their latest snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forgelens.contracts import SLICE, Grain


def latest_per_key(
    rows: DataFrame, keys: Sequence[str], newest: str = "api_fetched_at", then: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key. Equal times fall back on ``then``, highest first."""
    tie_breaks = [F.desc(c) for c in then] or [F.xxhash64(*rows.columns)]
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(newest), *tie_breaks)
    return rows.withColumn("_recency", F.row_number().over(order)).where("_recency = 1").drop("_recency")


def build_mart(
    candidates: DataFrame, snapshot: DataFrame, grain: Grain, slice_cols: Sequence[str] = SLICE
) -> DataFrame:
    """Every candidate with its snapshot, if it has one; the candidate wins on shared columns.

    Slices match where both sides carry them. Slice columns not asked for are dropped.
    """
    unused = [c for c in SLICE if c not in slice_cols]
    left = candidates.drop(*unused)
    on = [grain.id, *[c for c in slice_cols if c in left.columns and c in snapshot.columns]]
    attributes = [c for c in snapshot.columns if c not in left.columns and c not in unused]
    return left.join(snapshot.select(*on, *attributes), on, "left").select(*left.columns, *attributes)


def match_rate(candidates: DataFrame, snapshot: DataFrame, grain: Grain, slice_cols: Sequence[str] = SLICE) -> DataFrame:
    """How many candidates there are and how many of them have a snapshot."""
    on = [grain.id, *[c for c in slice_cols if c in candidates.columns and c in snapshot.columns]]
    known = snapshot.select(*on, F.lit(1).alias("_found"))
    joined = candidates.select(*on).join(known, on, "left")
    return joined.agg(F.count("*").alias("candidates"), F.count("_found").alias("matched"))


def project_contract(table: DataFrame, contract: StructType, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Exactly the contract's columns: others are dropped, missing ones become typed nulls."""
    present = set(table.columns)
    return table.selectExpr(
        *[
            f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in contract.fields
        ],
        *partition_cols,
    )
