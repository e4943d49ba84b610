"""Joins that respect slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_slices(
    left: DataFrame, right: DataFrame, slice_cols: Sequence[str], keys: Sequence[str] = (), how: str = "inner"
) -> DataFrame:
    """Equi-join within slices; rows without a slice (no timestamp) form a slice of their own."""
    on = [*slice_cols, *keys]
    theirs = right.select(*[F.col(c).alias(f"_right_{c}" if c in on else c) for c in right.columns])
    condition = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in slice_cols]
    condition += [F.col(c) == F.col(f"_right_{c}") for c in keys]
    return left.join(theirs, condition, how).drop(*[f"_right_{c}" for c in on])
