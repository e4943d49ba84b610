"""Scans of the landing zone and of slice-partitioned tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forgelens.contracts import CORRUPT, RAW_EVENT, SLICE
from forgelens.functions.expressions import slice_start
from forgelens.sources.staging import children, day_dir, slice_dir


def read_raw_events(
    spark: SparkSession, paths: str | Sequence[str], base_path: str | None = None, spread: bool = False
) -> DataFrame:
    """Newline-delimited JSON, plain or gzip, against the fixed raw schema.

    A gzip file is one task however large it is; ``spread`` redistributes the parsed rows, for
    work on them that doesn't shuffle by itself. ``base_path`` keeps ``dt=/hr=``
    directory names as columns when single directories are listed.
    """
    reader = spark.read.schema(RAW_EVENT).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if base_path:
        reader = reader.option("basePath", base_path)
    raw = reader.json(paths if isinstance(paths, str) else list(paths))
    raw = raw.withColumn("source_file", F.col("_metadata.file_path"))
    return raw.hint("rebalance") if spread else raw


# Up to this many days the driver lists each day's hours itself. Of more it names the days
# only, and Spark lists them, in tasks.
_DAYS_LISTED = 32


def slice_paths(spark: SparkSession, root: str, slices: Iterable[tuple[date, int]]) -> list[str]:
    """Directories that hold all given slices there are: of hours, or of whole days if there are many.

    One storage call tells the days of the table and one each the hours of a few days; the
    number of calls doesn't grow with the slices.
    """
    hours_by_day: dict[date, set[int]] = {}
    for day, hour in slices:
        hours_by_day.setdefault(day, set()).add(hour)
    days = _days(spark, root)
    wanted = sorted(hours_by_day.keys() & days)
    if len(wanted) > _DAYS_LISTED:
        return [day_dir(root, day) for day in wanted]
    present = {day: children(spark, day_dir(root, day)) for day in wanted}
    return [slice_dir(root, day, hour) for day in wanted for hour in sorted(hours_by_day[day]) if f"hr={hour}" in present[day]]


def _days(spark: SparkSession, root: str) -> set[date]:
    """Days that a ``dt=`` table has a directory for."""
    return {date.fromisoformat(name[3:]) for name in children(spark, root) if name.startswith("dt=") and name[3:4].isdigit()}


def read_slices(
    spark: SparkSession, root: str, slices: Iterable[tuple[date, int]] | None = None, schema: StructType | None = None
) -> DataFrame:
    """A ``dt=/hr=`` table, or the given slices of it.

    Their directories are named, so a long history is not listed for a few of its slices;
    those that don't exist are empty. ``schema`` is that of a table without any of them.
    """
    if slices is None:
        return spark.read.parquet(root)
    slices = list(slices)
    return _read_paths(spark, root, slice_paths(spark, root, slices), schema).where(in_slices(slices))


def read_days(spark: SparkSession, root: str, start: date, end: date, schema: StructType | None = None) -> DataFrame:
    """The days from ``start`` to ``end`` of a ``dt=/hr=`` table, both included.

    Only their directories are listed, whatever the length of the history.
    """
    days = sorted(d for d in _days(spark, root) if start <= d <= end)
    return _read_paths(spark, root, [day_dir(root, d) for d in days], schema).where(F.col("dt").between(F.lit(start), F.lit(end)))


def _read_paths(spark: SparkSession, root: str, paths: list[str], schema: StructType | None) -> DataFrame:
    if not paths:
        return spark.read.parquet(root).where(F.lit(False)) if schema is None else spark.createDataFrame([], schema)
    return spark.read.option("basePath", root).parquet(*paths)


def in_slices(slices: Iterable[tuple[date, int]]) -> Column:
    """Predicate on the partition columns for a list of slices, grouped by day."""
    hours_by_day: dict[date, set[int]] = {}
    for day, hour in slices:
        hours_by_day.setdefault(day, set()).add(hour)
    if not hours_by_day:
        return F.lit(False)
    # Days that ask for the same hours share one term: a long run of whole days stays short.
    days_by_hours: dict[frozenset[int], list[date]] = {}
    for day, hours in hours_by_day.items():
        days_by_hours.setdefault(frozenset(hours), []).append(day)
    predicate = None
    for hours, days in days_by_hours.items():
        term = F.col("dt").isin(days) & F.col("hr").isin(sorted(hours))
        predicate = term if predicate is None else predicate | term
    return predicate


def slice_calendar(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """Every hourly slice from ``start`` to ``end``, both included, without listing storage."""
    bounds = spark.range(1).select(F.lit(start).cast("timestamp_ntz").alias("first"), F.lit(end).cast("timestamp_ntz").alias("last"))
    return _hours(bounds)


def calendar_of(table: DataFrame) -> DataFrame:
    """Every hourly slice between the first and the last one present in ``table``."""
    start = slice_start(F.col("dt"), F.col("hr"))
    return _hours(table.agg(F.min(start).alias("first"), F.max(start).alias("last")))


def _hours(bounds: DataFrame) -> DataFrame:
    hours = bounds.select(F.explode(F.expr("sequence(first, last, interval 1 hour)")).alias("hour"))
    return hours.select(F.col("hour").cast("date").alias(SLICE[0]), F.hour("hour").cast("int").alias(SLICE[1]))
