"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssX"


def ratio(part: str, whole: str) -> str:
    """SQL for ``part / whole``, 0.0 when there is nothing to divide by."""
    return f"CASE WHEN {whole} > 0 THEN {part} / {whole} ELSE 0.0D END"


def utc(instant: Column) -> Column:
    """UTC wall clock of a zoned timestamp, whatever the session's time zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr("timestamp_ntz'1970-01-01'"))


def parse_utc(text: Column) -> Column:
    """ISO-8601 text to a UTC wall clock; text that is no timestamp becomes null.

    The fixed pattern comes first; other ISO spellings, such as fractions of a second,
    are left to Spark's own cast.
    """
    return utc(F.coalesce(F.try_to_timestamp(text, F.lit(ISO_SECONDS)), F.try_to_timestamp(text)))


def slice_start(dt: Column, hr: Column) -> Column:
    """First moment of an hourly slice."""
    return F.timestamp_add("HOUR", hr, dt.cast("timestamp_ntz"))


def bucket(value: Column, limits: Sequence[tuple[int, str]], beyond: str) -> Column:
    """Label of the first limit ``value`` does not exceed; nulls fall beyond the last one."""
    first, *rest = limits
    chain = F.when(value <= first[0], first[1])
    for limit, label in rest:
        chain = chain.when(value <= limit, label)
    return chain.otherwise(beyond)


def flag(condition: Column, yes: str, no: str) -> Column:
    """Two-way label; an unknown condition counts as ``no``."""
    return F.when(condition, yes).otherwise(no)


def relabel(value: Column, labels: Mapping[object, str]) -> Column:
    """Replace known values by their labels, everything else by null."""
    (first, label), *rest = labels.items()
    chain = F.when(value == F.lit(first), label)
    for key, text in rest:
        chain = chain.when(value == F.lit(key), text)
    return chain


def or_unknown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("Unknown")).alias(name)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, for comparing results across engines."""
    return df.selectExpr(
        *[
            f"round({f.name}, {digits}) AS {f.name}" if isinstance(f.dataType, DoubleType) else f.name
            for f in df.schema.fields
        ]
    )
