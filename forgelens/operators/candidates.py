"""Entities that lead on at least one metric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgelens.contracts import SLICE, Grain
from forgelens.functions.joins import join_slices
from forgelens.operators.metrics import valid_events

_BUCKETS_PER_PLACE = 4
_LOG_OF_IDS = 44.0  # above the logarithm of the largest id


def available_metrics(metrics: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted metrics that the table has."""
    present = [m for m in wanted if m in metrics.columns]
    if not present:
        raise ValueError(f"no metric to rank on: wanted {list(wanted)}, table has {metrics.columns}")
    return present


def metric_leaders(
    metrics: DataFrame,
    grain: Grain,
    top_n: int = 100,
    wanted: Sequence[str] | None = None,
    slice_cols: Sequence[str] = SLICE,
) -> DataFrame:
    """The ``top_n`` entities of every metric and slice, ties broken by the entity keys.

    All metrics are ranked in one pass over (entity, metric, value) rows, by one plan at every
    size. Values that cannot make it are dropped before they are sorted, see ``_above_floors``;
    of what is left, little more than ``top_n`` per group, Spark cuts each task's rows to
    ``top_n`` before the shuffle (WindowGroupLimit).

    ``metrics`` is read twice: pass a stored table.
    """
    names = available_metrics(metrics, wanted or grain.metrics)
    ids = [*slice_cols, *grain.keys]
    wide = valid_events(metrics, grain).selectExpr(*ids, *[f"CAST({m} AS DOUBLE) AS {m}" for m in names])
    entities = wide.select(*ids, F.array(*names).alias("_values"))
    entities = _above_floors(entities, _floors(wide, names, grain, top_n, slice_cols), grain, slice_cols)
    labels = F.array(*[F.lit(m) for m in names])
    values = (
        entities.select(*ids, F.posexplode("_values").alias("_position", "metric_value"))
        .where("metric_value IS NOT NULL")
        .select(*ids, F.get(labels, F.col("_position")).alias("selection_metric"), "metric_value")
    )
    return _leaders(values, [*slice_cols, "selection_metric"], grain, top_n)


def _place(value: str, grain: Grain) -> str:
    """SQL for a number that never rises from an entity to one ranked below it.

    A whole value is lowered by less than a half, more for higher ids, so that ties at it, such as the
    zeros and ones of rare event types, are told apart. What lies between two whole numbers is
    squeezed into the lower half and keeps its order; there, ties stay ties.
    """
    share = f"log1p(greatest({grain.id}, 0L)) / {_LOG_OF_IDS}D"
    whole = f"CAST(floor({value}) AS DOUBLE)"
    return f"CASE WHEN {value} = {whole} THEN {value} - {share} / 2 ELSE {whole} + ({value} - {whole}) / 2 END"


def _floors(wide: DataFrame, names: Sequence[str], grain: Grain, top_n: int, slice_cols: Sequence[str]) -> DataFrame:
    """Per slice, a ``_place`` for each metric that at least ``top_n`` entities reach.

    Entities are hashed into a few buckets per place to give away; the ``top_n``-th largest
    bucket maximum is reached by ``top_n`` different entities. It is null if there are not
    that many.
    """
    bucket = F.pmod(F.xxhash64(*grain.keys), F.lit(_BUCKETS_PER_PLACE * top_n)).alias("_bucket")
    maxima = wide.groupBy(*slice_cols, bucket).agg(*[F.expr(f"max({_place(m, grain)}) AS {m}") for m in names])
    nth = [F.expr(f"get(sort_array(collect_list({m}), false), {top_n - 1})") for m in names]
    return maxima.groupBy(*slice_cols).agg(F.array(*nth).alias("_floors"))


def _above_floors(entities: DataFrame, floors: DataFrame, grain: Grain, slice_cols: Sequence[str]) -> DataFrame:
    """Blank out values whose place is below the floor: they cannot be among the leaders.

    Without this, every entity would be sorted once per metric, mostly for the zeros of
    event types it never had and for the ones of those it had once.
    """
    if slice_cols:
        # One small row per slice: hashed, it needs neither the entities sorted nor a broadcast. AQE splits a large slice.
        bounded = join_slices(entities, floors.hint("shuffle_hash"), slice_cols)
    else:
        bounded = entities.select("*", floors.scalar().alias("_floors"))
    # A place is never above its value: most values fail that comparison and need no place.
    reached = F.expr(f"zip_with(_values, _floors, (v, f) -> CASE WHEN f IS NULL OR (v >= f AND {_place('v', grain)} >= f) THEN v END)")
    return bounded.withColumn("_values", reached).drop("_floors")


def _leaders(values: DataFrame, group: Sequence[str], grain: Grain, top_n: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("metric_value"), *grain.keys)
    return values.withColumn("metric_rank", F.row_number().over(order)).where(F.col("metric_rank") <= top_n)


def select_candidates(
    metrics: DataFrame,
    grain: Grain,
    top_n: int = 100,
    wanted: Sequence[str] | None = None,
    slice_cols: Sequence[str] = SLICE,
) -> DataFrame:
    """Metric rows of the leaders, each with the sorted list of metrics it leads on.

    Only keys and values go through the ranking; the wide rows join the few survivors.
    ``metrics`` is read for both, so pass a stored table.
    """
    ids = [*slice_cols, *grain.keys]
    reasons = (
        metric_leaders(metrics, grain, top_n, wanted, slice_cols)
        .groupBy(*ids)
        .agg(F.array_sort(F.collect_set("selection_metric")).alias("selection_reasons"))
    )
    return join_slices(metrics, reasons, slice_cols, grain.keys)
