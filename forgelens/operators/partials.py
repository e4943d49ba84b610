"""Hourly partial metrics that merge exactly: sums, maxima and sets of ids.

Sums and maxima of hours add up to those of a day or of any range. Distinct counts don't, so the
hours keep the sets themselves. A set is cut into chunks of 32,768 ids: a chunk with few ids holds
their positions as an array, one with ``DENSE`` and more a bitmap of 4 KB. Chunks of several hours
are merged by uniting positions and by ``bitmap_or_agg``; a count is the sum over chunks. So a day
or the whole range is derived from its hours without an event being read again, and a late hour
costs its own events only.

No chunk is larger than 32,768 ids: an entity with a third of all events is spread over the ids it
has before its chunks are gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelens.contracts import EVENT_COUNTS, SLICE, Grain
from forgelens.operators.metrics import DISTINCT, event_code, valid_events, with_scores
from forgelens.sources.staging import stage

DENSE = 2048  # from here on a bitmap is no larger than the positions


def _sets_of(grain: Grain) -> dict[str, tuple[str, str]]:
    return {d: v for d, v in DISTINCT.items() if v[1] in grain.counts}


def hourly_sums(events: DataFrame, grain: Grain, slice_cols: Sequence[str] = SLICE) -> DataFrame:
    """The additive counts and the last event of every entity and slice."""
    codes = valid_events(events, grain).withColumn("_code", F.expr(event_code()))
    counted = {
        "total_events": "count(*)",
        "public_events_count": "count_if(is_public)",
        "bot_events": "count_if(contains(lower(actor_login), '[bot]'))",
        "merged_pr_count": "count_if(pull_request_merged)",
        **{c: f"count_if(_code = {k})" for k, c in enumerate(EVENT_COUNTS, start=1)},
    }
    return codes.groupBy(*slice_cols, *grain.keys).agg(*[F.expr(sql).alias(c) for c, sql in counted.items()], F.max("created_at").alias("last_event_at"))


def hourly_sets(events: DataFrame, grain: Grain, slice_cols: Sequence[str] = SLICE, dense: int = DENSE) -> DataFrame:
    """The ids that an entity mentions in a slice, by dimension, in chunks (dimension, chunk, positions, bits).

    Of ``positions`` and ``bits`` one is null. Null ids are no members.
    """
    keys = [*slice_cols, *grain.keys]
    ids = valid_events(events, grain).select(*keys, *[F.col(c).cast("long").alias(d) for d, (c, _) in _sets_of(grain).items()])
    members = ids.unpivot(keys, list(_sets_of(grain)), "dimension", "_id").where("_id IS NOT NULL")
    chunks = members.select(*keys, "dimension", F.expr("bitmap_bucket_number(_id)").alias("chunk"), F.expr("cast(bitmap_bit_position(_id) AS int)").alias("_at"))
    return _pack(_gathered(chunks).withColumn("bits", F.lit(None).cast("binary")), dense)


def _gathered(members: DataFrame) -> DataFrame:
    """One row for each chunk with its positions, repeated ones once."""
    keys = [c for c in members.columns if c != "_at"]
    return members.distinct().groupBy(*keys).agg(F.collect_list("_at").alias("positions"))


def _pack(chunks: DataFrame, dense: int) -> DataFrame:
    """Chunks with positions, bits or both as one of the two."""
    keys = [c for c in chunks.columns if c not in ("positions", "bits")]
    chunks = stage(chunks)
    is_dense = F.col("bits").isNotNull() | (F.size("positions") >= dense)
    small = chunks.where(~is_dense)
    listed = chunks.where(is_dense).select(*keys, F.explode("positions").alias("_at"))
    # A chunk of an entity is at most one task's work: 32,768 positions.
    made = listed.groupBy(*keys).agg(F.expr("bitmap_construct_agg(_at)").alias("bits"))
    whole = chunks.where(is_dense & F.col("bits").isNotNull()).select(*keys, "bits").unionByName(made)
    united = whole.groupBy(*keys).agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    return small.unionByName(united.withColumn("positions", F.lit(None).cast("array<int>")).select(small.columns))


def merge_sums(sums: DataFrame, grain: Grain, slice_cols: Sequence[str]) -> DataFrame:
    """Sums of coarser slices; no slice columns means one whole range."""
    added = [c for c in grain.counts if c in sums.columns]
    return sums.groupBy(*slice_cols, *grain.keys).agg(*[F.sum(c).alias(c) for c in added], F.max("last_event_at").alias("last_event_at"))


def merge_sets(sets: DataFrame, grain: Grain, slice_cols: Sequence[str], dense: int = DENSE) -> DataFrame:
    """Sets of coarser slices, in chunks again: what is merged can be merged further."""
    keys = [*slice_cols, *grain.keys, "dimension", "chunk"]
    listed = _gathered(sets.where("bits IS NULL").select(*keys, F.explode("positions").alias("_at")))
    mapped = sets.where("bits IS NOT NULL").groupBy(*keys).agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    rows = listed.withColumn("bits", F.lit(None).cast("binary")).unionByName(mapped.withColumn("positions", F.lit(None).cast("array<int>")))
    both = rows.groupBy(*keys).agg(F.first("positions", ignorenulls=True).alias("positions"), F.first("bits", ignorenulls=True).alias("bits"))
    return _pack(both, dense)


def rolled_up(sums: DataFrame, sets: DataFrame, grain: Grain, slice_cols: Sequence[str] = ()) -> DataFrame:
    """The metrics of ``slice_cols`` from partials of finer slices; the same as from their events."""
    keys = [*slice_cols, *grain.keys]
    size = F.coalesce(F.expr("bitmap_count(bits)"), F.size("positions")).cast("long")
    counts = merge_sets(sets, grain, slice_cols).groupBy(*keys).agg(*[F.sum(F.when(F.col("dimension") == d, size).otherwise(0)).alias(m) for d, (_, m) in _sets_of(grain).items()])
    added = merge_sums(sums, grain, slice_cols)
    # Both have one row for each entity: they are laid together by one aggregation, nulls in keys included.
    rows = added.unionByName(counts, allowMissingColumns=True).groupBy(*keys)
    whole = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in grain.counts], F.max("last_event_at").alias("last_event_at"))
    return with_scores(whole)
