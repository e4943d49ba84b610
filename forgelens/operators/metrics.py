"""Activity metrics per repository or organization, for any number of slices at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelens.contracts import EVENT_COUNTS, EVENT_RATIOS, EVENT_TYPES, SLICE, Grain
from forgelens.functions.expressions import ratio

# Sets whose size is a metric: dimension -> (event column, metric).
DISTINCT = {
    "actor": ("actor_id", "unique_actors"),
    "issue": ("issue_id", "issues_count"),
    "comment": ("comment_id", "comments_count"),
    "release": ("release_id", "releases_count"),
    "repo": ("repo_id", "repos_count"),
}
_EVENT = "event"


def valid_events(rows: DataFrame, grain: Grain) -> DataFrame:
    """Rows that name an entity of this grain; a repository name has the form owner/name."""
    named = f" AND {grain.label} LIKE '%/%'" if grain.name == "repo" else ""
    return rows.where(f"{grain.id} IS NOT NULL AND {grain.label} IS NOT NULL{named}")


def event_code(column: str = "event_type") -> str:
    """SQL for the type's position in the vocabulary, from 1; 0 for unknown or missing types."""
    vocabulary = ", ".join(f"'{t}'" for t in EVENT_TYPES)
    return f"coalesce(array_position(array({vocabulary}), {column}), 0L)"


def entity_counts(
    events: DataFrame, grain: Grain, slice_cols: Sequence[str] = SLICE, gathered: bool = False
) -> DataFrame:
    """All counts of a grain in one scan, exact distinct counts included.

    Every event is turned into one row per thing it mentions: its type, its actor, and
    where present its issue, comment, release and repository. The first aggregation, on
    (entity, dimension, member), both removes duplicates and counts, so the second one
    only adds up. An entity that holds a large part of all events is spread over its
    members in the first shuffle and is down to one row per task in the second.

    Where most entities have few events, that spreads them too, and the second aggregation would
    begin with a wide row in memory for nearly every member. ``gathered`` deals the narrow rows by
    entity before it, in pieces of the size AQE is set to: a piece holds its entities only, however
    large the table is, and a large entity is split over several pieces.
    """
    keys = [*slice_cols, *grain.keys]
    distinct = {d: v for d, v in DISTINCT.items() if d != "repo" or "repos_count" in grain.extra_counts}
    facts = valid_events(events, grain).selectExpr(
        *keys,
        "created_at",
        "is_public AS _public",
        "contains(lower(actor_login), '[bot]') AS _bot",
        "pull_request_merged AS _merged",
        f"{event_code()} AS {_EVENT}",
        *[f"CAST({column} AS BIGINT) AS {dimension}" for dimension, (column, _) in distinct.items()],
    )
    members = facts.unpivot(
        [*keys, "created_at", "_public", "_bot", "_merged"], [_EVENT, *distinct], "_dimension", "_member"
    ).where("_member IS NOT NULL")
    per_member = members.groupBy(*keys, "_dimension", "_member").agg(
        F.expr("count(*) AS _n"),
        F.expr("count_if(_public) AS _public"),
        F.expr("count_if(_bot) AS _bot"),
        F.expr("count_if(_merged) AS _merged"),
        F.expr("max(created_at) AS _last"),
    )
    if gathered:
        # Dealt by a hash that is no key of the aggregation, so that AQE may split the pieces.
        per_member = per_member.withColumn("_entity", F.xxhash64(*keys)).hint("rebalance", "_entity")

    def total(column: str, condition: str = "") -> str:
        return f"sum(CASE WHEN _dimension = '{_EVENT}' {condition} THEN {column} ELSE 0 END)"

    by_name = {
        "total_events": total("_n"),
        "public_events_count": total("_public"),
        "bot_events": total("_bot"),
        "merged_pr_count": total("_merged"),
        **{metric: f"count_if(_dimension = '{d}')" for d, (_, metric) in distinct.items()},
        **{c: total("_n", f"AND _member = {code}") for code, c in enumerate(EVENT_COUNTS, start=1)},
    }
    return per_member.groupBy(*keys).agg(
        *[F.expr(f"{by_name[name]} AS {name}") for name in grain.counts], F.expr("max(_last) AS last_event_at")
    )


def with_scores(counts: DataFrame) -> DataFrame:
    """Add the share of each event type, the composite score and the bot share."""
    push = ratio("push_events", "total_events")
    return counts.selectExpr(
        "*",
        *[f"{ratio(c, 'total_events')} AS {r}" for c, r in zip(EVENT_COUNTS, EVENT_RATIOS)],
        f"0.5D * log1p(total_events) + 0.3D * {push} + 0.2D * log1p(unique_actors) AS composite_score",
        f"{ratio('bot_events', 'total_events')} AS bot_ratio",
    )


def entity_metrics(
    events: DataFrame, grain: Grain, slice_cols: Sequence[str] = SLICE, gathered: bool = False
) -> DataFrame:
    """Counts, ratios and scores per entity and slice; no slice columns means one whole range."""
    return with_scores(entity_counts(events, grain, slice_cols, gathered))
