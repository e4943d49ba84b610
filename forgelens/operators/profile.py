"""Exploratory profiles of the event and mart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelens.contracts import EVENT_TYPES
from forgelens.functions.expressions import ratio


def event_types_present(events: DataFrame) -> DataFrame:
    """Event types in the data; types outside the vocabulary show up here."""
    return events.select("event_type").where(F.col("event_type").isNotNull()).distinct()


def event_type_pivot(events: DataFrame) -> DataFrame:
    """Events per repository and type, one column per type of the vocabulary, zero-filled."""
    return events.groupBy("repo_id").pivot("event_type", list(EVENT_TYPES)).count().na.fill(0)


def repo_actor_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("repo_id", "repo_full_name").agg(
        F.count("*").alias("total_events"),
        F.count("actor_id").alias("actors_count"),
        F.count_distinct("actor_id").alias("unique_actors"),
    )


def event_null_profile(events: DataFrame) -> DataFrame:
    """Missing keys in one row: how often each is null, and how many rows have all of them."""
    keys = ("repo_id", "repo_full_name", "org_id", "org_login")
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return events.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
        F.count_if(complete).alias("fully_keyed_rows"),
    )


def mart_repo_rollup(mart: DataFrame) -> DataFrame:
    return mart.groupBy("repo_id", "repo_full_name").agg(
        F.count("*").alias("repo_count"),
        F.sum("total_events").alias("total_events"),
        F.sum("push_events").alias("total_push_events"),
        F.sum("pull_request_events").alias("total_pull_request_events"),
        F.avg("composite_score").alias("avg_composite_score"),
    )


def distinct_repos(events: DataFrame) -> DataFrame:
    return events.select("repo_id").distinct()


def repo_bot_suffix(events: DataFrame) -> DataFrame:
    """Bot share under the narrower rule: the login ends with the bot mark."""
    bots = F.count_if(F.endswith(F.lower("actor_login"), F.lit("[bot]")))
    counts = events.groupBy("repo_id", "repo_full_name").agg(
        F.count("*").alias("events_total"), bots.alias("bot_events")
    )
    return counts.selectExpr("*", f"{ratio('bot_events', 'events_total')} AS bot_ratio")


def repo_comment_leaders(metrics: DataFrame) -> DataFrame:
    shown = ("repo_id", "repo_full_name", "issues_count", "comments_count", "releases_count", "merged_pr_count")
    return metrics.select(*shown).orderBy(F.desc("comments_count"), "repo_id", "repo_full_name")
