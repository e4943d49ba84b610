"""Rollups behind the report pages, computed in Spark from the dashboard summaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelens.functions.expressions import relabel, slice_start

# Columns of the page tables, in display order.
REPO_TABLE = (
    "dt",
    "hr",
    "repo_full_name",
    "repo_name",
    "owner_login",
    "language",
    "visibility",
    "total_events",
    "push_events",
    "pull_request_events",
    "stargazers_count",
    "forks_count",
    "watchers_count",
    "avg_composite_score",
    "avg_bot_ratio",
)
ORG_TABLE = (
    "dt",
    "hr",
    "org_login",
    "org_name",
    "location",
    "company",
    "is_verified",
    "total_events",
    "push_events",
    "pull_request_events",
    "public_repos",
    "followers",
    "avg_composite_score",
    "avg_bot_ratio",
)
COMMON_TABLE = (
    "repo_full_name",
    "owner_login",
    "language",
    "repo_total_events",
    "repo_avg_composite_score",
    "stargazers_count",
    "org_name",
    "org_location",
    "org_company",
    "org_followers",
    "org_public_repos",
    "org_is_verified",
)
SCATTER = (
    "stargazers_count",
    "repo_total_events",
    "org_followers",
    "language",
    "repo_full_name",
    "org_name",
    "org_location",
    "org_company",
    "repo_avg_composite_score",
)
# Defaults for missing text, and display labels.
REPO_DEFAULTS = {"language": "Unknown", "repo_full_name": "Unknown repository"}
ORG_DEFAULTS = {
    "org_login": "Unknown organization",
    "org_name": "Unknown organization",
    "location": "Unknown",
    "company": "Unknown",
}
COMMON_DEFAULTS = {
    "repo_full_name": "Unknown repository",
    "repo_name": "Unknown repository",
    "owner_login": "Unknown owner",
    "language": "Unknown",
    "org_name": "Independent owner",
    "org_location": "Unknown",
    "org_company": "Unknown",
    "org_is_verified": False,
}
COMMON_NUMBERS = (
    "repo_total_events",
    "repo_avg_composite_score",
    "stargazers_count",
    "org_followers",
    "org_public_repos",
)
EVENT_LABELS = {"push_events": "Push Events", "pull_request_events": "Pull Request Events"}
VERIFIED_LABELS = {True: "Verified", False: "Not Verified"}
QUALITY_LABELS = {"avg_bot_ratio": "Average Bot Ratio", "avg_composite_score": "Average Composite Score"}


def _in_range(summary: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of the days from ``start`` to ``end``, both included, with the slice's time."""
    days = summary.where(F.col("dt").between(F.lit(start), F.lit(end)))
    return days.withColumn("timestamp", slice_start(F.col("dt"), F.col("hr")))


def load_repo_summary(summary: DataFrame, start: date, end: date) -> DataFrame:
    return _in_range(summary, start, end).na.fill(REPO_DEFAULTS)


def load_org_summary(summary: DataFrame, start: date, end: date) -> DataFrame:
    return _in_range(summary, start, end).na.fill(ORG_DEFAULTS)


def load_common_summary(rollup: DataFrame) -> DataFrame:
    """The rollup with text defaults, and with every number as a double, 0 if it is none."""
    filled = rollup.na.fill(COMMON_DEFAULTS)
    return filled.withColumns(
        {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in COMMON_NUMBERS}
    )


def _summed(frame: DataFrame, *keys: str, value: str = "total_events") -> DataFrame:
    """Sum per key, largest first; the keys settle ties."""
    return frame.groupBy(*keys).agg(F.sum(value).alias(value)).orderBy(F.desc(value), *keys)


def _long(timeline: DataFrame, labels: dict[str, str], name: str, value: str) -> DataFrame:
    rows = timeline.unpivot(["timestamp"], list(labels), name, value)
    return rows.withColumn(name, relabel(F.col(name), labels))


# --- repositories -------------------------------------------------------------------


def repo_table(loaded: DataFrame) -> DataFrame:
    return loaded.select(*REPO_TABLE).orderBy(F.desc("dt"), F.desc("hr"), F.desc("total_events"), "repo_full_name")


def repo_top_n(loaded: DataFrame, top_n: int = 25) -> DataFrame:
    return _summed(loaded, "repo_full_name").limit(top_n)


def repo_language(loaded: DataFrame) -> DataFrame:
    return _summed(loaded, "language")


def repo_timeline(loaded: DataFrame) -> DataFrame:
    counts = ("total_events", "push_events", "pull_request_events")
    return loaded.groupBy("timestamp").agg(*[F.sum(c).alias(c) for c in counts]).orderBy("timestamp")


def repo_push_vs_pr(loaded: DataFrame) -> DataFrame:
    return _long(repo_timeline(loaded), EVENT_LABELS, "event_type", "events")


# --- organizations ------------------------------------------------------------------


def org_table(loaded: DataFrame) -> DataFrame:
    return loaded.select(*ORG_TABLE).orderBy(F.desc("dt"), F.desc("hr"), F.desc("total_events"), "org_login")


def org_top_n(loaded: DataFrame, top_n: int = 25) -> DataFrame:
    return _summed(loaded, "org_login").limit(top_n)


def org_location(loaded: DataFrame) -> DataFrame:
    return _summed(loaded, "location")


def org_verified(loaded: DataFrame) -> DataFrame:
    """Events by verification; organizations of unknown verification are left out."""
    status: Column = relabel(F.col("is_verified"), VERIFIED_LABELS)
    labelled = loaded.withColumn("verification_status", status)
    return _summed(labelled.where(F.col("verification_status").isNotNull()), "verification_status")


def org_timeline(loaded: DataFrame) -> DataFrame:
    """Events per slice, and the plain mean of the organizations' average ratio and score."""
    return (
        loaded.groupBy("timestamp")
        .agg(F.sum("total_events").alias("total_events"), *[F.avg(c).alias(c) for c in QUALITY_LABELS])
        .orderBy("timestamp")
    )


def org_quality(loaded: DataFrame) -> DataFrame:
    return _long(org_timeline(loaded), QUALITY_LABELS, "metric", "value")


# --- repositories with their owners -------------------------------------------------


def common_table(loaded: DataFrame) -> DataFrame:
    order = [F.desc("repo_total_events"), F.desc("stargazers_count"), F.asc("repo_full_name")]
    return loaded.select(*COMMON_TABLE).orderBy(*order)


def common_location_language(loaded: DataFrame) -> DataFrame:
    return _summed(loaded, "org_location", "language", value="repo_total_events")


def common_scatter(loaded: DataFrame) -> DataFrame:
    return loaded.select(*SCATTER)
