"""Metadata-service answers to snapshot, topic and error tables.

The service itself is not called here; its stored answers (``contracts.API_RESPONSE``) are
the input. ``entity`` holds a repository's full name or an organization's login.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from forgelens.contracts import ORG_SNAPSHOT, REPO, REPO_SNAPSHOT, SLICE, Grain
from forgelens.functions.expressions import parse_utc

SNAPSHOT_ROUTE, ERROR_ROUTE, FATAL_ROUTE = "snapshot", "error", "fatal"


class EnrichmentFailed(RuntimeError):
    """Some answers forbid going on with the slice."""


class RateLimited(EnrichmentFailed):
    """The service refused answers because of its rate limit."""


# Snapshot column -> path in the answer's payload.
REPO_PATHS = {
    "repo_id": "id",
    "repo_full_name": "full_name",
    "repo_name": "name",
    "owner_login": "owner.login",
    "owner_id": "owner.id",
    "owner_type": "owner.type",
    "description": "description",
    "language": "language",
    "license_spdx_id": "license.spdx_id",
    "default_branch": "default_branch",
    "visibility": "visibility",
    "is_fork": "fork",
    "is_archived": "archived",
    "is_disabled": "disabled",
    "stargazers_count": "stargazers_count",
    "forks_count": "forks_count",
    "watchers_count": "watchers_count",
    "subscribers_count": "subscribers_count",
    "open_issues_count": "open_issues_count",
    "created_at": "created_at",
    "updated_at": "updated_at",
    "pushed_at": "pushed_at",
}
ORG_PATHS = {
    "org_id": "id",
    "org_login": "login",
    "org_name": "name",
    "company": "company",
    "blog": "blog",
    "location": "location",
    "email": "email",
    "description": "description",
    "twitter_username": "twitter_username",
    "is_verified": "is_verified",
    "has_organization_projects": "has_organization_projects",
    "has_repository_projects": "has_repository_projects",
    "public_repos": "public_repos",
    "public_gists": "public_gists",
    "followers": "followers",
    "following": "following",
    "html_url": "html_url",
    "created_at": "created_at",
    "updated_at": "updated_at",
}


def _payload_schema(paths: dict[str, str], contract: StructType) -> StructType:
    """Payload type implied by the snapshot's columns; timestamps arrive as text."""
    top: dict[str, StructType | StructField] = {}
    for column, path in paths.items():
        kind = contract[column].dataType
        kind = kind if isinstance(kind, (LongType, BooleanType)) else StringType()
        head, _, leaf = path.partition(".")
        if leaf:
            top.setdefault(head, StructType()).add(leaf, kind)
        else:
            top[head] = kind
    return StructType([StructField(name, kind) for name, kind in top.items()])


REPO_PAYLOAD = _payload_schema(REPO_PATHS, REPO_SNAPSHOT)
ORG_PAYLOAD = _payload_schema(ORG_PATHS, ORG_SNAPSHOT)


def route(status: Column) -> Column:
    """Where an answer goes: found, gone, or a reason to stop."""
    return (
        F.when(status == 200, SNAPSHOT_ROUTE).when(status == 404, ERROR_ROUTE).otherwise(FATAL_ROUTE)
    )


def _routed(responses: DataFrame, target: str) -> DataFrame:
    return responses.where(route(F.col("status_code")) == target)


def snapshots(responses: DataFrame, grain: Grain) -> DataFrame:
    """Typed snapshot rows of the entities that were found."""
    repo = grain.name == REPO.name
    paths, contract = (REPO_PATHS, REPO_SNAPSHOT) if repo else (ORG_PATHS, ORG_SNAPSHOT)
    parsed = _routed(responses, SNAPSHOT_ROUTE).withColumn(
        "p", F.from_json("payload", REPO_PAYLOAD if repo else ORG_PAYLOAD)
    )

    def column(name: str) -> Column:
        value = F.col(f"p.{paths[name]}")
        is_time = contract[name].dataType.typeName() == "timestamp_ntz"
        return (parse_utc(value) if is_time else value).alias(name)

    return parsed.select(*[column(n) for n in paths], F.col("fetched_at").alias("api_fetched_at"), *SLICE)


def topics(responses: DataFrame) -> DataFrame:
    """One row per topic of a found repository."""
    wanted = StructType(
        [
            StructField("id", LongType()),
            StructField("full_name", StringType()),
            StructField("topics", ArrayType(StringType())),
        ]
    )
    parsed = _routed(responses, SNAPSHOT_ROUTE).withColumn("p", F.from_json("payload", wanted))
    return parsed.select(
        F.col("p.id").alias("repo_id"),
        F.col("p.full_name").alias("repo_full_name"),
        F.explode("p.topics").alias("topic"),
        *SLICE,
    )


def errors(responses: DataFrame, grain: Grain) -> DataFrame:
    """Entities the service no longer knows."""
    return _routed(responses, ERROR_ROUTE).select(
        F.col("entity").alias(grain.label),
        F.col("status_code").alias("error_status"),
        F.get_json_object("payload", "$.message").alias("error_message"),
        F.col("fetched_at").alias("api_fetched_at"),
        *SLICE,
    )


def require_no_fatal(responses: DataFrame, shown: int = 5) -> None:
    """Raise, before anything is written, if any answer is neither found nor gone.

    All statuses decide which error it is; ``shown`` only shortens its text.
    """
    fatal = _routed(responses, FATAL_ROUTE)
    by_status = fatal.groupBy("status_code").agg(F.count("*").alias("answers"), F.min("entity").alias("entity"))
    refused = F.col("status_code").isin(403, 429)
    total = by_status.agg(F.sum("answers").alias("answers"), F.coalesce(F.bool_or(refused), F.lit(False)).alias("refused")).first()
    if not total.answers:
        return
    worst = by_status.orderBy(F.desc("answers"), "status_code").limit(shown).collect()
    text = "; ".join(f"status {r.status_code}: {r.answers} answers, such as {r.entity}" for r in worst)
    if total.refused:
        sample = fatal.where(refused).orderBy("entity").first()
        raise RateLimited(
            f"{text}; status {sample.status_code} for {sample.entity}: remaining={sample.remaining}, "
            f"retry_after={sample.retry_after}, reset_at={sample.reset_at}"
        )
    raise EnrichmentFailed(text)


def pending(candidates: DataFrame, responses: DataFrame, grain: Grain, slice_cols: Sequence[str] = SLICE) -> DataFrame:
    """Candidates still to be asked for; only an answer of 200 settles an entity."""
    done = _routed(responses, SNAPSHOT_ROUTE).select(F.col("entity").alias(grain.label), *slice_cols)
    return unsettled(candidates, done, grain, slice_cols)


def unsettled(candidates: DataFrame, done: DataFrame, grain: Grain, slice_cols: Sequence[str] = SLICE) -> DataFrame:
    """Candidates of which ``done``, such as the stored snapshots, has no row in their slice."""
    return candidates.join(done, [grain.label, *slice_cols], "left_anti")


def owner_and_name(full_name: str = "repo_full_name") -> list[Column]:
    """Both parts of ``owner/name``; the name keeps any further slashes."""
    whole = F.col(full_name)
    owner = F.substring_index(whole, "/", 1)
    return [owner.alias("owner"), F.substr(whole, F.length(owner) + 2).alias("name")]
