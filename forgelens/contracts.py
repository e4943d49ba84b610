"""Column contracts: event vocabulary, entity grains, table schemas, metric lists."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

SLICE = ("dt", "hr")

# The event types that get their own count and ratio column.
EVENT_TYPES = (
    "CommitCommentEvent",
    "CreateEvent",
    "DeleteEvent",
    "DiscussionEvent",
    "ForkEvent",
    "GollumEvent",
    "IssueCommentEvent",
    "IssuesEvent",
    "MemberEvent",
    "PublicEvent",
    "PullRequestEvent",
    "PullRequestReviewCommentEvent",
    "PullRequestReviewEvent",
    "PushEvent",
    "ReleaseEvent",
    "WatchEvent",
)

# Counts every entity has, whatever its event types are.
BASE_COUNTS = (
    "total_events",
    "public_events_count",
    "unique_actors",
    "bot_events",
    "issues_count",
    "comments_count",
    "releases_count",
    "merged_pr_count",
)


def event_column(event_type: str) -> str:
    """Count column of an event type: ``IssuesEvent`` -> ``issues_events``."""
    words = re.findall(r"[A-Z][^A-Z]*|^[^A-Z]+", event_type)
    return "_".join(words).lower() + "s"


EVENT_COUNTS = tuple(event_column(t) for t in EVENT_TYPES)
EVENT_RATIOS = tuple(f"{c}_ratio" for c in EVENT_COUNTS)
SCORES = ("composite_score", "bot_ratio")


@dataclass(frozen=True)
class Grain:
    """An entity level: its identifier, its display name, and what is ranked on it."""

    name: str
    id: str
    label: str
    extra_counts: tuple[str, ...] = ()

    @property
    def keys(self) -> tuple[str, str]:
        return (self.id, self.label)

    @property
    def counts(self) -> tuple[str, ...]:
        return BASE_COUNTS + EVENT_COUNTS + self.extra_counts

    @property
    def metrics(self) -> tuple[str, ...]:
        return self.counts + EVENT_RATIOS + SCORES


REPO = Grain("repo", "repo_id", "repo_full_name")
ORG = Grain("org", "org_id", "org_login", extra_counts=("repos_count",))

# Warehouse layout: buckets of the curated tables.
BUCKETS = {"repo": 16, "org": 8}


def _fields(data_type: DataType, *names: str) -> list[StructField]:
    return [StructField(n, data_type) for n in names]


def _struct(*groups: list[StructField]) -> StructType:
    return StructType([f for g in groups for f in g])


_L, _I, _D, _S, _B = LongType(), IntegerType(), DoubleType(), StringType(), BooleanType()
_T, _DT = TimestampNTZType(), DateType()
_SLICE_FIELDS = [StructField("dt", _DT), StructField("hr", _I)]

# Raw archive line. Scalars are read as text and converted with try_cast, so a value of
# an unexpected kind becomes null instead of spoiling the whole line.
CORRUPT = "_corrupt_record"
RAW_EVENT = _struct(
    _fields(_S, "id", "type", "created_at", "public"),
    [
        StructField("repo", _struct(_fields(_S, "id", "name"))),
        StructField("actor", _struct(_fields(_S, "id", "login"))),
        StructField("org", _struct(_fields(_S, "id", "login", "url", "avatar_url"))),
        StructField(
            "payload",
            _struct(
                _fields(_S, "action", "ref_type"),
                [
                    StructField("pull_request", _struct(_fields(_S, "id", "merged"))),
                    StructField("issue", _struct(_fields(_S, "id"))),
                    StructField("comment", _struct(_fields(_S, "id"))),
                    StructField("release", _struct(_fields(_S, "id"))),
                    StructField("member", _struct(_fields(_S, "id"))),
                ],
            ),
        ),
    ],
    _fields(_S, CORRUPT),
)

# Timestamps are UTC wall-clock values (timestamp_ntz), so no result depends on the
# time zone of the session that reads them.
EVENTS_FLAT = _struct(
    _fields(_L, "event_id"),
    _fields(_S, "event_type"),
    _fields(_T, "created_at"),
    _fields(_L, "repo_id"),
    _fields(_S, "repo_full_name"),
    _fields(_L, "actor_id"),
    _fields(_S, "actor_login"),
    _fields(_L, "org_id"),
    _fields(_S, "org_login", "org_url", "org_avatar_url"),
    _fields(_B, "is_public"),
    _fields(_S, "payload_action", "payload_ref_type"),
    _fields(_L, "pull_request_id"),
    _fields(_B, "pull_request_merged"),
    _fields(_L, "issue_id", "comment_id", "release_id", "member_id"),
    _fields(_T, "ingestion_ts"),
    _fields(_S, "source_file"),
)

REPO_SNAPSHOT = _struct(
    _fields(_L, "repo_id"),
    _fields(_S, "repo_full_name", "repo_name", "owner_login"),
    _fields(_L, "owner_id"),
    _fields(_S, "owner_type", "description", "language", "license_spdx_id", "default_branch", "visibility"),
    _fields(_B, "is_fork", "is_archived", "is_disabled"),
    _fields(_L, "stargazers_count", "forks_count", "watchers_count", "subscribers_count", "open_issues_count"),
    _fields(_T, "created_at", "updated_at", "pushed_at", "api_fetched_at"),
    _SLICE_FIELDS,
)

ORG_SNAPSHOT = _struct(
    _fields(_L, "org_id"),
    _fields(_S, "org_login", "org_name", "company", "blog", "location", "email", "description", "twitter_username"),
    _fields(_B, "is_verified", "has_organization_projects", "has_repository_projects"),
    _fields(_L, "public_repos", "public_gists", "followers", "following"),
    _fields(_S, "html_url"),
    _fields(_T, "created_at", "updated_at", "api_fetched_at"),
    _SLICE_FIELDS,
)

SNAPSHOT = {"repo": REPO_SNAPSHOT, "org": ORG_SNAPSHOT}

# Answer of the metadata service for one entity in one slice. ``entity`` is the
# repository's full name or the organization's login.
API_RESPONSE = _struct(
    _fields(_S, "entity"),
    _fields(_I, "status_code"),
    _fields(_S, "payload"),
    _fields(_T, "fetched_at"),
    _fields(_S, "retry_after", "reset_at", "remaining"),
    _SLICE_FIELDS,
)


def metrics_schema(grain: Grain) -> StructType:
    """Metrics of one entity; candidates add ``selection_reasons``."""
    return _struct(
        [StructField(grain.id, _L), StructField(grain.label, _S)],
        _fields(_L, *grain.counts),
        _fields(_T, "last_event_at"),
        _fields(_D, *EVENT_RATIOS, *SCORES),
    )


def in_slice(schema: StructType) -> StructType:
    """The stored form of a table: its columns and the slice."""
    return _struct(list(schema.fields), _SLICE_FIELDS)


def candidates_schema(grain: Grain) -> StructType:
    return in_slice(_struct(list(metrics_schema(grain).fields), [StructField("selection_reasons", ArrayType(_S))]))


def mart_schema(grain: Grain) -> StructType:
    """Curated table without its partition columns: metrics, reasons, snapshot attributes.

    The two bookkeeping strings at the end are part of the published table contract. The
    loader that filled them is not built here, so they are always null.
    """
    metrics = metrics_schema(grain)
    known = {*metrics.names, *SLICE}
    return _struct(
        list(metrics.fields),
        [StructField("selection_reasons", ArrayType(_S))],
        [f for f in SNAPSHOT[grain.name].fields if f.name not in known],
        _fields(_S, "_dlt_load_id", "_dlt_id"),
    )


# Columns of the published dashboard tables.
DASHBOARDS = {
    "repositories/summary": _struct(
        _fields(_L, "repo_id"),
        _fields(_S, "repo_full_name", "repo_name", "owner_login", "owner_type", "language", "visibility"),
        _fields(_B, "is_fork", "is_archived", "is_disabled"),
        _fields(
            _L,
            "stargazers_count",
            "forks_count",
            "watchers_count",
            "subscribers_count",
            "open_issues_count",
            "total_events",
            "push_events",
            "pull_request_events",
            "issue_comment_events",
            "fork_events",
        ),
        _fields(_D, "avg_composite_score", "avg_bot_ratio"),
        _SLICE_FIELDS,
    ),
    "repositories/language": _struct(
        _fields(_S, "language"),
        _fields(_L, "repo_count", "total_events"),
        _fields(_D, "avg_composite_score"),
        _fields(_L, "total_stargazers"),
        _SLICE_FIELDS,
    ),
    "repositories/owner": _struct(
        _fields(_S, "owner_type"),
        _fields(_L, "repo_count", "total_events"),
        _fields(_D, "avg_composite_score"),
        _SLICE_FIELDS,
    ),
    "repositories/visibility": _struct(
        _fields(_S, "visibility"),
        _fields(_L, "repo_count", "total_events"),
        _SLICE_FIELDS,
    ),
    "repositories/fork": _struct(
        _fields(_S, "fork_status"),
        _fields(_L, "repo_count", "total_events"),
        _fields(_D, "avg_composite_score"),
        _SLICE_FIELDS,
    ),
    "repositories/freshness": _struct(
        _fields(_S, "freshness_bucket"),
        _fields(_L, "repo_count", "total_events"),
        _SLICE_FIELDS,
    ),
    "repositories/event_type": _struct(
        _fields(_S, "event_type"),
        _fields(_L, "event_count"),
        _SLICE_FIELDS,
    ),
    "repositories/top_100": _struct(
        _fields(_L, "repo_id"),
        _fields(_S, "repo_full_name", "owner_login", "language"),
        _fields(_L, "total_events", "unique_actors"),
        _fields(_D, "composite_score"),
        _fields(_L, "stargazers_count", "forks_count"),
        _SLICE_FIELDS,
    ),
    "organizations/summary": _struct(
        _fields(_L, "org_id"),
        _fields(_S, "org_login", "org_name", "location", "company", "blog", "email", "twitter_username"),
        _fields(_B, "is_verified", "has_organization_projects", "has_repository_projects"),
        _fields(
            _L,
            "public_repos",
            "public_gists",
            "followers",
            "following",
            "total_events",
            "push_events",
            "pull_request_events",
        ),
        _fields(_D, "avg_composite_score", "avg_bot_ratio"),
        _SLICE_FIELDS,
    ),
    "organizations/company": _struct(
        _fields(_S, "company"),
        _fields(_L, "org_count", "total_events"),
        _SLICE_FIELDS,
    ),
    "organizations/location": _struct(
        _fields(_S, "location"),
        _fields(_L, "org_count", "total_events"),
        _fields(_D, "avg_followers"),
        _SLICE_FIELDS,
    ),
    "organizations/size": _struct(
        _fields(_S, "size_bucket"),
        _fields(_L, "org_count", "total_events"),
        _fields(_D, "avg_followers"),
        _SLICE_FIELDS,
    ),
    "organizations/social": _struct(
        _fields(_S, "twitter_status", "blog_status", "email_status"),
        _fields(_L, "org_count"),
        _SLICE_FIELDS,
    ),
    "organizations/verified_distribution": _struct(
        _fields(_S, "verification_status"),
        _fields(_L, "org_count", "total_events"),
        _fields(_D, "avg_composite_score"),
        _SLICE_FIELDS,
    ),
    "organizations/top_100": _struct(
        _fields(_L, "org_id"),
        _fields(_S, "org_login", "org_name", "location"),
        _fields(_L, "public_repos", "followers", "repos_count", "total_events"),
        _fields(_D, "composite_score"),
        _SLICE_FIELDS,
    ),
    "common/summary": _struct(
        _fields(_L, "repo_id"),
        _fields(_S, "repo_full_name", "repo_name", "owner_login", "language"),
        _fields(_L, "repo_total_events"),
        _fields(_D, "repo_avg_composite_score"),
        _fields(_L, "stargazers_count", "org_id"),
        _fields(_S, "org_name", "org_location", "org_company"),
        _fields(_L, "org_followers", "org_public_repos"),
        _fields(_B, "org_is_verified"),
        _SLICE_FIELDS,
    ),
    "common/language_location": _struct(
        _fields(_S, "language", "org_location"),
        _fields(_L, "repo_count", "total_events"),
        _SLICE_FIELDS,
    ),
    "common/verified": _struct(
        _fields(_S, "verification_status"),
        _fields(_L, "repo_count", "total_events"),
        _fields(_D, "avg_repo_score"),
        _SLICE_FIELDS,
    ),
}


def require_contract(table: DataFrame, name: str) -> DataFrame:
    """``table`` in the order of the dashboard's contract; an error if names or types differ."""
    wanted = {f.name: f.dataType for f in DASHBOARDS[name].fields}
    got = {f.name: f.dataType for f in table.schema.fields}
    if got != wanted:
        differ = sorted(c for c in {*got, *wanted} if got.get(c) != wanted.get(c))
        raise ValueError(f"dashboard {name} breaks its contract in {', '.join(differ)}")
    return table.select(*wanted)
