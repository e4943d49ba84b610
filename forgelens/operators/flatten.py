"""Raw nested events to the flat event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelens.contracts import CORRUPT, RAW_EVENT
from forgelens.functions.expressions import parse_utc, utc

# Flat column -> (path in the raw event, type).
FLAT_COLUMNS = {
    "event_id": ("id", "bigint"),
    "event_type": ("type", "string"),
    "created_at": ("created_at", "timestamp_ntz"),
    "repo_id": ("repo.id", "bigint"),
    "repo_full_name": ("repo.name", "string"),
    "actor_id": ("actor.id", "bigint"),
    "actor_login": ("actor.login", "string"),
    "org_id": ("org.id", "bigint"),
    "org_login": ("org.login", "string"),
    "org_url": ("org.url", "string"),
    "org_avatar_url": ("org.avatar_url", "string"),
    "is_public": ("public", "boolean"),
    "payload_action": ("payload.action", "string"),
    "payload_ref_type": ("payload.ref_type", "string"),
    "pull_request_id": ("payload.pull_request.id", "bigint"),
    "pull_request_merged": ("payload.pull_request.merged", "boolean"),
    "issue_id": ("payload.issue.id", "bigint"),
    "comment_id": ("payload.comment.id", "bigint"),
    "release_id": ("payload.release.id", "bigint"),
    "member_id": ("payload.member.id", "bigint"),
}


def _typed(path: str, data_type: str) -> Column:
    value = F.col(path)
    if data_type == "string":
        return value
    return parse_utc(value) if data_type == "timestamp_ntz" else value.try_cast(data_type)


def is_reject() -> Column:
    """True for a line Spark could not read at all."""
    fields = [f.name for f in RAW_EVENT.fields if f.name != CORRUPT]
    return F.col(CORRUPT).isNotNull() & F.coalesce(*[F.col(n).cast("string") for n in fields]).isNull()


def flatten_events(raw: DataFrame) -> DataFrame:
    """One typed row per readable raw event, with its lineage; slice columns pass through."""
    slices = [c for c in ("dt", "hr") if c in raw.columns]
    return raw.where(~is_reject()).select(
        *[_typed(path, kind).alias(name) for name, (path, kind) in FLAT_COLUMNS.items()],
        utc(F.current_timestamp()).alias("ingestion_ts"),
        F.col("source_file") if "source_file" in raw.columns else F.lit(None).cast("string").alias("source_file"),
        *slices,
    )


def rejected_lines(raw: DataFrame) -> DataFrame:
    """The unreadable lines, kept apart from the events."""
    lineage = [c for c in ("source_file", "dt", "hr") if c in raw.columns]
    return raw.where(is_reject()).select(F.col(CORRUPT).alias("line"), *lineage)


def with_event_slice(events: DataFrame) -> DataFrame:
    """Assign each event to the hourly slice of its own timestamp."""
    return events.withColumns(
        {"dt": F.col("created_at").cast("date"), "hr": F.hour("created_at").cast("int")}
    )
