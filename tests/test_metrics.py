from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta

import pytest

from builders import DAY, ORG, REPO, SLICE, events
from forgelens.contracts import EVENT_COUNTS, EVENT_TYPES, event_column, metrics_schema
from forgelens.operators.metrics import entity_metrics


def test_event_columns():
    assert event_column("PullRequestReviewEvent") == "pull_request_review_events"
    assert event_column("IssuesEvent") == "issues_events"
    assert len(set(EVENT_COUNTS)) == 16


def test_repositories(spark):
    rows = [
        {"pull_request_merged": True, "issue_id": 41, "comment_id": 52, "release_id": 63},
        {
            "event_type": "IssuesEvent",
            "is_public": False,
            "actor_id": 2,
            "actor_login": "helper[BOT]",
            "issue_id": 44,
            "created_at": datetime(2026, 3, 20, 21, 30),
        },
        {"repo_id": 8422, "repo_full_name": "invalid-name"},
        {"repo_id": None, "repo_full_name": None},
    ]
    (row,) = entity_metrics(events(spark, rows), REPO).collect()
    expected = {
        "repo_id": 7311,
        "repo_full_name": "lantern/wick",
        "total_events": 2,
        "public_events_count": 1,
        "unique_actors": 2,
        "bot_events": 1,
        "issues_count": 2,
        "comments_count": 1,
        "releases_count": 1,
        "merged_pr_count": 1,
        "push_events": 1,
        "issues_events": 1,
        "watch_events": 0,
        "push_events_ratio": 0.5,
        "issues_events_ratio": 0.5,
        "bot_ratio": 0.5,
        "last_event_at": datetime(2026, 3, 20, 21, 30),
        "dt": DAY,
        "hr": 21,
    }
    assert {k: row[k] for k in expected} == expected
    assert row.composite_score == pytest.approx(0.5 * math.log1p(2) + 0.15 + 0.2 * math.log1p(2))


def test_organizations(spark):
    org = {"org_id": 501, "org_login": "lantern"}
    rows = [
        {**org, "repo_id": 7311},
        {**org, "repo_id": 102, "event_type": "WatchEvent", "actor_id": 2, "actor_login": "bob"},
        {"repo_id": 103},
    ]
    (row,) = entity_metrics(events(spark, rows), ORG).collect()
    assert (row.org_id, row.total_events, row.repos_count, row.unique_actors) == (501, 2, 2, 2)
    assert (row.push_events, row.watch_events, row.push_events_ratio) == (1, 1, 0.5)


def test_slice_without_push_events_and_without_organizations(spark):
    frame = events(spark, [{"event_type": "WatchEvent"}])
    (row,) = entity_metrics(frame, REPO).collect()
    assert (row.push_events, row.push_events_ratio) == (0, 0.0)
    assert entity_metrics(frame, ORG).count() == 0


def test_unknown_and_missing_types_count_in_the_total_only(spark):
    frame = events(spark, [{}, {"event_type": "SponsorshipEvent"}, {"event_type": None}])
    (row,) = entity_metrics(frame, REPO).collect()
    assert row.total_events == 3
    assert sum(row[c] for c in EVENT_COUNTS) == 1


def test_missing_actor_and_flags(spark):
    frame = events(spark, [{"actor_id": None, "actor_login": None, "is_public": None}])
    (row,) = entity_metrics(frame, REPO).collect()
    assert (row.unique_actors, row.bot_events, row.public_events_count, row.merged_pr_count) == (0, 0, 0, 0)


def test_renamed_repository_is_two_entities(spark):
    frame = events(spark, [{}, {"repo_full_name": "lantern/renamed"}])
    assert entity_metrics(frame, REPO).count() == 2


def test_schema_is_the_contract(spark):
    for grain in (REPO, ORG):
        got = entity_metrics(events(spark, []), grain, ()).schema
        want = metrics_schema(grain)
        assert {(f.name, f.dataType) for f in got} == {(f.name, f.dataType) for f in want}


def random_events(seed, n=600):
    """Skewed on purpose: a third of all events belong to one repository."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        repo = 1 if rng.random() < 0.34 else rng.randrange(2, 12)
        at = datetime(2026, 3, 20) + timedelta(hours=rng.randrange(30), seconds=rng.randrange(3600))
        rows.append(
            {
                "event_id": i,
                "event_type": rng.choice([*EVENT_TYPES, "NewEvent", None]),
                "created_at": at,
                "repo_id": repo,
                "repo_full_name": f"o/{repo}",
                "actor_id": rng.choice([None, *range(9)]),
                "actor_login": rng.choice([None, "ann", "ci[bot]"]),
                "org_id": repo % 3 or None,
                "org_login": f"org{repo % 3}" if repo % 3 else None,
                "is_public": rng.choice([True, False, None]),
                "pull_request_merged": rng.choice([True, False, None]),
                "issue_id": rng.choice([None, 1, 2, 3]),
                "comment_id": rng.choice([None, None, i]),
                "release_id": rng.choice([None, 5]),
                "dt": at.date(),
                "hr": at.hour,
            }
        )
    return rows


def brute_force(rows, grain, slices):
    groups: dict[tuple, list[dict]] = {}
    for row in rows:
        if row[grain.id] is not None:
            groups.setdefault((*[row[c] for c in slices], row[grain.id]), []).append(row)

    def sizes(members, column):
        return len({m[column] for m in members} - {None})

    return {
        key: (
            len(members),
            sum(bool(m["is_public"]) for m in members),
            sizes(members, "actor_id"),
            sum("[bot]" in (m["actor_login"] or "") for m in members),
            sizes(members, "issue_id"),
            sizes(members, "comment_id"),
            sizes(members, "release_id"),
            sum(bool(m["pull_request_merged"]) for m in members),
            *[sum(m["event_type"] == t for m in members) for t in EVENT_TYPES],
            *([sizes(members, "repo_id")] if grain is ORG else []),
        )
        for key, members in groups.items()
    }


@pytest.mark.parametrize("grain", [REPO, ORG], ids=["repo", "org"])
@pytest.mark.parametrize("slices", [(), ("dt",), SLICE], ids=["whole", "daily", "hourly"])
def test_against_brute_force(spark, grain, slices):
    rows = random_events(7)
    got = entity_metrics(events(spark, rows), grain, slices).collect()
    found = {(*[r[c] for c in slices], r[grain.id]): tuple(r[c] for c in grain.counts) for r in got}
    assert found == brute_force(rows, grain, slices)


def test_many_slices_equal_single_slices(spark):
    rows = random_events(3, 200)
    whole = entity_metrics(events(spark, rows), REPO).where("dt = DATE '2026-03-21'")
    alone = entity_metrics(events(spark, [r for r in rows if r["dt"] == date(2026, 3, 21)]), REPO)
    columns = sorted(whole.columns)
    assert sorted(map(str, whole.select(columns).collect())) == sorted(map(str, alone.select(columns).collect()))


def test_plan_has_two_shuffles_and_no_sort(spark, plan_of):
    plan = plan_of(entity_metrics(events(spark, []), ORG))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Sort" not in plan
    assert plan.count("Expand") == 1


@pytest.mark.parametrize("grain", [REPO, ORG], ids=["repo", "org"])
@pytest.mark.parametrize("slices", [(), SLICE], ids=["whole", "hourly"])
def test_gathered_members_give_the_same_counts(spark, grain, slices):
    rows = random_events(5)
    got = entity_metrics(events(spark, rows), grain, slices, gathered=True).collect()
    found = {(*[r[c] for c in slices], r[grain.id]): tuple(r[c] for c in grain.counts) for r in got}
    assert found == brute_force(rows, grain, slices)


def test_gathered_members_are_dealt_in_pieces_before_wide_rows_are_made(spark, plan_of):
    """Otherwise the second aggregation holds a wide row for nearly every member of a task."""
    plan = plan_of(entity_metrics(events(spark, []), REPO, gathered=True))
    assert plan.count("REBALANCE_PARTITIONS_BY_COL") == 1
    below = plan.split("REBALANCE_PARTITIONS_BY_COL")[0]
    assert below.count("HashAggregate") == 2 and "Sort" not in plan


