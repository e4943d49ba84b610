from __future__ import annotations

import json
from datetime import datetime

import pytest

from builders import DAY, ORG, REPO, by, metrics, responses
from forgelens.contracts import ORG_SNAPSHOT, REPO_SNAPSHOT
from forgelens.operators import enrichment as e

REPO_PAYLOAD = {
    "id": 1,
    "full_name": "lantern/wick",
    "name": "core",
    "owner": {"login": "lantern", "id": 9, "type": "Organization"},
    "license": None,
    "language": "Go",
    "fork": False,
    "stargazers_count": 5,
    "created_at": "2020-01-02T03:04:05Z",
    "pushed_at": None,
    "topics": ["a", "b"],
}


def answer(entity, status=200, payload=None, **more):
    return {"entity": entity, "status_code": status, "payload": json.dumps(payload or {}), **more}


def test_repository_snapshot(spark):
    licensed = {**REPO_PAYLOAD, "id": 2, "license": {"spdx_id": "MIT"}}
    frame = responses(spark, [answer("lantern/wick", payload=REPO_PAYLOAD), answer("x/y", payload=licensed), answer("gone/x", 404)])
    got = e.snapshots(frame, REPO)
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in REPO_SNAPSHOT}
    rows = by(got.collect(), "repo_id")
    assert sorted(rows) == [1, 2]
    assert (rows[1]["owner_login"], rows[1]["owner_id"], rows[1]["license_spdx_id"]) == ("lantern", 9, None)
    assert rows[2]["license_spdx_id"] == "MIT"
    assert rows[1]["created_at"] == datetime(2020, 1, 2, 3, 4, 5)
    assert (rows[1]["pushed_at"], rows[1]["api_fetched_at"]) == (None, datetime(2026, 3, 20, 21, 5))


def test_organization_snapshot(spark):
    payload = {"id": 3, "login": "lantern", "name": "Acme", "is_verified": True, "followers": 7}
    got = e.snapshots(responses(spark, [answer("lantern", payload=payload)]), ORG)
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in ORG_SNAPSHOT}
    row = got.first()
    assert (row.org_id, row.org_name, row.is_verified, row.followers, row.blog) == (3, "Acme", True, 7, None)


def test_topics_only_of_found_repositories(spark):
    rows = [
        answer("a/a", payload=REPO_PAYLOAD),
        answer("a/b", payload={"id": 2, "full_name": "a/b", "topics": []}),
        answer("a/c", payload={"id": 3, "full_name": "a/c", "topics": None}),
        answer("a/d", 404, payload={"topics": ["x"]}),
    ]
    assert sorted((r.repo_id, r.topic) for r in e.topics(responses(spark, rows)).collect()) == [(1, "a"), (1, "b")]


def test_error_rows(spark):
    frame = responses(spark, [answer("a/gone", 404, {"message": "Not Found"}), answer("a/ok", payload=REPO_PAYLOAD)])
    (row,) = e.errors(frame, REPO).collect()
    assert (row.repo_full_name, row.error_status, row.error_message, row.dt) == ("a/gone", 404, "Not Found", DAY)


def test_found_and_gone_are_not_fatal(spark):
    e.require_no_fatal(responses(spark, [answer("a", 200), answer("b", 404)]))


@pytest.mark.parametrize("status", [401, 500, None])
def test_fatal_answers(spark, status):
    with pytest.raises(e.EnrichmentFailed, match=f"status {status}"):
        e.require_no_fatal(responses(spark, [answer("a", 200), answer("b", status)]))


@pytest.mark.parametrize("status", [403, 429])
def test_rate_limit_is_reported_with_its_headers(spark, status):
    bad = answer("b", status, remaining="0", retry_after="60", reset_at="17")
    with pytest.raises(e.RateLimited, match="b: remaining=0, retry_after=60, reset_at=17"):
        e.require_no_fatal(responses(spark, [answer("a", 200), bad]))


def test_only_found_entities_are_settled(spark):
    candidates = metrics(
        spark,
        REPO,
        [{"repo_id": i, "repo_full_name": f"a/{i}", "hr": hr} for i, hr in ((1, 21), (2, 21), (3, 21), (1, 22))],
    )
    seen = responses(spark, [answer("a/1", 200), answer("a/2", 404)])
    left = e.pending(candidates, seen, REPO).collect()
    assert sorted((r.repo_id, r.hr) for r in left) == [(1, 22), (2, 21), (3, 21)]


def test_owner_and_name(spark):
    frame = spark.createDataFrame([("a/b",), ("a/b/c",)], "repo_full_name string").select(*e.owner_and_name())
    assert sorted(map(tuple, frame.collect())) == [("a", "b"), ("a", "b/c")]


def test_a_rate_limit_shows_whatever_else_fails(spark):
    codes = [code for code in (401, 500, 501, 502, 503) for _ in range(2)] + [429]
    frame = responses(spark, [{"entity": f"a/{k}", "status_code": code} for k, code in enumerate(codes)])
    with pytest.raises(e.RateLimited, match="429"):
        e.require_no_fatal(frame)
