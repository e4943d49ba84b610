from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from builders import DAY, ORG, REPO, SLICE, by
from forgelens.contracts import DASHBOARDS, in_slice, mart_schema, require_contract
from forgelens.operators import dashboards as d

REPO_MART = (
    "dt date, hr int, repo_id bigint, repo_full_name string, repo_name string, owner_login string, owner_type string, "
    "language string, visibility string, is_fork boolean, is_archived boolean, is_disabled boolean, "
    "stargazers_count bigint, forks_count bigint, watchers_count bigint, subscribers_count bigint, "
    "open_issues_count bigint, total_events bigint, push_events bigint, pull_request_events bigint, "
    "issue_comment_events bigint, issues_events bigint, fork_events bigint, watch_events bigint, unique_actors bigint, "
    "composite_score double, bot_ratio double, pushed_at timestamp_ntz"
)
ORG_MART = (
    "dt date, hr int, org_id bigint, org_login string, org_name string, location string, company string, blog string, "
    "email string, twitter_username string, is_verified boolean, has_organization_projects boolean, "
    "has_repository_projects boolean, public_repos bigint, public_gists bigint, followers bigint, following bigint, "
    "repos_count bigint, total_events bigint, push_events bigint, pull_request_events bigint, composite_score double, "
    "bot_ratio double"
)


def mart(spark, schema, rows, **defaults):
    names = [c.split()[0] for c in schema.split(", ")]
    base = {"dt": DAY, "hr": 10, "total_events": 1, "composite_score": 1.0, "bot_ratio": 0.0, **defaults}
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], schema)


def repos(spark, rows):
    return mart(spark, REPO_MART, rows, repo_id=1, repo_full_name="lantern/tide", owner_login="lantern")


def orgs(spark, rows):
    return mart(spark, ORG_MART, rows, org_id=10, org_login="lantern")


def test_repository_summary(spark):
    rows = [
        {"total_events": 31, "push_events": 4, "pull_request_events": 9, "issue_comment_events": 6, "fork_events": 2, "composite_score": 1.25, "bot_ratio": 0.5},
        {"total_events": 14, "push_events": 6, "pull_request_events": 0, "issue_comment_events": 5, "fork_events": 3, "composite_score": 2.75, "bot_ratio": 0.0, "is_fork": True, "language": "Zig"},
        {"total_events": 1, "push_events": 1, "pull_request_events": 0, "issue_comment_events": 0, "fork_events": 0, "composite_score": 0.5, "bot_ratio": 1.0},
    ]
    (row,) = d.repo_summary(repos(spark, rows)).collect()
    assert (row.total_events, row.push_events, row.pull_request_events, row.issue_comment_events, row.fork_events) == (46, 11, 9, 11, 5)
    assert (row.avg_composite_score, row.avg_bot_ratio) == (pytest.approx(1.5), pytest.approx(0.5))
    assert (row.is_fork, row.language, row.visibility) == (True, "Zig", None)


def test_organization_summary(spark):
    rows = [
        {"total_events": 61, "push_events": 13, "pull_request_events": 2, "composite_score": 0.75, "bot_ratio": 0.1},
        {"total_events": 7, "push_events": 0, "pull_request_events": 7, "composite_score": 1.75, "bot_ratio": 0.6},
        {"total_events": 2, "push_events": 2, "pull_request_events": 0, "composite_score": 0.5, "bot_ratio": 0.2},
    ]
    (row,) = d.org_summary(orgs(spark, rows)).collect()
    assert (row.total_events, row.push_events, row.pull_request_events) == (70, 15, 9)
    assert (row.avg_composite_score, row.avg_bot_ratio) == (pytest.approx(1.0), pytest.approx(0.3))


def test_rollup_of_repositories_with_and_without_owner(spark):
    left = repos(
        spark,
        [
            {"total_events": 4, "composite_score": 0.5},
            {"total_events": 9, "composite_score": 2.5},
            {"repo_id": 2, "repo_full_name": "nobody/raft", "owner_login": None, "total_events": 3, "composite_score": 1.0},
        ],
    )
    right = orgs(spark, [{"org_name": "Lantern Works", "location": "Porto", "followers": 17, "is_verified": False}])
    owned, alone = sorted(d.common_rollup(left, right).collect(), key=lambda r: r.repo_id)
    assert (owned.repo_total_events, owned.repo_avg_composite_score) == (13, pytest.approx(1.5))
    assert (owned.org_id, owned.org_name, owned.org_location, owned.org_followers, owned.org_is_verified) == (10, "Lantern Works", "Porto", 17, False)
    assert (alone.repo_total_events, alone.org_id, alone.org_name) == (3, None, None)


def test_freshness_limits(spark):
    today = date(2026, 3, 20)
    ages = {-3: "0-7d", 7: "0-7d", 8: "8-30d", 30: "8-30d", 31: "31-90d", 90: "31-90d", 91: "90d+", None: "90d+"}
    for age, label in ages.items():
        pushed = None if age is None else datetime(2026, 3, 20, 23) - timedelta(days=age)
        (row,) = d.repo_freshness(repos(spark, [{"pushed_at": pushed}]), as_of=today).collect()
        assert (age, row.freshness_bucket) == (age, label)


def test_organization_sizes(spark):
    sizes = {0: "1-5", 5: "1-5", 6: "6-20", 20: "6-20", 21: "21-100", 100: "21-100", 101: "100+", None: "100+"}
    frame = orgs(spark, [{"org_id": i, "repos_count": n} for i, n in enumerate(sizes)])
    got = {r.size_bucket: r.org_count for r in d.org_size(frame).collect()}
    assert got == {"1-5": 2, "6-20": 2, "21-100": 2, "100+": 2}


def test_unknown_labels_and_flags(spark):
    frame = repos(spark, [{"is_fork": None}, {"is_fork": True}, {"is_fork": False, "language": "Go"}])
    assert {r.fork_status: r.repo_count for r in d.repo_fork(frame).collect()} == {"original": 2, "fork": 1}
    assert {r.language: r.repo_count for r in d.repo_language(frame).collect()} == {"Unknown": 2, "Go": 1}
    for build, column in ((d.repo_owner, "owner_type"), (d.repo_visibility, "visibility")):
        assert [r[column] for r in build(frame).collect()] == ["Unknown"]
    people = orgs(spark, [{"is_verified": None}, {"is_verified": True, "blog": "b", "email": "e"}])
    assert {r.verification_status for r in d.org_verified(people).collect()} == {"verified", "not_verified"}
    assert {tuple(r)[:3] for r in d.org_social(people).collect()} == {
        ("no_twitter", "no_blog", "no_email"),
        ("no_twitter", "has_blog", "has_email"),
    }
    assert [r.company for r in d.org_company(people).collect()] == ["Unknown"]
    assert [r.location for r in d.org_location(people).collect()] == ["Unknown"]


def test_event_type_totals_of_an_empty_mart_are_null(spark):
    rows = by(d.repo_event_type(repos(spark, [])).collect(), "event_type")
    assert len(rows) == 6
    assert {r["event_count"] for r in rows.values()} == {None}


def test_top_100_with_a_tie_at_the_end(spark, plan_of):
    frame = repos(spark, [{"repo_id": i, "composite_score": 1.0 if i > 3 else 2.0} for i in range(1, 151)])
    top = d.repo_top_100(frame)
    assert sorted(r.repo_id for r in top.collect()) == list(range(1, 101))
    assert "TakeOrderedAndProject" in plan_of(top)
    per_hour = d.repo_top_100(frame, ("dt", "hr"))
    assert sorted(r.repo_id for r in per_hour.collect()) == list(range(1, 101))
    assert plan_of(per_hour).count("WindowGroupLimit") == 2


def test_common_datasets_equal_the_plain_join(spark):
    """Owners are summed up before the join; a hot, a missing and a doubled owner must not change results."""
    owners = ["hot"] * 20 + [None] * 10 + ["cold", "twice", "nobody"]
    left = repos(
        spark,
        [
            {
                "repo_id": i,
                "owner_login": o,
                "language": "Go" if i % 2 else None,
                "total_events": i,
                "composite_score": None if i % 5 == 0 else float(i),
            }
            for i, o in enumerate(owners)
        ],
    )
    right = orgs(
        spark,
        [
            {"org_id": 1, "org_login": "hot", "location": "X", "is_verified": True},
            {"org_id": 2, "org_login": "cold", "location": "X", "is_verified": False},
            {"org_id": 3, "org_login": "twice", "location": "Y", "is_verified": True},
            {"org_id": 4, "org_login": "twice", "location": None, "is_verified": None},
        ],
    )
    left.createOrReplaceTempView("r")
    right.createOrReplaceTempView("o")
    plain = spark.sql(
        """SELECT CASE WHEN o.is_verified THEN 'verified' ELSE 'not_verified' END AS verification_status,
             count(*) AS repo_count, sum(r.total_events) AS total_events, avg(r.composite_score) AS avg_repo_score
           FROM r LEFT JOIN o ON r.owner_login = o.org_login GROUP BY 1"""
    )
    assert sorted(map(tuple, d.common_verified(left, right).collect())) == sorted(map(tuple, plain.collect()))
    plain = spark.sql(
        """SELECT coalesce(r.language, 'Unknown') AS language, coalesce(o.location, 'Unknown') AS org_location,
             count(*) AS repo_count, sum(r.total_events) AS total_events
           FROM r LEFT JOIN o ON r.owner_login = o.org_login GROUP BY 1, 2"""
    )
    assert sorted(map(tuple, d.common_language_location(left, right).collect())) == sorted(map(tuple, plain.collect()))


def test_hourly_join_stays_within_the_hour(spark):
    left = repos(spark, [{"hr": 1, "total_events": 5}, {"hr": 2, "total_events": 7}])
    right = orgs(spark, [{"hr": 1, "is_verified": True}])
    rows = d.common_verified(left, right, ("dt", "hr")).collect()
    assert {(r.hr, r.verification_status, r.total_events) for r in rows} == {(1, "verified", 5), (2, "not_verified", 7)}


def test_all_datasets_have_a_builder():
    assert len(d.REPO_DASHBOARDS) + len(d.ORG_DASHBOARDS) + len(d.COMMON_DASHBOARDS) == 18


def test_every_dataset_keeps_its_contract(spark):
    left, right = (spark.createDataFrame([], in_slice(mart_schema(grain))) for grain in (REPO, ORG))
    areas = {"repositories": (d.REPO_DASHBOARDS, [left]), "organizations": (d.ORG_DASHBOARDS, [right]), "common": (d.COMMON_DASHBOARDS, [left, right])}
    seen = set()
    for area, (builders, marts) in areas.items():
        for name, build in builders.items():
            extra = {"as_of": DAY} if build is d.repo_freshness else {}
            frame = build(*marts, SLICE, **extra)
            assert require_contract(frame, f"{area}/{name}").columns == DASHBOARDS[f"{area}/{name}"].names
            with pytest.raises(ValueError, match="total_more"):
                require_contract(frame.withColumn("total_more", frame.hr), f"{area}/{name}")
            seen.add(f"{area}/{name}")
    assert seen == DASHBOARDS.keys() and len(seen) == 18
