from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from builders import DAY
from forgelens.operators import pages
from forgelens.operators.dashboards import common_rollup, org_summary, repo_summary
from test_dashboards import orgs, repos

SLICE = ("dt", "hr")


def repo_page(spark, rows, start=DAY, end=DAY):
    return pages.load_repo_summary(repo_summary(repos(spark, rows), SLICE), start, end)


def org_page(spark, rows):
    return pages.load_org_summary(org_summary(orgs(spark, rows), SLICE), DAY, DAY)


def test_range_is_inclusive_and_rows_carry_their_time(spark):
    rows = [{"dt": date(2026, 3, d), "hr": 7} for d in (18, 19, 20, 21)]
    loaded = repo_page(spark, rows, date(2026, 3, 19), date(2026, 3, 20)).collect()
    assert sorted(r.timestamp for r in loaded) == [datetime(2026, 3, 19, 7), datetime(2026, 3, 20, 7)]


def test_missing_text_gets_its_default(spark):
    (row,) = repo_page(spark, [{"repo_full_name": None}]).collect()
    assert (row.language, row.repo_full_name, row.visibility) == ("Unknown", "Unknown repository", None)
    (row,) = org_page(spark, [{"org_login": None}]).collect()
    assert (row.org_login, row.org_name, row.location, row.company) == (
        "Unknown organization",
        "Unknown organization",
        "Unknown",
        "Unknown",
    )


def test_common_defaults_and_numbers(spark):
    rollup = common_rollup(repos(spark, [{"owner_login": None}]), orgs(spark, [{}]))
    (row,) = pages.load_common_summary(rollup).collect()
    assert (row.owner_login, row.repo_name, row.org_name) == ("Unknown owner", "Unknown repository", "Independent owner")
    assert (row.org_is_verified, row.org_followers, row.repo_total_events) == (False, 0.0, 1.0)


def test_numbers_that_are_text(spark):
    rollup = common_rollup(repos(spark, [{}]), orgs(spark, [{}]))
    frame = rollup.withColumn("org_followers", F.lit("many"))
    assert pages.load_common_summary(frame).first().org_followers == 0.0


def test_rankings(spark):
    rows = [
        {"repo_id": i, "repo_full_name": f"a/{i}", "total_events": n, "language": "Go" if i < 3 else None}
        for i, n in enumerate((5, 9, 9, 1))
    ]
    loaded = repo_page(spark, rows)
    assert [r.repo_full_name for r in pages.repo_top_n(loaded, 2).collect()] == ["a/1", "a/2"]
    assert [tuple(r) for r in pages.repo_language(loaded).collect()] == [("Go", 23), ("Unknown", 1)]
    assert [r.total_events for r in pages.repo_table(loaded).collect()] == [9, 9, 5, 1]


def test_timeline_and_its_long_form(spark):
    rows = [{"hr": h, "push_events": 1, "pull_request_events": 2, "repo_id": i} for h in (1, 2) for i in (1, 2)]
    loaded = repo_page(spark, rows)
    assert [(r.timestamp.hour, r.push_events) for r in pages.repo_timeline(loaded).collect()] == [(1, 2), (2, 2)]
    long = {(r.timestamp.hour, r.event_type): r.events for r in pages.repo_push_vs_pr(loaded).collect()}
    assert long == {(h, t): n for h in (1, 2) for t, n in (("Push Events", 2), ("Pull Request Events", 4))}


def test_unknown_verification_is_left_out(spark):
    rows = [{"org_id": i, "org_login": str(i), "is_verified": v, "total_events": i} for i, v in ((1, True), (2, False), (3, None))]
    got = {r.verification_status: r.total_events for r in pages.org_verified(org_page(spark, rows)).collect()}
    assert got == {"Verified": 1, "Not Verified": 2}


def test_quality_is_an_unweighted_mean(spark):
    rows = [
        {"org_id": 1, "org_login": "a", "bot_ratio": 0.0, "composite_score": 1.0, "total_events": 99},
        {"org_id": 2, "org_login": "b", "bot_ratio": 1.0, "composite_score": 3.0},
    ]
    loaded = org_page(spark, rows)
    (row,) = pages.org_timeline(loaded).collect()
    assert (row.total_events, row.avg_bot_ratio, row.avg_composite_score) == (100, 0.5, 2.0)
    assert {r.metric: r.value for r in pages.org_quality(loaded).collect()} == {
        "Average Bot Ratio": pytest.approx(0.5),
        "Average Composite Score": pytest.approx(2.0),
    }
    assert [r.org_login for r in pages.org_top_n(loaded, 1).collect()] == ["a"]


def test_table_columns(spark):
    common = pages.load_common_summary(common_rollup(repos(spark, [{}]), orgs(spark, [{}])))
    assert pages.common_table(common).columns == list(pages.COMMON_TABLE)
    assert pages.common_scatter(common).columns == list(pages.SCATTER)
    assert [tuple(r) for r in pages.common_location_language(common).collect()] == [("Unknown", "Unknown", 1.0)]
    assert pages.org_table(org_page(spark, [{}])).columns == list(pages.ORG_TABLE)
