"""Coarser slices from hourly partials against the metrics of the events themselves."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from builders import DAY, ORG, REPO, events
from forgelens.operators import partials
from forgelens.operators.metrics import entity_metrics
from forgelens.plans.slices import Layout, daily, summarise
from forgelens.sources.warehouse import write_slices


def text(frame, columns=None):
    return sorted(map(str, frame.select(sorted(columns or frame.columns)).collect()))


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    made = []
    for _ in range(1500):
        at = datetime(2026, 3, 20, 21) + timedelta(minutes=pick.randrange(0, 400))
        repo = pick.choice((1, 1, 1, 2, 3))
        made.append(
            {
                "repo_id": repo, "repo_full_name": f"a/{repo}" if pick.random() < 0.95 else None, "org_id": pick.choice((None, 7, 8)), "org_login": "seven",
                "actor_id": pick.choice((pick.randrange(9), pick.randrange(90_000), 2**40 + pick.randrange(3))), "actor_login": pick.choice(("x", "y[bot]", None)),
                "event_type": pick.choice(("PushEvent", "PullRequestEvent", "Unheard", None)), "is_public": pick.choice((True, False, None)),
                "pull_request_merged": pick.choice((True, None)), "issue_id": pick.choice((None, -3, 5)), "comment_id": pick.randrange(40_000), "created_at": at, "dt": at.date(), "hr": at.hour,
            }
        )
    return made


@pytest.mark.parametrize("grain", [REPO, ORG], ids=["repo", "org"])
@pytest.mark.parametrize("dense", [1, 40, partials.DENSE])
def test_days_and_range_equal_those_of_the_events(spark, rows, grain, dense):
    frame = events(spark, rows)
    sums, sets = partials.hourly_sums(frame, grain), partials.hourly_sets(frame, grain, dense=dense)
    for by in (("dt",), (), ("dt", "hr")):
        wanted = entity_metrics(frame, grain, by)
        assert text(partials.rolled_up(sums, sets, grain, by), wanted.columns) == text(wanted)


def test_merging_in_steps_is_merging_at_once(spark, rows):
    sets = partials.hourly_sets(events(spark, rows), REPO, dense=40)
    assert 0 < sets.where("bits IS NULL").count() < sets.count() and sets.where("(bits IS NULL) = (positions IS NULL)").count() == 0
    once = partials.merge_sets(sets, REPO, (), dense=40)
    steps = partials.merge_sets(partials.merge_sets(sets, REPO, ("dt",), dense=40), REPO, (), dense=40)
    shown = [c for c in sorted(once.columns) if c != "positions"] + ["array_sort(positions) AS p"]
    assert sorted(map(str, once.selectExpr(*shown).collect())) == sorted(map(str, steps.selectExpr(*shown).collect()))
    assert partials.merge_sets(sets.where(F.lit(False)), REPO, ()).count() == 0


def test_a_late_hour_changes_its_day_without_other_events(spark, rows, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    path = layout.path("bronze", "events_flat")
    frame = events(spark, rows)
    late = (DAY, 23)
    in_late = (F.col("dt") == late[0]) & (F.col("hr") == late[1])
    write_slices(frame.where(~in_late), path)
    summarise(spark, layout)
    daily(spark, layout, [DAY, DAY + timedelta(1)])
    before = text(spark.read.parquet(layout.path("silver", "repo_daily")).where(F.col("dt") > DAY))
    known = [(r.dt, r.hr) for r in frame.select("dt", "hr").distinct().collect()]
    write_slices(frame.where(in_late), path, owned=known)  # hours that are summed up are not needed any more
    assert {(r.dt, r.hr) for r in spark.read.parquet(path).select("dt", "hr").distinct().collect()} == {late}
    summarise(spark, layout, [late])
    daily(spark, layout, [DAY])
    for grain in (REPO, ORG):
        wanted = entity_metrics(frame, grain, ("dt",))
        stored = spark.read.parquet(layout.path("silver", f"{grain.name}_daily"))
        assert text(stored, wanted.columns) == text(wanted)
    assert text(spark.read.parquet(layout.path("silver", "repo_daily")).where(F.col("dt") > DAY)) == before
    assert date(2026, 3, 21) in {r.dt for r in stored.select("dt").distinct().collect()}
