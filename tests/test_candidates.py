from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from builders import DAY, ORG, REPO, SLICE, by, events, metrics
from forgelens.operators import candidates
from forgelens.operators.candidates import metric_leaders, select_candidates
from forgelens.operators.metrics import entity_metrics
from forgelens.sources.staging import stage
from test_metrics import random_events


def test_only_metrics_the_table_has(spark):
    present = ("total_events", "bot_events", "push_events_ratio", "repos_count")
    frame = metrics(spark, ORG, [{"org_id": 10, "org_login": "lantern", "base": 1}]).select(*SLICE, *ORG.keys, *present)
    (row,) = select_candidates(frame, ORG, 1).collect()
    assert row.selection_reasons == sorted(present)


def test_no_known_metric_is_an_error(spark):
    frame = metrics(spark, ORG, []).select(*SLICE, *ORG.keys)
    with pytest.raises(ValueError, match="no metric"):
        select_candidates(frame, ORG, 1)


def test_null_metrics_are_not_ranked(spark):
    frame = metrics(
        spark,
        REPO,
        [
            {"repo_id": 1, "repo_full_name": "a/a", "bot_ratio": None, "base": 2},
            {"repo_id": 2, "repo_full_name": "a/b", "bot_ratio": 0.0, "base": 1},
        ],
    )
    rows = by(select_candidates(frame, REPO, 5, wanted=["bot_ratio"]).collect(), "repo_id")
    assert list(rows) == [2]


def test_ties_go_to_the_lower_key(spark):
    rows = [{"repo_id": i, "repo_full_name": f"a/{i}", "base": 1} for i in (4, 2, 9, 1)]
    leaders = metric_leaders(metrics(spark, REPO, rows), REPO, 2, wanted=["total_events"]).collect()
    assert sorted((r.metric_rank, r.repo_id) for r in leaders) == [(1, 1), (2, 2)]


def brute_force(rows, grain, top_n):
    """Per slice: union of the top rows of every metric, as entity -> metrics it leads on."""
    slices: dict[tuple, list[dict]] = {}
    for row in rows:
        slices.setdefault((row["dt"], row["hr"]), []).append(row)
    reasons: dict[tuple, set[str]] = {}
    for (dt, hr), members in slices.items():
        for metric in grain.metrics:
            ranked = sorted(members, key=lambda m: (-m[metric], m[grain.id], m[grain.label]))
            for member in ranked[:top_n]:
                reasons.setdefault((dt, hr, member[grain.id]), set()).add(metric)
    return {key: sorted(names) for key, names in reasons.items()}


@pytest.mark.parametrize("grain", [REPO, ORG], ids=["repo", "org"])
@pytest.mark.parametrize("limit", ["1000", "1"], ids=["group limit", "no group limit"])
def test_against_brute_force(spark, grain, limit):
    table = stage(entity_metrics(events(spark, random_events(11, 300)), grain))
    expected = brute_force([r.asDict() for r in table.collect()], grain, 2)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
    try:
        got = select_candidates(table, grain, 2).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert {(r.dt, r.hr, r[grain.id]): r.selection_reasons for r in got} == expected


def test_many_slices_equal_single_slices(spark):
    rows = [
        {"repo_id": i, "repo_full_name": f"a/{i}", "base": i, "dt": day, "hr": hr}
        for i in range(1, 5)
        for day in (DAY, date(2026, 3, 21))
        for hr in (0, 1)
    ]
    together = select_candidates(metrics(spark, REPO, rows), REPO, 1).collect()
    assert sorted((str(r.dt), r.hr, r.repo_id) for r in together) == [
        (day, hr, 4) for day in ("2026-03-20", "2026-03-21") for hr in (0, 1)
    ]


@pytest.mark.parametrize("slices", [(), ("dt",)], ids=["whole", "daily"])
def test_floors_never_cost_a_leader(spark, slices):
    """Heavy ties, few entities, many places: the ranking equals that of sorted rows."""
    rows = [
        {"repo_id": i, "repo_full_name": f"a/{i}", "base": i % 3, "push_events": i, "watch_events": None, "hr": 0}
        for i in range(60)
    ]
    table = metrics(spark, REPO, rows + [{**r, "dt": date(2026, 3, 21)} for r in rows[:4]])
    table = table.groupBy(*slices, *REPO.keys).agg(*[F.max(m).alias(m) for m in REPO.metrics])
    stored = [r.asDict() for r in table.collect()]
    for top_n in (1, 5, 59, 60, 200):
        found = sorted((*(r[c] for c in slices), r.selection_metric, r.metric_rank, r.repo_id) for r in metric_leaders(table, REPO, top_n, slice_cols=slices).collect())
        wanted = []
        for group in {tuple(r[c] for c in slices) for r in stored}:
            for metric in REPO.metrics:
                members = [r for r in stored if tuple(r[c] for c in slices) == group and r[metric] is not None]
                ranked = sorted(members, key=lambda r: (-r[metric], r["repo_id"]))[:top_n]
                wanted += [(*group, metric, k + 1, r["repo_id"]) for k, r in enumerate(ranked)]
        assert found == sorted(wanted)


@pytest.mark.parametrize("slices", [(), SLICE], ids=["whole", "hourly"])
def test_ties_with_the_last_place_are_not_all_sorted(spark, monkeypatch, slices):
    """Entities that all have the same few values, as most have in an hour: about top_n of each are ranked."""
    rows = [{"repo_id": i, "repo_full_name": f"a/{i}", "base": 1, "watch_events": 0} for i in range(1, 2001)]
    table = stage(metrics(spark, REPO, rows))
    wanted = [(m, k, k) for m in ("push_events", "push_events_ratio", "watch_events") for k in range(1, 6)]
    found = metric_leaders(table, REPO, 5, wanted=sorted({w[0] for w in wanted}), slice_cols=slices).collect()
    assert sorted((r.selection_metric, r.metric_rank, r.repo_id) for r in found) == sorted(wanted)
    monkeypatch.setattr(candidates, "_leaders", lambda values, *_: values)
    assert metric_leaders(table, REPO, 5, slice_cols=slices).count() < 20 * len(REPO.metrics)


@pytest.mark.parametrize("top_n", [1, 4, 30])
def test_floors_keep_the_order_of_any_value_and_id(spark, top_n):
    """Values between whole numbers and beyond them, ids below zero and of any size."""
    rng = random.Random(top_n)
    odd = [0.0, -0.0, 0.5, 0.75, 1.0, 1.0 + 2**-52, 1.0 - 2**-53, 2.0, -1.0, -0.5, 2.0**60, 1e300, float("inf"), float("-inf")]
    ids = [*range(-3, 40), *(2**62 + i for i in range(40)), *(10**9 + i for i in range(200))]
    values = {i: rng.choice(odd[: rng.choice([3, 8, len(odd)])]) for i in ids}
    table = stage(metrics(spark, REPO, [{"repo_id": i, "repo_full_name": f"a/{i}", "bot_ratio": v} for i, v in values.items()]))
    found = metric_leaders(table, REPO, top_n, wanted=["bot_ratio"]).collect()
    leaders = sorted(ids, key=lambda i: (-values[i], i))[:top_n]
    assert [r.repo_id for r in sorted(found, key=lambda r: r.metric_rank)] == leaders
    lowest = metrics(spark, REPO, [{"repo_id": i, "repo_full_name": f"a/{i}", "bot_ratio": float("nan") if i == 7 else 1.0} for i in range(60)])
    assert 7 in [r.repo_id for r in metric_leaders(lowest, REPO, top_n, wanted=["bot_ratio"]).collect()]


def test_rows_without_a_slice_are_ranked_among_themselves(spark):
    rows = [{"repo_id": i, "repo_full_name": f"a/{i}", "base": i, "dt": dt} for dt in (DAY, None) for i in (1, 2)]
    got = select_candidates(metrics(spark, REPO, rows), REPO, 1).collect()
    assert sorted((str(r.dt), r.repo_id) for r in got) == [("2026-03-20", 2), ("None", 2)]


def test_rows_are_cut_before_the_shuffle(spark, plan_of):
    plan = plan_of(metric_leaders(metrics(spark, REPO, []), REPO, 25))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Generate") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Exchange SinglePartition" not in plan


def test_entities_are_not_sorted_by_slice_to_meet_their_floors(spark, plan_of):
    assert "SortMergeJoin" not in plan_of(metric_leaders(metrics(spark, REPO, []), REPO, 25))
