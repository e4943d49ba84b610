from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from builders import ORG, REPO, SLICE
from forgelens.operators import dashboards
from forgelens.operators.candidates import select_candidates
from forgelens.operators.enrichment import EnrichmentFailed
from forgelens.operators.metrics import entity_metrics
from forgelens.plans import slices as batch
from forgelens.plans.slices import Layout, enrich, ingest, run_slices
from forgelens.sources import driver_tables as tables
from forgelens.sources.raw import in_slices
from forgelens.sources.staging import stage

SF = "/root/testdata/sf0.001"
DAYS = [date(2024, 1, 10), date(2024, 1, 11)]
TOP_N = 3


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Two days of the activity stream as an hourly archive, and the answers for them."""
    events = stage(tables.events_flat(spark, SF).where(F.col("dt").isin(DAYS)))
    landing = str(tmp_path_factory.mktemp("landing"))
    lines = tables.raw_event_json(events)
    lines.repartition("dt", "hr").write.mode("append").partitionBy("dt", "hr").option("compression", "gzip").text(landing)
    answers = []
    for grain, build, snapshot in (
        (REPO, tables.repo_responses, tables.repo_snapshot),
        (ORG, tables.org_responses, tables.org_snapshot),
    ):
        candidates = select_candidates(stage(entity_metrics(events, grain)), grain, TOP_N)
        answers.append(stage(build(candidates, snapshot(spark, SF))))
    slices = [(r.dt, r.hr) for r in events.select("dt", "hr").distinct().collect()]
    return events, landing, answers, slices


def test_whole_batch_and_rerun_of_one_slice(spark, tmp_path, source):
    events, landing, answers, slices = source
    spark.sql(f"CREATE DATABASE IF NOT EXISTS batch LOCATION '{tmp_path / 'db'}'")
    options = {"top_n": TOP_N, "database": "batch", "as_of": date(2001, 8, 8)}
    layout = run_slices(spark, str(tmp_path / "lake"), landing, *answers, slices=slices, **options)

    def rows(zone, table):
        return sorted(map(str, spark.read.parquet(layout.path(zone, table)).collect()))

    flat = spark.read.parquet(layout.path("bronze", "events_flat"))
    assert flat.count() == events.count()
    assert {(r.dt, r.hr) for r in flat.select("dt", "hr").distinct().collect()} == set(slices)
    want = entity_metrics(events, REPO)
    got = spark.read.parquet(layout.path("silver", "repo_aggregates")).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    mart = spark.table("batch.repositories")
    assert mart.count() == spark.read.parquet(layout.path("silver", "repo_candidates")).count()
    assert 0 < mart.where("repo_name IS NOT NULL").count() <= mart.count()
    summary = dashboards.repo_summary(mart, SLICE)
    stored = spark.read.parquet(layout.path("dashboards", "repositories/summary")).select(summary.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, summary.collect()))
    names = [p.name for area in ("repositories", "organizations", "common") for p in (tmp_path / "lake" / "dashboards" / area).iterdir()]
    assert len(names) == 18

    before = {t: rows(*t) for t in (("silver", "org_candidates"), ("dashboards", "common/summary"))}
    day, hour = slices[0]
    one = [a.where((F.col("dt") == day) & (F.col("hr") == hour)) for a in answers]
    run_slices(spark, layout.root, landing, *one, slices=[(day, hour)], **options)
    assert {t: rows(*t) for t in before} == before
    assert spark.table("batch.repositories").count() == mart.count()


def test_fatal_answer_stops_before_anything_is_written(spark, tmp_path, source):
    repo_answers, org_answers = source[2]
    layout = Layout(str(tmp_path / "lake"))
    with pytest.raises(EnrichmentFailed):
        enrich(spark, layout, repo_answers, org_answers.withColumn("status_code", F.lit(500)))
    assert not (tmp_path / "lake").exists()


def test_loads_of_answers_add_up(spark, tmp_path, source):
    repo_answers, org_answers = source[2]
    once, twice = Layout(str(tmp_path / "once")), Layout(str(tmp_path / "twice"))
    enrich(spark, once, repo_answers, org_answers)
    first = F.pmod(F.xxhash64("entity"), F.lit(2)) == 0
    enrich(spark, twice, repo_answers.where(first), org_answers.where(first))
    for _ in range(2):  # the second load, repeated, changes nothing
        enrich(spark, twice, repo_answers.where(~first), org_answers.where(~first))
    for table in ("repo_snapshot", "org_snapshot", "repo_snapshot_errors", "org_snapshot_errors", "repo_topics"):
        one, two = (spark.read.parquet(layout.path("bronze", table)) for layout in (once, twice))
        assert one.count() > 0 or "errors" in table
        assert sorted(map(str, two.select(one.columns).collect())) == sorted(map(str, one.collect())), table


def test_emptied_slice_is_cleared_everywhere_and_nothing_stays_staged(spark, tmp_path, source):
    events, landing, answers, slices = source
    spark.sql(f"CREATE DATABASE IF NOT EXISTS emptied LOCATION '{tmp_path / 'db'}'")
    options = {"top_n": TOP_N, "database": "emptied", "as_of": date(2001, 8, 8)}
    two = sorted(slices)[:2]
    copy = tmp_path / "landing"
    spark.read.text(landing).where(in_slices(two)).write.partitionBy("dt", "hr").text(str(copy))
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.rglob("forgelens-*"))
    layout = run_slices(spark, str(tmp_path / "lake"), str(copy), *answers, slices=two, **options)
    assert set(shared.rglob("forgelens-*")) == before
    (day, hour), other = two
    broken = copy / f"dt={day}" / f"hr={hour}"
    for old in broken.iterdir():
        old.unlink()
    (broken / "part.txt").write_text("not json\n")
    run_slices(spark, layout.root, str(copy), *answers, slices=[(day, hour)], **options)
    for zone, table in (("bronze", "events_flat"), ("silver", "repo_aggregates"), ("silver", "repo_candidates"), ("marts", "repositories"), ("dashboards", "repositories/summary")):
        left = {(r.dt, r.hr) for r in spark.read.parquet(layout.path(zone, table)).select("dt", "hr").distinct().collect()}
        assert left == {other}, table
    assert {(r.dt, r.hr) for r in spark.table("emptied.repositories").select("dt", "hr").distinct().collect()} == {other}
    assert spark.read.parquet(layout.path("bronze", "events_rejected")).count() == 1


def test_rejects_of_two_flat_landings_add_up(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    line = '{"id": "1", "type": "WatchEvent", "created_at": "2026-03-20T21:15:00Z"}'
    for name in ("a", "b"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "events.json").write_text(f"{line}\nbroken {name}\n")
        ingest(spark, layout, str(folder))
    assert spark.read.parquet(layout.path("bronze", "events_rejected")).count() == 2


def test_ingest_parses_once(spark, tmp_path, source, monkeypatch):
    """One scan of the lines; the events cross one exchange on their way to the table."""
    events, landing, _, slices = source
    reads = []
    original = batch.read_raw_events
    monkeypatch.setattr(batch, "read_raw_events", lambda *a, **k: reads.append(original(*a, **k)) or reads[-1])
    ingest(spark, Layout(str(tmp_path / "lake")), landing, slices[:2])
    assert len(reads) == 1
    assert "Rebalance" not in reads[0]._jdf.queryExecution().optimizedPlan().toString()
