"""Pages from stored dashboards, and what a scan of many slices costs in storage calls."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from forgelens.contracts import DASHBOARDS
from forgelens.operators.dashboards import org_summary, repo_summary
from forgelens.plans import reports
from forgelens.plans.slices import Layout
from forgelens.sources import raw, warehouse
from forgelens.sources.raw import read_days, read_slices, slice_paths
from forgelens.sources.warehouse import write_slices
from test_dashboards import orgs, repos

START = date(2026, 1, 1)
SLICE = ("dt", "hr")


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    """Forty days of stored summaries, every hour of them, three repositories and one organization each."""
    layout = Layout(str(tmp_path_factory.mktemp("lake")))
    hours = spark.range(40 * 24).select(F.expr("date_add(DATE '2026-01-01', cast(id div 24 as int))").alias("dt"), (F.col("id") % 24).cast("int").alias("hr"))
    for name, frame in ((reports.REPOSITORIES, repo_summary(repos(spark, [{"repo_id": i, "repo_full_name": None if i == 2 else f"a/{i}"} for i in range(3)]), SLICE)), (reports.ORGANIZATIONS, org_summary(orgs(spark, [{}]), SLICE))):
        days = frame.drop(*SLICE).crossJoin(hours).select(DASHBOARDS[name].fieldNames())
        write_slices(days.coalesce(1), layout.path("dashboards", name))
    return layout


@pytest.fixture
def calls(monkeypatch):
    """Paths that the driver lists itself."""
    made = []
    listed = raw.children
    monkeypatch.setattr(raw, "children", lambda spark, path: made.append(path) or listed(spark, path))
    return made


def test_a_week_reads_its_slices_only(spark, layout, calls, plan_of):
    page = reports.repository_page(spark, layout, START + timedelta(7), START + timedelta(13))
    assert len(calls) == 1
    assert len({f.rsplit("/", 1)[0] for f in page.inputFiles()}) == 168
    scan = next(line for line in plan_of(page.select("repo_id", "dt")).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(dt" in scan and "ReadSchema: struct<repo_id:bigint>" in scan
    assert page.count() == 168 * 3 and page.where("repo_full_name = 'Unknown repository'").count() == 168
    first, last = page.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert (first.date(), last.date(), last.hour) == (START + timedelta(7), START + timedelta(13), 23)


def test_ranges_beyond_the_history(spark, layout):
    assert reports.organization_page(spark, layout, START - timedelta(9), START).count() == 24
    empty = reports.organization_page(spark, layout, START - timedelta(9), START - timedelta(1))
    assert empty.count() == 0 and set(DASHBOARDS[reports.ORGANIZATIONS].fieldNames()) < set(empty.columns)
    assert read_days(spark, layout.path("dashboards", "none"), START, START, DASHBOARDS[reports.COMMON]).count() == 0


def test_storage_calls_do_not_grow_with_the_slices(spark, layout, calls):
    """A backfill of a year, most of it not there yet, takes one call; a few hours take one for each day."""
    path = layout.path("dashboards", reports.REPOSITORIES)
    year = [(START + timedelta(d), h) for d in range(365) for h in range(24)]
    assert len(year) == 8760 and len(slice_paths(spark, path, year)) == 40 and calls == [path]
    calls.clear()
    few = [(START, 3), (START, 30), (START + timedelta(1), 5), (START + timedelta(99), 1)]
    assert [p[len(path) :] for p in slice_paths(spark, path, few)] == ["/dt=2026-01-01/hr=3", "/dt=2026-01-02/hr=5"]
    assert len(calls) == 3
    calls.clear()
    assert read_slices(spark, path, year).count() == 40 * 24 * 3 and len(calls) == 1


def test_clearing_many_emptied_slices_takes_few_calls(spark, layout, calls, tmp_path):
    path = str(tmp_path / "t")
    stored = read_days(spark, layout.path("dashboards", reports.ORGANIZATIONS), START, START + timedelta(34))
    write_slices(stored, path)
    owned = [(START + timedelta(d), h) for d in range(365) for h in range(24)]
    calls.clear()
    gone = []
    original = warehouse.remove
    warehouse.remove = lambda spark, p: gone.append(p) or original(spark, p)
    try:
        write_slices(stored.where("hr <> 7"), path, owned=owned)
    finally:
        warehouse.remove = original
    cleared = [p for p in gone if p.endswith("/hr=7")]
    assert len(calls) == 1 and len(cleared) == 35
    assert spark.read.parquet(path).groupBy("hr").count().count() == 23
