"""The hourly batch for any number of slices in one Spark application."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelens.contracts import (
    EVENTS_FLAT,
    ORG,
    REPO,
    SLICE,
    SNAPSHOT,
    Grain,
    candidates_schema,
    in_slice,
    mart_schema,
    metrics_schema,
    require_contract,
)
from forgelens.operators import dashboards, enrichment, partials
from forgelens.operators.candidates import select_candidates
from forgelens.operators.flatten import flatten_events, rejected_lines, with_event_slice
from forgelens.operators.marts import build_mart, latest_per_key
from forgelens.operators.metrics import entity_metrics
from forgelens.sources.raw import in_slices, read_raw_events, read_slices
from forgelens.sources.staging import children, slice_dir, stage, staging
from forgelens.sources.warehouse import write_bucketed, write_slices

Slices = Sequence[tuple[date, int]]


@dataclass(frozen=True)
class Layout:
    """Where the tables live: ``<root>/<zone>/<table>/dt=YYYY-MM-DD/hr=H/``."""

    root: str

    def path(self, zone: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{table}"


def ingest(spark: SparkSession, layout: Layout, landing: str, slices: Slices | None = None) -> None:
    """Flatten the landing zone into the event table and keep unreadable lines apart.

    The lines are parsed once and stored; events and rejects are both taken from there.

    A landing folder with ``dt=/hr=`` directories assigns slices, as the hourly archive
    does; then every slice named here is replaced by exactly what its directory holds, and
    cleared if that has no readable event. A flat landing folder gives each event the slice of
    its own timestamp, and the whole history of the slices it touches is expected to be in it;
    its rejects are kept by source file, and those of other files stay.
    """
    if slices is None:
        raw = read_raw_events(spark, landing)
    else:
        # Directory names are known, so storage is not listed. A slice without data yet
        # has no directory and would fail the scan: ask for the slices that have landed.
        raw = read_raw_events(spark, [slice_dir(landing, *s) for s in slices], base_path=landing)
    assigned = all(c in raw.columns for c in SLICE)
    with staging(spark):
        parsed = stage(raw)
        events = flatten_events(parsed)
        write_slices(events if assigned else with_event_slice(events), layout.path("bronze", "events_flat"), owned=slices)
        rejects = rejected_lines(parsed)
        path = layout.path("bronze", "events_rejected")
        if assigned:
            write_slices(rejects, path, owned=slices)
        else:
            by_file = rejects.withColumn("file_id", F.md5("source_file"))
            by_file.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_id").parquet(path)


def aggregate(spark: SparkSession, layout: Layout, slices: Slices | None = None) -> None:
    events = read_slices(spark, layout.path("bronze", "events_flat"), slices, in_slice(EVENTS_FLAT))
    for grain in (REPO, ORG):
        write_slices(entity_metrics(events, grain, gathered=True), layout.path("silver", f"{grain.name}_aggregates"), owned=slices)


def summarise(spark: SparkSession, layout: Layout, slices: Slices | None = None) -> None:
    """Store the partial metrics of hours, from which coarser slices are derived (``daily``)."""
    events = read_slices(spark, layout.path("bronze", "events_flat"), slices, in_slice(EVENTS_FLAT))
    for grain in (REPO, ORG):
        with staging(spark):
            write_slices(partials.hourly_sums(events, grain), layout.path("silver", f"{grain.name}_sums"), owned=slices)
            write_slices(partials.hourly_sets(events, grain), layout.path("silver", f"{grain.name}_sets"), owned=slices)


def daily(spark: SparkSession, layout: Layout, days: Sequence[date]) -> None:
    """Replace the daily metrics of ``days`` by those of their stored hours; no event is read.

    To be run after ``summarise`` for the days whose hours came or changed.
    """
    for grain in (REPO, ORG):
        hours = [(day, hour) for day in days for hour in range(24)]
        sums, sets = (read_slices(spark, layout.path("silver", f"{grain.name}_{table}"), hours) for table in ("sums", "sets"))
        with staging(spark):
            path = layout.path("silver", f"{grain.name}_daily")
            write_slices(partials.rolled_up(sums, sets, grain, ("dt",)), path, ("dt",))


def rank(spark: SparkSession, layout: Layout, top_n: int = 100, slices: Slices | None = None) -> None:
    for grain in (REPO, ORG):
        metrics = read_slices(spark, layout.path("silver", f"{grain.name}_aggregates"), slices, in_slice(metrics_schema(grain)))
        write_slices(select_candidates(metrics, grain, top_n), layout.path("silver", f"{grain.name}_candidates"), owned=slices)


def to_ask(spark: SparkSession, layout: Layout, grain: Grain, slices: Slices | None = None) -> DataFrame:
    """Candidates whose snapshot is not stored yet: what the next load has to fetch."""
    candidates = read_slices(spark, layout.path("silver", f"{grain.name}_candidates"), slices, candidates_schema(grain))
    stored = _stored(spark, layout.path("bronze", f"{grain.name}_snapshot"), slices)
    return candidates if stored is None else enrichment.unsettled(candidates, stored.select(grain.label, *SLICE), grain)


def enrich(
    spark: SparkSession, layout: Layout, repo_responses: DataFrame, org_responses: DataFrame, slices: Slices | None = None
) -> None:
    """Split the stored answers; nothing is written if any of them is fatal.

    Loads add up: an answer joins what earlier loads stored for its slice, and of several for
    one entity the last one counts. Slices without new answers are not touched. The answers
    are stored once for all their outputs.
    """
    with staging(spark):
        answers = {}
        for grain, responses in ((REPO, repo_responses), (ORG, org_responses)):
            answers[grain] = stage(responses if slices is None else responses.where(in_slices(slices)))
        for responses in answers.values():
            enrichment.require_no_fatal(responses)
        for grain, responses in answers.items():
            key = [grain.id, *SLICE]
            _add(spark, enrichment.snapshots(responses, grain), layout.path("bronze", f"{grain.name}_snapshot"), lambda t, key=key: latest_per_key(t, key))
            label = [grain.label, *SLICE]
            _add(spark, enrichment.errors(responses, grain), layout.path("bronze", f"{grain.name}_snapshot_errors"), lambda t, label=label: latest_per_key(t, label))
        _add(spark, enrichment.topics(answers[REPO]), layout.path("bronze", "repo_topics"), DataFrame.distinct)


def _stored(spark: SparkSession, path: str, slices: Slices | None) -> DataFrame | None:
    """A table that earlier loads may not have made yet."""
    return read_slices(spark, path, slices) if children(spark, path) else None


def _add(spark: SparkSession, new: DataFrame, path: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merge ``new`` with what the slices it touches hold."""
    new = stage(new)
    touched = [(r.dt, r.hr) for r in new.select(*SLICE).distinct().collect()]  # one pair for each hour loaded
    before = _stored(spark, path, touched) if touched else None
    # The slices it is read from stay until the merged ones are complete.
    write_slices(merge(new) if before is None else merge(before.select(new.columns).unionByName(new)), path)


def curate(spark: SparkSession, layout: Layout, database: str = "default", slices: Slices | None = None) -> None:
    for grain, table in ((REPO, "repositories"), (ORG, "organizations")):
        candidates = read_slices(spark, layout.path("silver", f"{grain.name}_candidates"), slices, candidates_schema(grain))
        snapshot = read_slices(spark, layout.path("bronze", f"{grain.name}_snapshot"), slices, SNAPSHOT[grain.name])
        write_slices(build_mart(candidates, snapshot, grain), layout.path("marts", f"{table}_stage"), owned=slices)
        stored = read_slices(spark, layout.path("marts", f"{table}_stage"), slices, in_slice(mart_schema(grain)))
        write_bucketed(stored, grain, f"{database}.{table}", layout.path("marts", table), owned=slices)


def report(
    spark: SparkSession,
    layout: Layout,
    database: str = "default",
    slices: Slices | None = None,
    as_of: date | None = None,
) -> None:
    repos, orgs = (spark.table(f"{database}.{t}") for t in ("repositories", "organizations"))
    if slices is not None:
        repos, orgs = repos.where(in_slices(slices)), orgs.where(in_slices(slices))
    for area, builders, marts in (
        ("repositories", dashboards.REPO_DASHBOARDS, (repos,)),
        ("organizations", dashboards.ORG_DASHBOARDS, (orgs,)),
        ("common", dashboards.COMMON_DASHBOARDS, (repos, orgs)),
    ):
        for name, build in builders.items():
            extra = {"as_of": as_of} if build is dashboards.repo_freshness else {}
            dataset = require_contract(build(*marts, SLICE, **extra), f"{area}/{name}")
            write_slices(dataset, layout.path("dashboards", f"{area}/{name}"), owned=slices)


def run_slices(
    spark: SparkSession,
    root: str,
    landing: str,
    repo_responses: DataFrame,
    org_responses: DataFrame,
    slices: Slices | None = None,
    top_n: int = 100,
    database: str = "default",
    as_of: date | None = None,
) -> Layout:
    """Landing zone and stored answers to marts and dashboards.

    Every step writes its table and the next one reads it, so a lost executor costs a
    step's tasks at most. A failed run is started again from the first step: every step
    replaces the slices it is given, and only enrichment adds to what is stored.
    """
    layout = Layout(root)
    ingest(spark, layout, landing, slices)
    aggregate(spark, layout, slices)
    rank(spark, layout, top_n, slices)
    enrich(spark, layout, repo_responses, org_responses, slices)
    curate(spark, layout, database, slices)
    report(spark, layout, database, slices, as_of)
    return layout
