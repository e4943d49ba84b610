"""Every operator as a named query over the star-schema test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelens.contracts import DASHBOARDS, EVENT_RATIOS, ORG, REPO, SCORES, SLICE, Grain, mart_schema, require_contract
from forgelens.functions.expressions import round_doubles
from forgelens.operators import dashboards, enrichment, pages, partials, profile
from forgelens.operators.candidates import metric_leaders, select_candidates
from forgelens.operators.flatten import flatten_events, with_event_slice
from forgelens.operators.marts import build_mart, latest_per_key, match_rate, project_contract
from forgelens.operators.metrics import entity_metrics, valid_events
from forgelens.plans import reports
from forgelens.plans.slices import Layout, enrich
from forgelens.sources import driver_tables as tables
from forgelens.sources.raw import calendar_of, in_slices, read_days, read_raw_events, slice_calendar
from forgelens.sources.staging import children, shared_dir, stage
from forgelens.sources.warehouse import write_bucketed, write_slices

Query = Callable[[SparkSession, str], DataFrame]

# Parameters the oracle shares: the deployed number of candidates, and a small one for queries
# that show the ranking bite where few entities compete.
TOP_N = 25
SMALL_TOP_N = 3
AS_OF = date(2001, 8, 8)
FIRST_DAY, LAST_DAY = date(2024, 1, 8), date(2024, 1, 21)
ONE_SLICE = (date(2024, 1, 15), 12)
SPARSE_METRICS = ("total_events", "bot_ratio", "stars_gained", "repos_count")
PAGE_TOP_N = 10
WHOLE: tuple[str, ...] = ()
DAY = ("dt",)

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; its doubles are rounded so that engines can be compared."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: round_doubles(build(spark, sf_dir))
        return build

    return register


def _metrics(spark: SparkSession, sf: str, grain: Grain, by: tuple[str, ...]) -> DataFrame:
    return entity_metrics(tables.events_flat(spark, sf), grain, by, gathered=True)


def _snapshot(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    return tables.repo_snapshot(spark, sf) if grain is REPO else tables.org_snapshot(spark, sf)


def _candidates(spark: SparkSession, sf: str, grain: Grain, by: tuple[str, ...]) -> DataFrame:
    return select_candidates(stage(_metrics(spark, sf, grain, by)), grain, TOP_N, slice_cols=by)


def _mart(spark: SparkSession, sf: str, grain: Grain, by: tuple[str, ...]) -> DataFrame:
    return build_mart(_candidates(spark, sf, grain, by), _snapshot(spark, sf, grain), grain, by)


def _show_reasons(df: DataFrame) -> DataFrame:
    return df.withColumn("selection_reasons", F.array_join("selection_reasons", ","))


# --- sources and sinks --------------------------------------------------------------


def _written_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The events as gzip archive lines on shared storage, one directory per day."""
    lines = tables.raw_event_json(tables.events_flat(spark, sf)).select("dt", "value")
    path = shared_dir(spark)
    lines.hint("rebalance", "dt").write.partitionBy("dt").option("compression", "gzip").text(path)
    return read_raw_events(spark, path).drop("dt")


@query("raw_flatten_roundtrip")
def _(spark, sf):
    flat = with_event_slice(flatten_events(_written_raw(spark, sf)))
    return flat.select(*tables.events_flat(spark, sf).columns)


@query("raw_flatten_sparse_payload")
def _(spark, sf):
    flat = flatten_events(_written_raw(spark, sf))
    optional = (
        "payload_action",
        "payload_ref_type",
        "pull_request_id",
        "pull_request_merged",
        "issue_id",
        "comment_id",
        "release_id",
        "member_id",
        "org_id",
        "org_url",
    )
    return flat.groupBy("event_type").agg(
        F.count("*").alias("events"), *[F.count(c).alias(f"with_{c}") for c in optional]
    )


@query("slice_overwrite_idempotent")
def _(spark, sf):
    metrics = stage(_metrics(spark, sf, REPO, DAY))
    path = shared_dir(spark)
    write_slices(metrics, path, DAY)
    write_slices(metrics.where(F.col("dt") == ONE_SLICE[0]), path, DAY)
    return spark.read.parquet(path).groupBy("dt").agg(
        F.count("*").alias("entities"), F.sum("total_events").alias("total_events")
    )


@query("slice_emptied")
def _(spark, sf):
    """An hour that comes out empty is cleared, the others stay."""
    metrics = stage(_metrics(spark, sf, REPO, SLICE))
    path = shared_dir(spark)
    write_slices(metrics, path)
    write_slices(metrics.where(F.lit(False)), path, owned=[ONE_SLICE])
    return spark.read.parquet(path).groupBy(*SLICE).agg(
        F.count("*").alias("entities"), F.sum("total_events").alias("total_events")
    )


@query("slice_filter")
def _(spark, sf):
    path = shared_dir(spark)
    write_slices(tables.events_flat(spark, sf), path, DAY)
    return spark.read.parquet(path).where(in_slices([ONE_SLICE])).select("event_id", "event_type", "repo_id", *SLICE)


@query("slice_calendar_coverage")
def _(spark, sf):
    events = tables.events_flat(spark, sf).select(*SLICE)
    counts = stage(events.groupBy(*SLICE).agg(F.count("*").alias("events")))
    return calendar_of(counts).join(counts, list(SLICE), "left").na.fill({"events": 0})


@query("slice_calendar_range")
def _(spark, sf):
    """The hours of a range by the calendar, with or without events."""
    first, last = datetime.combine(FIRST_DAY, time(0)), datetime.combine(LAST_DAY, time(23))
    counts = tables.events_flat(spark, sf).groupBy(*SLICE).agg(F.count("*").alias("events"))
    return slice_calendar(spark, first, last).join(counts, list(SLICE), "left").na.fill({"events": 0})


def _bucketed(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    """Daily mart as a bucketed table, one day written twice, then summed up per entity."""
    table = f"{grain.name}_mart_{uuid.uuid4().hex[:12]}"
    path = shared_dir(spark)
    mart = stage(_mart(spark, sf, grain, DAY))
    write_bucketed(mart, grain, table, path, DAY)
    write_bucketed(mart.where(F.col("dt") == ONE_SLICE[0]), grain, table, path, DAY)
    return spark.table(table).groupBy(*grain.keys).agg(
        F.count("*").alias("slices"),
        F.sum("total_events").alias("total_events"),
        F.max("composite_score").alias("best_score"),
        F.sum(F.size("selection_reasons")).alias("reasons"),
    )


QUERIES["bucketed_repo_mart"] = lambda spark, sf: round_doubles(_bucketed(spark, sf, REPO))
QUERIES["bucketed_org_mart"] = lambda spark, sf: round_doubles(_bucketed(spark, sf, ORG))


@query("mart_contract_projection")
def _(spark, sf):
    extra = _mart(spark, sf, REPO, WHOLE).withColumn("not_in_contract", F.lit(1))
    return _show_reasons(project_contract(extra, mart_schema(REPO)))


# --- metrics ------------------------------------------------------------------------


@query("valid_repo_events")
def _(spark, sf):
    return valid_events(tables.events_flat(spark, sf), REPO).select("event_id", *REPO.keys)


@query("valid_org_events")
def _(spark, sf):
    return valid_events(tables.events_flat(spark, sf), ORG).select("event_id", *ORG.keys)


def _metric_queries(grain: Grain) -> None:
    counts = (*grain.keys, *grain.counts, "last_event_at")
    for suffix, by in (("", WHOLE), ("_daily", DAY), ("_hourly", SLICE)):

        @query(f"{grain.name}_metrics{suffix}")
        def _(spark, sf, by=by):
            return _metrics(spark, sf, grain, by).select(*by, *counts)

    for suffix, by in (("", WHOLE), ("_daily", DAY)):

        @query(f"{grain.name}_metrics{suffix}_from_hours")
        def _(spark, sf, by=by):
            """Derived from stored partials of hours; no event is read for the coarser slices."""
            events = tables.events_flat(spark, sf)
            sums, sets = stage(partials.hourly_sums(events, grain)), stage(partials.hourly_sets(events, grain))
            return partials.rolled_up(sums, sets, grain, by).select(*by, *counts, *SCORES)

    @query(f"{grain.name}_metric_ratios")
    def _(spark, sf):
        return _metrics(spark, sf, grain, WHOLE).select(*grain.keys, *EVENT_RATIOS)

    @query(f"{grain.name}_scores")
    def _(spark, sf):
        return _metrics(spark, sf, grain, WHOLE).select(*grain.keys, *SCORES)

    @query(f"{grain.name}_metric_topn_small")
    def _(spark, sf):
        return metric_leaders(stage(_metrics(spark, sf, grain, SLICE)), grain, SMALL_TOP_N)

    for suffix, by in (("", WHOLE), ("_hourly", SLICE)):

        @query(f"{grain.name}_metric_topn{suffix}")
        def _(spark, sf, by=by):
            return metric_leaders(stage(_metrics(spark, sf, grain, by)), grain, TOP_N, slice_cols=by)

        @query(f"{grain.name}_candidates{suffix}")
        def _(spark, sf, by=by):
            return _show_reasons(_candidates(spark, sf, grain, by))

        @query(f"{grain.name}_mart{suffix}")
        def _(spark, sf, by=by):
            return _show_reasons(_mart(spark, sf, grain, by))


_metric_queries(REPO)
_metric_queries(ORG)


@query("candidates_sparse_metrics")
def _(spark, sf):
    metrics = stage(_metrics(spark, sf, ORG, WHOLE).drop("repos_count"))
    return _show_reasons(
        select_candidates(metrics, ORG, SMALL_TOP_N, wanted=SPARSE_METRICS, slice_cols=WHOLE)
    ).select(*ORG.keys, "selection_reasons")


# --- profiles -----------------------------------------------------------------------

for _name in (
    "event_types_present",
    "event_type_pivot",
    "repo_actor_counts",
    "event_null_profile",
    "distinct_repos",
    "repo_bot_suffix",
):
    QUERIES[_name] = lambda spark, sf, build=getattr(profile, _name): round_doubles(
        build(tables.events_flat(spark, sf))
    )


@query("distinct_event_rows")
def _(spark, sf):
    mentioned = ("repo_id", "repo_full_name", "actor_id", "actor_login", "event_type", "is_public")
    return tables.events_flat(spark, sf).select(*mentioned).distinct()


@query("repo_comment_leaders")
def _(spark, sf):
    return profile.repo_comment_leaders(_metrics(spark, sf, REPO, WHOLE))


@query("mart_repo_rollup")
def _(spark, sf):
    return profile.mart_repo_rollup(_mart(spark, sf, REPO, SLICE))


@query("repo_owner_split")
def _(spark, sf):
    repos = valid_events(tables.events_flat(spark, sf), REPO).select(*REPO.keys).distinct()
    return repos.select(*REPO.keys, *enrichment.owner_and_name())


# --- enrichment ---------------------------------------------------------------------


def _responses(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    """Answers for the hourly candidates."""
    answers = tables.repo_responses if grain is REPO else tables.org_responses
    return answers(_candidates(spark, sf, grain, SLICE), _snapshot(spark, sf, grain))


@query("enrich_split_counts")
def _(spark, sf):
    """Rows per output of the split, repositories and organizations together."""
    parts = []
    for grain in (REPO, ORG):
        responses = stage(_responses(spark, sf, grain))
        enrichment.require_no_fatal(responses)
        outputs = {
            f"{grain.name}_snapshot": enrichment.snapshots(responses, grain),
            f"{grain.name}_snapshot_errors": enrichment.errors(responses, grain),
        }
        if grain is REPO:
            outputs["repo_topics"] = enrichment.topics(responses)
        for name, frame in outputs.items():
            path = shared_dir(spark)
            write_slices(frame, path, DAY)
            stored = spark.read.schema(frame.schema).parquet(path)
            parts.append(stored.groupBy("dt").agg(F.count("*").alias("rows")).withColumn("output", F.lit(name)))
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    return counted


@query("enrich_route_counts")
def _(spark, sf):
    """All routes: the customer's market segment decides the status of its repository."""
    segments = tables.table(spark, sf, "customer")
    status = (
        F.when(F.col("c_mktsegment") == "BUILDING", 200)
        .when(F.col("c_mktsegment") == "AUTOMOBILE", 404)
        .when(F.col("c_mktsegment") == "MACHINERY", 401)
        .when(F.col("c_mktsegment") == "HOUSEHOLD", 403)
        .otherwise(F.when(F.col("c_acctbal") < 0, 500).otherwise(429))
    )
    routed = segments.select(status.alias("status_code")).withColumn("route", enrichment.route(F.col("status_code")))
    return routed.groupBy("status_code", "route").agg(F.count("*").alias("answers"))


@query("enrich_repo_snapshot")
def _(spark, sf):
    return enrichment.snapshots(_responses(spark, sf, REPO), REPO)


@query("enrich_org_snapshot")
def _(spark, sf):
    return enrichment.snapshots(_responses(spark, sf, ORG), ORG)


@query("enrich_resume")
def _(spark, sf):
    """Two loads, the second with what the first left open: the same as one load."""
    responses, layout = stage(_responses(spark, sf, REPO)), Layout(shared_dir(spark))
    first = F.pmod(F.xxhash64("entity"), F.lit(3)) > 0
    nobody = responses.where(F.lit(False))
    enrich(spark, layout, responses.where(first), nobody)
    stored = spark.read.parquet(layout.path("bronze", "repo_snapshot")).select(F.col("repo_full_name").alias("entity"), *SLICE)
    enrich(spark, layout, responses.join(stored, ["entity", *SLICE], "left_anti").select(responses.columns), nobody)
    contract = enrichment.snapshots(responses, REPO)
    return spark.read.parquet(layout.path("bronze", "repo_snapshot")).select(contract.columns)


@query("enrich_errors")
def _(spark, sf):
    return enrichment.errors(_responses(spark, sf, REPO), REPO)


@query("enrich_org_errors")
def _(spark, sf):
    return enrichment.errors(_responses(spark, sf, ORG), ORG)


@query("enrich_repo_topics")
def _(spark, sf):
    return enrichment.topics(_responses(spark, sf, REPO))


def _pending(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    answers = tables.repo_responses if grain is REPO else tables.org_responses
    candidates = stage(_candidates(spark, sf, grain, SLICE))
    responses = answers(candidates, _snapshot(spark, sf, grain))
    return enrichment.pending(candidates, responses, grain).select(*SLICE, *grain.keys)


QUERIES["enrich_pending_repos"] = lambda spark, sf: _pending(spark, sf, REPO)
QUERIES["enrich_pending_orgs"] = lambda spark, sf: _pending(spark, sf, ORG)


@query("enrich_match_rate")
def _(spark, sf):
    return match_rate(_candidates(spark, sf, REPO, WHOLE), tables.repo_snapshot(spark, sf), REPO, WHOLE)


@query("enrich_snapshot_latest")
def _(spark, sf):
    """Each order is a repeated fetch of its customer's snapshot; the last one stays."""
    fetched = tables.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("repo_id"),
        F.col("o_orderdate").alias("api_fetched_at"),
        F.floor("o_totalprice").cast("bigint").alias("stargazers_count"),
        F.col("o_orderpriority").alias("language"),
        F.col("o_orderkey").alias("load_id"),
    )
    return latest_per_key(fetched, ["repo_id"], then=["load_id"])


# --- dashboards ---------------------------------------------------------------------


def _dashboard_queries() -> None:
    names = {"verified_distribution": "verified"}
    for grain, builders in ((REPO, dashboards.REPO_DASHBOARDS), (ORG, dashboards.ORG_DASHBOARDS)):
        for dataset, build in builders.items():

            @query(f"dash_{grain.name}_{names.get(dataset, dataset)}")
            def _(spark, sf, build=build, grain=grain):
                extra = {"as_of": AS_OF} if build is dashboards.repo_freshness else {}
                return build(_mart(spark, sf, grain, WHOLE), **extra)

            @query(f"dash_{grain.name}_{names.get(dataset, dataset)}_hourly")
            def _(spark, sf, build=build, grain=grain):
                extra = {"as_of": AS_OF} if build is dashboards.repo_freshness else {}
                return build(_mart(spark, sf, grain, SLICE), SLICE, **extra)

    common = {"rollup": "summary", "language_location": "language_location", "verified": "verified"}
    for name, dataset in common.items():
        build = dashboards.COMMON_DASHBOARDS[dataset]

        @query(f"dash_common_{name}")
        def _(spark, sf, build=build):
            return build(_mart(spark, sf, REPO, WHOLE), _mart(spark, sf, ORG, WHOLE))

        @query(f"dash_common_{name}_hourly")
        def _(spark, sf, build=build):
            return build(_mart(spark, sf, REPO, SLICE), _mart(spark, sf, ORG, SLICE), SLICE)


_dashboard_queries()


# --- pages --------------------------------------------------------------------------


_stored: dict[tuple[str, str, str], Layout] = {}


def _store(spark: SparkSession, sf: str, name: str) -> Layout:
    """Write one dashboard summary of the whole history, as the batch does."""
    layout = Layout(shared_dir(spark))
    path = layout.path("dashboards", name)
    if name == reports.REPOSITORIES:
        write_slices(require_contract(dashboards.repo_summary(_mart(spark, sf, REPO, SLICE), SLICE), name), path)
    elif name == reports.ORGANIZATIONS:
        write_slices(require_contract(dashboards.org_summary(_mart(spark, sf, ORG, SLICE), SLICE), name), path)
    else:
        dashboards.common_rollup(_mart(spark, sf, REPO, WHOLE), _mart(spark, sf, ORG, WHOLE)).write.parquet(path)
    return layout


def _dashboards_of(spark: SparkSession, sf: str, name: str) -> Layout:
    """Where a summary is stored: written by the first page of an application that asks for it."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stored or not children(spark, _stored[key].path("dashboards", name)):
        _stored[key] = _store(spark, sf, name)
    return _stored[key]


for _grain, _name in ((REPO, reports.REPOSITORIES), (ORG, reports.ORGANIZATIONS)):

    @query(f"report_store_{_grain.name}_summary")
    def _(spark, sf, name=_name):
        """The summary is written anew and read by its days."""
        path = _store(spark, sf, name).path("dashboards", name)
        stored = read_days(spark, path, FIRST_DAY, LAST_DAY, DASHBOARDS[name])
        return stored.groupBy(*SLICE).agg(F.count("*").alias("entities"), F.sum("total_events").alias("total_events"))


def _repo_page(spark: SparkSession, sf: str) -> DataFrame:
    return reports.repository_page(spark, _dashboards_of(spark, sf, reports.REPOSITORIES), FIRST_DAY, LAST_DAY)


def _org_page(spark: SparkSession, sf: str) -> DataFrame:
    return reports.organization_page(spark, _dashboards_of(spark, sf, reports.ORGANIZATIONS), FIRST_DAY, LAST_DAY)


def _common_page(spark: SparkSession, sf: str) -> DataFrame:
    return reports.common_page(spark, _dashboards_of(spark, sf, reports.COMMON))


def _page_queries() -> None:
    def loaded(frame: DataFrame) -> DataFrame:
        return frame

    repo = {
        "page_repo_summary": loaded,
        "page_repo_table": pages.repo_table,
        "page_repo_top_n": lambda frame: pages.repo_top_n(frame, PAGE_TOP_N),
        "page_repo_language": pages.repo_language,
        "page_repo_timeline": pages.repo_timeline,
        "page_repo_push_vs_pr": pages.repo_push_vs_pr,
    }
    org = {
        "page_org_summary": loaded,
        "page_org_table": pages.org_table,
        "page_org_top_n": lambda frame: pages.org_top_n(frame, PAGE_TOP_N),
        "page_org_location": pages.org_location,
        "page_org_verified": pages.org_verified,
        "page_org_timeline": pages.org_timeline,
        "page_org_quality": pages.org_quality,
    }
    common = {
        "page_common_summary": loaded,
        "page_common_table": pages.common_table,
        "page_common_location_language": pages.common_location_language,
        "page_common_scatter": pages.common_scatter,
    }
    for source, builders in ((_repo_page, repo), (_org_page, org), (_common_page, common)):
        for name, build in builders.items():

            @query(name)
            def _(spark, sf, source=source, build=build):
                return build(source(spark, sf))


_page_queries()
