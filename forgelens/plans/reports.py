"""The report pages' inputs, read from the stored dashboards.

A page never starts from events: it reads the summary tables that the batch wrote, for a range of
days only. The days of the table are told by one storage call, the directories of the range are
named, and the date filter prunes partitions; a page of one week reads its 168 slices however long
the history is.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from forgelens.contracts import DASHBOARDS
from forgelens.operators import pages
from forgelens.plans.slices import Layout
from forgelens.sources.raw import read_days

REPOSITORIES, ORGANIZATIONS, COMMON = "repositories/summary", "organizations/summary", "common/summary"


def _days_of(spark: SparkSession, layout: Layout, name: str, start: date, end: date) -> DataFrame:
    contract = DASHBOARDS[name]
    return read_days(spark, layout.path("dashboards", name), start, end, contract).select(contract.fieldNames())


def repository_page(spark: SparkSession, layout: Layout, start: date, end: date) -> DataFrame:
    """Stored repository summaries of the days from ``start`` to ``end``, both included; missing text has its default."""
    return pages.load_repo_summary(_days_of(spark, layout, REPOSITORIES, start, end), start, end)


def organization_page(spark: SparkSession, layout: Layout, start: date, end: date) -> DataFrame:
    """Stored organization summaries of the days from ``start`` to ``end``, both included."""
    return pages.load_org_summary(_days_of(spark, layout, ORGANIZATIONS, start, end), start, end)


def common_page(spark: SparkSession, layout: Layout) -> DataFrame:
    """All stored rows of repositories with their owners: this page has no range of days."""
    names = [f.name for f in DASHBOARDS[COMMON].fields]
    stored = spark.read.parquet(layout.path("dashboards", COMMON))
    return pages.load_common_summary(stored.select(*[c for c in names if c in stored.columns]))
