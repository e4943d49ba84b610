"""Registered queries against their SQL. ``tools/check_oracles.py`` does the same for all of them."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracles import TABLES, difference

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "raw_flatten_roundtrip",
    "slice_calendar_coverage",
    "repo_metrics",
    "org_scores",
    "repo_mart_hourly",
    "org_mart",
    "mart_contract_projection",
    "event_type_pivot",
    "enrich_repo_snapshot",
    "enrich_resume",
    "enrich_org_errors",
    "enrich_repo_topics",
    "slice_emptied",
    "org_metric_topn_small",
    "dash_repo_top_100_hourly",
    "dash_common_rollup",
    "dash_common_language_location_hourly",
    "page_org_quality",
    "page_common_summary",
]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert contract.queries().keys() - contract.LLM_QUERIES.keys() == contract.oracle_sql().keys() - contract.LLM_ORACLES.keys()
    assert contract.LLM_ORACLES.keys() <= contract.LLM_QUERIES.keys()


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, database, name):
    got = contract.queries()[name](spark, SF).toArrow()
    assert difference(got, database.sql(contract.oracle_sql()[name]).to_arrow_table()) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
