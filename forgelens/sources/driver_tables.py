"""The engine's input tables, derived from the star-schema test tables.

``events`` plays the activity stream, a ``customer`` is a repository, its ``nation`` is the
owning organization, and ``orders`` and ``supplier`` feed the snapshot attributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelens.contracts import EVENT_COUNTS, EVENT_TYPES
from forgelens.functions.expressions import slice_start

# Source event type -> the three event types it stands for, chosen by the remainder of k.
EVENT_TYPE_BY_SOURCE = {
    "click": ("PushEvent", "CreateEvent", "DeleteEvent"),
    "view": ("WatchEvent", "ForkEvent", "PublicEvent"),
    "purchase": ("PullRequestEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent"),
    "error": ("IssuesEvent", "IssueCommentEvent", "CommitCommentEvent"),
    "signup": ("ReleaseEvent", "MemberEvent", "GollumEvent"),
}
COMMENT_TYPES = ("IssueCommentEvent", "CommitCommentEvent", "PullRequestReviewCommentEvent")
# Repositories of an account in debit, and organizations with a supplier this far in debit,
# are unknown to the metadata service.
ORG_DEBIT_LIMIT = -500.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_type() -> str:
    cases = " ".join(
        f"WHEN '{source}' THEN element_at(array('{a}', '{b}', '{c}'), CAST(k % 3 AS INT) + 1)"
        for source, (a, b, c) in EVENT_TYPE_BY_SOURCE.items()
    )
    return f"CASE event_type {cases} END"


def events_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = ", ".join(f"'{t}'" for t in COMMENT_TYPES)
    raw = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id", "event_type", "value", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k"
    )
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS user_id", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name", "n_regionkey")
    joined = (
        raw.selectExpr("*", f"{_event_type()} AS kind")
        .join(customer, "user_id", "left")
        .join(nation, "c_nationkey", "left")
    )
    return joined.selectExpr(
        "event_id",
        "kind AS event_type",
        "ts AS created_at",
        "user_id AS repo_id",
        "CASE WHEN user_id % 25 = 24 THEN c_name ELSE concat(n_name, '/', c_name) END AS repo_full_name",
        "k AS actor_id",
        "concat('user', CAST(k AS STRING), CASE WHEN k % 10 = 0 THEN '[bot]' ELSE '' END) AS actor_login",
        "CASE WHEN n_regionkey != 0 THEN CAST(c_nationkey AS BIGINT) END AS org_id",
        "CASE WHEN n_regionkey != 0 THEN n_name END AS org_login",
        "value >= 10 AS is_public",
        "CASE WHEN kind = 'PullRequestEvent' THEN value >= 50 END AS pull_request_merged",
        "CASE WHEN event_type = 'error' THEN event_id % 97 END AS issue_id",
        f"CASE WHEN kind IN ({comments}) THEN event_id END AS comment_id",
        "CASE WHEN kind = 'ReleaseEvent' THEN event_id % 53 END AS release_id",
        "CAST(ts AS DATE) AS dt",
        "CAST(hour(ts) AS INT) AS hr",
    )


def repo_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.expr("count_if(o_orderstatus = 'O') AS open_orders"),
            F.expr("min(o_orderdate) AS first_order"),
            F.expr("max(o_orderdate) AS last_order"),
        )
    )
    customer = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    return (
        customer.join(nation, "c_nationkey")
        .join(activity, "c_custkey", "left")
        .selectExpr(
            "c_custkey AS repo_id",
            "concat(n_name, '/', c_name) AS repo_full_name",
            "c_name AS repo_name",
            "n_name AS owner_login",
            "CAST(c_nationkey AS BIGINT) AS owner_id",
            "CASE c_custkey % 3 WHEN 0 THEN 'Organization' WHEN 1 THEN 'User' END AS owner_type",
            "nullif(c_mktsegment, 'BUILDING') AS language",
            "CASE WHEN c_custkey % 6 != 5 THEN 'public' END AS visibility",
            "CASE WHEN c_custkey % 7 != 6 THEN c_custkey % 4 = 0 END AS is_fork",
            "c_custkey % 10 = 9 AS is_archived",
            "false AS is_disabled",
            "CAST(floor(c_acctbal) AS BIGINT) AS stargazers_count",
            "CAST(floor(c_acctbal / 10) AS BIGINT) AS forks_count",
            "CAST(floor(c_acctbal) AS BIGINT) AS watchers_count",
            "c_custkey % 50 AS subscribers_count",
            "coalesce(open_orders, 0) AS open_issues_count",
            "first_order AS created_at",
            "last_order AS pushed_at",
        )
    )


def org_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = (
        table(spark, sf_dir, "supplier")
        .groupBy(F.col("s_nationkey").alias("n_nationkey"))
        .agg(
            F.expr("count(*) AS public_repos"),
            F.expr("sum(CAST(floor(abs(s_acctbal)) AS BIGINT)) AS followers"),
            F.expr("min(s_acctbal) AS lowest"),
        )
        .where(F.col("lowest") >= ORG_DEBIT_LIMIT)
    )
    region = table(spark, sf_dir, "region").selectExpr("r_regionkey AS n_regionkey", "r_name")
    return (
        table(spark, sf_dir, "nation")
        .join(region, "n_regionkey")
        .join(members, "n_nationkey")
        .selectExpr(
            "CAST(n_nationkey AS BIGINT) AS org_id",
            "n_name AS org_login",
            "concat('Org ', n_name) AS org_name",
            "CASE WHEN n_nationkey % 5 != 4 THEN r_name END AS location",
            "CASE WHEN n_nationkey % 4 != 3 THEN concat('Company ', CAST(n_regionkey AS STRING)) END AS company",
            "CASE WHEN n_nationkey % 2 = 0 THEN concat('https://example.test/', n_name) END AS blog",
            "CASE WHEN n_nationkey % 3 = 0 THEN concat(n_name, '@example.test') END AS email",
            "CASE WHEN n_nationkey % 4 = 0 THEN n_name END AS twitter_username",
            "CASE n_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_verified",
            "true AS has_organization_projects",
            "n_nationkey % 2 = 1 AS has_repository_projects",
            "public_repos",
            "CAST(n_nationkey % 7 AS BIGINT) AS public_gists",
            "followers",
            "CAST(n_regionkey AS BIGINT) AS following",
        )
    )


def _iso(value: str) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def raw_event_json(events: DataFrame) -> DataFrame:
    """The flat events as archive lines; parts an event lacks are absent from its line."""

    def part(name: str, *fields: Column) -> Column:
        return F.when(F.col(f"{name}_id").isNotNull(), F.struct(F.col(f"{name}_id").alias("id"), *fields)).alias(name)

    is_pull = F.col("pull_request_merged").isNotNull()
    pull = F.when(is_pull, F.struct(F.col("pull_request_merged").alias("merged"))).alias("pull_request")
    line = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        F.col("is_public").alias("public"),
        F.struct(F.col("repo_id").alias("id"), F.col("repo_full_name").alias("name")).alias("repo"),
        F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login")).alias("actor"),
        part("org", F.col("org_login").alias("login")),
        F.struct(pull, part("issue"), part("comment"), part("release")).alias("payload"),
    )
    return events.select("dt", "hr", F.to_json(line).alias("value"))


def _answers(found: Column, payload: Column) -> list[Column]:
    gone = F.lit('{"message":"Not Found"}')
    return [
        F.when(found, F.lit(200)).otherwise(F.lit(404)).alias("status_code"),
        F.when(found, F.to_json(payload)).otherwise(gone).alias("payload"),
        F.timestamp_add("MINUTE", F.lit(5), slice_start(F.col("dt"), F.col("hr"))).alias("fetched_at"),
        *[F.lit(None).cast("string").alias(h) for h in ("retry_after", "reset_at", "remaining")],
        F.col("dt"),
        F.col("hr"),
    ]


def repo_responses(candidates: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One answer per candidate and slice; topics are the event types seen in the slice."""
    known = snapshot.select(F.col("repo_id"), F.struct(*[c for c in snapshot.columns if c != "repo_id"]).alias("s"))
    seen = [F.when(F.col(c) > 0, F.lower(F.lit(t))) for t, c in zip(EVENT_TYPES, EVENT_COUNTS)]
    payload = F.struct(
        F.col("repo_id").alias("id"),
        F.col("s.repo_full_name").alias("full_name"),
        F.col("s.repo_name").alias("name"),
        F.struct(
            F.col("s.owner_login").alias("login"),
            F.col("s.owner_id").alias("id"),
            F.col("s.owner_type").alias("type"),
        ).alias("owner"),
        F.col("s.language").alias("language"),
        F.col("s.visibility").alias("visibility"),
        F.col("s.is_fork").alias("fork"),
        F.col("s.is_archived").alias("archived"),
        F.col("s.is_disabled").alias("disabled"),
        *[
            F.col(f"s.{c}").alias(c)
            for c in ("stargazers_count", "forks_count", "watchers_count", "subscribers_count", "open_issues_count")
        ],
        _iso("s.created_at").alias("created_at"),
        _iso("s.pushed_at").alias("pushed_at"),
        F.array_compact(F.array(*seen)).alias("topics"),
    )
    joined = candidates.join(known, "repo_id", "left")
    return joined.select(F.col("repo_full_name").alias("entity"), *_answers(F.col("s").isNotNull(), payload))


def org_responses(candidates: DataFrame, snapshot: DataFrame) -> DataFrame:
    known = snapshot.select(F.col("org_id"), F.struct(*[c for c in snapshot.columns if c != "org_id"]).alias("s"))
    same = [c for c in snapshot.columns if c not in ("org_id", "org_login", "org_name")]
    payload = F.struct(
        F.col("org_id").alias("id"),
        F.col("s.org_login").alias("login"),
        F.col("s.org_name").alias("name"),
        *[F.col(f"s.{c}").alias(c) for c in same],
    )
    joined = candidates.join(known, "org_id", "left")
    return joined.select(F.col("org_login").alias("entity"), *_answers(F.col("s").isNotNull(), payload))
