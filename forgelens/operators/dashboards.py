"""The 18 dashboard datasets, each a function of the curated marts.

``by`` names the slice columns to report on: none for one slice or a whole range, dt and
hr to build every hour's dataset in one job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelens.functions.expressions import bucket, flag, or_unknown

Slices = Sequence[str]

# Upper limits and labels of the published buckets.
FRESHNESS = ((7, "0-7d"), (30, "8-30d"), (90, "31-90d"))
STALE = "90d+"
ORG_SIZES = ((5, "1-5"), (20, "6-20"), (100, "21-100"))
LARGEST = "100+"
# Event counts shown in the event type distribution.
SHOWN_EVENTS = (
    "push_events",
    "pull_request_events",
    "issue_comment_events",
    "issues_events",
    "fork_events",
    "watch_events",
)
TOP = 100


def _maxima(*names: str) -> list[Column]:
    return [F.max(n).alias(n) for n in names]


def _sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _averages(*names: str) -> list[Column]:
    return [F.avg(n).alias(f"avg_{n}") for n in names]


def _distribution(mart: DataFrame, by: Slices, keys: list[Column], count: str, *more: Column) -> DataFrame:
    return mart.groupBy(*by, *keys).agg(F.count("*").alias(count), *more)


def _top(mart: DataFrame, by: Slices, tie_break: str, columns: Sequence[str]) -> DataFrame:
    order = [F.desc("composite_score"), F.desc("total_events"), F.asc(tie_break)]
    if not by:
        return mart.orderBy(*order).limit(TOP).select(*columns)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return mart.withColumn("_place", place).where(F.col("_place") <= TOP).select(*by, *columns)


# --- repositories -------------------------------------------------------------------


def repo_summary(mart: DataFrame, by: Slices = ()) -> DataFrame:
    return mart.groupBy(*by, "repo_id", "repo_full_name").agg(
        *_maxima("repo_name", "owner_login", "owner_type", "language", "visibility"),
        *_maxima("is_fork", "is_archived", "is_disabled"),
        *_maxima("stargazers_count", "forks_count", "watchers_count", "subscribers_count", "open_issues_count"),
        *_sums("total_events", "push_events", "pull_request_events", "issue_comment_events", "fork_events"),
        *_averages("composite_score", "bot_ratio"),
    )


def repo_language(mart: DataFrame, by: Slices = ()) -> DataFrame:
    return _distribution(
        mart,
        by,
        [or_unknown("language")],
        "repo_count",
        *_sums("total_events"),
        *_averages("composite_score"),
        F.sum("stargazers_count").alias("total_stargazers"),
    )


def repo_owner(mart: DataFrame, by: Slices = ()) -> DataFrame:
    return _distribution(
        mart, by, [or_unknown("owner_type")], "repo_count", *_sums("total_events"), *_averages("composite_score")
    )


def repo_visibility(mart: DataFrame, by: Slices = ()) -> DataFrame:
    return _distribution(mart, by, [or_unknown("visibility")], "repo_count", *_sums("total_events"))


def repo_fork(mart: DataFrame, by: Slices = ()) -> DataFrame:
    status = flag(F.col("is_fork"), "fork", "original").alias("fork_status")
    return _distribution(mart, by, [status], "repo_count", *_sums("total_events"), *_averages("composite_score"))


def repo_freshness(mart: DataFrame, by: Slices = (), as_of: date | None = None) -> DataFrame:
    """Repositories by days since the last push, seen from ``as_of`` (today if not given)."""
    today = F.lit(as_of) if as_of else F.current_date()
    age = F.date_diff(today, F.col("pushed_at"))
    freshness = bucket(age, FRESHNESS, STALE).alias("freshness_bucket")
    return _distribution(mart, by, [freshness], "repo_count", *_sums("total_events"))


def repo_event_type(mart: DataFrame, by: Slices = ()) -> DataFrame:
    totals = mart.groupBy(*by).agg(*_sums(*SHOWN_EVENTS))
    return totals.unpivot(list(by), list(SHOWN_EVENTS), "event_type", "event_count")


def repo_top_100(mart: DataFrame, by: Slices = ()) -> DataFrame:
    columns = [
        "repo_id",
        "repo_full_name",
        "owner_login",
        "language",
        "total_events",
        "unique_actors",
        "composite_score",
        "stargazers_count",
        "forks_count",
    ]
    return _top(mart, by, "repo_id", columns)


# --- organizations ------------------------------------------------------------------


def org_summary(mart: DataFrame, by: Slices = ()) -> DataFrame:
    return mart.groupBy(*by, "org_id", "org_login").agg(
        *_maxima("org_name", "location", "company", "blog", "email", "twitter_username"),
        *_maxima("is_verified", "has_organization_projects", "has_repository_projects"),
        *_maxima("public_repos", "public_gists", "followers", "following"),
        *_sums("total_events", "push_events", "pull_request_events"),
        *_averages("composite_score", "bot_ratio"),
    )


def org_company(mart: DataFrame, by: Slices = ()) -> DataFrame:
    return _distribution(mart, by, [or_unknown("company")], "org_count", *_sums("total_events"))


def org_location(mart: DataFrame, by: Slices = ()) -> DataFrame:
    return _distribution(
        mart, by, [or_unknown("location")], "org_count", *_sums("total_events"), *_averages("followers")
    )


def org_size(mart: DataFrame, by: Slices = ()) -> DataFrame:
    size = bucket(F.col("repos_count"), ORG_SIZES, LARGEST).alias("size_bucket")
    return _distribution(mart, by, [size], "org_count", *_sums("total_events"), *_averages("followers"))


def org_social(mart: DataFrame, by: Slices = ()) -> DataFrame:
    channels = {"twitter": "twitter_username", "blog": "blog", "email": "email"}
    flags = [
        flag(F.col(column).isNotNull(), f"has_{name}", f"no_{name}").alias(f"{name}_status")
        for name, column in channels.items()
    ]
    return _distribution(mart, by, flags, "org_count")


def _verification(is_verified: Column) -> Column:
    return flag(is_verified, "verified", "not_verified").alias("verification_status")


def org_verified(mart: DataFrame, by: Slices = ()) -> DataFrame:
    return _distribution(
        mart,
        by,
        [_verification(F.col("is_verified"))],
        "org_count",
        *_sums("total_events"),
        *_averages("composite_score"),
    )


def org_top_100(mart: DataFrame, by: Slices = ()) -> DataFrame:
    columns = [
        "org_id",
        "org_login",
        "org_name",
        "location",
        "public_repos",
        "followers",
        "repos_count",
        "total_events",
        "composite_score",
    ]
    return _top(mart, by, "org_id", columns)


# --- repositories with their owners -------------------------------------------------


def _with_owner(repos: DataFrame, orgs: DataFrame, by: Slices, attributes: Sequence[Column]) -> DataFrame:
    """Left join on the owner's login; repositories without owner stay, unmatched.

    Those don't go through the join: their common null key would bring them into one task.
    """
    owners = orgs.select(*by, F.col("org_login").alias("owner_login"), *attributes)
    owned = repos.where("owner_login IS NOT NULL").join(owners, [*by, "owner_login"], "left")
    return owned.unionByName(repos.where("owner_login IS NULL"), allowMissingColumns=True)


def _per_owner(repos: DataFrame, by: Slices, *more: str) -> DataFrame:
    """Repositories summed up per owner before the join.

    A frequent owner, or the many repositories without one, would otherwise meet in one
    join partition. Counts and sums add up again after the join.
    """
    return repos.groupBy(*by, "owner_login", *more).agg(
        F.count("*").alias("_repos"),
        F.sum("total_events").alias("_events"),
        F.sum("composite_score").alias("_score"),
        F.count("composite_score").alias("_scored"),
    )


def common_rollup(repos: DataFrame, orgs: DataFrame, by: Slices = ()) -> DataFrame:
    attributes = {
        "org_id": "org_id",
        "org_name": "org_name",
        "location": "org_location",
        "company": "org_company",
        "followers": "org_followers",
        "public_repos": "org_public_repos",
        "is_verified": "org_is_verified",
    }
    joined = _with_owner(repos, orgs, by, [F.col(c).alias(a) for c, a in attributes.items()])
    return joined.groupBy(*by, "repo_id", "repo_full_name").agg(
        *_maxima("repo_name", "owner_login", "language"),
        F.sum("total_events").alias("repo_total_events"),
        F.avg("composite_score").alias("repo_avg_composite_score"),
        *_maxima("stargazers_count", *attributes.values()),
    )


def common_language_location(repos: DataFrame, orgs: DataFrame, by: Slices = ()) -> DataFrame:
    joined = _with_owner(_per_owner(repos, by, "language"), orgs, by, [F.col("location").alias("org_location")])
    return joined.groupBy(*by, or_unknown("language"), or_unknown("org_location")).agg(
        F.sum("_repos").alias("repo_count"), F.sum("_events").alias("total_events")
    )


def common_verified(repos: DataFrame, orgs: DataFrame, by: Slices = ()) -> DataFrame:
    joined = _with_owner(_per_owner(repos, by), orgs, by, [F.col("is_verified")])
    scored = F.sum("_scored")
    return joined.groupBy(*by, _verification(F.col("is_verified"))).agg(
        F.sum("_repos").alias("repo_count"),
        F.sum("_events").alias("total_events"),
        F.when(scored > 0, F.sum("_score") / scored).alias("avg_repo_score"),
    )


REPO_DASHBOARDS: dict[str, Callable[..., DataFrame]] = {
    "summary": repo_summary,
    "language": repo_language,
    "owner": repo_owner,
    "visibility": repo_visibility,
    "fork": repo_fork,
    "freshness": repo_freshness,
    "event_type": repo_event_type,
    "top_100": repo_top_100,
}
ORG_DASHBOARDS: dict[str, Callable[..., DataFrame]] = {
    "summary": org_summary,
    "company": org_company,
    "location": org_location,
    "size": org_size,
    "social": org_social,
    "verified_distribution": org_verified,
    "top_100": org_top_100,
}
COMMON_DASHBOARDS: dict[str, Callable[..., DataFrame]] = {
    "summary": common_rollup,
    "language_location": common_language_location,
    "verified": common_verified,
}
