"""Expected results of every query as SQL over the star-schema tables (DuckDB dialect).

The statements are written from the definitions of the metrics, not from the Spark plans:
plain distinct counts, window ranks per metric, joins and group-bys.
"""

from __future__ import annotations

import re

from forgelens.contracts import (
    EVENT_COUNTS,
    EVENT_RATIOS,
    EVENT_TYPES,
    ORG,
    REPO,
    SCORES,
    Grain,
    mart_schema,
)
from forgelens.plans.queries import (
    AS_OF,
    FIRST_DAY,
    LAST_DAY,
    ONE_SLICE,
    PAGE_TOP_N,
    SMALL_TOP_N,
    TOP_N,
)
from forgelens.sources.driver_tables import COMMENT_TYPES, EVENT_TYPE_BY_SOURCE, ORG_DEBIT_LIMIT

# Fixed values, written out here so that a wrong one in the engine shows.
FRESHNESS = (
    (7, "0-7d"),
    (30, "8-30d"),
    (90, "31-90d"),
)
STALE = "90d+"
ORG_SIZES = (
    (5, "1-5"),
    (20, "6-20"),
    (100, "21-100"),
)
LARGEST = "100+"
SHOWN_EVENTS = (
    "push_events",
    "pull_request_events",
    "issue_comment_events",
    "issues_events",
    "fork_events",
    "watch_events",
)
REPO_DEFAULTS = {
    "language": "Unknown",
    "repo_full_name": "Unknown repository",
}
ORG_DEFAULTS = {
    "org_login": "Unknown organization",
    "org_name": "Unknown organization",
    "location": "Unknown",
    "company": "Unknown",
}
COMMON_DEFAULTS = {
    "repo_full_name": "Unknown repository",
    "repo_name": "Unknown repository",
    "owner_login": "Unknown owner",
    "language": "Unknown",
    "org_name": "Independent owner",
    "org_location": "Unknown",
    "org_company": "Unknown",
    "org_is_verified": False,
}
COMMON_NUMBERS = (
    "repo_total_events",
    "repo_avg_composite_score",
    "stargazers_count",
    "org_followers",
    "org_public_repos",
)
REPO_TABLE = (
    "dt",
    "hr",
    "repo_full_name",
    "repo_name",
    "owner_login",
    "language",
    "visibility",
    "total_events",
    "push_events",
    "pull_request_events",
    "stargazers_count",
    "forks_count",
    "watchers_count",
    "avg_composite_score",
    "avg_bot_ratio",
)
ORG_TABLE = (
    "dt",
    "hr",
    "org_login",
    "org_name",
    "location",
    "company",
    "is_verified",
    "total_events",
    "push_events",
    "pull_request_events",
    "public_repos",
    "followers",
    "avg_composite_score",
    "avg_bot_ratio",
)
COMMON_TABLE = (
    "repo_full_name",
    "owner_login",
    "language",
    "repo_total_events",
    "repo_avg_composite_score",
    "stargazers_count",
    "org_name",
    "org_location",
    "org_company",
    "org_followers",
    "org_public_repos",
    "org_is_verified",
)
SCATTER = (
    "stargazers_count",
    "repo_total_events",
    "org_followers",
    "language",
    "repo_full_name",
    "org_name",
    "org_location",
    "org_company",
    "repo_avg_composite_score",
)

BY = {"all": (), "day": ("dt",), "hour": ("dt", "hr")}
SNAPSHOT_COLUMNS = {
    "repo": (
        "repo_name",
        "owner_login",
        "owner_id",
        "owner_type",
        "language",
        "visibility",
        "is_fork",
        "is_archived",
        "is_disabled",
        "stargazers_count",
        "forks_count",
        "watchers_count",
        "subscribers_count",
        "open_issues_count",
        "created_at",
        "pushed_at",
    ),
    "org": (
        "org_name",
        "location",
        "company",
        "blog",
        "email",
        "twitter_username",
        "is_verified",
        "has_organization_projects",
        "has_repository_projects",
        "public_repos",
        "public_gists",
        "followers",
        "following",
    ),
}


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def comma(*names: str) -> str:
    return ", ".join(n for n in names if n)


def r(expression: str, name: str | None = None) -> str:
    return f"round({expression}, 6) AS {name or expression}"


def big(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def rounded(columns) -> list[str]:
    return [r(c) if c in EVENT_RATIOS + SCORES else c for c in columns]


# --- common table expressions -------------------------------------------------------


def _flat() -> str:
    types = "\n".join(
        f"    WHEN raw_type = '{source}' THEN CASE k % 3 WHEN 0 THEN '{a}' WHEN 1 THEN '{b}' ELSE '{c}' END"
        for source, (a, b, c) in EVENT_TYPE_BY_SOURCE.items()
    )
    return f"""
  SELECT t.event_id, t.event_type, t.ts AS created_at, t.user_id AS repo_id,
    CASE WHEN t.user_id % 25 = 24 THEN c.c_name ELSE n.n_name || '/' || c.c_name END AS repo_full_name,
    t.k AS actor_id,
    'user' || CAST(t.k AS VARCHAR) || CASE WHEN t.k % 10 = 0 THEN '[bot]' ELSE '' END AS actor_login,
    CASE WHEN n.n_regionkey <> 0 THEN CAST(n.n_nationkey AS BIGINT) END AS org_id,
    CASE WHEN n.n_regionkey <> 0 THEN n.n_name END AS org_login,
    t.value >= 10 AS is_public,
    CASE WHEN t.event_type = 'PullRequestEvent' THEN t.value >= 50 END AS pull_request_merged,
    CASE WHEN t.raw_type = 'error' THEN t.event_id % 97 END AS issue_id,
    CASE WHEN t.event_type IN ({quoted(COMMENT_TYPES)}) THEN t.event_id END AS comment_id,
    CASE WHEN t.event_type = 'ReleaseEvent' THEN t.event_id % 53 END AS release_id,
    CAST(t.ts AS DATE) AS dt, CAST(hour(t.ts) AS INTEGER) AS hr
  FROM (
    SELECT e.*, CASE
{types}
    END AS event_type
    FROM (
      SELECT event_id, ts, user_id, event_type AS raw_type, value,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
      FROM events
    ) e
  ) t
  LEFT JOIN customer c ON t.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""


_REPO_SNAP = """
  SELECT c.c_custkey AS repo_id, n.n_name || '/' || c.c_name AS repo_full_name, c.c_name AS repo_name,
    n.n_name AS owner_login, CAST(n.n_nationkey AS BIGINT) AS owner_id,
    CASE c.c_custkey % 3 WHEN 0 THEN 'Organization' WHEN 1 THEN 'User' END AS owner_type,
    NULLIF(c.c_mktsegment, 'BUILDING') AS language,
    CASE WHEN c.c_custkey % 6 <> 5 THEN 'public' END AS visibility,
    CASE WHEN c.c_custkey % 7 <> 6 THEN c.c_custkey % 4 = 0 END AS is_fork,
    c.c_custkey % 10 = 9 AS is_archived, FALSE AS is_disabled,
    CAST(floor(c.c_acctbal) AS BIGINT) AS stargazers_count,
    CAST(floor(c.c_acctbal / 10) AS BIGINT) AS forks_count,
    CAST(floor(c.c_acctbal) AS BIGINT) AS watchers_count,
    c.c_custkey % 50 AS subscribers_count,
    COALESCE(o.open_orders, 0) AS open_issues_count, o.first_order AS created_at, o.last_order AS pushed_at
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (
    SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'O') AS open_orders,
      min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
    FROM orders GROUP BY o_custkey
  ) o ON c.c_custkey = o.o_custkey
  WHERE c.c_acctbal >= 0"""

_ORG_SNAP = f"""
  SELECT CAST(n.n_nationkey AS BIGINT) AS org_id, n.n_name AS org_login, 'Org ' || n.n_name AS org_name,
    CASE WHEN n.n_nationkey % 5 <> 4 THEN r.r_name END AS location,
    CASE WHEN n.n_nationkey % 4 <> 3 THEN 'Company ' || CAST(n.n_regionkey AS VARCHAR) END AS company,
    CASE WHEN n.n_nationkey % 2 = 0 THEN 'https://example.test/' || n.n_name END AS blog,
    CASE WHEN n.n_nationkey % 3 = 0 THEN n.n_name || '@example.test' END AS email,
    CASE WHEN n.n_nationkey % 4 = 0 THEN n.n_name END AS twitter_username,
    CASE n.n_nationkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_verified,
    TRUE AS has_organization_projects, n.n_nationkey % 2 = 1 AS has_repository_projects,
    s.suppliers AS public_repos, CAST(n.n_nationkey % 7 AS BIGINT) AS public_gists,
    s.followers, CAST(n.n_regionkey AS BIGINT) AS following
  FROM nation n
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN (
    SELECT s_nationkey, count(*) AS suppliers,
      CAST(sum(CAST(floor(abs(s_acctbal)) AS BIGINT)) AS BIGINT) AS followers
    FROM supplier GROUP BY s_nationkey HAVING min(s_acctbal) >= {ORG_DEBIT_LIMIT}
  ) s ON n.n_nationkey = s.s_nationkey"""


def _valid(grain: Grain) -> str:
    names = f"{grain.id} IS NOT NULL AND {grain.label} IS NOT NULL"
    return names + (f" AND {grain.label} LIKE '%/%'" if grain is REPO else "")


def _metrics(grain: Grain, by: tuple[str, ...]) -> str:
    keys = comma(*by, *grain.keys)
    counts = [
        "count(*) AS total_events",
        "count(*) FILTER (WHERE is_public) AS public_events_count",
        "count(DISTINCT actor_id) AS unique_actors",
        "count(*) FILTER (WHERE lower(actor_login) LIKE '%[bot]%') AS bot_events",
        "count(DISTINCT issue_id) AS issues_count",
        "count(DISTINCT comment_id) AS comments_count",
        "count(DISTINCT release_id) AS releases_count",
        "count(*) FILTER (WHERE pull_request_merged) AS merged_pr_count",
        *[f"count(*) FILTER (WHERE event_type = '{t}') AS {c}" for t, c in zip(EVENT_TYPES, EVENT_COUNTS)],
    ]
    if grain is ORG:
        counts.append("count(DISTINCT repo_id) AS repos_count")
    ratios = [f"{c} / total_events AS {name}" for c, name in zip(EVENT_COUNTS, EVENT_RATIOS)]
    score = "0.5 * ln(1 + total_events) + 0.3 * (push_events / total_events) + 0.2 * ln(1 + unique_actors)"
    return f"""
  SELECT *, {", ".join(ratios)},
    {score} AS composite_score, bot_events / total_events AS bot_ratio
  FROM (
    SELECT {keys}, {", ".join(counts)}, max(created_at) AS last_event_at
    FROM flat WHERE {_valid(grain)} GROUP BY {keys}
  )"""


def _leaders(grain: Grain, source: str, by: tuple[str, ...], metrics, top_n: int) -> str:
    ids = comma(*by, *grain.keys)
    values = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in metrics)
    return f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {comma(*by, "selection_metric")} ORDER BY metric_value DESC, {comma(*grain.keys)}
    ) AS metric_rank
    FROM (UNPIVOT (SELECT {ids}, {values} FROM {source}) ON {comma(*metrics)}
      INTO NAME selection_metric VALUE metric_value)
  ) WHERE metric_rank <= {top_n}"""


def _candidates(grain: Grain, source: str, leaders: str, by: tuple[str, ...]) -> str:
    ids = comma(*by, *grain.keys)
    return f"""
  SELECT m.*, r.selection_reasons, r.reasons
  FROM {source} m JOIN (
    SELECT {ids}, string_agg(selection_metric, ',' ORDER BY selection_metric) AS selection_reasons,
      count(*) AS reasons
    FROM {leaders} GROUP BY {ids}
  ) r USING ({ids})"""


def _mart(grain: Grain, candidates: str) -> str:
    attributes = ", ".join(f"s.{c}" for c in SNAPSHOT_COLUMNS[grain.name])
    return f"\n  SELECT c.*, {attributes} FROM {candidates} c LEFT JOIN {grain.name}_snap s USING ({grain.id})"


def _ctes() -> dict[str, str]:
    ctes = {"flat": _flat(), "repo_snap": _REPO_SNAP, "org_snap": _ORG_SNAP}
    for grain in (REPO, ORG):
        for suffix, by in BY.items():
            m, t, c = (f"{grain.name}_{kind}_{suffix}" for kind in ("metrics", "leaders", "candidates"))
            ctes[m] = _metrics(grain, by)
            ctes[t] = _leaders(grain, m, by, grain.metrics, TOP_N)
            ctes[c] = _candidates(grain, m, t, by)
            ctes[f"{grain.name}_mart_{suffix}"] = _mart(grain, c)
    for suffix, by in BY.items():
        ctes[f"repo_summary_{suffix}"] = _repo_summary(f"repo_mart_{suffix}", by)
        ctes[f"org_summary_{suffix}"] = _org_summary(f"org_mart_{suffix}", by)
        ctes[f"rollup_{suffix}"] = _rollup(suffix, by)
    days = f"dt BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"
    at = "CAST(dt AS TIMESTAMP) + hr * INTERVAL 1 HOUR AS timestamp"
    ctes["repo_page"] = f"\n  SELECT * REPLACE ({_filled(REPO_DEFAULTS)}), {at} FROM repo_summary_hour WHERE {days}"
    ctes["org_page"] = f"\n  SELECT * REPLACE ({_filled(ORG_DEFAULTS)}), {at} FROM org_summary_hour WHERE {days}"
    numbers = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0) AS {c}" for c in COMMON_NUMBERS)
    ctes["common_page"] = f"\n  SELECT * REPLACE ({_filled(COMMON_DEFAULTS)}, {numbers}) FROM rollup_all"
    return ctes


def _filled(defaults: dict[str, object]) -> str:
    literals = {c: f"'{v}'" if isinstance(v, str) else str(v) for c, v in defaults.items()}
    return ", ".join(f"COALESCE({c}, {v}) AS {c}" for c, v in literals.items())


# --- dashboards ---------------------------------------------------------------------


def _agg(by: tuple[str, ...], keys: list[str], aggregates: list[str], source: str) -> str:
    selected = comma(*by, *keys, *aggregates)
    positions = ", ".join(str(i + 1) for i in range(len(by) + len(keys)))
    return f"SELECT {selected} FROM {source}" + (f" GROUP BY {positions}" if positions else "")


def _max(*names: str) -> list[str]:
    return [f"max({n}) AS {n}" for n in names]


def _sum(*names: str) -> list[str]:
    return [big(f"sum({n})", n) for n in names]


def _avg(*names: str) -> list[str]:
    return [r(f"avg({n})", f"avg_{n}") for n in names]


def _repo_summary(mart: str, by) -> str:
    return _agg(
        by,
        list(REPO.keys),
        [
            *_max("repo_name", "owner_login", "owner_type", "language", "visibility", "is_fork", "is_archived"),
            *_max("is_disabled", "stargazers_count", "forks_count", "watchers_count", "subscribers_count"),
            *_max("open_issues_count"),
            *_sum("total_events", "push_events", "pull_request_events", "issue_comment_events", "fork_events"),
            "avg(composite_score) AS avg_composite_score",
            "avg(bot_ratio) AS avg_bot_ratio",
        ],
        mart,
    )


def _org_summary(mart: str, by) -> str:
    return _agg(
        by,
        list(ORG.keys),
        [
            *_max(*SNAPSHOT_COLUMNS["org"]),
            *_sum("total_events", "push_events", "pull_request_events"),
            "avg(composite_score) AS avg_composite_score",
            "avg(bot_ratio) AS avg_bot_ratio",
        ],
        mart,
    )


def _owned(suffix: str, by) -> str:
    on = " AND ".join(["r.owner_login = o.org_login", *[f"r.{c} = o.{c}" for c in by]])
    return f"repo_mart_{suffix} r LEFT JOIN org_mart_{suffix} o ON {on}"


def _rollup(suffix: str, by) -> str:
    keys = [f"r.{c} AS {c}" for c in by]
    return _agg(
        tuple(keys),
        ["r.repo_id AS repo_id", "r.repo_full_name AS repo_full_name"],
        [
            *[f"max(r.{c}) AS {c}" for c in ("repo_name", "owner_login", "language")],
            big("sum(r.total_events)", "repo_total_events"),
            "avg(r.composite_score) AS repo_avg_composite_score",
            "max(r.stargazers_count) AS stargazers_count",
            *["max(o.org_id) AS org_id", "max(o.org_name) AS org_name", "max(o.location) AS org_location"],
            *["max(o.company) AS org_company", "max(o.followers) AS org_followers"],
            *["max(o.public_repos) AS org_public_repos", "max(o.is_verified) AS org_is_verified"],
        ],
        _owned(suffix, by),
    )


def _top_100(mart: str, by, key: str, columns: tuple[str, ...]) -> str:
    order = f"composite_score DESC, total_events DESC, {key}"
    window = f"PARTITION BY {comma(*by)} " if by else ""
    return (
        f"SELECT {comma(*by, *rounded(columns))} FROM {mart} "
        f"QUALIFY row_number() OVER ({window}ORDER BY {order}) <= 100"
    )


def _days_case(limits, beyond: str, value: str) -> str:
    whens = " ".join(f"WHEN {value} <= {limit} THEN '{label}'" for limit, label in limits)
    return f"CASE {whens} ELSE '{beyond}' END"


def _dashboards(suffix: str) -> dict[str, str]:
    by = BY[suffix]
    repo, org = f"repo_mart_{suffix}", f"org_mart_{suffix}"
    unknown = "COALESCE({0}, 'Unknown') AS {0}".format
    repo_count, org_count = "count(*) AS repo_count", "count(*) AS org_count"
    verified = "CASE WHEN {} THEN 'verified' ELSE 'not_verified' END AS verification_status".format
    summary_rounding = "* REPLACE (" + ", ".join(r(f"avg_{c}") for c in SCORES) + ")"
    owned_by = tuple(f"r.{c} AS {c}" for c in by)
    age = f"date_diff('day', CAST(pushed_at AS DATE), DATE '{AS_OF}')"
    has = "CASE WHEN {1} IS NOT NULL THEN 'has_{0}' ELSE 'no_{0}' END AS {0}_status".format
    return {
        "repo_summary": f"SELECT {summary_rounding} FROM repo_summary_{suffix}",
        "repo_language": _agg(
            by,
            [unknown("language")],
            [repo_count, *_sum("total_events"), *_avg("composite_score"), big("sum(stargazers_count)", "total_stargazers")],
            repo,
        ),
        "repo_owner": _agg(by, [unknown("owner_type")], [repo_count, *_sum("total_events"), *_avg("composite_score")], repo),
        "repo_visibility": _agg(by, [unknown("visibility")], [repo_count, *_sum("total_events")], repo),
        "repo_fork": _agg(
            by,
            ["CASE WHEN is_fork THEN 'fork' ELSE 'original' END AS fork_status"],
            [repo_count, *_sum("total_events"), *_avg("composite_score")],
            repo,
        ),
        "repo_freshness": _agg(
            by,
            [f"{_days_case(FRESHNESS, STALE, age)} AS freshness_bucket"],
            [repo_count, *_sum("total_events")],
            repo,
        ),
        "repo_event_type": " UNION ALL ".join(
            f"SELECT {comma(*by, f"'{c}' AS event_type", f"{c} AS event_count")} FROM ({_agg(by, [], _sum(c), repo)})"
            for c in SHOWN_EVENTS
        ),
        "repo_top_100": _top_100(
            repo,
            by,
            "repo_id",
            (
                "repo_id",
                "repo_full_name",
                "owner_login",
                "language",
                "total_events",
                "unique_actors",
                "composite_score",
                "stargazers_count",
                "forks_count",
            ),
        ),
        "org_summary": f"SELECT {summary_rounding} FROM org_summary_{suffix}",
        "org_company": _agg(by, [unknown("company")], [org_count, *_sum("total_events")], org),
        "org_location": _agg(by, [unknown("location")], [org_count, *_sum("total_events"), *_avg("followers")], org),
        "org_size": _agg(
            by,
            [f"{_days_case(ORG_SIZES, LARGEST, 'repos_count')} AS size_bucket"],
            [org_count, *_sum("total_events"), *_avg("followers")],
            org,
        ),
        "org_social": _agg(
            by, [has("twitter", "twitter_username"), has("blog", "blog"), has("email", "email")], [org_count], org
        ),
        "org_verified": _agg(
            by, [verified("is_verified")], [org_count, *_sum("total_events"), *_avg("composite_score")], org
        ),
        "org_top_100": _top_100(
            org,
            by,
            "org_id",
            (
                "org_id",
                "org_login",
                "org_name",
                "location",
                "public_repos",
                "followers",
                "repos_count",
                "total_events",
                "composite_score",
            ),
        ),
        "common_rollup": f"SELECT * REPLACE ({r('repo_avg_composite_score')}) FROM rollup_{suffix}",
        "common_language_location": _agg(
            owned_by,
            ["COALESCE(r.language, 'Unknown') AS language", "COALESCE(o.location, 'Unknown') AS org_location"],
            [repo_count, big("sum(r.total_events)", "total_events")],
            _owned(suffix, by),
        ),
        "common_verified": _agg(
            owned_by,
            [verified("o.is_verified")],
            [repo_count, big("sum(r.total_events)", "total_events"), r("avg(r.composite_score)", "avg_repo_score")],
            _owned(suffix, by),
        ),
    }


# --- pages --------------------------------------------------------------------------


def _page_sum(key: str, source: str, value: str = "total_events", cast: bool = True) -> str:
    total = big(f"sum({value})", value) if cast else r(f"sum({value})", value)
    return f"SELECT {key}, {total} FROM {source} GROUP BY ALL"


def _pages() -> dict[str, str]:
    averages = ", ".join(r(f"avg_{c}") for c in SCORES)
    one_score = r("repo_avg_composite_score")
    timeline = "SELECT timestamp, {} FROM repo_page GROUP BY timestamp".format(
        ", ".join(_sum("total_events", "push_events", "pull_request_events"))
    )
    quality = {"avg_bot_ratio": "Average Bot Ratio", "avg_composite_score": "Average Composite Score"}
    shown = {"push_events": "Push Events", "pull_request_events": "Pull Request Events"}
    status = "CASE WHEN is_verified THEN 'Verified' WHEN NOT is_verified THEN 'Not Verified' END"

    def table(columns) -> str:
        return comma(*[r(c) if "avg" in c else c for c in columns])

    return {
        **{
            f"report_store_{name}_summary": "SELECT dt, hr, count(*) AS entities, CAST(sum(total_events) AS BIGINT) AS total_events "
            f"FROM {name}_summary_hour WHERE dt BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' GROUP BY dt, hr"
            for name in ("repo", "org")
        },
        "page_repo_summary": f"SELECT * REPLACE ({averages}) FROM repo_page",
        "page_repo_table": f"SELECT {table(REPO_TABLE)} FROM repo_page",
        "page_repo_top_n": _page_sum("repo_full_name", "repo_page")
        + f" ORDER BY total_events DESC, repo_full_name LIMIT {PAGE_TOP_N}",
        "page_repo_language": _page_sum("language", "repo_page"),
        "page_repo_timeline": timeline,
        "page_repo_push_vs_pr": " UNION ALL ".join(
            f"SELECT timestamp, '{label}' AS event_type, {big(f'sum({c})', 'events')} FROM repo_page GROUP BY timestamp"
            for c, label in shown.items()
        ),
        "page_org_summary": f"SELECT * REPLACE ({averages}) FROM org_page",
        "page_org_table": f"SELECT {table(ORG_TABLE)} FROM org_page",
        "page_org_top_n": _page_sum("org_login", "org_page")
        + f" ORDER BY total_events DESC, org_login LIMIT {PAGE_TOP_N}",
        "page_org_location": _page_sum("location", "org_page"),
        "page_org_verified": _page_sum(f"{status} AS verification_status", "org_page WHERE is_verified IS NOT NULL"),
        "page_org_timeline": "SELECT timestamp, {}, {} FROM org_page GROUP BY timestamp".format(
            big("sum(total_events)", "total_events"), ", ".join(r(f"avg({c})", c) for c in quality)
        ),
        "page_org_quality": " UNION ALL ".join(
            f"SELECT timestamp, '{label}' AS metric, {r(f'avg({c})', 'value')} FROM org_page GROUP BY timestamp"
            for c, label in quality.items()
        ),
        "page_common_summary": f"SELECT * REPLACE ({one_score}) FROM common_page",
        "page_common_table": f"SELECT {table(COMMON_TABLE)} FROM common_page",
        "page_common_location_language": _page_sum("org_location, language", "common_page", "repo_total_events", cast=False),
        "page_common_scatter": f"SELECT {table(SCATTER)} FROM common_page",
    }


# --- everything else ----------------------------------------------------------------


def _metric_oracles(grain: Grain) -> dict[str, str]:
    out: dict[str, str] = {}
    keys = comma(*grain.keys)
    for name, suffix in (("", "all"), ("_daily", "day"), ("_hourly", "hour")):
        columns = comma(*BY[suffix], *grain.keys, *grain.counts, "last_event_at")
        out[f"{grain.name}_metrics{name}"] = f"SELECT {columns} FROM {grain.name}_metrics_{suffix}"
        if suffix != "hour":
            out[f"{grain.name}_metrics{name}_from_hours"] = f"SELECT {columns}, {comma(*rounded(SCORES))} FROM {grain.name}_metrics_{suffix}"
    out[f"{grain.name}_metric_ratios"] = f"SELECT {keys}, {comma(*rounded(EVENT_RATIOS))} FROM {grain.name}_metrics_all"
    out[f"{grain.name}_scores"] = f"SELECT {keys}, {comma(*rounded(SCORES))} FROM {grain.name}_metrics_all"
    replace = ", ".join(rounded(EVENT_RATIOS + SCORES))
    for name, suffix in (("", "all"), ("_hourly", "hour")):
        out[f"{grain.name}_metric_topn{name}"] = (
            f"SELECT * REPLACE ({r('metric_value')}, CAST(metric_rank AS INTEGER) AS metric_rank) "
            f"FROM {grain.name}_leaders_{suffix}"
        )
        if suffix == "hour":
            out[f"{grain.name}_metric_topn_small"] = f"{out[f'{grain.name}_metric_topn{name}']} WHERE metric_rank <= {SMALL_TOP_N}"
        for kind in ("candidates", "mart"):
            out[f"{grain.name}_{kind}{name}"] = (
                f"SELECT * EXCLUDE (reasons) REPLACE ({replace}) FROM {grain.name}_{kind}_{suffix}"
            )
    return out


def _contract(grain: Grain) -> str:
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    known = {*grain.keys, *grain.metrics, "last_event_at", "selection_reasons", *SNAPSHOT_COLUMNS[grain.name]}
    columns = []
    for field in mart_schema(grain).fields:
        if field.name not in known:
            columns.append(f"CAST(NULL AS {kinds[field.dataType.simpleString()]}) AS {field.name}")
        else:
            columns.extend(rounded([field.name]))
    return f"SELECT {', '.join(columns)} FROM {grain.name}_mart_all"


def _bucketed(grain: Grain) -> str:
    return _agg(
        (),
        list(grain.keys),
        [
            "count(*) AS slices",
            *_sum("total_events"),
            r("max(composite_score)", "best_score"),
            big("sum(reasons)", "reasons"),
        ],
        f"{grain.name}_mart_day",
    )


def _snapshot_rows(grain: Grain) -> str:
    """Snapshots of the hourly candidates, as the answers carry them."""
    absent = {
        "repo": ("description", "license_spdx_id", "default_branch"),
        "org": ("description", "html_url"),
    }[grain.name]
    times = {"repo": ("updated_at",), "org": ("created_at", "updated_at")}[grain.name]
    nulls = [f"CAST(NULL AS VARCHAR) AS {c}" for c in absent] + [f"CAST(NULL AS TIMESTAMP) AS {c}" for c in times]
    return (
        f"SELECT {comma(f's.{grain.id} AS {grain.id}', f's.{grain.label} AS {grain.label}')}, "
        f"{', '.join('s.' + c for c in SNAPSHOT_COLUMNS[grain.name])}, {', '.join(nulls)}, "
        f"{_FETCHED} AS api_fetched_at, c.dt, c.hr "
        f"FROM {grain.name}_candidates_hour c JOIN {grain.name}_snap s USING ({grain.id})"
    )


_FETCHED = "CAST(c.dt AS TIMESTAMP) + c.hr * INTERVAL 1 HOUR + INTERVAL 5 MINUTE"


def _error_rows(grain: Grain) -> str:
    return (
        f"SELECT c.{grain.label}, 404 AS error_status, 'Not Found' AS error_message, {_FETCHED} AS api_fetched_at, "
        f"c.dt, c.hr FROM {grain.name}_candidates_hour c ANTI JOIN {grain.name}_snap s USING ({grain.id})"
    )


def _topic_rows() -> str:
    seen = ", ".join(f"CASE WHEN c.{c} > 0 THEN '{t.lower()}' END" for t, c in zip(EVENT_TYPES, EVENT_COUNTS))
    return (
        "SELECT * FROM (SELECT s.repo_id AS repo_id, s.repo_full_name AS repo_full_name, "
        f"unnest([{seen}]) AS topic, c.dt, c.hr "
        "FROM repo_candidates_hour c JOIN repo_snap s USING (repo_id)) WHERE topic IS NOT NULL"
    )


def _pending(grain: Grain) -> str:
    return (
        f"SELECT c.dt, c.hr, {', '.join('c.' + k for k in grain.keys)} "
        f"FROM {grain.name}_candidates_hour c ANTI JOIN {grain.name}_snap s USING ({grain.id})"
    )


def _others() -> dict[str, str]:
    day, hour = ONE_SLICE
    optional = {
        "payload_action": None,
        "payload_ref_type": None,
        "pull_request_id": None,
        "pull_request_merged": "pull_request_merged",
        "issue_id": "issue_id",
        "comment_id": "comment_id",
        "release_id": "release_id",
        "member_id": None,
        "org_id": "org_id",
        "org_url": None,
    }
    filled = ", ".join(f"count({c or 'NULL'}) AS with_{name}" for name, c in optional.items())
    split = {
        "repo_snapshot": _snapshot_rows(REPO),
        "repo_snapshot_errors": _error_rows(REPO),
        "repo_topics": _topic_rows(),
        "org_snapshot": _snapshot_rows(ORG),
        "org_snapshot_errors": _error_rows(ORG),
    }
    keys = ("repo_id", "repo_full_name", "org_id", "org_login")
    pivots = ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES)
    sparse = _leaders(ORG, "org_metrics_all", (), ("total_events", "bot_ratio"), SMALL_TOP_N)
    valid_repo = _valid(REPO)
    return {
        "raw_flatten_roundtrip": "SELECT * FROM flat",
        "raw_flatten_sparse_payload": f"SELECT event_type, count(*) AS events, {filled} FROM flat GROUP BY event_type",
        "slice_overwrite_idempotent": "SELECT dt, count(*) AS entities, CAST(sum(total_events) AS BIGINT) AS total_events "
        "FROM repo_metrics_day GROUP BY dt",
        "slice_emptied": "SELECT dt, hr, count(*) AS entities, CAST(sum(total_events) AS BIGINT) AS total_events "
        f"FROM repo_metrics_hour WHERE dt <> DATE '{day}' OR hr <> {hour} GROUP BY dt, hr",
        "slice_filter": f"SELECT event_id, event_type, repo_id, dt, hr FROM flat WHERE dt = DATE '{day}' AND hr = {hour}",
        "slice_calendar_coverage": "SELECT CAST(h AS DATE) AS dt, CAST(hour(h) AS INTEGER) AS hr, count(f.created_at) AS events "
        "FROM (SELECT unnest(generate_series(date_trunc('hour', min(created_at)), date_trunc('hour', max(created_at)), "
        "INTERVAL 1 HOUR)) AS h FROM flat) LEFT JOIN flat f ON date_trunc('hour', f.created_at) = h GROUP BY h",
        "slice_calendar_range": "SELECT CAST(h AS DATE) AS dt, CAST(hour(h) AS INTEGER) AS hr, count(f.created_at) AS events "
        f"FROM (SELECT unnest(generate_series(TIMESTAMP '{FIRST_DAY}', TIMESTAMP '{LAST_DAY}' + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS h) "
        "LEFT JOIN flat f ON date_trunc('hour', f.created_at) = h GROUP BY h",
        "bucketed_repo_mart": _bucketed(REPO),
        "bucketed_org_mart": _bucketed(ORG),
        "mart_contract_projection": _contract(REPO),
        "valid_repo_events": f"SELECT event_id, repo_id, repo_full_name FROM flat WHERE {valid_repo}",
        "valid_org_events": f"SELECT event_id, org_id, org_login FROM flat WHERE {_valid(ORG)}",
        "candidates_sparse_metrics": "SELECT org_id, org_login, string_agg(selection_metric, ',' ORDER BY selection_metric) "
        f"AS selection_reasons FROM ({sparse}) GROUP BY org_id, org_login",
        "event_types_present": "SELECT DISTINCT event_type FROM flat WHERE event_type IS NOT NULL",
        "event_type_pivot": f"SELECT repo_id, {pivots} FROM flat GROUP BY repo_id",
        "repo_actor_counts": "SELECT repo_id, repo_full_name, count(*) AS total_events, count(actor_id) AS actors_count, "
        "count(DISTINCT actor_id) AS unique_actors FROM flat GROUP BY repo_id, repo_full_name",
        "event_null_profile": "SELECT count(*) AS total_rows, "
        + ", ".join(f"count(*) FILTER (WHERE {k} IS NULL) AS null_{k}" for k in keys)
        + f", count(*) FILTER (WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)}) AS fully_keyed_rows FROM flat",
        "distinct_repos": "SELECT DISTINCT repo_id FROM flat",
        "distinct_event_rows": "SELECT DISTINCT repo_id, repo_full_name, actor_id, actor_login, event_type, is_public FROM flat",
        "repo_bot_suffix": "SELECT repo_id, repo_full_name, events_total, bot_events, "
        + r("bot_events / events_total", "bot_ratio")
        + " FROM (SELECT repo_id, repo_full_name, count(*) AS events_total, "
        "count(*) FILTER (WHERE lower(actor_login) LIKE '%[bot]') AS bot_events FROM flat GROUP BY repo_id, repo_full_name)",
        "repo_comment_leaders": "SELECT repo_id, repo_full_name, issues_count, comments_count, releases_count, "
        "merged_pr_count FROM repo_metrics_all",
        "mart_repo_rollup": _agg(
            (),
            list(REPO.keys),
            [
                "count(*) AS repo_count",
                *_sum("total_events"),
                big("sum(push_events)", "total_push_events"),
                big("sum(pull_request_events)", "total_pull_request_events"),
                *_avg("composite_score"),
            ],
            "repo_mart_hour",
        ),
        "repo_owner_split": "SELECT DISTINCT repo_id, repo_full_name, split_part(repo_full_name, '/', 1) AS owner, "
        f"substr(repo_full_name, strpos(repo_full_name, '/') + 1) AS name FROM flat WHERE {valid_repo}",
        "enrich_split_counts": " UNION ALL ".join(
            f"SELECT dt, count(*) AS rows, '{name}' AS output FROM ({rows}) GROUP BY dt" for name, rows in split.items()
        ),
        "enrich_route_counts": "SELECT status_code, CASE status_code WHEN 200 THEN 'snapshot' WHEN 404 THEN 'error' "
        "ELSE 'fatal' END AS route, count(*) AS answers FROM (SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 200 "
        "WHEN 'AUTOMOBILE' THEN 404 WHEN 'MACHINERY' THEN 401 WHEN 'HOUSEHOLD' THEN 403 "
        "ELSE CASE WHEN c_acctbal < 0 THEN 500 ELSE 429 END END AS status_code FROM customer) GROUP BY status_code",
        "enrich_repo_snapshot": split["repo_snapshot"],
        "enrich_org_snapshot": split["org_snapshot"],
        "enrich_resume": split["repo_snapshot"],
        "enrich_errors": split["repo_snapshot_errors"],
        "enrich_org_errors": split["org_snapshot_errors"],
        "enrich_repo_topics": split["repo_topics"],
        "enrich_pending_repos": _pending(REPO),
        "enrich_pending_orgs": _pending(ORG),
        "enrich_match_rate": "SELECT count(*) AS candidates, count(s.repo_id) AS matched "
        "FROM repo_candidates_all c LEFT JOIN repo_snap s ON c.repo_id = s.repo_id",
        "enrich_snapshot_latest": "SELECT o_custkey AS repo_id, o_orderdate AS api_fetched_at, "
        "CAST(floor(o_totalprice) AS BIGINT) AS stargazers_count, o_orderpriority AS language, o_orderkey AS load_id "
        "FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    }


def _with(body: str, ctes: dict[str, str]) -> str:
    """Prefix ``body`` with the expressions it needs, in the order they are defined."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for name in (words & ctes.keys()) - needed:
            needed.add(name)
            texts.append(ctes[name])
    parts = [f"{name} AS ({sql}\n)" for name, sql in ctes.items() if name in needed]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body


def oracles() -> dict[str, str]:
    bodies = {**_others(), **_metric_oracles(REPO), **_metric_oracles(ORG), **_pages()}
    bodies.update({f"dash_{name}": sql for name, sql in _dashboards("all").items()})
    bodies.update({f"dash_{name}_hourly": sql for name, sql in _dashboards("hour").items()})
    ctes = _ctes()
    return {name: _with(sql, ctes) for name, sql in bodies.items()}

