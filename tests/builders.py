"""Small tables with defaults, so that a test states only what it is about."""

from __future__ import annotations

from datetime import date, datetime

from forgelens.contracts import API_RESPONSE, EVENTS_FLAT, ORG, REPO, SLICE, metrics_schema
from pyspark.sql.types import StructType

DAY = date(2026, 3, 20)


def _frame(spark, schema, rows, defaults):
    filled = [{**defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in filled], schema)


def events(spark, rows):
    """Flat events with their slice."""
    schema = StructType(list(EVENTS_FLAT.fields)).add("dt", "date").add("hr", "integer")
    defaults = {
        "event_type": "PushEvent",
        "created_at": datetime(2026, 3, 20, 21, 0),
        "repo_id": 7311,
        "repo_full_name": "lantern/wick",
        "actor_id": 1,
        "actor_login": "marlow",
        "is_public": True,
        "dt": DAY,
        "hr": 21,
    }
    return _frame(spark, schema, rows, defaults)


def metrics(spark, grain, rows):
    """Metric rows; ``base`` fills every metric that a row does not name."""
    schema = StructType(list(metrics_schema(grain).fields)).add("dt", "date").add("hr", "integer")
    filled = []
    for row in rows:
        row = dict(row)
        base = row.pop("base", 0)
        values = {m: base if m in grain.counts else float(base) for m in grain.metrics}
        filled.append({"dt": DAY, "hr": 10, "last_event_at": datetime(2026, 3, 20, 10), **values, **row})
    return _frame(spark, schema, filled, {})


def responses(spark, rows):
    defaults = {"status_code": 200, "payload": "{}", "fetched_at": datetime(2026, 3, 20, 21, 5), "dt": DAY, "hr": 21}
    return _frame(spark, API_RESPONSE, rows, defaults)


def by(rows, key):
    return {row[key]: row.asDict(recursive=True) for row in rows}


__all__ = ["DAY", "ORG", "REPO", "SLICE", "by", "events", "metrics", "responses"]
