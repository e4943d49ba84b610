from __future__ import annotations

import gzip
import json
from datetime import date, datetime

from forgelens.contracts import EVENTS_FLAT
from forgelens.operators.flatten import flatten_events, rejected_lines, with_event_slice
from forgelens.sources.raw import read_raw_events

FULL = {
    "id": "880042",
    "type": "PullRequestEvent",
    "created_at": "2026-03-20T21:15:00Z",
    "public": False,
    "repo": {"id": 5150, "name": "lantern/wick"},
    "actor": {"id": 77, "login": "marlow"},
    "org": {"id": 31, "login": "lantern", "url": "https://api.example/lantern", "avatar_url": "https://img.example/31"},
    "payload": {
        "action": "reopened",
        "ref_type": "tag",
        "pull_request": {"id": 60013, "merged": False},
        "issue": {"id": 70021},
        "comment": {"id": 80034},
        "release": {"id": 90045},
        "member": {"id": 1009},
    },
}
OTHER = {
    "id": "880043",
    "type": "WatchEvent",
    "created_at": "2026-03-20T22:40:10Z",
    "public": True,
    "repo": {"id": 5151, "name": "ferry/oar"},
    "actor": {"id": 78, "login": "imogen"},
    "payload": {"action": "started"},
}
PAYLOAD_COLUMNS = (
    "payload_action",
    "payload_ref_type",
    "pull_request_id",
    "pull_request_merged",
    "issue_id",
    "comment_id",
    "release_id",
    "member_id",
)


def write(tmp_path, *lines, name="events.json"):
    text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n"
    path = tmp_path / name
    path.write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    return str(path)


def flat(spark, path):
    return flatten_events(read_raw_events(spark, path))


def test_full_event_beside_a_small_one(spark, tmp_path):
    frame = flat(spark, write(tmp_path, FULL, OTHER))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in EVENTS_FLAT]
    row, small = (r.asDict() for r in frame.orderBy("event_id").collect())
    assert (small["event_id"], small["payload_action"], small["org_id"], small["issue_id"]) == (880043, "started", None, None)
    assert row.pop("ingestion_ts") is not None
    assert row.pop("source_file").endswith("events.json")
    assert row == {
        "event_id": 880042,
        "event_type": "PullRequestEvent",
        "created_at": datetime(2026, 3, 20, 21, 15),
        "repo_id": 5150,
        "repo_full_name": "lantern/wick",
        "actor_id": 77,
        "actor_login": "marlow",
        "org_id": 31,
        "org_login": "lantern",
        "org_url": "https://api.example/lantern",
        "org_avatar_url": "https://img.example/31",
        "is_public": False,
        "payload_action": "reopened",
        "payload_ref_type": "tag",
        "pull_request_id": 60013,
        "pull_request_merged": False,
        "issue_id": 70021,
        "comment_id": 80034,
        "release_id": 90045,
        "member_id": 1009,
    }


def test_event_without_payload_or_org(spark, tmp_path):
    event = {k: v for k, v in FULL.items() if k not in ("payload", "org")}
    row = flat(spark, write(tmp_path, event)).first()
    assert all(row[c] is None for c in (*PAYLOAD_COLUMNS, "org_id", "org_login", "org_url"))
    assert row.repo_id == 5150


def test_gzip_and_sparse_payload(spark, tmp_path):
    event = {**FULL, "payload": {"pull_request": {"id": 123}}}
    row = flat(spark, write(tmp_path, event, name="events.json.gz")).first()
    assert (row.pull_request_id, row.pull_request_merged) == (123, None)


def test_unreadable_lines_are_kept_apart(spark, tmp_path):
    path = write(tmp_path, FULL, "not json", '{"id": "2", "type": ', {**FULL, "id": "3"})
    raw = read_raw_events(spark, path)
    assert sorted(r.event_id for r in flatten_events(raw).collect()) == [3, 880042]
    assert {r.line for r in rejected_lines(raw).collect()} == {"not json", '{"id": "2", "type": '}


def test_values_of_unexpected_kind_become_null(spark, tmp_path):
    event = {**FULL, "id": "x", "public": "maybe", "created_at": "yesterday", "payload": "none", "repo": {"id": "7"}}
    raw = read_raw_events(spark, write(tmp_path, event))
    row = flatten_events(raw).first()
    assert (row.event_id, row.is_public, row.created_at, row.issue_id) == (None, None, None, None)
    assert (row.repo_id, row.event_type) == (7, "PullRequestEvent")
    assert rejected_lines(raw).count() == 0


def test_slice_follows_the_utc_clock_in_any_session_zone(spark, tmp_path):
    event = {**FULL, "created_at": "2026-03-20T23:30:00Z"}
    late = {**FULL, "id": "2", "created_at": "2026-03-21T01:30:00+02:00"}
    path = write(tmp_path, event, late)
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            rows = with_event_slice(flat(spark, path)).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert {(r.created_at, r.dt, r.hr) for r in rows} == {(datetime(2026, 3, 20, 23, 30), date(2026, 3, 20), 23)}


def test_directory_names_give_the_slice(spark, tmp_path):
    folder = tmp_path / "dt=2026-03-20" / "hr=5"
    folder.mkdir(parents=True)
    write(folder, FULL)
    row = flatten_events(read_raw_events(spark, [str(folder)], base_path=str(tmp_path))).first()
    assert (row.dt, row.hr) == (date(2026, 3, 20), 5)
