from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest

from builders import DAY, REPO, events, metrics
from forgelens.operators.marts import project_contract
from forgelens.contracts import mart_schema
from forgelens.sources import warehouse
from forgelens.sources.raw import calendar_of, in_slices, read_slices, slice_calendar
from forgelens.sources.staging import shared_dir, stage
from forgelens.sources.warehouse import write_bucketed, write_slices

NEXT = date(2026, 3, 21)


def rows(*slices, base=1, n=3):
    return [
        {"repo_id": i, "repo_full_name": f"a/{i}", "base": base, "dt": dt, "hr": hr} for dt, hr in slices for i in range(n)
    ]


def test_only_written_slices_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    write_slices(metrics(spark, REPO, rows((DAY, 0), (DAY, 1), (NEXT, 0))), path)
    for _ in range(2):
        write_slices(metrics(spark, REPO, rows((DAY, 1), base=7, n=2)), path)
    got = spark.read.parquet(path).groupBy("dt", "hr").sum("total_events").collect()
    assert {(r.dt, r.hr): r[2] for r in got} == {(DAY, 0): 3, (DAY, 1): 14, (NEXT, 0): 3}
    assert (Path(path) / "dt=2026-03-20" / "hr=1").is_dir()


def test_slice_predicate_prunes_partitions(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    write_slices(metrics(spark, REPO, rows((DAY, 0), (DAY, 1), (NEXT, 0), (NEXT, 1))), path)
    picked = read_slices(spark, path, [(DAY, 1), (NEXT, 0)])
    assert {(r.dt, r.hr) for r in picked.select("dt", "hr").collect()} == {(DAY, 1), (NEXT, 0)}
    scan = next(line for line in plan_of(picked.select("repo_id", "dt", "hr")).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    assert "ReadSchema: struct<repo_id:bigint>" in scan
    assert read_slices(spark, path).count() == 12
    assert read_slices(spark, path, []).count() == 0


def test_predicate_of_many_slices_stays_short(spark):
    whole_days = [(date(2026, 1, 1 + d), h) for d in range(31) for h in range(24)]
    assert " OR " not in str(in_slices(whole_days))


def test_calendar(spark):
    hours = slice_calendar(spark, datetime(2026, 3, 20, 22), datetime(2026, 3, 21, 1)).collect()
    assert [(r.dt, r.hr) for r in hours] == [(DAY, 22), (DAY, 23), (NEXT, 0), (NEXT, 1)]
    frame = events(spark, [{"dt": DAY, "hr": 23}, {"dt": NEXT, "hr": 1}])
    assert [(r.dt, r.hr) for r in calendar_of(frame).collect()] == [(DAY, 23), (NEXT, 0), (NEXT, 1)]


def test_bucketed_table(spark, tmp_path, plan_of):
    table = "bucketed_test"
    frame = metrics(spark, REPO, rows((DAY, 0), (NEXT, 0), n=40))
    write_bucketed(frame, REPO, table, str(tmp_path / "b"))
    write_bucketed(metrics(spark, REPO, rows((DAY, 0), base=5, n=40)), REPO, table, str(tmp_path / "b"))
    stored = spark.table(table)
    assert set(stored.columns) == {*mart_schema(REPO).names, "dt", "hr"}
    got = stored.groupBy("dt").sum("total_events").collect()
    assert {r.dt: r[1] for r in got} == {DAY: 200, NEXT: 40}
    per_repo = plan_of(stored.where(in_slices([(DAY, 0)])).groupBy("repo_id").count())
    assert "Exchange" not in per_repo and "Bucketed: true" in per_repo
    files = list((tmp_path / "b" / "dt=2026-03-20" / "hr=0").glob("*.parquet"))
    assert 1 < len(files) <= 16
    spark.sql(f"DROP TABLE {table}")


def test_contract_of_what_is_stored(spark):
    frame = metrics(spark, REPO, rows((DAY, 0)))
    assert project_contract(frame, mart_schema(REPO), ("dt", "hr")).columns[-2:] == ["dt", "hr"]


def test_staged_tables_live_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark).startswith(root)
    staged = stage(spark.range(10))
    assert staged.count() == 10
    assert all(root in f for f in staged.inputFiles())


def test_empty_frames_can_be_staged(spark):
    assert stage(spark.range(0)).count() == 0


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_owned_slices_without_rows_are_cleared(spark, tmp_path):
    path = str(tmp_path / "t")
    write_slices(metrics(spark, REPO, rows((DAY, 0), (DAY, 1), (NEXT, 0))), path)
    write_slices(metrics(spark, REPO, rows((DAY, 0), base=5)), path, owned=[(DAY, 0), (DAY, 1), (NEXT, 5)])
    got = spark.read.parquet(path).groupBy("dt", "hr").sum("total_events").collect()
    assert {(r.dt, r.hr): r[2] for r in got} == {(DAY, 0): 15, (NEXT, 0): 3}


def test_bucketed_slices_stay_in_a_static_session(spark, tmp_path):
    table, path = "bucketed_static", str(tmp_path / "b")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")
    try:
        write_bucketed(metrics(spark, REPO, rows((DAY, 0), (DAY, 1), (NEXT, 0))), REPO, table, path)
        write_bucketed(metrics(spark, REPO, rows((DAY, 1), base=7, n=2)), REPO, table, path, owned=[(DAY, 1), (NEXT, 0)])
        got = spark.table(table).groupBy("dt", "hr").sum("total_events").collect()
        assert {(r.dt, r.hr): r[2] for r in got} == {(DAY, 0): 3, (DAY, 1): 14}
        with pytest.raises(ValueError, match="stored at"):
            write_bucketed(metrics(spark, REPO, rows((DAY, 1))), REPO, table, str(tmp_path / "other"))
        metrics(spark, REPO, rows((DAY, 1))).write.saveAsTable("not_bucketed")
        with pytest.raises(ValueError, match="not written by write_bucketed"):
            write_bucketed(metrics(spark, REPO, rows((DAY, 1))), REPO, "not_bucketed", path)
    finally:
        spark.conf.set(mode, before)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql("DROP TABLE IF EXISTS not_bucketed")


def _totals(frame):
    return {(r.dt, r.hr): r[2] for r in frame.groupBy("dt", "hr").sum("total_events").collect()}


def _broken(*_, **__):
    raise OSError("the driver is lost")


@pytest.mark.parametrize("bucketed", [False, True])
def test_a_failed_write_leaves_all_slices_or_is_finished(spark, tmp_path, monkeypatch, bucketed):
    """Lost before the plan is stored: nothing has changed. Lost amid the exchange: the next write finishes it."""
    path, table = str(tmp_path / "t"), f"failing_{bucketed}".lower()

    def write(*slices, base, owned=None):
        frame = metrics(spark, REPO, rows(*slices, base=base))
        write_bucketed(frame, REPO, table, path, owned=owned) if bucketed else write_slices(frame, path, owned=owned)

    def stored():
        spark.catalog.clearCache()
        return _totals(spark.table(table) if bucketed else spark.read.parquet(path))

    old = {(DAY, 0): 3, (DAY, 1): 3, (NEXT, 0): 3}
    write(*old, base=1)
    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "write_text", _broken)
        with pytest.raises(OSError, match="is lost"):
            write((DAY, 0), (DAY, 2), base=9, owned=[(DAY, 1)])
    assert stored() == old
    with monkeypatch.context() as broken:
        move = warehouse.move
        broken.setattr(warehouse, "move", lambda *a: _broken() if a[-1].endswith("hr=2") else move(*a))
        with pytest.raises(OSError, match="is lost"):
            write((DAY, 0), (DAY, 2), base=5, owned=[(DAY, 0), (DAY, 1), (DAY, 2)])
    write((NEXT, 3), base=7)
    assert stored() == {(DAY, 0): 15, (DAY, 2): 15, (NEXT, 0): 3, (NEXT, 3): 21}
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    if bucketed:
        spark.sql(f"DROP TABLE {table}")
