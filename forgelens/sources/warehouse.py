"""Slice-partitioned and bucketed tables: write whole slices, replace only those, all or none.

A write goes to a folder beside the table first. When it is complete, a plan of the slices to replace
and to clear is stored with it, and only then their directories are exchanged. A failure before
the plan leaves the table as it was; one after it is finished by the next write, or by
``recover``, as everything it needs is there. A table has one writer at a time; a reader sees each
slice as it was or as it is, not the moment of the exchange of all of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelens.contracts import BUCKETS, SLICE, Grain, mart_schema
from forgelens.operators.marts import project_contract
from forgelens.sources.raw import slice_paths
from forgelens.sources.staging import children, make_folder, move, read_text, remove, write_text

Slices = Sequence[tuple[date, int]]
Plan = dict[str, list[str]]  # directories below the table to "replace" and to "clear"

_PLAN = "publish.json"
_AT_ONCE = 16


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def _leaves(files: Iterable[str], depth: int) -> set[str]:
    """``dt=.../hr=...`` of the files' paths."""
    return {"/".join(file.split("/")[-1 - depth : -1]) for file in files}


def _publish(spark: SparkSession, path: str, work: str, depth: int, owned: Slices | None) -> Plan:
    """Store the plan of a complete write and carry it out."""
    made = _leaves(spark.read.schema("_any int").parquet(f"{work}/new").inputFiles(), depth)
    there = _leaves(_files(spark, path, owned or ()), len(SLICE))
    mine = {f"dt={day.isoformat()}/hr={hour}" for day, hour in owned or ()}
    plan = {"replace": sorted(made), "clear": sorted((there & mine) - made)}
    write_text(spark, f"{work}/{_PLAN}", json.dumps(plan))
    return _carry_out(spark, path, work, plan)


def _carry_out(spark: SparkSession, path: str, work: str, plan: Plan, again: bool = False) -> Plan:
    """Exchange the directories of a plan; ``again``: what an earlier try has done already is left."""

    def exchange(leaf: str) -> None:
        if not again or children(spark, f"{work}/new/{leaf}"):
            remove(spark, f"{path}/{leaf}")
            move(spark, f"{work}/new/{leaf}", f"{path}/{leaf}")

    make_folder(spark, path)
    with ThreadPoolExecutor(_AT_ONCE) as pool:  # storage calls: waiting, not work
        list(pool.map(exchange, plan["replace"]))
        list(pool.map(lambda leaf: remove(spark, f"{path}/{leaf}"), plan["clear"]))
    remove(spark, work)
    if not children(spark, _beside(path)):
        remove(spark, _beside(path))
    return plan


def recover(spark: SparkSession, path: str) -> list[Plan]:
    """Finish the writes that failed while slices were exchanged, undo those that failed before.

    Returns the plans that were finished. Costs one storage call if there is nothing to do.
    """
    finished = []
    for name in sorted(children(spark, _beside(path))):
        work = f"{_beside(path)}/{name}"
        if _PLAN in children(spark, work):
            plan = json.loads(read_text(spark, f"{work}/{_PLAN}"))
            finished.append(_carry_out(spark, path, work, plan, again=True))
        else:
            remove(spark, work)
    if not finished:
        remove(spark, _beside(path))
    return finished


def _files(spark: SparkSession, path: str, slices: Slices) -> set[str]:
    """Paths of the files of the slices; Spark lists many directories in tasks."""
    paths = slice_paths(spark, path, slices) if slices else []
    return set(spark.read.schema("_any int").option("basePath", path).parquet(*paths).inputFiles()) if paths else set()


def write_slices(table: DataFrame, path: str, slice_cols: Sequence[str] = SLICE, owned: Slices | None = None) -> None:
    """Replace the slices present in ``table`` below ``path``; all other slices stay.

    Slices named in ``owned`` are replaced in any case: one that gets no rows is cleared.

    The rebalance hint gathers a small slice in one file and lets AQE split a large one
    over several tasks, so that neither many tiny files nor one huge task come up.
    """
    spark = table.sparkSession
    recover(spark, path)
    work = f"{_beside(path)}/{uuid.uuid4().hex}"
    table.hint("rebalance", *slice_cols).write.partitionBy(*slice_cols).parquet(f"{work}/new")
    _publish(spark, path, work, len(slice_cols), owned)


def write_bucketed(
    mart: DataFrame, grain: Grain, table: str, path: str, slice_cols: Sequence[str] = SLICE, owned: Slices | None = None
) -> None:
    """Write the mart as a table partitioned by slice and bucketed by entity id.

    The first call creates the table, later ones replace the slices they bring and clear the
    ``owned`` ones that come out empty, in any session. A table with other buckets or at another place
    than ``path`` is refused. Rows are shuffled by slice and bucket, which leaves one
    sorted file per bucket and slice while all slices are written in parallel.
    """
    spark = mart.sparkSession
    buckets = BUCKETS[grain.name]
    contract = project_contract(mart, mart_schema(grain), slice_cols)
    exists = spark.catalog.tableExists(table)
    if exists:
        _require_same(spark, table, path, buckets, grain.id)
        for plan in recover(spark, path):
            _register(spark, table, plan)
        contract = contract.select(*spark.table(table).columns)
    work = f"{_beside(path)}/{uuid.uuid4().hex}"
    placed = contract.repartition(*slice_cols, F.pmod(F.hash(grain.id), F.lit(buckets)))
    writer = placed.write.format("parquet").option("compression", "snappy")
    writer = writer.partitionBy(*slice_cols).bucketBy(buckets, grain.id).sortBy(grain.id)
    if not exists:
        writer.option("path", path).saveAsTable(table)
        return
    # A table of its own gives the files their bucket numbers; dropping it leaves them.
    beside = f"{table}_{work[-32:]}"
    try:
        writer.option("path", f"{work}/new").saveAsTable(beside)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
    _register(spark, table, _publish(spark, path, work, len(slice_cols), owned))


def _register(spark: SparkSession, table: str, plan: Plan) -> None:
    """Tell the catalog the slices that a plan has made and cleared."""

    def specs(leaves: list[str]) -> list[str]:
        values = [[part.split("=", 1) for part in leaf.split("/")] for leaf in leaves]
        literal = lambda v: "NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'"
        return [f"PARTITION ({', '.join(f'{k} = {literal(v)}' for k, v in leaf)})" for leaf in values]

    made, gone = specs(plan["replace"]), specs(plan["clear"])
    for start in range(0, len(made), 500):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(made[start : start + 500])}")
    for start in range(0, len(gone), 500):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone[start : start + 500])}")
    spark.catalog.refreshTable(table)


def _require_same(spark: SparkSession, table: str, path: str, buckets: int, key: str) -> None:
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if about.get("Num Buckets") != str(buckets) or about.get("Bucket Columns") != f"[`{key}`]":
        raise ValueError(f"{table} was not written by write_bucketed: it is not in {buckets} buckets of {key}")
    plain = lambda p: p.split(":", 1)[-1].lstrip("/").rstrip("/") if p.startswith("file:") else p.strip("/")
    if plain(about["Location"]) != plain(path):
        raise ValueError(f"{table} is stored at {about['Location']}, not at {path}")
