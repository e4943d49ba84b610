"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_open: list[list[str]] = []  # folders made since each open ``staging`` block began


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="forgelens-"))
        root = spark.sparkContext.getCheckpointDir()
    path = f"{root.rstrip('/')}/forgelens-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside the block when it ends, also if it fails.

    For steps that store their results: frames made inside must not be read after it. A lazy
    frame that a query returns still needs its staged tables, so queries don't use this.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is in; nothing happens if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def make_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the folders above its new place are made."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    store = new.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(new.getParent())
    if not store.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; it appears under its name when it is whole."""
    place, part = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.part"))
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not store.rename(part, place):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()[0]


def day_dir(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/dt={day.isoformat()}"


def slice_dir(root: str, day: date, hour: int) -> str:
    return f"{day_dir(root, day)}/hr={hour}"


def children(spark: SparkSession, path: str) -> set[str]:
    """Names directly in a folder, by one storage call; none if it doesn't exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        return {f.getPath().getName() for f in store.listStatus(place)}
    except Py4JJavaError as error:
        if "FileNotFoundException" in error.java_exception.getClass().getName():
            return set()
        raise


def stage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from the stored copy.

    For a frame that several branches of a plan read: it is computed once, its lineage
    ends here, and losing an executor costs no recomputation.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
