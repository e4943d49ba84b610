"""Exact top-k search by inner product over norm-bucketed vectors.

Vectors become integers, floor(scale * x). They are ordered by length into buckets of at most
``BUCKET`` vectors, so a bucket's vectors have similar lengths. For a query q with lower bound
t on its k-th score, a vector p of a bucket with greatest length L can only be among the first
k if cos(q, p) >= t / (|q| L), the local threshold. Per bucket and query:

* threshold above 1: no vector of the bucket can reach it, the bucket is skipped;
* a high threshold: coordinate pruning. On the query's largest coordinates the unit vectors of
  the bucket must lie in an interval round the query's, found from the threshold;
* otherwise length pruning: only vectors with |p| >= t / |q|.

What is left is verified by the integer product. The bounds start from the longest vectors and
rise from bucket to bucket. A pruned vector has a score below a bound that k others reach, so
nothing is lost, ties included.

Queries come in blocks of at most ``QUERIES``: a block is broadcast, and each task searches its
buckets for the whole block and returns at most k rows a query, which one window merges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelens.sources.staging import stage

BUCKET = 2048
QUERIES = 4096
_HIGH = 0.75
_FOCUS = 4
_EXACT = 1 << 53


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(id, v, size) of the usable vectors: not null, without null or non-finite components."""
    v = F.col(vector_column)
    usable = vectors.where(F.col(id_column).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    squares = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return usable.select(F.col(id_column).cast("long").alias("id"), whole.alias("v")).withColumn("length", F.sqrt(squares))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column(1)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


class _Best:
    """The k best (score, id) of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * queries
        self.ids = [np.zeros(0, np.int64)] * queries

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores[query], scores), np.append(self.ids[query], ids)
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]

    def bound(self, query: int) -> float:
        return float(self.scores[query][-1]) if len(self.scores[query]) == self.k else -np.inf


def _products(rows: np.ndarray, query: np.ndarray, floats: np.ndarray | None, query_floats: np.ndarray) -> np.ndarray:
    """Integer products: in doubles where these are exact, else in 64-bit integers."""
    return (floats @ query_floats).astype(np.int64) if floats is not None else rows @ query


def _search(ids: np.ndarray, rows: np.ndarray, queries: tuple, best: _Best, bounds: np.ndarray) -> None:
    """Verify one bucket's candidates for every query."""
    query_ids, query_rows, lengths_q = queries
    floats = rows.astype(np.float64)
    lengths = np.sqrt((floats * floats).sum(1))
    order = np.argsort(-lengths, kind="stable")
    ids, rows, floats, lengths = ids[order], rows[order], floats[order], lengths[order]
    top = lengths[0]
    unit = floats / np.maximum(lengths, 1e-300)[:, None]
    small = top * lengths_q.max(initial=0) < _EXACT
    for q in range(len(query_ids)):
        bound = max(bounds[q], best.bound(q))
        exact = floats if small else None
        if bound == -np.inf or bound <= 0 or lengths_q[q] == 0 or top == 0:
            pick = slice(None)
        else:
            threshold = bound / (lengths_q[q] * top) * (1 - 1e-9)
            if threshold > 1:
                continue
            stop = int(np.searchsorted(-lengths, -bound / lengths_q[q] * (1 - 1e-9), "right"))
            pick = slice(0, stop)
            if threshold >= _HIGH:
                # With cos >= c, p on a coordinate lies within q c -+ sqrt((1 - q^2)(1 - c^2)), or beyond c towards q.
                direction = query_rows[q] / lengths_q[q]
                keep = np.arange(stop)
                for f in np.argsort(-np.abs(direction))[:_FOCUS]:
                    x, spread = direction[f], np.sqrt(max(0.0, (1 - direction[f] ** 2) * (1 - threshold**2)))
                    low = -1.0 if -x >= threshold else x * threshold - spread
                    high = 1.0 if x >= threshold else x * threshold + spread
                    side = unit[keep, f]
                    keep = keep[(side >= low - 1e-9) & (side <= high + 1e-9)]
                pick = keep
        scores = _products(rows[pick], query_rows[q], exact[pick] if exact is not None else None, query_rows[q].astype(np.float64))
        found = ids[pick]
        use = (scores >= bound) & (found != query_ids[q])
        if use.any():
            best.add(q, scores[use], found[use])


def _block(rows: list, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    matrix = np.array([r.v for r in rows], np.int64).reshape(len(rows), width)
    return np.array([r.id for r in rows], np.int64), matrix, np.sqrt((matrix.astype(float) ** 2).sum(1))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best vectors for each query, or all if fewer.

    A query's own row, and any row of its id, is no candidate of it. Vectors of another number
    of components than the query's are none either. Rows repeated under one id stay separate
    candidates; as a query an id counts once, with its smallest vector. Vectors that are null or
    hold null or non-finite components take no part. Ties go to the smaller id.
    """
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, id_column, vector_column, scale).withColumn("width", F.size("v"))
    # Sorted by length within tasks that hold a range of lengths each: rows of a bucket are alike.
    stored = stage(whole.repartitionByRange(F.col("width"), F.col("length").desc(), F.col("id")).sortWithinPartitions("width", F.col("length").desc()))
    flagged = vectors.where(is_query).select(F.col(id_column).cast("long").alias("id")).distinct()
    asked = stage(stored.join(flagged, "id").groupBy("id").agg(F.min("v").alias("v")).withColumn("width", F.size("v")))
    found = None
    for width, count in sorted((r["width"], r["count"]) for r in asked.groupBy("width").count().collect()):
        mine = stored.where(F.col("width") == width).select("id", "v", "length")
        n = -(-count // QUERIES)
        longest = mine.orderBy(F.col("length").desc(), "id").limit(BUCKET).collect()
        first = _block(longest, width)
        for part in range(n):
            rows = asked.where((F.col("width") == width) & (F.pmod(F.xxhash64("id"), F.lit(n)) == part)).orderBy("id").collect()
            if not rows:
                continue
            queries = _block(rows, width)
            start = _Best(len(rows), k)
            _search(first[0], first[1], queries, start, np.full(len(rows), -np.inf))
            bounds = np.array([start.bound(q) for q in range(len(rows))])
            sent = spark.sparkContext.broadcast((queries, bounds))

            def run(batches: Iterator[pa.RecordBatch], sent=sent, width=width) -> Iterator[pa.RecordBatch]:
                queries, bounds = sent.value
                best = _Best(len(queries[0]), k)
                for batch in batches:
                    ids, matrix = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch, width)
                    for a in range(0, len(ids), BUCKET):
                        _search(ids[a : a + BUCKET], matrix[a : a + BUCKET], queries, best, bounds)
                sizes = [len(s) for s in best.scores]
                columns = [np.repeat(queries[0], sizes), np.concatenate(best.ids), np.concatenate(best.scores)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

            out = mine.select("id", "v").mapInArrow(run, "query_id long, vec_id long, score long")
            found = out if found is None else found.unionAll(out)
    if found is None:
        found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op1_exact_top_k(vectors: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score of every hundredth vector."""
    return top_k(vectors, F.col("vec_id") % 100 == 0)


OP1_SQL = """
with v as (
  select vec_id::bigint as vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, p.vec_id, list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2]))::bigint as score
  from v q join v p on p.vec_id <> q.vec_id and len(p.v) = len(q.v) where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""
