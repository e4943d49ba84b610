from __future__ import annotations

import random

import cases
import pytest
from pyspark.sql import functions as F

from forgelens.llm import topk


def expected(rows, k=10, every=100):
    usable = [(i, [int((x * 1024) // 1) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and abs(x) < float("inf") for x in v)]
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        vector = min(v for i, v in usable if i == q)
        scores = sorted((-sum(a * b for a, b in zip(vector, v, strict=True)), i) for i, v in usable if i != q and len(v) == len(vector))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(vectors, **more):
    return sorted(tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 100 == 0, **more).collect())


def test_driver_vectors(spark):
    rows = cases.driver_rows(spark, "embeddings")
    assert sorted(tuple(r) for r in topk.op1_exact_top_k(rows).collect()) == expected([(r.vec_id, r.embedding) for r in rows.collect()])


@pytest.mark.parametrize("queries", [4096, 3])
def test_lengths_ties_and_unusable_vectors(spark, monkeypatch, queries):
    monkeypatch.setattr(topk, "QUERIES", queries)
    monkeypatch.setattr(topk, "BUCKET", 16)
    rng = random.Random(2)
    rows = []
    for i in range(900):
        size = rng.choice([0.1, 1.0, 30.0])
        base = [1.0, 0.5, 0.0, 0.0] if i % 3 else [rng.gauss(0, 1) for _ in range(4)]
        rows.append((i, [size * (x + rng.gauss(0, 0.02)) for x in base]))
    rows += [(900, [1.0, 1.0]), (901, [2.0, 3.0]), (1000, None), (1001, [1.0, None, 0.0, 0.0]), (1100, [float("nan")] * 4), (1102, [float("inf")] * 4), (None, [1.0] * 4)]
    rows += [(200, rows[200][1]), (7, rows[7][1]), (1200, [0.0] * 4), (1300, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(frame) == expected(rows)


def test_few_and_no_vectors(spark):
    some = spark.createDataFrame([(0, [1.0], "x"), (1, [2.0], "y")], "vec_id long, embedding array<double>, score string")
    assert found(some) == [(0, 1, 1, 1024 * 2048)]
    assert found(some.limit(0)) == []
