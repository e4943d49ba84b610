from __future__ import annotations

import math
import zlib
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from forgelens.llm import pitman_yor

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens(text):
    return (text or "").encode().translate(LOWER).split() + [b""]


def base_scores(rows):
    counts = Counter(w for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        held = d is not None and zlib.crc32(str(d).encode()) % 7 == 2
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))
        out.append((d, held, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(base, 6)))
    return sorted(out, key=str)


def test_counts_and_base_of_awkward_and_driver_documents(spark):
    for docs in (cases.awkward(spark), cases.driver_rows(spark)):
        found = pitman_yor.op9_lm_scoring(docs).collect()
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found], key=str)
        assert [g[:5] for g in got] == [w[:5] for w in base_scores(rows)]
        assert [g[5] for g in got] == pytest.approx([w[5] for w in base_scores(rows)], rel=1e-6)
        assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    out = pitman_yor.op9_lm_scoring(cases.driver_rows(spark, sf="0.01")).where("held_out")
    sums = out.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert sums.s / sums.n > sums.b / sums.n + 0.2
    again = pitman_yor.op9_lm_scoring(cases.driver_rows(spark, sf="0.01").limit(10_000)).where("held_out").agg(F.sum("score")).first()[0]
    assert again == pytest.approx(sums.s, rel=1e-6)


def test_probabilities_sum_to_one(spark):
    """Texts of every known word and an unknown one: all that can come first, or second."""
    train = spark.createDataFrame([(k, t) for k, t in enumerate(["a b a c", "b a b b", "c", "a a d", "d e", "a"] * 3)], "doc_id long, text string")
    words = ["a", "b", "c", "d", "e", "new"]
    asked = spark.createDataFrame([(100 + k, w) for k, w in enumerate(words)] + [(200, "")], "doc_id long, text string")
    ends = {r.doc_id: r.score for r in pitman_yor.score_texts(train.unionAll(asked), F.col("doc_id") >= 100, contexts=1).where("doc_id >= 100").collect()}
    # P(w, end) = P(w | start) P(end | w), and with one context besides the start all P(end | w) are equal.
    first = [10 ** ends[100 + k] for k in range(6)]
    nothing = 10 ** ends[200]
    end_after = sum(first) / (1 - nothing)
    assert 0 < end_after < 1
    two = spark.createDataFrame([(400 + k, f"new {w}") for k, w in enumerate(words)], "doc_id long, text string")
    more = {r.doc_id: r.score for r in pitman_yor.score_texts(train.unionAll(asked).unionAll(two), F.col("doc_id") >= 100, contexts=1).where("doc_id >= 100").collect()}
    # P(new w end) / (P(new | start) P(end)) over all w, plus P(end), is one.
    p_new = 10 ** more[105] / end_after
    assert sum(10 ** more[400 + k] for k in range(6)) / (p_new * end_after) + end_after == pytest.approx(1, abs=1e-4)


def test_tables_follow_their_conditional():
    """Against the exact distribution, by enumerating the seatings' weights."""
    random = np.random.default_rng(1)
    d, a, c = 0.6, 0.7, 5
    stirling = {(1, 1): 1.0}
    for n in range(1, c):
        for t in range(1, n + 2):
            stirling[n + 1, t] = stirling.get((n, t - 1), 0) + (n - t * d) * stirling.get((n, t), 0)
    weights = np.array([stirling[c, t] * a**t for t in range(1, c + 1)])
    drawn = pitman_yor.draw_tables(np.full(40_000, c), np.full(40_000, a), d, random)
    shares = np.bincount(drawn, minlength=c + 1)[1:] / 40_000
    assert shares == pytest.approx(weights / weights.sum(), abs=0.01)
    many = pitman_yor.draw_tables(np.array([0, 1, 2, 64, 65, 5_000, 1_000_000]), np.full(7, 3.0), d, random)
    assert many[0] == 0 and many[1] == 1 and (many <= [0, 1, 2, 64, 65, 5_000, 1_000_000]).all() and (np.diff(many) >= -5).all()


def test_empty_table(spark):
    assert pitman_yor.op9_lm_scoring(cases.empty(spark)).count() == 0
