from __future__ import annotations

import cases
import numpy as np

from forgelens.llm import quality


def test_linear_time_form_equals_all_pairs():
    rng = np.random.default_rng(4)
    machine = quality.Machine(0.3, rng.normal(size=quality.SLOTS), rng.normal(size=(quality.SLOTS, quality.FACTORS)) / 5)
    slots, values = quality.features("One two two three. FOUR!", None)
    raw = machine.bias + sum(machine.linear[s] * x for s, x in zip(slots, values, strict=True))
    for i in range(len(slots)):
        for j in range(i):
            raw += machine.factors[slots[i]] @ machine.factors[slots[j]] * values[i] * values[j]
    assert abs(machine.score(slots, values) - 1 / (1 + np.exp(-raw))) < 1e-6


def test_held_out_accuracy(spark):
    docs, labels = (cases.driver_rows(spark, t, "0.01") for t in ("documents", "labels"))
    out = quality.op8_quality_classifier(docs, labels)
    assert out.count() == docs.count() and out.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
    both = out.join(labels, "doc_id").where("held_out").collect()
    right = [r.predicted == r.quality for r in both]
    assert len(right) > 40 and sum(right) / len(right) > 0.93
    again = {r.doc_id: r.score for r in quality.op8_quality_classifier(docs.repartition(5), labels.repartition(3)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in out.collect())


def test_labels_are_no_input_of_a_score(spark):
    docs, labels = (cases.driver_rows(spark, t, "0.001") for t in ("documents", "labels"))
    plain = {r.doc_id: r.score for r in quality.op8_quality_classifier(docs, labels).collect()}
    other = docs.selectExpr("doc_id", "text", "'q' as lang", "'q' as source", "n_chars", "1 as quality")
    moved = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    assert {r.doc_id: r.score for r in quality.op8_quality_classifier(other, moved).collect()} == plain


def test_awkward_documents_and_labels(spark):
    docs = cases.awkward(spark).selectExpr("*", "'x' as score", "7 as predicted", "8 as held_out")
    kinds = "doc_id long, quality int, toxic int"
    for rows in ([], [(1, 1, 0)], [(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (3, 5, 0)], [(k, k % 2, 0) for k in range(1, 15)] * 2):
        out = quality.op8_quality_classifier(docs, spark.createDataFrame(rows, kinds)).collect()
        assert len(out) == len(cases.ROWS) and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    assert quality.op8_quality_classifier(cases.empty(spark), spark.createDataFrame([(1, 1, 0)], kinds)).count() == 0
