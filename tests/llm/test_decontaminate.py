from __future__ import annotations

import hashlib
import re

import cases
import numpy as np
import pytest

from forgelens.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, window=10):
    phrases: dict[tuple, set] = {}
    for item, text in items:
        words = slow_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            phrases.setdefault(tuple(words[i : i + size]), set()).update([] if item is None else [str(item)])
    out = []
    for doc_id, text in docs:
        words, hit, found = slow_words(text), set(), set()
        for size in {len(p) for p in phrases}:
            for i in range(len(words) - size + 1):
                if (p := tuple(words[i : i + size])) in phrases:
                    found |= phrases[p]
                    hit |= set(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "Boats came in with the tide; nobody spoke until noon, then the bells rang"), (2, "the baker closed"), (10, "über häuser"), (3, None), (4, ""), (None, "the tide"), (2, "the baker closed"), (5, "ab"), (6, "morning light fell over the harbour boats came in with")]


@pytest.mark.parametrize("block", [200_000, 20])
def test_awkward_documents(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    docs, items = cases.awkward(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    found = sorted([tuple(r) for r in decontaminate.op4_benchmark_decontamination(docs, items).collect()], key=str)
    assert found == expected([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
    assert any(r[2] for r in found)


def test_driver_documents(spark):
    docs, items = cases.driver_rows(spark, sf="0.01"), cases.driver_rows(spark, "benchmark", "0.01")
    found = sorted([tuple(r) for r in decontaminate.op4_benchmark_decontamination(docs, items).collect()], key=str)
    assert found == expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])


def test_items_without_an_id_are_hit_but_not_named(spark):
    words = [f"w{i}" for i in range(11)]
    docs = spark.createDataFrame([(1, "x " + " ".join(words) + " y"), (2, " ".join(words[:10])), (3, "x y")], "doc_id long, text string")
    out = {r.doc_id: r for r in decontaminate.op4_benchmark_decontamination(docs, spark.createDataFrame([(None, " ".join(words))], "item_id long, text string")).collect()}
    assert {d: (r.n_hit, r.n_items, r.contaminated) for d, r in out.items()} == {1: (11, 0, True), 2: (10, 0, True), 3: (0, 0, False)}


def test_index_counts_and_places():
    rng = np.random.default_rng(3)
    text = rng.integers(1, 5, 400)
    index = decontaminate.Index(text, 6)
    for size in (1, 2, 3, 5):
        phrase = rng.integers(1, 5, size)
        rows = np.zeros((1, 6), np.int64)
        rows[0, 6 - size :] = phrase
        low, high = index.search(rows, np.array([size]))
        places = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        assert places == [i for i in range(400 - size + 1) if (text[i : i + size] == phrase).all()]


def test_cutting_keeps_the_rest_to_the_byte(spark):
    docs = cases.awkward(spark).selectExpr("doc_id", "text", "'k' as hit_items", "7 as n_words")
    out = {r.doc_id: r for r in decontaminate.cut_passages(docs, spark.createDataFrame([(2, "the baker closed")], "item_id long, text string")).collect()}
    assert "The baker closed" not in out[1].text and out[1].text.endswith("  his shop early. A letter lay unopened on the table. ".strip(" ") + " ")
    assert out[7].text == cases.ROWS[7][1] and out[4].text is None and (out[1].hit_items, out[1].n_words) == ("k", 7)
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.op4_benchmark_decontamination(cases.empty(spark), nothing).count() == 0
    assert decontaminate.op4_benchmark_decontamination(docs.select("doc_id", "text"), nothing).where("contaminated or n_hit > 0").count() == 0
