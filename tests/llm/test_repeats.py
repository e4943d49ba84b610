from __future__ import annotations

import hashlib
import random

import cases
import numpy as np
import pytest

from forgelens.llm import induced, repeats
from forgelens.llm.induced import DEPTH, suffix_array
from forgelens.sources.staging import stage


@pytest.mark.parametrize("memory", [8, 1 << 20])
@pytest.mark.parametrize("letters", [1, 2, 26])
def test_suffixes_and_common_prefixes(letters, memory):
    rng = random.Random(letters)
    for _ in range(40):
        strings = [bytes(rng.randrange(97, 97 + letters) for _ in range(rng.choice([1, 2, 7, 40, 150]))) for _ in range(rng.randint(1, 6))]
        order, common, starts = suffix_array(strings, memory)
        text = b"".join(bytes(c + 1 for c in s) + b"\0" for s in strings)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        assert [text[s - 1 : s] for s in starts[1:]] == [b"\0"] * (len(strings) - 1)
        for k in range(1, len(order)):
            a, b = text[order[k - 1] :], text[order[k] :]
            equal = next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert common[k] == min(DEPTH, equal)


def brute_force(rows):
    """Expected digest of each (doc_id, text), by looking up every window."""
    first: dict[bytes, tuple] = {}
    order = lambda d: (d is not None, d or 0)
    for doc_id, text in rows:
        raw = (text or "").encode()
        for s in range(len(raw) - 99):
            place = (order(doc_id), s)
            first[raw[s : s + 100]] = min(first.get(raw[s : s + 100], place), place)
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - 99):
            if first[raw[s : s + 100]] < (order(doc_id), s):
                gone[s : s + 100] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    return sorted([tuple(r) for r in repeats.op7_suffix_array_dedup(docs).collect()], key=str)


def test_awkward_documents(spark):
    docs = cases.awkward(spark)
    assert found(docs) == brute_force([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("crowd", [256, 2])
def test_driver_documents(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    docs = cases.driver_rows(spark)
    assert found(docs) == brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_text_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_BLOCK", 512)
    docs = cases.awkward(spark)
    assert found(docs) == brute_force([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table_and_clashing_names(spark):
    assert found(cases.empty(spark)) == []
    docs = cases.awkward(spark).selectExpr("doc_id", "text", "'x' as kept", "1 as start", "2 as key", "3 as n_bytes", "4 as h")
    out = repeats.cut_repeats(docs)
    assert out.count() == len(cases.ROWS)
    assert {"start", "key", "h", "kept", "n_bytes"} <= set(out.columns) and "text" not in out.columns
    assert out.where("start <> 1 or key <> 2 or h <> 4").count() == 0


def test_pending_tuples_of_a_byte_are_taken_at_once():
    queues = induced._Queues(100)
    for k in range(3):
        queues.put(7, np.array([k, k + 10]), np.array([k, k], np.uint8))
    suffixes, common = queues.take(7)
    assert (suffixes.tolist(), common.tolist()) == ([0, 10, 1, 11, 2, 12], [0, 0, 1, 1, 2, 2])
    assert queues.take(7) is None and queues.held == 0


def test_parts_on_disk_keep_their_order():
    queues, taken = induced._Queues(3), []
    for k in range(4):
        queues.put(7, np.array([k, k + 10]), np.zeros(2, np.uint8))
    while (part := queues.take(7)) is not None:
        taken += part[0].tolist()
    assert taken == [0, 10, 1, 11, 2, 12, 3, 13]


def test_runs_cover_each_window_once():
    rng = random.Random(5)
    texts = [bytes(rng.randrange(97, 99) for _ in range(n)) for n in (0, 300, 99, 100, 0, 0, 1500, 101, 0)]
    stops = np.cumsum([len(t) for t in texts])
    starts = stops - [len(t) for t in texts]
    runs = list(zip(*(c.tolist() for c in repeats._runs(np.frombuffer(b"".join(texts), np.uint8), starts, stops)), strict=True))
    windows = [(text, start + k) for text, _, start, further, _ in runs for k in range(further + 1)]
    assert windows == [(text, k) for text, t in enumerate(texts) for k in range(len(t) - 99)]
    grams = {}
    for text, h, start, further, way in runs:
        assert further <= way <= 100 - repeats.GRAM
        assert grams.setdefault(texts[text][start + way :][: repeats.GRAM], h) == h


def test_stored_cuts_are_compressed_well(spark, monkeypatch):
    stored = {}

    def staged(df, compression=None):
        out = stage(df, compression)
        stored.setdefault("cut" in df.columns, []).extend(out.inputFiles())
        return out

    monkeypatch.setattr(repeats, "stage", staged)
    found(cases.driver_rows(spark))
    assert stored[True] and all(".zstd." in f for f in stored[True])
