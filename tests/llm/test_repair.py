from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import cases
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forgelens.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
AWKWARD = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi!"), (1, 2, "user", "What now?"),
    (2, None, "system", "Be brief."), (2, 3, "user", "One."), (2, 3, "user", "One."), (2, 9, "assistant", "Two"),
    (3, 0, None, None), (3, 1, "tool", "output."), (3, 2, "user", "  \n\t "), (3, 3, "", "text."),
    (None, None, None, None), (None, 4, "assistant", "No id."), (None, 4, "assistant", "No id."),
    (5, 0, "assistant", "No start. \n"), (5, 1, "assistant", "Again?"), (5, 2, "system", "Late."), (5, 7, "user", "Ünïcödé 中"),
    (6, 2**40, "user", "Far."), (6, -5, "assistant", "Before!"), (7, 0, "user", "long " * 60_000 + "."),
    (8, None, "user", "x."), (8, None, "assistant", "y."), (8, None, "user", "x."),
]


def damage(row):
    conv_id, turn, role, text = row
    plain = lambda x: " " if x is None else str(x)
    role, text = plain(role), plain(text)
    kind = zlib.crc32(f"{plain(conv_id)}:{plain(turn)}".encode()) % 20
    if kind == 0:
        return []
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def cheapest(rows):
    """(cost, audit) by trying everything: rows are (initial, fault)."""
    kept = {("s", ""): "s", **{("u", x): "u" for x in ("", "s", "a")}, ("a", "u"): "a"}
    other = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserts):
        ways = []
        if i == len(rows) and last in ("", "a"):
            ways.append((0, ""))
        if inserts < 3:
            cost, audit = best(i, other[last], inserts + 1)
            ways.append((cost + 5, "I" + audit))
        if i < len(rows):
            initial, fault = rows[i]
            cost, audit = best(i + 1, last, 0)
            ways.append((cost + 2, "D" + audit))
            if fault not in ("b", "d"):
                extra = 5 * (fault == "t")
                if (initial, last) in kept:
                    cost, audit = best(i + 1, kept[initial, last], 0)
                    ways.append((cost + extra, "K" + audit))
                cost, audit = best(i + 1, other[last], 0)
                ways.append((cost + 1 + extra, "R" + audit))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def expected(table):
    out = []
    for conv_id in {r[0] for r in table}:
        rows = [d for r in table if r[0] == conv_id for d in damage(r)]
        order = lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest())
        rows.sort(key=order)
        turns = {r[1] for r in rows if r[1] is not None}
        marked, seen = [], set()
        for _, _, role, text in rows:
            stripped = text.strip(repair.SPACE)
            fault = "b" if not stripped else "d" if (role, text) in seen else "t" if stripped[-1] not in ".!?" else "-"
            seen.add((role, text))
            marked.append((role[:1], fault))
        cost, audit = cheapest(tuple(marked))
        turn, last, place = [], "", 0
        for edit in audit:
            role, text = ("", "") if edit == "I" else rows[place][2:]
            place += edit != "I"
            if edit != "D":
                role = role if edit == "K" else "assistant" if last == "u" else "user"
                last = role[0]
                turn.append(f"{role}:{'' if edit == 'I' else text}")
        pairs = [a[0] + b[0] for a, b in zip(marked, marked[1:], strict=False)]
        counts = [sum(f == k for _, f in marked) for k in "bdt"]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv_id, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(turn).encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    return sorted([tuple(r) for r in repair.op12_conversation_repair(docs).select(*NAMES).collect()], key=str)


def test_driver_and_awkward_rows_by_trying_everything(spark):
    driver = [tuple(r) for r in cases.driver_rows(spark, "conversations", "0.01").select("conv_id", "turn", "role", "text").collect()]
    table = [*AWKWARD, *[(d and d + 100, *rest) for d, *rest in driver]]
    rows = found(spark.createDataFrame(table, SCHEMA).repartition(3))
    assert rows == expected(table)
    assert {e for r in rows for e in r[7]} == set("DKR")  # a deletion is always cheaper than an insert


@pytest.mark.parametrize("size", [1, 7])
def test_one_conversation_over_many_blocks_and_partitions(spark, monkeypatch, size):
    monkeypatch.setattr(repair, "BLOCK_ROWS", size)
    texts = ["One.", "Two", "", "Three!", "One.", "Four?"]
    hot = [(1, t if t % 11 else None, ("user", "assistant", "user", "system", "assistant")[t % 5], f"{texts[t % 6]}{t % 40}{'.' * (t % 3)}") for t in range(150)]
    hot += [(1, 7, "user", "same.")] * 20
    table = [*hot, (0, 1, "user", "a."), (2, 1, "user", "b.")]
    assert found(spark.createDataFrame(table, SCHEMA)) == expected(table)


ROWS = st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from("-bdt")), max_size=9)


@given(ROWS, st.integers(1, 4))
@settings(deadline=None, max_examples=300)
def test_blocks_give_the_edits_of_the_whole(rows, size):
    cost, audit = cheapest(tuple(rows))
    plain = [(initial, fault, 0) for initial, fault in rows]
    edits, state = repair.walk(plain, repair.FINAL, repair.START)
    assert "".join(edits) + repair.closing(state) == audit and repair.vector(plain, repair.FINAL)[0] == cost
    blocks, end, ends = [plain[k : k + size] for k in range(0, len(plain), size)], list(repair.FINAL), []
    for block in reversed(blocks):
        ends.append(end)
        assert repair.through(repair.matrix(block), end) == repair.vector(block, end)
        end = repair.vector(block, end)
    state, made = repair.START, ""
    for block, end in zip(blocks, reversed(ends), strict=True):
        edits, state = repair.walk(block, end, state)
        made += "".join(edits)
    assert made + repair.closing(state) == audit


def test_repaired_turns_are_whole_conversations(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", 1), (1, 1, "user", "Hello?", 1), (1, 2, "assistant", "Yes.", 2), (2, 0, "user", "No", 0)], f"{SCHEMA}, n long")
    out = {r.conv_id: r for r in repair.repair(rows).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [("user", "Hello?"), ("assistant", "Yes.")] and out[1].edits == "DKKD"
    assert out[2].turns == [] and out[2].edits == "" and out[2].cost == 0


def test_empty_table_and_clashing_names(spark):
    assert repair.op12_conversation_repair(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame(AWKWARD, SCHEMA).selectExpr("*", "1 as n", "2 as block", "'x' as h", "3 as fault", "4 as edits")
    assert found(docs) == expected(AWKWARD)
