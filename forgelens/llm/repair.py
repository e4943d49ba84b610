"""Conversation structure repair: cheapest edits by dynamic programming with checkpoints.

A conversation should hold the roles ``(s?(ua)+)?``: maybe a system turn, then user and assistant
in turn. Walking it takes four states: nothing yet, after the system turn, after a user turn,
after an assistant turn; the first and the last one may be the end. Each row is kept (0), given the
other role (1) or deleted (2); empty turns may be inserted anywhere (5). Blank rows and rows
whose role and text stood earlier are deleted in any case, a truncated row costs 5 unless deleted.

The vector of a place holds the cost from each state to the end. Vectors are computed backward
and stored only at every sqrt(n)-th row. Walking forward, those between two checkpoints
are computed again, and of the edits that reach the vector's cost, the tight ones, the first in
ASCII order is taken: Delete, Insert, Keep, Rerole.

A conversation may hold a third of all rows, so it is no group of Spark's. Rows are sorted
over all partitions by (conv_id, turn) and cut into blocks. A block alone gives the costs between its
4 x 4 states; chained from the end, one small row for each block, they give the vector behind each
block: checkpoints again, between tasks. With it every block is walked from all four states, which
gives each block's first state, and then once more to emit its edits. Only the first and last
conversation of a partition, and those of several blocks, go that way; for the others the block is
the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelens.sources.staging import stage

BLOCK_ROWS, BLOCK_CHARS = 4096, 1 << 20
SPACE = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # by a turn that is inserted or gets the fitting role
_KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
RETYPE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
_NEVER = 1 << 60
FINAL = (0, 2 * INSERT, INSERT, 0)  # behind the last row: what is missing is inserted

BLANK, DUPLICATE, TRUNCATED = "b", "d", "t"  # faults; "-" is none

# A row as the cost sees it: its role's initial and its fault, and how many copies follow it.
Row = tuple[str, str, int]


def before(row: Row, later: Sequence[int]) -> list[int]:
    """The vector before a row from the one behind it."""
    initial, fault, copies = row
    extra = DELETE * copies  # copies are duplicates
    cost = [DELETE + extra + later[s] for s in range(4)]
    if fault not in (BLANK, DUPLICATE):
        extra += CUT_OFF if fault == TRUNCATED else 0
        for s in range(4):
            kept = _KEPT.get((initial, s))
            if kept is not None:
                cost[s] = min(cost[s], extra + later[kept])
            cost[s] = min(cost[s], RETYPE + extra + later[_NEXT[s]])
    for _ in range(2):  # two turns inserted at most: from nothing to an assistant turn
        cost = [min(cost[s], INSERT + cost[_NEXT[s]]) for s in range(4)]
    return cost


def vector(rows: Sequence[Row], end: Sequence[int]) -> list[int]:
    """The vector before all rows."""
    for row in reversed(rows):
        end = before(row, end)
    return list(end)


def matrix(rows: Sequence[Row]) -> list[int]:
    """Cost from each state before the rows to each state behind them, 16 numbers."""
    ways = [vector(rows, [0 if s == to else _NEVER for s in range(4)]) for to in range(4)]
    return [min(ways[to][s], _NEVER) for s in range(4) for to in range(4)]


def through(ways: Sequence[int], end: Sequence[int]) -> list[int]:
    return [min(_NEVER, *(ways[4 * s + to] + end[to] for to in range(4))) for s in range(4)]


def walk(rows: Sequence[Row], end: Sequence[int], state: int) -> tuple[list[str], int]:
    """The ASCII-least tight edits of each row, with the inserts before it, and the state behind them."""
    step = max(1, isqrt(len(rows)))
    places = list(range(0, len(rows), step))
    checkpoints, here = {}, list(end)
    for place in reversed(places):
        checkpoints[place] = here  # the vector behind the part that begins here
        here = vector(rows[place : place + step], here)
    edits = []
    for place in places:
        part, vectors = rows[place : place + step], [checkpoints[place]]
        for row in reversed(part):
            vectors.append(before(row, vectors[-1]))
        for row in part:
            now, later = vectors.pop(), vectors[-1]
            text, state = _edit(row, now, later, state)
            edits.append(text)
    return edits, state


def _edit(row: Row, now: Sequence[int], later: Sequence[int], state: int) -> tuple[str, int]:
    initial, fault, copies = row
    extra, made = DELETE * copies, ""
    cut_off = CUT_OFF if fault == TRUNCATED else 0
    while True:
        if now[state] == DELETE + extra + later[state]:
            return made + "D" * (1 + copies), state
        if now[state] == INSERT + now[_NEXT[state]]:
            made, state = made + "I", _NEXT[state]
            continue
        kept = _KEPT.get((initial, state))
        if kept is not None and now[state] == cut_off + extra + later[kept]:
            return made + "K" + "D" * copies, kept
        return made + "R" + "D" * copies, _NEXT[state]


def closing(state: int) -> str:
    """Inserts behind the last row."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def edited(turns: Sequence[tuple[str, str]], edits: Sequence[str], state: int) -> Iterator[tuple[str, str]]:
    """The turns that the edits leave; ``turns`` may end before the edits do."""
    for k, text in enumerate(edits):
        for edit in text:
            if edit == "D":
                continue
            role, said = turns[k] if k < len(turns) else ("", "")
            if edit == "K":
                state = _KEPT[role[:1], state]
                yield role, said
            else:
                state = _NEXT[state]
                yield _ROLE[state], "" if edit == "I" else said


# Rows and blocks --------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the rows with faults planted by a hash of their id; n copies, 0 of a dropped row."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    role, text = part("role"), part("text")
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 0, "").when(kind == 4, "user").otherwise(role)
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long")
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("n"))


def _identity() -> Column:
    """Tells roles and texts of a conversation apart; also settles the order of rows of one turn."""
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, n) in order, cut into blocks (see ``repair``)."""
    marked = rows.withColumn("h", _identity())
    spans = marked.where("n > 0").groupBy("conv_id", "h").agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
    # Stored: few rows as a rule, and a join with a stored table is split where a key is frequent.
    repeated = stage(spans.where("not (first <=> last)").select(F.col("conv_id").alias("__id"), F.col("h").alias("__h"), F.col("first.turn").alias("__turn")))
    # Equal rows of one turn become one row before anything is sorted.
    single = marked.groupBy("conv_id", "turn", "role", "text", "h").agg(F.sum("n").alias("n"))
    joined = single.join(repeated, F.expr("conv_id <=> __id and h = __h"), "left")
    stripped = F.rtrim("text", F.lit(SPACE))
    later = F.col("__h").isNotNull() & ~F.col("turn").eqNullSafe(F.col("__turn"))
    fault = F.when(stripped == "", BLANK).when(later, DUPLICATE).when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise("-")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("h")]
    sorted_rows = (
        joined.select("conv_id", "turn", "role", "text", "n", "h", fault.alias("fault"))
        .repartitionByRange(*order).sortWithinPartitions(*order).drop("h")
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, whole boolean, rows array<struct<initial:string,fault:string,copies:bigint>>, turns array<struct<role:string,text:string>>, "
        "first_turn bigint, last_turn bigint, n_turns bigint, first_initial string, last_initial string, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
    )
    return sorted_rows.mapInArrow(_cut_blocks, schema).withColumn("block", F.monotonically_increasing_id())


_LEGAL = {"su", "ua", "au"}


class _Block:
    def __init__(self, conv_id, whole: bool):
        self.conv_id, self.whole = conv_id, whole
        self.rows: list[Row] = []
        self.turns: list[tuple[str, str]] = []
        self.chars, self.n_turns, self.illegal = 0, 0, 0
        self.first_turn = self.last_turn = self.first_initial = self.last_initial = None
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}

    def add(self, turn, role: str, text: str, n: int, fault: str) -> None:
        self.rows.append((role[:1], fault, n - 1))
        gone = fault in (BLANK, DUPLICATE)  # its role and text can't come back
        self.turns.append(("", "") if gone else (role, text))
        self.chars += 0 if gone else len(role) + len(text)
        if turn is not None and turn != self.last_turn:
            self.n_turns, self.last_turn = self.n_turns + 1, turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        if self.last_initial is not None:
            self.illegal += self.last_initial + role[:1] not in _LEGAL
        else:
            self.first_initial = role[:1]
        self.last_initial = role[:1]
        self.illegal += n - 1
        if fault in self.faults:
            self.faults[fault] += 1
        self.faults[BLANK if fault == BLANK else DUPLICATE] += n - 1

    def row(self) -> dict:
        named = {"blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED]}
        own = {k: getattr(self, k) for k in ("conv_id", "whole", "first_turn", "last_turn", "n_turns", "first_initial", "last_initial", "illegal")}
        rows = [{"initial": i, "fault": f, "copies": c} for i, f, c in self.rows]
        return {**own, **named, "rows": rows, "turns": [{"role": r, "text": t} for r, t in self.turns]}


_ROWS = pa.list_(pa.struct([("initial", pa.string()), ("fault", pa.string()), ("copies", pa.int64())]))
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one sorted partition, one conversation each."""
    counts = [(k, pa.int64()) for k in ("first_turn", "last_turn", "n_turns")]
    initials = [(k, pa.string()) for k in ("first_initial", "last_initial")]
    faults = [(k, pa.int64()) for k in ("blank", "duplicate", "truncated", "illegal")]
    block, first = None, True
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        schema = pa.schema([("conv_id", kind), ("whole", pa.bool_()), ("rows", _ROWS), ("turns", _TURNS), *counts, *initials, *faults])
        done: list[dict] = []
        for r in batch.to_pylist():
            if block is None:
                block = _Block(r["conv_id"], False)
            elif block.conv_id != r["conv_id"]:
                done.append(block.row())
                block, first = _Block(r["conv_id"], True), False
            elif len(block.rows) >= BLOCK_ROWS or block.chars >= BLOCK_CHARS:
                block.whole = False
                done.append(block.row())
                block = _Block(r["conv_id"], False)
            if r["n"]:
                block.add(r["turn"], r["role"], r["text"], r["n"], r["fault"])
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if block is not None:
        block.whole = False  # the next partition may go on with it
        yield pa.RecordBatch.from_pylist([block.row()], schema)


def _rows_of(values: list[dict]) -> list[Row]:
    return [(r["initial"], r["fault"], r["copies"]) for r in values]


def _with_ends(blocks: DataFrame) -> DataFrame:
    """Blocks of conversations cut between tasks, each with its first state and the vector behind it."""
    kind = blocks.schema["conv_id"].dataType.simpleString()
    vectors, numbers = pa.list_(pa.int64()), pa.list_(pa.int32())

    def matrices(batches):
        for batch in batches:
            made = [matrix(_rows_of(r)) for r in batch.column("rows").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), pa.array(made, vectors)], names=["conv_id", "block", "ways"])

    def backward(chain: pa.Table) -> pa.Table:
        chain, end, ends = chain.sort_by([("block", "descending")]), list(FINAL), []
        for ways in chain["ways"].to_pylist():
            ends.append(end)
            end = through(ways, end)
        return pa.table({"block": chain["block"], "end": pa.array(ends, vectors)})

    def exits(batches):
        for batch in batches:
            made = []
            for rows, end in zip(batch.column("rows").to_pylist(), batch.column("end").to_pylist(), strict=True):
                rows = _rows_of(rows)
                start = vector(rows, end)
                made.append([walk(rows, end, s)[1] if start[s] < _NEVER else s for s in range(4)])
            yield pa.RecordBatch.from_arrays([*batch.select(["conv_id", "block", "end"]).columns, pa.array(made, numbers)], names=["conv_id", "block", "end", "exits"])

    def forward(chain: pa.Table) -> pa.Table:
        chain, state, states = chain.sort_by("block"), START, []
        for after in chain["exits"].to_pylist():
            states.append(state)
            state = after[state]
        last = [False] * (len(states) - 1) + [True]
        return pa.table({"block": chain["block"], "end": chain["end"], "state": pa.array(states, pa.int32()), "last": pa.array(last)})

    narrow = blocks.select("conv_id", "block", "rows")
    ends = narrow.mapInArrow(matrices, f"conv_id {kind}, block bigint, ways array<bigint>").groupBy("conv_id").applyInArrow(backward, "block bigint, end array<bigint>")
    left = narrow.join(ends, "block").mapInArrow(exits, f"conv_id {kind}, block bigint, end array<bigint>, exits array<int>")
    places = left.groupBy("conv_id").applyInArrow(forward, "block bigint, end array<bigint>, state int, last boolean")
    return blocks.join(places, "block")


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation of ``rows`` (conv_id, turn, role, text, n), in blocks.

    ``turn`` is a whole number or null, ``n`` the number of copies of a row, 0 for a row that only
    makes its conversation exist. Rows are taken by turn, nulls first, rows of one turn by a hash
    of role and text; roles and texts must not be null. A row's first fault counts: blank, then
    duplicate, then truncated. Rows with a null conv_id are a conversation of their own.

    Returns one row for each block: conv_id, block (rising within a conversation), edits (initials
    of its edits), turns (array of role and text as repaired), cost; and for counts over
    the whole the block's first and last turn and initial, number of turns, faults and illegal
    neighbours. A conversation without rows has one block without turns; an empty table gives
    none. Other columns of ``rows`` are left out.
    """
    alone, together = _repaired(rows)
    return alone.unionAll(together)


def _repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks that are a conversation, and those that may go on in another one."""
    blocks = stage(_blocks(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.col("n").cast("long").alias("n"))))
    alone = blocks.where("whole").withColumns({"end": F.lit(list(FINAL)).cast("array<bigint>"), "state": F.lit(START), "last": F.lit(True)})
    together = _with_ends(blocks.where("not whole")).select(alone.columns)
    kept = ["conv_id", "block", "whole", "first_turn", "last_turn", "n_turns", "first_initial", "last_initial", "blank", "duplicate", "truncated", "illegal"]
    schema = ", ".join(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in kept)

    def solve(batches):
        for batch in batches:
            edits_of, turns_of, costs = [], [], []
            for r in batch.select(["rows", "turns", "end", "state", "last"]).to_pylist():
                rows = _rows_of(r["rows"])
                edits, state = walk(rows, r["end"], r["state"])
                if r["last"]:
                    edits.append(closing(state))
                turns = [(t["role"], t["text"]) for t in r["turns"]]
                turns_of.append([{"role": a, "text": b} for a, b in edited(turns, edits, r["state"])])
                edits_of.append("".join(edits))
                costs.append(_cost(rows, edits))
            made = [pa.array(edits_of, pa.string()), pa.array(costs, pa.int64()), pa.array(turns_of, _TURNS)]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, *made], names=[*kept, "edits", "cost", "turns"])

    def solved(part: DataFrame) -> DataFrame:
        return part.mapInArrow(solve, f"{schema}, edits string, cost bigint, turns array<struct<role:string,text:string>>")

    return solved(alone), solved(together)


def _cost(rows: Sequence[Row], edits: Sequence[str]) -> int:
    price = {"D": DELETE, "I": INSERT, "K": 0, "R": RETYPE}
    total = sum(price[e] for text in edits for e in text)
    return total + sum(CUT_OFF for row, text in zip(rows, edits, strict=False) if row[1] == TRUNCATED and text.lstrip("I")[0] != "D")


def op12_conversation_repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conv_id.

    A null id, turn, role or text is one space for the damage; a null conv_id is returned as null.
    Blocks are joined in a stream sorted by conversation: no more than a block's texts are in memory,
    only the audit, which is one value of the result, grows with its conversation.
    """
    alone, together = _repaired(damaged(conversations))
    kind = alone.schema["conv_id"].dataType.simpleString()
    counts = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    schema = f"conv_id {kind}, {counts}, audit string, repaired_sha256 string"
    in_order = together.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return alone.mapInArrow(_digest, schema).unionAll(in_order.mapInArrow(_digest, schema))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("blank", "duplicate", "truncated", "illegal", "cost")
    now: dict | None = None

    def begin(conv_id) -> dict:
        return {"conv_id": conv_id, **dict.fromkeys(names, 0), "first": None, "last": None, "n": 0, "initial": None, "edits": [], "sha": hashlib.sha256(), "any": False}

    def end(now: dict) -> dict:
        gaps = 0 if now["first"] is None else now["last"] - now["first"] + 1 - now["n"]
        return {"conv_id": now["conv_id"], "gaps": gaps, **{k: now[k] for k in names}, "audit": "".join(now["edits"]), "repaired_sha256": now["sha"].hexdigest()}

    for batch in batches:
        schema = pa.schema([batch.schema.field("conv_id"), *[(k, pa.int64()) for k in ("gaps", *names)], ("audit", pa.string()), ("repaired_sha256", pa.string())])
        done = []
        for r in batch.to_pylist():
            if now is None or now["conv_id"] != r["conv_id"]:
                if now is not None:
                    done.append(end(now))
                now = begin(r["conv_id"])
            for k in names:
                now[k] += r[k]
            now["n"] += r["n_turns"] - (r["first_turn"] is not None and r["first_turn"] == now["last"])
            now["first"] = r["first_turn"] if now["first"] is None else now["first"]
            now["last"] = now["last"] if r["last_turn"] is None else r["last_turn"]
            if now["initial"] is not None and r["first_initial"] is not None:
                now["illegal"] += now["initial"] + r["first_initial"] not in _LEGAL
            now["initial"] = now["initial"] if r["last_initial"] is None else r["last_initial"]
            now["edits"].append(r["edits"])
            for turn in r["turns"]:
                now["sha"].update(("\n" if now["any"] else "").encode() + f"{turn['role']}:{turn['text']}".encode("utf-8", "surrogatepass"))
                now["any"] = True
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([end(now)], schema)
