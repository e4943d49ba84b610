"""Language model: hierarchical Pitman-Yor process over words in the context of the word before.

Model. The word before picks a restaurant by its hash among ``contexts`` (the start of a text
has its own); the restaurants share a parent, the restaurant of single words, whose base is
uniform over the V known words and one for all unknown ones. A word w that sits c times in
restaurant u at t tables of c_u customers at T_u has the probability

    (c - d t) / (r + c_u) + (r + d T_u) / (r + c_u) * P(w),

and P(w) is the same in the parent, whose customers are the children's tables.

Seating. A sweep of Gibbs sampling draws the tables of every (restaurant, word) anew from its
conditional, the generalised Stirling number S_d(c, t) times a^t with a = (r + d T_u) P(w);
beyond ``_EXACT`` customers it goes on customer by customer in steps of a sixteenth. Then the
parent's tables are drawn from the customers they make. Totals are those of the sweep before.
Probabilities are averaged over the sweeps after the burn-in.

Flow. Tasks turn texts into blocks: per block the distinct (word, restaurant) pairs with their
training counts, sorted by word hash, and for each document the numbers of its pairs. Pairs go
to buckets by word hash, at most once a block, so a frequent word is no hot key; a bucket has
whole words, so the parent's customers are counted there. Each sweep maps over the buckets, and
only the tables of each restaurant (``contexts`` sums) go round. The answers, a probability for
each pair asked, go back to the blocks, where documents add them up. Words are told apart by
64-bit hashes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelens.llm.common import held_out
from forgelens.sources.staging import stage

CONTEXTS = 4096
BURN_IN, SAMPLES = 2, 2
STRENGTH = 1.0
_BLOCK_WORDS = 2_000_000
_BUCKET_BYTES = 16 << 20
_BUCKETS = 64
_EXACT = 64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b""


def _pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, byte planes apart."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(values.dtype.str.encode() + b" " + planes.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    kind, _, raw = zstandard.ZstdDecompressor().decompress(packed).partition(b" ")
    dtype = np.dtype(kind.decode())
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, -1).T).view(dtype).reshape(-1)


def _slim(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint16 if values.max(initial=0) < 1 << 16 else np.uint32 if values.max(initial=0) < 1 << 32 else np.uint64)


# Blocks ---------------------------------------------------------------------------------

_BLOCK_TYPE = "block string, bucket int, doc_ids array<long>, held array<boolean>, sizes binary, tokens binary, words binary, pairs binary, contexts binary, counts binary"
_BLOCK_COLUMNS = [c.split()[0] for c in _BLOCK_TYPE.split(", ")]
_BLOCK_TYPES = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_())] + [pa.binary()] * 6


def _block(name: str, docs: list[tuple], buckets: int, contexts: int) -> pa.RecordBatch:
    """One block: a row with its documents (bucket -1), and one for each bucket it asks."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    sizes, local = np.zeros(len(docs), np.int64), []
    for k, (_, _, text) in enumerate(docs):
        local += [number[w] for w in (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()]
        local.append(number[_END])
        sizes[k] = len(local)
    sizes = np.diff(sizes, prepend=0)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), np.uint64, len(number))
    order = np.argsort(hashes)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    hashes, tokens = hashes[order], place[np.array(local, np.int64)]
    doc = np.repeat(np.arange(len(docs)), sizes)
    before = np.append(0, (hashes[tokens[:-1]] % np.uint64(contexts)).astype(np.int64))
    before[np.append(True, doc[1:] != doc[:-1])] = contexts  # the start of a text
    pairs, pair_of = np.unique(tokens * (contexts + 1) + before, return_inverse=True)
    held = np.array([h for _, h, _ in docs])
    counts = np.bincount(pair_of[~held[doc]], minlength=len(pairs))
    in_doc = pair_of[np.lexsort((pair_of, doc))]
    steps = np.diff(in_doc, prepend=0)
    first = np.cumsum(sizes) - sizes
    steps[first] = in_doc[first]
    rows = [(name, -1, [d for d, _, _ in docs], held.tolist(), _pack(_slim(sizes)), _pack(_slim(steps)), None, None, None, None)]
    word_of = pairs // (contexts + 1)
    bucket = ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
    word_cut, pair_cut = np.searchsorted(bucket, np.arange(buckets + 1)), np.searchsorted(bucket[word_of], np.arange(buckets + 1))
    for b in range(buckets):
        (w0, w1), (p0, p1) = word_cut[b : b + 2], pair_cut[b : b + 2]
        if w1 > w0:
            each = np.bincount(word_of[p0:p1] - w0, minlength=w1 - w0)
            rows.append((name, b, None, None, None, None, _pack(hashes[w0:w1]), _pack(_slim(each)), _pack(_slim(pairs[p0:p1] % (contexts + 1))), _pack(_slim(counts[p0:p1]))))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BLOCK_TYPES, strict=True)], names=_BLOCK_COLUMNS)


def _blocks(docs: DataFrame, buckets: int, contexts: int) -> DataFrame:
    """Blocks of ``docs`` (doc_id, held, text, task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, n, task = 0, 0, 0
        for batch in batches:
            for doc_id, is_held, text, task in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((doc_id, is_held, text))
                size += len(text or "") // 6 + 1
                if size >= _BLOCK_WORDS:
                    yield _block(f"{task}-{n}", held, buckets, contexts)
                    held, size, n = [], 0, n + 1
        if held:
            yield _block(f"{task}-{n}", held, buckets, contexts)

    return docs.mapInArrow(run, _BLOCK_TYPE)


# Seating --------------------------------------------------------------------------------


def _stirling(discount: float) -> list[np.ndarray]:
    """Logs of S_d(n, 1..n) for n up to _EXACT."""
    rows = [np.zeros(0), np.zeros(1)]
    for n in range(1, _EXACT):
        t = np.arange(1, n + 2)
        with np.errstate(divide="ignore"):
            stay = np.append(rows[n] + np.log(np.maximum(n - t[:-1] * discount, 1e-300)), -np.inf)
        rows.append(np.logaddexp(stay, np.append(-np.inf, rows[n])))
    return rows


def draw_tables(customers: np.ndarray, open_weight: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Numbers of tables of dishes with so many customers; ``open_weight`` is a, see above."""
    tables = np.minimum(customers, 1)
    many = np.flatnonzero(customers > 1)
    known, log_a = _stirling(discount), np.log(np.maximum(open_weight, 1e-300))
    start = np.minimum(customers[many], _EXACT)
    order = np.argsort(start, kind="stable")
    cut = np.searchsorted(start[order], np.arange(_EXACT + 2))
    for n in range(2, _EXACT + 1):
        for at in range(cut[n], cut[n + 1], 20_000):
            dishes = many[order[at : min(at + 20_000, cut[n + 1])]]
            weights = known[n] + np.arange(1, n + 1) * log_a[dishes, None]
            weights = np.cumsum(np.exp(weights - weights.max(1, keepdims=True)), 1)
            tables[dishes] = 1 + (weights < random.random(len(dishes))[:, None] * weights[:, -1:]).sum(1)
    more = np.flatnonzero(customers > _EXACT)
    seated = np.full(len(more), _EXACT)
    while len(more):
        step = np.minimum(np.maximum(seated // 16, 1), customers[more] - seated)
        a = open_weight[more]
        tables[more] += random.binomial(step, np.clip(a / (a + np.maximum(seated - discount * tables[more], 1e-9)), 0, 1))
        seated = seated + step
        on = seated < customers[more]
        more, seated = more[on], seated[on]
    return tables


@dataclass
class Totals:
    """What goes round between sweeps."""

    types: int  # V
    tokens: int  # N
    discount: float
    parent_discount: float
    customers: np.ndarray  # of each restaurant
    tables: np.ndarray
    parent_customers: int
    parent_tables: int

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """P(w) of words with so many customers and tables in the parent."""
        whole = STRENGTH + self.parent_customers
        open_ = (STRENGTH + self.parent_discount * self.parent_tables) / whole
        return np.maximum(customers - self.parent_discount * tables, 0) / whole + open_ / (self.types + 1)

    def opening(self) -> np.ndarray:
        return STRENGTH + self.discount * self.tables


def _merged(rows: list[dict], contexts: int) -> tuple[np.ndarray, ...]:
    """(words, pairs as word number and restaurant, their counts, the pair of each row's each pair)."""
    words = [_unpack(r["words"]) for r in rows]
    each = [_unpack(r["pairs"]).astype(np.int64) for r in rows]
    known, at = np.unique(np.concatenate(words), return_inverse=True)
    word = np.repeat(at, np.concatenate(each))
    key = word * (contexts + 1) + np.concatenate([_unpack(r["contexts"]) for r in rows]).astype(np.int64)
    pairs, pair_of = np.unique(key, return_inverse=True)
    counts = np.bincount(pair_of, np.concatenate([_unpack(r["counts"]) for r in rows]).astype(np.float64), len(pairs)).astype(np.int64)
    return known, at, pairs // (contexts + 1), pairs % (contexts + 1), counts, pair_of


_STATE = "bucket int, word binary, context binary, counts binary, tables array<binary>, parents array<binary>, by_context array<long>, customers_by_context array<long>, numbers array<long>"
_STATE_COLUMNS = [c.split()[0] for c in _STATE.split(", ")]
_STATE_TYPES = [pa.int32(), *[pa.binary()] * 3, *[pa.list_(pa.binary())] * 2, *[pa.list_(pa.int64())] * 3]


def _state(bucket, word, context, counts, tables, parents, contexts: int) -> pa.Table:
    """A bucket after a sweep. numbers: V, N, pairs once and twice, words once and twice, parent's customers and tables."""
    last, n_words = tables[-1], len(parents[-1])
    word_counts = np.bincount(word, counts, n_words).astype(np.int64)
    sums = lambda x: np.bincount(context, x, contexts + 1).astype(np.int64).tolist()
    numbers = [(word_counts > 0).sum(), counts.sum(), (counts == 1).sum(), (counts == 2).sum(), (word_counts == 1).sum(), (word_counts == 2).sum(), last.sum(), parents[-1].sum()]
    row = (bucket, _pack(_slim(word)), _pack(_slim(context)), _pack(_slim(counts)), [_pack(_slim(t)) for t in tables], [_pack(_slim(t)) for t in parents], sums(last), sums(counts), [int(x) for x in numbers])
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, _STATE_TYPES, strict=True)], names=_STATE_COLUMNS)


def _totals(states: DataFrame, contexts: int, discounts: tuple[float, float] | None) -> Totals:
    """Sums over the buckets, combined before the shuffle; a fixed number of them reaches the driver."""
    every = F.concat("by_context", "customers_by_context", "numbers")
    rows = states.select(F.posexplode(every)).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    sums = np.zeros(2 * (contexts + 1) + 8, np.int64)
    for r in rows:
        sums[r["pos"]] = r["n"]
    v, n, p1, p2, w1, w2, customers, tables = sums[-8:].tolist()
    ratio = lambda one, two: float(np.clip(one / max(1, one + 2 * two), 0.1, 0.95))
    own, parent = discounts or (ratio(p1, p2), ratio(w1, w2))
    return Totals(v, n, own, parent, sums[contexts + 1 : -8], sums[: contexts + 1], customers, tables)


def _first_state(requests: DataFrame, contexts: int) -> DataFrame:
    """Buckets with one table for each pair and word."""

    def run(table: pa.Table) -> pa.Table:
        words, _, word, context, counts, _ = _merged(table.to_pylist(), contexts)
        tables = np.minimum(counts, 1)
        parents = np.minimum(np.bincount(word, tables, len(words)).astype(np.int64), 1)
        return _state(table["bucket"][0].as_py(), word, context, counts, [tables], [parents], contexts)

    return requests.groupBy("bucket").applyInArrow(run, _STATE)


def _sweep(states: DataFrame, totals: Totals, sweep: int, keep: bool, contexts: int) -> DataFrame:
    """Every bucket with new tables; those of the sweep before stay if ``keep``."""
    sent = states.sparkSession.sparkContext.broadcast(vars(totals))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals(**sent.value)
        opening = totals.opening()
        parent_open = (STRENGTH + totals.parent_discount * totals.parent_tables) / (totals.types + 1)
        for batch in batches:
            for row in batch.to_pylist():
                random = np.random.default_rng([row["bucket"], sweep])
                word, context, counts = (_unpack(row[c]).astype(np.int64) for c in ("word", "context", "counts"))
                tables, parents = [_unpack(t).astype(np.int64) for t in row["tables"]], [_unpack(t).astype(np.int64) for t in row["parents"]]
                n = len(parents[-1])
                p = totals.parent(np.bincount(word, tables[-1], n), parents[-1])
                new = draw_tables(counts, opening[context] * p[word], totals.discount, random)
                sent_up = np.bincount(word, new, n).astype(np.int64)
                new_parents = draw_tables(sent_up, np.full(n, parent_open), totals.parent_discount, random)
                old = (tables, parents) if keep else ([], [])
                yield from _state(row["bucket"], word, context, counts, [*old[0], new], [*old[1], new_parents], contexts).to_batches()

    return states.mapInArrow(run, _STATE)


# Answers --------------------------------------------------------------------------------


def _answers(requests: DataFrame, states: DataFrame, history: list[Totals], contexts: int) -> DataFrame:
    """(block, bucket, logs, known): log10 of each asked pair's probability, and each word's training count."""
    sent = requests.sparkSession.sparkContext.broadcast([vars(t) for t in history])

    def run(asked: pa.Table, state: pa.Table) -> pa.Table:
        rows = sorted(asked.to_pylist(), key=lambda r: r["block"])
        words, at, word, context, counts, pair_of = _merged(rows, contexts)
        kept = state.to_pylist()[0]
        probability = np.zeros(len(counts))
        for totals, tables, parents in zip(map(lambda t: Totals(**t), sent.value), kept["tables"], kept["parents"], strict=True):
            tables, parents = _unpack(tables).astype(np.float64), _unpack(parents).astype(np.float64)
            p = totals.parent(np.bincount(word, tables, len(words)), parents)
            whole = STRENGTH + totals.customers
            probability += np.maximum(counts - totals.discount * tables, 0) / whole[context] + (totals.opening() / whole)[context] * p[word]
        logs = np.log10(probability / len(sent.value)).astype(np.float32)
        word_counts = _slim(np.bincount(word, counts, len(words)).astype(np.int64))
        pair_cut = np.cumsum([0, *[int(_unpack(r["pairs"]).astype(np.int64).sum()) for r in rows]])
        word_cut = np.cumsum([0, *[len(_unpack(r["words"])) for r in rows]])
        out = [(r["block"], r["bucket"], _pack(logs[pair_of[pair_cut[k] : pair_cut[k + 1]]]), r["pairs"], _pack(word_counts[at[word_cut[k] : word_cut[k + 1]]])) for k, r in enumerate(rows)]
        types = [pa.string(), pa.int32(), *[pa.binary()] * 3]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["block", "bucket", "logs", "pairs", "known"])

    left, right = requests.groupBy("bucket"), states.groupBy("bucket")
    return left.cogroup(right).applyInArrow(run, "block string, bucket int, logs binary, pairs binary, known binary")


def _scores(docs: DataFrame, answers: DataFrame, totals: Totals) -> DataFrame:
    types, tokens = totals.types, totals.tokens

    def run(block: pa.Table, answer: pa.Table) -> pa.Table:
        own = block.to_pylist()[0]
        rows = sorted(answer.to_pylist(), key=lambda r: r["bucket"])
        logs = np.concatenate([_unpack(r["logs"]) for r in rows]).astype(np.float64)
        known = np.concatenate([np.repeat(_unpack(r["known"]).astype(np.int64), _unpack(r["pairs"])) for r in rows])
        base = np.log10((known + 1) / (tokens + types + 1))
        sizes, steps = _unpack(own["sizes"]).astype(np.int64), _unpack(own["tokens"]).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        sums = np.cumsum(steps)
        pair = sums - np.repeat(np.where(first > 0, sums[first - 1], 0), sizes)
        add = lambda x: np.add.reduceat(x[pair], first)
        columns = [own["doc_ids"], own["held"], sizes, add((known > 0).astype(np.int64)), add(base), add(logs)]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    left, right = docs.groupBy("block"), answers.groupBy("block")
    return left.cogroup(right).applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def score_texts(docs: DataFrame, held: Column, contexts: int = CONTEXTS, burn_in: int = BURN_IN, samples: int = SAMPLES, discounts: tuple[float, float] | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    ``score`` is the log10 probability of the text under the model, ``base_score`` that under
    single words with one added to each count; both learn from the rows that are not ``held``.
    A null text is an empty one: it has the end token only. Repeated rows are rows of their
    own. Without training text a token's probability is uniform. An empty table gives an empty
    result. Discounts are estimated from the numbers of pairs and words seen once and twice,
    unless given.
    """
    rows = docs.select("doc_id", held.alias("held"), "text", F.spark_partition_id().alias("task"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = stage(_blocks(rows, max(_BUCKETS, int(total) // _BUCKET_BYTES), contexts))
    requests = blocks.where("bucket >= 0").select("block", "bucket", "words", "pairs", "contexts", "counts")
    states = stage(_first_state(requests, contexts))
    totals, history = _totals(states, contexts, discounts), []
    for sweep in range(burn_in + samples):
        states = stage(_sweep(states, totals, sweep, sweep > burn_in, contexts))
        totals = _totals(states, contexts, (totals.discount, totals.parent_discount))
        history.append(totals)
    answers = _answers(requests, states, history[burn_in:], contexts)
    out = _scores(blocks.where("bucket = -1").select("block", "doc_ids", "held", "sizes", "tokens"), answers, totals)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op9_lm_scoring(docs: DataFrame) -> DataFrame:
    """The model's and the base's score of all documents, learned from the rows not held out."""
    return score_texts(docs.select("doc_id", "text"), held_out("doc_id", 7, 2))
