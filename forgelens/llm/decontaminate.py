"""Benchmark passages in documents, found in FM-indexes of the documents.

Documents and items become numbers of their words. A task takes documents by the shard; what
it indexes are the stretches of words that all occur in the phrases, long enough for the
shortest of them: no phrase can occur elsewhere. An index holds the Burrows-Wheeler string of
these stretches as a wavelet tree, the counts of smaller words, and every ``SAMPLE``-th suffix
position. All phrases are searched backwards at once; the suffixes in a phrase's range are
walked to the next sampled one, which gives the place; overlapping places are merged.

Phrases are the windows of ``window`` successive words of an item, or the whole of a shorter
one. They go to the tasks in blocks of at most ``BLOCK`` windows, one pass over the documents
for each block, so that what is broadcast has a bound whatever the size of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelens.llm.common import append_columns
from forgelens.sources.staging import stage

WINDOW = 10
BLOCK = 200_000
SAMPLE = 16
_SHARD = 1 << 25  # bytes of text that one index covers

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z in lower case; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


class _Wavelet:
    """Ranks of symbols in a string, by one bit a level, the highest first."""

    def __init__(self, symbols: np.ndarray, count: int) -> None:
        self.bits, self.levels = max(1, int(count - 1).bit_length()), []
        order = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (order >> level) & 1
            zeros = np.append(0, np.cumsum(1 - bit)).astype(np.int32)
            self.levels.append((bit.astype(bool), zeros))
            order = np.concatenate([order[bit == 0], order[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        start = np.zeros(len(place), np.int64)
        stop = np.asarray(place, np.int64)
        for k, (_, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            za, zb = zeros[start], zeros[stop]
            start, stop = np.where(one, zeros[-1] + start - za, za), np.where(one, zeros[-1] + stop - zb, zb)
        return stop - start

    def at(self, place: np.ndarray) -> np.ndarray:
        """The symbol at each place."""
        symbol, place = np.zeros(len(place), np.int64), np.asarray(place, np.int64)
        for bits, zeros in self.levels:
            one = bits[place]
            place = np.where(one, zeros[-1] + place - zeros[place], zeros[place])
            symbol = 2 * symbol + one
        return symbol


class Index:
    """FM-index of a string of symbols from 1; 0 is the end and the smallest."""

    def __init__(self, symbols: np.ndarray, count: int) -> None:
        text = np.append(symbols, 0).astype(np.int64)
        n = len(text)
        rank, step = text, 1
        while True:
            after = np.zeros(n, np.int64)
            after[: max(0, n - step)] = rank[step:] + 1
            both = rank * (max(n, count) + 2) + after
            order = np.argsort(both, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.append(0, both[order][1:] != both[order][:-1]))
            if new[order[-1]] == n - 1:
                break
            rank, step = new, 2 * step
        self.size = n
        self.smaller = np.append(0, np.cumsum(np.bincount(text, minlength=count)))
        self.tree = _Wavelet(text[order - 1], count)
        self.sampled = order % SAMPLE == 0
        self.sample_rank = np.append(0, np.cumsum(self.sampled))
        self.samples = order[self.sampled]

    def _back(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.tree.rank(symbol, place)

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the phrases: rows padded on the left, the last symbol in the last column."""
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.size, np.int64)
        width = phrases.shape[1]
        for k in range(1, width + 1):
            on = np.flatnonzero((sizes >= k) & (low < high))
            if not len(on):
                break
            symbol = phrases[on, width - k]
            low[on], high[on] = self._back(symbol, low[on]), self._back(symbol, high[on])
        return low, np.maximum(high, low)

    def locate(self, suffixes: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by walking to sampled ones."""
        place, out = suffixes.copy(), np.zeros(len(suffixes), np.int64)
        walk, steps = np.arange(len(suffixes)), 0
        while len(walk):
            hit = self.sampled[place[walk]]
            out[walk[hit]] = self.samples[self.sample_rank[place[walk[hit]]]] + steps
            walk = walk[~hit]
            place[walk] = self._back(self.tree.at(place[walk]), place[walk])
            steps += 1
        return out


@dataclass
class Phrases:
    """Distinct windows of a block of items, as numbers of words, and the ids of the items that have them."""

    number: dict[bytes, int]
    rows: np.ndarray
    sizes: np.ndarray
    owners: list[list]

    @classmethod
    def of(cls, items: list[tuple], window: int) -> Phrases:
        number: dict[bytes, int] = {}
        owners: dict[tuple, dict] = {}
        for item, text in items:
            found = [number.setdefault(w, len(number) + 1) for w in words(text)]
            size = min(window, len(found))
            for k in range(len(found) - size + 1 if found else 0):
                named = owners.setdefault(tuple(found[k : k + size]), {})
                if item is not None:
                    named[item] = True
        rows = np.zeros((len(owners), window), np.int64)
        sizes = np.array([len(p) for p in owners], np.int64)
        for k, phrase in enumerate(owners):
            rows[k, window - len(phrase) :] = phrase
        return cls(number, rows, sizes, [list(x) for x in owners.values()])


def _hits(texts: list[list[int]], phrases: Phrases) -> list[tuple[list[tuple[int, int]], set]]:
    """Merged word spans (from, to) and items found, for each document of a shard."""
    out: list[tuple[list[tuple[int, int]], set]] = [([], set()) for _ in texts]
    if not len(phrases.sizes) or not texts:
        return out
    sizes = np.array([len(t) for t in texts], np.int64)
    symbols = np.fromiter((s for t in texts for s in t), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    within = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # Stretches of known words inside one document, not shorter than the shortest phrase.
    breaks = np.flatnonzero(np.append(True, (symbols[1:] == 0) != (symbols[:-1] == 0)) | np.append(True, doc[1:] != doc[:-1])) if len(symbols) else np.zeros(0, np.int64)
    ends = np.append(breaks[1:], len(symbols))
    use = (symbols[breaks] > 0) & (ends - breaks >= phrases.sizes.min()) if len(symbols) else np.zeros(0, bool)
    breaks, ends = breaks[use], ends[use]
    if not len(breaks):
        return out
    gap = len(phrases.number) + 1  # stands between stretches and in no phrase
    spans = ends - breaks + 1
    origin = np.repeat(breaks - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
    last = np.cumsum(spans) - 1
    origin[last] = 0
    text = symbols[origin]
    text[last] = gap
    index = Index(text, gap + 1)
    low, high = index.search(phrases.rows, phrases.sizes)
    found = np.repeat(np.arange(len(low)), high - low)
    suffix = np.arange(len(found)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[found]
    at = origin[index.locate(suffix)]
    order = np.argsort(at, kind="stable")
    for k, place in zip(found[order].tolist(), at[order].tolist(), strict=True):
        merged, items = out[doc[place]]
        items.update(phrases.owners[k])
        start, stop = int(within[place]), int(within[place] + phrases.sizes[k])
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return out


_ADDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
)
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _blocks(benchmark: DataFrame, window: int) -> Iterator[list[tuple]]:
    """Items (item_id as string, text) in blocks of bounded size; one block at a time is collected."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item"), "text", F.octet_length("text").alias("size"))
    total = items.agg(F.sum("size")).first()[0] or 0
    # A window starts at a word, and a word and its gap take two bytes at least.
    n = -(-int(total) // (2 * BLOCK)) or 1
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    items = stage(items) if n > 1 else items
    for k in range(n):
        yield [(r.item, r.text) for r in items.where(F.col("block") == k).select("item", "text").collect()]


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word spans, merged) and ``hit_items`` (item ids as strings, sorted).

    Null texts have no words and no hits, null item texts give no phrase. The windows of an item
    without an id are hit like others, but there is no id to name. Items repeated under one id count
    once. Columns with the names of added ones are replaced.
    """
    out = None
    for items in _blocks(benchmark, window):
        block = Phrases.of(items, window)
        sent = docs.sparkSession.sparkContext.broadcast((block.number, block.rows, block.sizes, block.owners))

        def rows(batches, sent=sent):
            phrases = Phrases(*sent.value)
            known = phrases.number
            for batch in batches:
                texts = batch.column(0)
                counts, hits, shard, size = [], [], [], 0
                for text in texts.to_pylist():
                    found = words(text)
                    counts.append(len(found))
                    shard.append([known.get(w, 0) for w in found])
                    size += len(text or "")
                    if size >= _SHARD:
                        hits += _hits(shard, phrases)
                        shard, size = [], 0
                hits += _hits(shard, phrases)
                spans = [[{"start": a, "stop": b} for a, b in s] for s, _ in hits]
                yield [pa.array(counts, pa.int64()), pa.array(spans, _SPAN_TYPE), pa.array([sorted(i) for _, i in hits], pa.list_(pa.string()))]

        if out is None:
            out = append_columns(docs, ["text"], _ADDS, rows)
        else:
            # Later blocks of a large benchmark add to what the earlier ones found.
            before = out.withColumnsRenamed({"hit_spans": "__spans", "hit_items": "__items"})
            out = append_columns(before, ["text"], _ADDS, rows)
            out = out.withColumn("hit_spans", _merged(F.concat("__spans", "hit_spans"))).withColumn("hit_items", F.array_sort(F.array_union("__items", "hit_items"))).drop("__spans", "__items")
    return out


def _merged(spans):
    """Overlapping and touching spans as one."""
    empty = F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)")
    last = lambda acc: F.element_at(acc, -1)
    return F.aggregate(
        F.array_sort(spans), empty,
        lambda acc, x: F.when((F.size(acc) == 0) | (x["start"] > F.try_element_at(acc, F.lit(-1))["stop"]), F.concat(acc, F.array(x))).otherwise(
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["stop"], x["stop"]).alias("stop"))))
        ),
    )


def cut_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the hit words of their texts; a text without hits stays as it is, to the byte.

    Cut are the bytes from the first byte of a hit span's first word to the last of its last.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    hits = find_passages(docs.select(F.struct(F.lit(0).alias("__"), *others).alias("row"), "text"), benchmark, window)

    def rows(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not spans:
                    out.append(text)
                    continue
                raw = text.encode("utf-8", "surrogatepass")
                is_word = np.frombuffer(raw.translate(_WORD), np.uint8) != 32
                starts = np.flatnonzero(is_word & ~np.append(False, is_word[:-1]))
                stops = np.flatnonzero(is_word & ~np.append(is_word[1:], False)) + 1
                kept, at = [], 0
                for span in spans:
                    kept.append(raw[at : starts[span["start"]]])
                    at = int(stops[span["stop"] - 1])
                out.append(b"".join([*kept, raw[at:]]).decode("utf-8", "ignore"))
            yield [pa.array(out, pa.string())]

    cut = append_columns(hits, ["text", "hit_spans"], T.StructType([T.StructField("__text", T.StringType())]), rows)
    return cut.select(*[(F.col("__text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op4_benchmark_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of all documents."""
    out = find_passages(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
