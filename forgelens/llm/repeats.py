"""Repeated byte strings: every byte covered by a ``WINDOW``-byte string that also starts earlier.

1. Anchors. Of the grams in a window, the one with the smallest hash anchors it; equal windows
   have equal anchors at the same place. Successive windows with one anchor are a run, stored
   as (hash, text, start, length): about one row for 35 bytes.
2. Anchors whose hash occurs once in all texts (exact copies of a text count once) can't hold a
   repeat. The others' runs are cut out of the texts, and equal cuts become one row with the
   earliest place; the later ones are removed as a whole.
3. Different cuts with the same anchor are aligned on it, and windows that no other one has where
   they stand are left out. The rest is sorted: ``induced.suffix_array`` gives its suffixes
   and common prefixes, blocks of whole anchor groups at a time. Suffixes that share ``WINDOW``
   bytes stand together; all but the earliest of them are removed.
4. An anchor with more than ``CROWD`` different cuts (a frequent line in ever new surroundings)
   is no group of one task: its windows are parted by their distance to the anchor, first eight
   distances at a time, then singly. Windows of a part share a longer core, which takes the
   anchor's place, and steps 2 and 3 are done again for the parts.

Nothing is left out at any size; texts travel compressed. Distinct texts are told apart by
SHA-256, cuts by 128-bit hashes, anchors by 64-bit hashes that only propose candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelens.llm.common import append_columns
from forgelens.llm.induced import DEPTH, eights, suffix_array
from forgelens.sources.staging import stage

WINDOW = DEPTH
GRAM = 32
CROWD = 256
_BLOCK = 1 << 18
_ROWS = 1 << 14  # of an Arrow batch that a task makes
_REACH = WINDOW - GRAM + 1  # grams in a window; a run has no more windows than that
_STEP = 0x10001  # times a place below 2 ** 46 it stays a long
_PARTS = (8, 1)
_MIX = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63], np.uint64)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place."""
    words = eights(data)
    words *= _MIX[0]
    words ^= words >> np.uint64(29)
    m = len(data) - GRAM + 1
    out = words[:m] * _MIX[0]
    part = np.empty(m, np.uint64)
    for k in range(1, GRAM // 8):
        out += np.multiply(words[8 * k : 8 * k + m], _MIX[k], out=part)
        out ^= np.right_shift(out, np.uint64(31), out=part)
    out *= _MIX[1]
    out ^= np.right_shift(out, np.uint64(32), out=part)
    return out


def _runs(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs in the texts data[start:stop]: (text number, anchor hash, first window, further windows, way to the anchor)."""
    if len(data) < WINDOW:
        return (np.zeros(0, np.int64),) * 5
    hashes = _gram_hashes(data)
    least = hashes & ~np.uint64((1 << 24) - 1)
    least |= np.arange(len(hashes), dtype=np.uint64)  # the first of equal ones
    have = 1
    while have < _REACH:
        step = min(have, _REACH - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    # A run ends where the anchor changes or its text has no further window.
    ends = np.maximum(stops - WINDOW + 1, starts)
    edges = np.unique(np.concatenate([np.flatnonzero(least[1:] != least[:-1]) + 1, starts, ends]))
    text = np.searchsorted(starts, edges, "right") - 1
    run = np.flatnonzero((text >= 0) & (edges < ends[text]))
    head, text = edges[run], text[run]
    further = edges[run + 1] - head - 1
    anchors = (least[head] & np.uint64((1 << 24) - 1)).astype(np.int64)
    return text, hashes[anchors].view(np.int64), head - starts[text], further, anchors - head


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each row starts, the end included."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data, offsets


def anchors(docs: DataFrame) -> DataFrame:
    """(h, loc, at) of every run of ``docs`` (key, text): ``at`` holds start, length and way to
    the anchor, and ``loc`` is ``key`` with a multiple of it, a number for the place."""

    piece = max(1, _BLOCK >> 2)  # its arrays stay in the processor's cache

    def together(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["h", "loc", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = _texts(batch.column(1))
            row, held, found = 0, 0, []
            while row < len(keys):
                stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + piece, "right")) - 1)
                # A text beyond a piece is taken in parts that overlap by a window less one byte.
                for a in range(int(offsets[row]), int(offsets[stop]), 8 * piece):
                    b = min(int(offsets[stop]), a + 8 * piece + WINDOW - 1)
                    bounds = np.clip(offsets[row : stop + 1], a, b) - a
                    text, h, start, further, way = _runs(data[a:b], bounds[:-1], bounds[1:])
                    at = (((start + np.maximum(a - offsets[row + text], 0)) << 7 | further) << 7) | way
                    found.append((h, keys[row + text] ^ (at * _STEP), at))
                    held += len(h)
                    if held >= _ROWS:
                        yield together(found)
                        held, found = 0, []
                row = stop
            if found:
                yield together(found)

    return docs.select("key", "text").mapInArrow(run, "h long, loc long, at long")


def _pack(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__packed``, the compressed text, instead of text."""

    def rows(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield [pa.array([pack(t.as_buffer() if t.is_valid else b"") for t in batch.column(0)], pa.binary())]

    return append_columns(docs, ["text"], T.StructType([T.StructField("__packed", T.BinaryType())]), rows).drop("text")


_CUT = "h long, sid binary, doc_id long, key long, start long, further int, way int, cut binary"
_CUT_NAMES = [c.split()[0] for c in _CUT.split(", ")]
_CUT_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_CUT_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CUT_TYPES, strict=True)], names=_CUT_NAMES)


def _cuts(texts: DataFrame) -> DataFrame:
    """The runs of each packed text, with the bytes of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ids, keys, packed, places = batch.columns
            of = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy())
            places = places.flatten()
            hashes, at = places.field("h"), places.field("at").to_numpy()
            raw, unpacked = b"", -1
            for a in range(0, len(of), _ROWS):
                row, here = of[a : a + _ROWS], at[a : a + _ROWS]
                start, further, way = here >> 14, here >> 7 & 127, here & 127
                cuts = []
                for text, begin, end in zip(row.tolist(), start.tolist(), (start + further + WINDOW).tolist(), strict=True):
                    if text != unpacked:
                        raw, unpacked = unpack(packed[text].as_py()), text
                    cuts.append(raw[begin:end])
                sids = [xxhash.xxh3_128_digest(c) for c in cuts]
                columns = [hashes.slice(a, _ROWS), sids, ids.take(pa.array(row)), keys.take(pa.array(row)), start, further, way, cuts]
                columns = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, _CUT_TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=_CUT_NAMES)

    return texts.mapInArrow(run, _CUT)


def _parts(cuts: DataFrame, size: int) -> DataFrame:
    """``cuts`` parted by the windows' way to the anchor, ``size`` ways to a part; h is the hash of the part's core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, key, start, further, way, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = 0
                while at <= further:
                    part = (way - at) // size
                    last = min(further, way - part * size)  # the part's last window
                    # Bytes that every window of the part has, whether or not it is in this cut.
                    core = cut[max(0, way - part * size) : way - (part * size + size - 1) + WINDOW]
                    piece = cut[at : last + WINDOW]
                    h = xxhash.xxh3_64_intdigest(core, part) - (1 << 63)
                    rows.append((h, xxhash.xxh3_128_digest(piece), doc_id, key, start + at, last - at, way - at, piece))
                    at = last + 1
            yield _cut_batch(rows)

    return cuts.select("doc_id", "key", "start", "further", "way", "cut").mapInArrow(run, _CUT)


@dataclass
class _Pieces:
    """Stretches of windows: where they stand in their texts, and their bytes."""

    ids: np.ndarray  # a null doc_id is the smallest long, and ``null`` says so
    null: np.ndarray
    keys: np.ndarray
    starts: np.ndarray
    further: np.ndarray
    raw: list[bytes]

    @staticmethod
    def of(parts: list[_Pieces]) -> _Pieces:
        arrays = [np.concatenate([getattr(p, c) for p in parts]) for c in ("ids", "null", "keys", "starts", "further")]
        return _Pieces(*arrays, [r for p in parts for r in p.raw])


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes from each place; equal bytes have equal hashes, and seldom others."""
    base, inverse = _MIX[1], np.uint64(pow(int(_MIX[1]), -1, 1 << 64))
    ups = np.full(len(data), base, np.uint64)
    downs = np.full(len(data), inverse, np.uint64)
    ups[:1] = downs[:1] = 1
    sums = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * np.cumprod(ups)))
    n = max(0, len(data) - WINDOW + 1)
    return (sums[WINDOW : WINDOW + n] - sums[:n]) * np.cumprod(downs)[:n]


def _in_common(groups: pa.Table) -> _Pieces:
    """What is left of whole anchor groups without the windows that only one cut has.

    Equal windows have their anchor at the same place. So windows are compared by hash with those of
    the other cuts that stand alike to the anchor; the sort then compares the bytes of what is left.
    """
    ids = groups["doc_id"].combine_chunks()
    null = ids.is_null().to_numpy(zero_copy_only=False)
    ids = pc.fill_null(ids, -(1 << 63)).to_numpy()
    h, keys, at = (groups[c].to_numpy() for c in ("h", "key", "at"))
    starts, further, way = at >> 14, at >> 7 & 127, at & 127
    data, offsets = _texts(groups["cut"].combine_chunks())
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    sizes = further + 1
    cut = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(cut)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    seen = _window_hashes(data)[offsets[cut] + inside]
    seen ^= (h[cut].view(np.uint64) + (way[cut] - inside).astype(np.uint64)) * _MIX[2]
    order = np.argsort(seen)
    same = seen[order[1:]] == seen[order[:-1]]
    common = np.zeros(len(seen), bool)
    common[order[1:][same]] = common[order[:-1][same]] = True
    cut, inside = cut[common], inside[common]
    first, last = _stretches(cut, inside)
    of, begin, end = cut[first], inside[first], inside[last] + WINDOW
    whole = data.tobytes()
    raw = [whole[a:b] for a, b in zip((offsets[of] + begin).tolist(), (offsets[of] + end).tolist(), strict=True)]
    return _Pieces(ids[of], null[of], keys[of], starts[of] + begin, end - begin - WINDOW, raw)


def _stretches(cut: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of successive windows of one cut begin and end; windows come in order."""
    breaks = np.flatnonzero((np.diff(cut) != 0) | (np.diff(inside) > 1))
    edge = np.arange(min(1, len(cut)))
    return np.append(edge, breaks + 1), np.append(breaks, edge + len(cut) - 1)


def _sorted_repeats(block: _Pieces) -> pa.RecordBatch:
    """(doc_id, key, start, stop) of the windows in ``block`` that stand earlier in it too."""
    suffixes, common, starts = suffix_array(block.raw)
    cut = np.searchsorted(starts, suffixes, "right") - 1
    inside = suffixes - starts[cut]
    group = np.cumsum(common < WINDOW)
    own = inside <= block.further[cut]
    group, cut, inside = group[own], cut[own], inside[own]
    ids, place = block.ids[cut], block.starts[cut] + inside
    order = np.lexsort((place, ids, group))
    group, cut, inside, ids, place = group[order], cut[order], inside[order], ids[order], place[order]
    head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    first = np.repeat(head, np.diff(np.append(head, len(group))))
    later = (ids != ids[first]) | (place != place[first])
    cut, inside = cut[later], inside[later]
    order = np.lexsort((inside, cut))
    cut, inside = cut[order], inside[order]
    head, last = _stretches(cut, inside)
    of = cut[head]
    start = block.starts[of] + inside[head]
    stop = block.starts[of] + inside[last] + WINDOW
    columns = [pa.array(block.ids[of], pa.int64(), mask=block.null[of]), *(pa.array(c, pa.int64()) for c in (block.keys[of], start, stop))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "start", "stop"])


_SPAN = "doc_id long, key long, start long, stop long"


def _by_sorting(cuts: DataFrame) -> DataFrame:
    """Spans of the sorted blocks; a block holds whole anchor groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[pa.Table]:
            held: list[pa.RecordBatch] = []
            for batch in (b.slice(k, _ROWS >> 3) for b in batches for k in range(0, b.num_rows, _ROWS >> 3)):
                held.append(batch)
                if sum(b.nbytes for b in held) < _BLOCK:
                    continue
                rows = pa.Table.from_batches(held)
                # The last group may go on in the next batch.
                n = int(pc.sum(pc.not_equal(rows["h"], rows["h"][-1])).as_py() or 0)
                if n:
                    yield rows.slice(0, n)
                    held = rows.slice(n).combine_chunks().to_batches()
            if held:
                yield pa.Table.from_batches(held)

        ready: list[_Pieces] = []
        for rows in blocks():
            ready.append(_in_common(rows))
            if sum(len(r) for p in ready for r in p.raw) >= _BLOCK:
                yield _sorted_repeats(_Pieces.of(ready))
                ready = []
        if any(p.raw for p in ready):
            yield _sorted_repeats(_Pieces.of(ready))

    at = F.expr("start << 14 | further << 7 | way").alias("at")  # one long to shuffle, not three
    dealt = cuts.select("h", "doc_id", "key", at, "cut").repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, _SPAN)


def _resolved(cuts: DataFrame, parts: tuple[int, ...]) -> DataFrame:
    """Spans of ``cuts``; groups of equal h hold all equal windows."""
    cuts = stage(cuts, "zstd")  # bytes of texts are most of what is stored
    place = F.struct("doc_id", "start", "key")
    same = [F.first(c).alias(c) for c in ("further", "way", "cut")]
    distinct = stage(cuts.groupBy("h", "sid").agg(F.min(place).alias("first"), F.count("*").alias("rows"), *same), "zstd")
    spans = (
        cuts.select("h", "sid", "doc_id", "key", "start", "further").join(distinct.where("rows > 1").select("h", "sid", "first"), ["h", "sid"])
        .where("not (doc_id <=> first.doc_id and start = first.start)").select("doc_id", "key", "start", F.expr(f"start + further + {WINDOW}").alias("stop"))
    )
    sizes = stage(distinct.groupBy("h").agg(F.count("*").alias("cuts")).where("cuts > 1"))
    differ = distinct.join(sizes, "h").selectExpr("h", "cuts", "first.doc_id as doc_id", "first.key as key", "first.start as start", "further", "way", "cut")
    spans = spans.unionAll(_by_sorting(differ.where(F.col("cuts") <= CROWD)))
    if parts and not sizes.where(F.col("cuts") > CROWD).isEmpty():
        spans = spans.unionAll(_resolved(_parts(differ.where(F.col("cuts") > CROWD), parts[0]), parts[1:]))
    return spans


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, start, stop) of bytes to remove, spans may overlap. ``docs``: doc_id, key, text."""
    whole = F.coalesce("text", F.lit("")).cast("binary")
    ids = stage(docs.select("doc_id", "key", F.sha2(whole, 256).alias("sha"), F.length(whole).cast("long").alias("n")).where(F.col("n") >= WINDOW))
    firsts = stage(ids.groupBy("sha").agg(F.min(F.struct("doc_id", "key")).alias("first"), F.count("*").alias("rows")))
    copies = ids.join(firsts.where("rows > 1"), "sha").where("not (doc_id <=> first.doc_id)").selectExpr("doc_id", "key", "0L as start", "n as stop")

    runs = anchors(docs)
    # Stored: a join between two shuffles is split where an anchor is frequent, one with a sum is not.
    again = stage(runs.groupBy("h").agg(F.min("loc").alias("a"), F.max("loc").alias("b")).where("a <> b").select("h"))
    places = runs.join(again.hint("merge"), "h").select(F.expr(f"loc ^ (at * {_STEP}L)").alias("key"), F.struct("at", "h").alias("place"))
    places = places.distinct().groupBy("key").agg(F.collect_list("place").alias("places"))
    # One text of each group of copies stands for all.
    chosen = stage(firsts.selectExpr("first.key as key", "first.doc_id as __id").join(places, "key"))
    texts = _pack(docs.select("doc_id", "key", "text")).join(chosen.withColumnRenamed("key", "__key"), F.expr("key = __key and doc_id <=> __id"))
    cuts = _cuts(texts.select("doc_id", "key", "__packed", "places"))
    return copies.unionAll(_resolved(cuts, _PARTS))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with the repeated bytes cut out.

    ``text`` gives way to ``kept`` (the bytes left), ``n_bytes``, ``n_removed`` and ``n_spans``
    (stretches removed). A null text is an empty one. Earlier is a smaller doc_id, null before
    all, or under the same doc_id a smaller start; so rows repeated with one doc_id don't
    remove each other. Columns with the names of added ones are replaced.
    """
    keyed = docs.withColumn("__key", F.xxhash64(F.coalesce("text", F.lit(""))))
    spans = repeated_spans(keyed.select("doc_id", F.col("__key").alias("key"), "text"))
    spans = stage(spans.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "stop")).alias("__spans")))
    spans = spans.withColumnsRenamed({"doc_id": "__id", "key": "__of"})
    joined = _pack(keyed).join(spans, F.expr("__key = __of and doc_id <=> __id"), "left").drop("__key", "__of", "__id")

    def rows(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            kept, sizes, removed, counts = [], [], [], []
            for packed, spans in zip(*batch.columns, strict=True):  # one text at a time: all of a batch would be large
                raw, left, at, n = unpack(packed.as_buffer()), [], 0, 0
                stop = -1
                for span in sorted((x["start"], x["stop"]) for x in spans.as_py() or ()):
                    if span[0] > stop:
                        n += 1
                        left.append(raw[at : span[0]])
                    stop = at = max(stop, span[1])
                left.append(raw[at:])
                kept.append(b"".join(left))
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept[-1]))
                counts.append(n)
            yield [pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, counts))]

    long = T.LongType()
    adds = T.StructType([T.StructField("kept", T.BinaryType()), *(T.StructField(c, long) for c in ("n_bytes", "n_removed", "n_spans"))])
    return append_columns(joined, ["__packed", "__spans"], adds, rows).drop("__packed", "__spans")


def op7_suffix_array_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of all documents."""
    out = cut_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
