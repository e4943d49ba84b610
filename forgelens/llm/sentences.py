"""Substring dedup by sliding spans of sentences.

A sentence ends after full stops, question or exclamation marks before white space, and at line
ends; marks of other scripts end one wherever they stand, as many of these write no space. It is
compared in lower case with single spaces. Every run of ``SPAN`` successive sentences is hashed
(96 bits); with ``short``, a text of fewer sentences is one run as a whole. Hashes are summed over all texts; of a repeated run the first
place stays, and the sentences of all others go: the first is the smallest doc_id, null before
all, then the smallest sentence number, then the smallest hash of the text. Runs are found in the input, not in what is left of it.

Only (hash, place) rows are shuffled. The first places are a combined minimum, so a run that a
third of all texts share is no large group, and the join back to the places can be split.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelens.llm.common import append_columns
from forgelens.sources.staging import stage

SPAN = 3
# Full stops, question and exclamation marks that only end sentences, with closing quotes and brackets:
# Chinese and Japanese (also half-width), Indic danda, Arabic and Urdu, Ethiopic, Armenian, Burmese, Khmer, Tibetan.
_MARKS = "\u3002\uff0e\uff01\uff1f\uff61\u0964\u0965\u06d4\u061f\u1362\u1367\u0589\u104a\u104b\u17d4\u17d5\u0f0d\u0f0e\u203c\u2047\u2048\u2049"
# Begins with a set of characters, so that the search passes over all others at once.
_BREAK = re.compile(
    rf"[.!?\n{_MARKS}](?:(?<=\n)\s*|(?<=[.!?])[.!?]*\s+|(?:(?<=[{_MARKS}])|[.!?]*[{_MARKS}])[.!?{_MARKS}]*[\u300d\u300f\u201d\u2019\uff09\u3011\u300b]*\s*)"
)
_WORD = re.compile(r"\S+\s*")
LONGEST = 12
_EVERY = 8
_CLAUSE = 4


def sentences(text: str | None, longest: int | None = LONGEST) -> list[str]:
    """Pieces of the text that make it up again; white space stays with the sentence before.

    Sentences of more than ``longest`` words are cut further, after words chosen by their hash alone (one
    in 8, four words at least to a piece), so that copies of a passage are cut alike wherever it stands.
    """
    text = text or ""
    stops = [m.end() for m in _BREAK.finditer(text)]
    starts = [0, *stops]
    pieces = [text[a:b] for a, b in zip(starts, [*stops, len(text)], strict=True) if b > a]
    return pieces if longest is None else [c for p in pieces for c in _clauses(p, longest)]


@lru_cache(1 << 16)
def _ends_clause(word: str) -> bool:
    return zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % _EVERY == 0


def _clauses(sentence: str, longest: int) -> list[str]:
    """``sentence``, cut further if it has more than ``longest`` words."""
    if len(sentence) <= 2 * longest:  # a word and its gap take two characters at least
        return [sentence]
    words = sentence.split()
    if len(words) <= longest:
        return [sentence]
    cuts, at = [0], _CLAUSE
    while at < len(words):
        if _ends_clause(words[at - 1]):
            cuts.append(at)
            at += _CLAUSE
        else:
            at += 1
    whole = " ".join(words)
    if sentence.startswith(whole):
        out = [" ".join(words[i:j]) + " " for i, j in pairwise(cuts)]
        return [*out, " ".join(words[cuts[-1] :]) + sentence[len(whole) :]]
    words = _WORD.findall(sentence)
    words[0] = sentence[: len(sentence) - sum(map(len, words))] + words[0]
    return ["".join(words[i:j]) for i, j in pairwise([*cuts, len(words)])]


def _runs(pieces: list[str], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``span`` pieces, as 64 and 32 bits."""
    raw = b"".join(xxhash.xxh3_128_digest(" ".join(p.split()).lower().encode("utf-8", "surrogatepass")) for p in pieces)
    both = np.frombuffer(raw, "<u8").reshape(-1, 2)
    n = len(pieces) - span + 1
    out = np.zeros((n, 2), np.uint64)
    for k in range(span):
        out = (out ^ both[k : k + n]) * np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F], np.uint64)
        out ^= out >> np.uint64(29)
    return out[:, 0].copy().view(np.int64), (out[:, 1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _places(docs: DataFrame, span: int, short: bool, longest: int | None) -> DataFrame:
    """(h, c, doc_id, number, mark): each run of ``docs`` (doc_id, mark, text) by its first sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "c", "doc_id", "number", "mark"]
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            hashes, checks, rows, numbers = [], [], [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                pieces = sentences(text, longest)
                if len(pieces) >= span or (short and "".join(pieces).strip()):
                    h, c = _runs(pieces, min(span, len(pieces)))
                    hashes.append(h)
                    checks.append(c)
                    rows.append(np.full(len(h), k))
                    numbers.append(np.arange(len(h), dtype=np.int32))
            if hashes:
                row = pa.array(np.concatenate(rows))
                found = [pa.array(np.concatenate(a)) for a in (hashes, checks, numbers)]
                yield pa.RecordBatch.from_arrays([*found[:2], ids.take(row), found[2], marks.take(row)], names=names)

    return docs.mapInArrow(run, "h long, c int, doc_id long, number int, mark long")


def cut_repeated_spans(docs: DataFrame, span: int = SPAN, short: bool = False, longest: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without the repeated sentences.

    ``text`` is what is left, ``n_sentences`` and ``n_removed`` are added; columns with these
    names are replaced. A null text stays null and has no sentence. Texts of fewer than ``span``
    sentences have no run and stay whole, unless ``short``: then such a text is one run and goes
    where another text of the same sentences stands before it. With ``longest``, sentences of more
    words are cut into clauses, which count as sentences. Rows repeated with one doc_id (or none) and text are at
    the same place and so don't remove each other; different texts of one doc_id, or without one, do.
    """
    marked = docs.withColumn("__mark", F.xxhash64("text"))
    places = _places(marked.select("doc_id", "__mark", "text"), span, short, longest)
    place = F.struct("doc_id", "number", "mark")
    first = places.groupBy("h", "c").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # Stored: a join between two shuffles is split where a run is frequent, one with a sum is not.
    first = stage(first.where("not (first <=> last)").drop("last"))
    later = places.join(first.hint("merge"), ["h", "c"]).where("not (doc_id <=> first.doc_id and number = first.number and mark = first.mark)")
    later = later.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__of"), "number")
    later = stage(later.groupBy("__id", "__of").agg(F.collect_set("number").alias("__runs")))

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield [pa.array([None if t is None else press(t.encode("utf-8", "surrogatepass")) for t in batch.column(0).to_pylist()], pa.binary())]

    packed = append_columns(marked, ["text"], T.StructType([T.StructField("__packed", T.BinaryType())]), pack).drop("text")
    joined = packed.join(later, F.expr("__mark = __of and doc_id <=> __id"), "left").drop("__id", "__of", "__mark")

    def rows(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts, sizes, removed = [], [], []
            for packed, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = None if packed is None else unpack(packed).decode("utf-8", "surrogatepass")
                pieces = sentences(text, longest)
                gone = {i + k for i in runs or () for k in range(min(span, len(pieces)))}
                texts.append("".join(p for i, p in enumerate(pieces) if i not in gone) if gone else text)
                sizes.append(len(pieces))
                removed.append(len(gone))
            yield [pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())]

    adds = [T.StructField("text", T.StringType()), T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())]
    return append_columns(joined, ["__packed", "__runs"], T.StructType(adds), rows).drop("__packed", "__runs")


def op10_substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_removed, kept_sha256 of all documents; a null text counts as empty."""
    out = cut_repeated_spans(docs.select("doc_id", "text"), longest=LONGEST)
    return out.select("doc_id", "n_sentences", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
