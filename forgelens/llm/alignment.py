"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes. Tokens of both are nodes; every token points to its
farthest-right overlapping token of the other tokenizer, a token that ends where the other one
does to the A token of that place, which points to itself. Doubling the pointers (s = s[s]), for
many texts at once, leads every token to the last A token of its component: tokens of one
terminal token are a group, and groups end exactly where both tokenizers have a cut.

A is a byte-level BPE read from its JSON file, B a sentencepiece BPE with byte fallback. Both
files are read by the driver and sent to the tasks: their size is that of the vocabularies.
Long texts are encoded in parts, cut at a space between two letters, where neither tokenizer has
a token across (B's vocabulary is checked for it); so the memory of an encoder is bounded, not
the text.

Corpus counts: of two tokens that end together one is a suffix of the other in bytes. So the
vocabularies alone give all pairs that can be linked (``Vocabularies.pairs``, 275 thousand for
the 50k and 32k vocabularies), a bound that does not grow with the data. A link is the place of
its pair in that list, counts are added up task by task, and only this table reaches the driver
and goes back to the tasks.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelens.llm.common import append_columns
from forgelens.sources.staging import stage

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
PART = 1 << 16  # characters that are encoded at once, at least
CHUNK = 1 << 20  # characters whose tokens are linked at once

# Fixed value: how a byte-level BPE of this family cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
_SPACE = "▁"


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Vocabularies:
    """Both vocabularies as bytes by id; None for ids that no text is cut into."""

    model: bytes
    a: list[bytes | None]
    b: list[bytes | None]
    pairs: np.ndarray  # a * len(b) + b of all pairs that can end together, rising

    @property
    def a_of_pair(self) -> np.ndarray:
        return self.pairs // len(self.b)

    @property
    def b_of_pair(self) -> np.ndarray:
        return self.pairs % len(self.b)


def load_vocabularies(folder: str = TOKENIZERS) -> Vocabularies:
    """Read both vocabulary files; refuse those that the parts of long texts don't suit."""
    whole = json.loads(Path(folder, A_FILE).read_text("utf-8"))
    special = {t["content"] for t in whole["added_tokens"]}
    symbols, vocab = _byte_symbols(), whole["model"]["vocab"]
    a: list[bytes | None] = [None] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        if token not in special:
            a[i] = bytes(symbols[c] for c in token)
    merged = [m if isinstance(m, str) else " ".join(m) for m in whole["model"]["merges"]]
    if any(vocab[m.replace(" ", "")] != 256 + k for k, m in enumerate(merged)):
        raise ValueError(f"{A_FILE}: ids are not in the order of the merges")
    model = Path(folder, B_FILE).read_bytes()
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    b: list[bytes | None] = []
    for i in range(pieces.vocab_size()):
        piece = pieces.id_to_piece(i)
        if pieces.is_byte(i):
            b.append(bytes([int(piece[3:5], 16)]))
        elif pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i):
            b.append(None)
        else:
            b.append(piece.replace(_SPACE, " ").encode())
            if _SPACE in piece.lstrip(_SPACE):
                raise ValueError(f"{B_FILE}: piece {i} goes across a space")
    return Vocabularies(model, a, b, _possible_pairs(a, b))


def _possible_pairs(a: list[bytes | None], b: list[bytes | None]) -> np.ndarray:
    """Pairs of which one token is a suffix of the other: at most one for each suffix of a token and each id of it."""
    of_a: dict[bytes, list[int]] = {}
    of_b: dict[bytes, list[int]] = {}
    for tokens, ids in ((a, of_a), (b, of_b)):
        for i, token in enumerate(tokens):
            if token:
                ids.setdefault(token, []).append(i)
    found = set()
    for token, ids in of_a.items():
        for k in range(len(token)):
            found.update(i * len(b) + j for j in of_b.get(token[k:], ()) for i in ids)
    for token, ids in of_b.items():
        for k in range(len(token)):
            found.update(i * len(b) + j for i in of_a.get(token[k:], ()) for j in ids)
    return np.array(sorted(found), np.int64)


class Encoders:
    """Both tokenizers, and the byte lengths of their tokens, as one task needs them."""

    def __init__(self, v: Vocabularies):
        ranks = {token: i for i, token in enumerate(v.a) if token}
        self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=v.model)
        self.bytes_a, self.bytes_b = v.a, v.b
        self.size_a, self.size_b = (np.array([len(t or b"") for t in tokens], np.int64) for tokens in (v.a, v.b))

    def encode(self, text: str | None, part: int = PART) -> tuple[np.ndarray, np.ndarray]:
        """Ids of space+text under A and of text under B; none if the text is null or empty, or the bytes differ."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        a: list[int] = []
        b: list[int] = []
        for piece in parts(text, part):
            a += self.a.encode_ordinary(" " + piece)
            b += self.b.encode(piece)
        whole = f" {text}".encode("utf-8", "surrogatepass")
        for ids, tokens in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join([tokens[i] or b"" for i in ids]) != whole:
                return none, none
        return np.array(a, np.int64), np.array(b, np.int64)


def parts(text: str, part: int = PART) -> list[str]:
    """``text`` without the spaces at which it may be cut into pieces of ``part`` characters or somewhat more."""
    out, start = [], 0
    while len(text) - start > part and (cut := _CUT.search(text, start + part)):
        out.append(text[start : cut.start()])
        start = cut.end()
    return [*out, text[start:]]


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """The last A token of the group of each A and B token, by pointer jumping.

    Both arrays hold the rising ends of tokens that cover the same bytes, of one text or of
    many texts laid one after the other. B tokens are numbered after the A tokens.
    """
    b_over = np.searchsorted(end_b, end_a)  # the token of B over an A token's last byte
    a_over = np.searchsorted(end_a, end_b)
    to = np.concatenate([np.where(end_b[b_over] > end_a, len(end_a) + b_over, np.arange(len(end_a))), a_over])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


def align(encoded: list[tuple[np.ndarray, np.ndarray]], encoders: Encoders) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of A and of B tokens in each group, for each of the texts, all linked at once."""
    a, b = (np.concatenate([e[k] for e in encoded] or [np.zeros(0, np.int64)]) for k in (0, 1))
    if not len(a):
        yield from ((np.zeros(0, np.int64),) * 2 for _ in encoded)
        return
    to = terminals(np.cumsum(encoders.size_a[a]), np.cumsum(encoders.size_b[b]))
    last = np.flatnonzero(to[: len(a)] == np.arange(len(a)))
    group = np.searchsorted(last, to)
    in_a, in_b = np.bincount(group[: len(a)], minlength=len(last)), np.bincount(group[len(a) :], minlength=len(last))
    stop = np.searchsorted(last, np.cumsum([len(e[0]) for e in encoded]))
    start = 0
    for end in stop.tolist():
        yield in_a[start:end], in_b[start:end]
        start = end


def _encoded(texts: list[str | None], encoders: Encoders) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids and group sizes of every text, by chunks of ``CHUNK`` characters."""
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop] or "") <= CHUNK):
            size += len(texts[stop] or "")
            stop += 1
        chunk = [encoders.encode(t) for t in texts[start:stop]]
        for (a, b), (in_a, in_b) in zip(chunk, align(chunk, encoders), strict=True):
            yield a, b, in_a, in_b
        start = stop


def align_tokens(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """``docs`` with a_ids, b_ids, a_sizes and b_sizes, arrays of int, for every row.

    Group k holds the next a_sizes[k] ids of A and the next b_sizes[k] of B. Null and empty texts,
    and texts that a tokenizer doesn't give back byte by byte, have empty arrays. Rows repeated
    stay repeated; columns with the added names are replaced, all others stay as they are. An
    empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(vocabularies))

    encoders = _once(lambda: Encoders(Vocabularies(**sent.value)))

    def rows(batches):
        for batch in batches:
            found = list(_encoded(batch.column(0).to_pylist(), encoders()))
            yield [pa.array([f[k].astype(np.int32) for f in found], pa.list_(pa.int32())) for k in range(4)]

    names = ("a_ids", "b_ids", "a_sizes", "b_sizes")
    adds = T.StructType([T.StructField(n, T.ArrayType(T.IntegerType())) for n in names])
    return append_columns(docs, ["text"], adds, rows)


def _once(make: Callable):
    """``make`` when it is first asked for in a task; its result after that."""
    made: list = []

    def get():
        if not made:
            made.append(make())
        return made[0]

    return get


def _labels(tables: Vocabularies) -> list[str]:
    """An id with what follows it: a comma, the end of A's part, of a group or of the text."""
    return [f"{i}{mark}" for i in range(max(len(tables.a), len(tables.b))) for mark in (",", "|", ";", "")]


def groups_text(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, labels: list[str]) -> str:
    """The groups as ``a1,a2|b1;a3|b2,b3``."""
    if not len(a):
        return ""
    mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    mark_a[np.cumsum(in_a) - 1] = 1
    mark_b[np.cumsum(in_b) - 1] = 2
    mark_b[-1] = 3
    place = np.concatenate([np.repeat(np.arange(len(in_a)) * 2, in_a), np.repeat(np.arange(len(in_b)) * 2 + 1, in_b)])
    codes = np.concatenate([a * 4 + mark_a, b * 4 + mark_b])[np.argsort(place, kind="stable")]
    return "".join(map(labels.__getitem__, codes.tolist()))


def op13_cross_tokenizer_alignment(docs: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of all documents.

    Texts are encoded once; their links are stored, packed, while the corpus counts are added up.
    """
    spark, v = docs.sparkSession, load_vocabularies(tokenizers)
    sent = spark.sparkContext.broadcast(vars(v))

    def tools():
        tables = Vocabularies(**sent.value)
        return tables, Encoders(tables), _labels(tables)

    ready = _once(tools)

    def digest(batches):
        (tables, encoders, labels), press = ready(), zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            out: list[tuple] = []
            for a, b, in_a, in_b in _encoded(batch.column(0).to_pylist(), encoders):
                ends = a[np.cumsum(in_a) - 1] * len(tables.b) + b[np.cumsum(in_b) - 1]
                links = np.searchsorted(tables.pairs, ends).astype(np.int32)
                sha = hashlib.sha256(groups_text(a, b, in_a, in_b, labels).encode()).hexdigest() if len(a) else ""
                out.append((len(a), len(b), len(in_a), len(links), sha, press(links.tobytes())))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]

    names = ("n_a", "n_b", "n_groups", "n_links")
    adds = T.StructType([*[T.StructField(n, T.LongType()) for n in names], T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType())])
    aligned = stage(append_columns(docs.select("doc_id", "text"), ["text"], adds, digest).drop("text"))
    counts, best = _corpus_counts(spark, aligned.select("links"), v)
    known = spark.sparkContext.broadcast((counts, best))

    def looked_up(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            counts, best = known.value
            links = [np.frombuffer(unpack(x), np.int32) for x in batch.column(0).to_pylist()]
            yield [pa.array([int(best[x].sum()) for x in links], pa.int64()), pa.array([int(counts[x].sum()) for x in links], pa.int64())]

    adds = T.StructType([T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    out = append_columns(aligned, ["links"], adds, looked_up)
    return out.select("doc_id", *names, "n_best", "count_sum", "groups_sha256")


def _corpus_counts(spark: SparkSession, links: DataFrame, v: Vocabularies) -> tuple[np.ndarray, np.ndarray]:
    """How many links hold each possible pair, and whether that is the most for its B id."""
    pairs = len(v.pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, sums = zstandard.ZstdDecompressor().decompress, np.zeros(pairs, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                np.add.at(sums, np.frombuffer(unpack(packed), np.int32), 1)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(sums[seen])], names=["pair", "n"])

    counts = np.zeros(pairs, np.int64)
    for r in links.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r.pair] = r.n  # at most one row for each possible pair
    most = np.zeros(len(v.b), np.int64)
    np.maximum.at(most, v.b_of_pair, counts)
    return counts, counts == most[v.b_of_pair]
