"""SimHash near-duplicates by deletion-variant signatures.

Fingerprint: 64 bits over the XXH64 values of word shingles; a bit is set if it is set in
more than half of them. Links: fingerprints that differ in at most ``bits`` places.

Search: a fingerprint is cut into fewer segments than ``bits + 1``, as few as still leave one
segment that differs by at most one bit (two of 32 bits for two bits). Each segment is indexed
as it is and with each of its bits left out; two fingerprints whose segment differs by at most
one bit share an entry, so an equality join finds them, and the whole distance is verified.

Exact copies are one fingerprint from the start. An entry that more than ``crowd`` different
fingerprints share is not paired out: its members are indexed once more by whole variants (all
bits but those that may differ), which need no verification and link to their smallest member.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelens.llm.common import append_columns
from forgelens.sources.staging import stage

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BITS = np.arange(63, -1, -1)


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Fingerprint of a whole text; zero if it is null or has no word."""
    # bytes.split() parts words at bytes 9 to 13 and 32, as the rule has it.
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(tokens) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return sum(1 << int(b) for b in _BITS[2 * ones > len(hashes)])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint as a signed long."""

    def rows(batches):
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column(0).to_pylist()], np.uint64)
            yield [pa.array(found.view(np.int64), pa.int64())]

    return append_columns(docs, ["text"], T.StructType([T.StructField("fp", T.LongType())]), rows)


def _pieces(bits: int) -> list[range]:
    """As few equal pieces of the 64 places as leave one with at most one of ``bits`` differences."""
    n = bits // 2 + 1
    return [range(64 * i // n, 64 * (i + 1) // n) for i in range(n)]


def _keep(places) -> int:
    """Long whose bits at ``places`` are set."""
    return int(np.array([sum(1 << p for p in places)], np.uint64).view(np.int64)[0])


def _entries(prints: DataFrame, masks: list[int]) -> DataFrame:
    """(fp, mask, value): each fingerprint under each mask."""
    every = F.explode(F.lit(np.array(masks, np.int64))).alias("mask")
    return prints.select("fp", every).select("fp", "mask", F.expr("fp & mask").alias("value"))


def links(prints: DataFrame, bits: int = 2, crowd: int = 64) -> DataFrame:
    """Links (a, b), a < b, that join the fingerprints ``fp`` (distinct) within ``bits`` places.

    Every two fingerprints within the distance are joined by a link or by a chain of links,
    and every link is within the distance.
    """
    masks = [_keep(q for q in piece if q != p) for piece in _pieces(bits) for p in [None, *piece]]
    key = F.xxhash64("mask", "value").alias("entry")  # equal entries meet; distances are verified
    entries = _entries(prints.select("fp"), masks).select(key, "fp")
    groups = entries.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1")
    # Groups grow with the input: no broadcast, also where they happen to be few.
    shared = stage(entries.join(groups.hint("merge"), "entry"))
    some = shared.where(F.col("n") <= crowd)
    pairs = some.select("entry", F.col("fp").alias("a")).join(some.select("entry", F.col("fp").alias("b")), "entry")
    found = pairs.where("a < b").where(F.expr(f"bit_count(a ^ b) <= {bits}")).select("a", "b")
    crowded = shared.where(F.col("n") > crowd)
    if not crowded.isEmpty():
        found = found.unionByName(_crowded(crowded, bits))
    return found.distinct()


def _crowded(members: DataFrame, bits: int) -> DataFrame:
    """Links among fingerprints that share an entry with many others.

    A fingerprint is indexed by every choice of ``bits`` places left out: two within the
    distance share such a variant, and all that share one are within the distance. Links go to
    the smallest of them, so they grow with the members and not with their pairs.
    """
    choices = [~_keep(c) for c in combinations(range(64), bits)]
    variants = _entries(members.select("fp").distinct().repartition("fp"), choices)
    least = variants.groupBy("mask", "value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    least = stage(least.drop("n"))
    return variants.join(least, ["mask", "value"]).where("a < fp").select("a", F.col("fp").alias("b"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each ``node`` of ``nodes`` reaches by ``edges`` (a, b).

    Rounds of large-star and small-star; both only take the smallest neighbour of a node, a
    sum that is combined before the shuffle, so a node with many links is no hot group.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large.where("a <> b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        after = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        after = stage(after.where("a <> b").distinct())
        if after.count() == edges.count() and after.exceptAll(edges).isEmpty():
            break
        edges = after
    return nodes.join(edges.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that the row reaches by links. Repeated rows stay; a
    null doc_id is never the smallest one unless it is alone. Texts without words have the
    fingerprint zero and are linked like others. An empty table gives an empty result.
    """
    prints = stage(fingerprints(docs.select("doc_id", "text"), words).select("doc_id", "fp"))
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    reach = components(distinct.select(F.col("fp").alias("node")), links(distinct, bits)).withColumnRenamed("node", "fp")
    reach = stage(reach.join(distinct, "fp"))
    smallest = reach.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stage(reach.join(smallest, "component").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def op3_simhash_near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of all documents."""
    out = near_duplicates(docs)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
