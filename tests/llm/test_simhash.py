from __future__ import annotations

import random

import cases
import xxhash

from forgelens.llm import simhash


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.translate(dict.fromkeys([9, 10, 11, 12, 13], " ")).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups(fingerprints: list[int], bits: int) -> list[int]:
    """Number of the smallest fingerprint of each one's group, all pairs compared."""
    top = list(range(len(fingerprints)))

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= bits:
                x, y = root(i), root(j)
                top[max(x, y)] = min(x, y)
    return [root(k) for k in range(len(fingerprints))]


def expected(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    group = groups(prints, 2)
    least: dict[int, int] = {}
    for (doc_id, _), g in zip(rows, group, strict=True):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return sorted([(d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, group, strict=True)], key=str)


def test_awkward_and_driver_documents(spark):
    for docs in (cases.awkward(spark), cases.driver_rows(spark)):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        found = sorted([tuple(r) for r in simhash.op3_simhash_near_dedup(docs).collect()], key=str)
        assert found == expected(rows)


def test_planted_fingerprints_and_crowds(spark):
    rng = random.Random(5)
    prints = []
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(15):
            prints.append(base ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(5))}))
    prints = sorted({p - (1 << 64) if p >= 1 << 63 else p for p in prints})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    wanted = groups([p % (1 << 64) for p in prints], 2)
    for crowd in (64, 3):
        links = simhash.links(frame, 2, crowd)
        pairs = [tuple(r) for r in links.collect()]
        assert all((a ^ b) % (1 << 64) != 0 and ((a ^ b) % (1 << 64)).bit_count() <= 2 for a, b in pairs)
        reach = {r.node: r.component for r in simhash.components(frame.withColumnRenamed("fp", "node"), links).collect()}
        assert [reach[p] for p in prints] == [prints[g] for g in wanted]


def test_long_chain_is_one_component(spark):
    nodes = spark.range(200).withColumnRenamed("id", "node")
    edges = spark.range(199).selectExpr("(id * 7) % 199 as a", "(id * 7) % 199 + 1 as b")
    out = simhash.components(nodes, edges)
    assert {r.component for r in out.collect()} == {0}


def test_empty_table_and_clashing_names(spark):
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0
    docs = cases.awkward(spark).selectExpr("doc_id", "text", "1 as fp", "2 as component", "3 as mask")
    assert simhash.near_duplicates(docs).count() == len(cases.ROWS)
