from __future__ import annotations

import hashlib
from collections import Counter
from pathlib import Path

import cases
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from forgelens.llm import alignment

MORE = [
    (20, "a <|endoftext|> b <s> </s> <unk> <0x41>", None, None, None),
    (21, "it's   the  tide\n\n\tand we'll  see ", None, None, None),
    (22, "▁ already there", None, None, None),
    (23, "晨光照亮港口。 नाव आई। \U0001f600\U0001f600 é", None, None, None),
    (24, " ", None, None, None),
    (25, "1234567890 " * 300, None, None, None),
    (26, "x" * 3000, None, None, None),
]


@pytest.fixture(scope="module")
def v():
    return alignment.load_vocabularies()


@pytest.fixture(scope="module")
def encoders(v):
    return alignment.Encoders(v)


def by_rule(rows):
    """The contract with the vocabulary files' own libraries and loops over byte offsets."""
    a = Tokenizer.from_file(str(Path(alignment.TOKENIZERS, alignment.A_FILE)))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(Path(alignment.TOKENIZERS, alignment.B_FILE)))
    symbols, bytes_of = alignment._byte_symbols(), lambda p: bytes([int(p[3:5], 16)])
    made, pairs = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        tokens_a = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ids_a]
        tokens_b = [bytes_of(b.id_to_piece(i)) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(tokens_a) != f" {text}".encode() or b"".join(tokens_b) != f" {text}".encode():
            made.append((doc_id, [], [], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(t) for t in tokens]).tolist() for tokens in (tokens_a, tokens_b))
        count_a, count_b = ({end: k + 1 for k, end in enumerate(ends)} for ends in (ends_a, ends_b))
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = count_a[end], count_b[end]
            groups.append(f"{','.join(map(str, ids_a[i:k]))}|{','.join(map(str, ids_b[j:m]))}")
            links.append((ids_a[k - 1], ids_b[m - 1]))
            i, j = k, m
        pairs.update(links)
        made.append((doc_id, ids_a, ids_b, groups, links))
    most: dict[int, int] = {}
    for (_, y), n in pairs.items():
        most[y] = max(most.get(y, 0), n)
    return [
        (d, len(x), len(y), len(g), len(k), sum(pairs[p] == most[p[1]] for p in k), sum(pairs[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if x else "")
        for d, x, y, g, k in made
    ]


def test_awkward_and_driver_documents_by_the_rule(spark):
    more = spark.createDataFrame(MORE, cases.SCHEMA)
    for docs in (cases.awkward(spark).union(more), cases.driver_rows(spark)):
        found = [tuple(r) for r in alignment.op13_cross_tokenizer_alignment(docs).collect()]
        wanted = by_rule([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        assert sorted(found, key=str) == sorted(wanted, key=str)
        assert any(r[3] < min(r[1], r[2]) for r in found)  # some groups hold several tokens


def test_groups_give_back_the_text(spark, v):
    out = alignment.align_tokens(cases.awkward(spark), v)
    for r in out.collect():
        at = [0, 0]
        whole = b""
        for k, m in zip(r.a_sizes, r.b_sizes, strict=True):
            a = b"".join(v.a[i] for i in r.a_ids[at[0] : at[0] + k])
            assert k and m and a == b"".join(v.b[i] for i in r.b_ids[at[1] : at[1] + m])
            whole, at = whole + a, [at[0] + k, at[1] + m]
        assert at == [len(r.a_ids), len(r.b_ids)]
        assert whole in (b"", f" {r.text}".encode()) and (whole or not r.text)


@given(st.text(alphabet="ab \n'sé1.▁<", max_size=300), st.integers(1, 30))
@settings(deadline=None, max_examples=150)
def test_parts_are_encoded_as_the_whole(encoders, text, part):
    assert " ".join(alignment.parts(text, part)) == text
    for one, other in zip(encoders.encode(text, part), encoders.encode(text, 10**9), strict=True):
        assert one.tolist() == other.tolist()


@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.lists(st.integers(1, 4), min_size=1, max_size=40))
def test_pointers_lead_to_the_end_of_the_component(one, other):
    gap = sum(one) - sum(other)
    one, other = (one, [*other, gap]) if gap > 0 else ([*one, -gap], other) if gap else (one, other)
    ends = [np.cumsum(x) for x in (one, other)]
    to = alignment.terminals(*ends)
    both = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    last = [ends[0].tolist().index(next(e for e in both if e >= end)) for side in ends for end in side.tolist()]
    assert to.tolist() == last


def test_possible_pairs_are_suffixes(v):
    known = set(v.pairs.tolist())
    assert len(known) == len(v.pairs) < sum(len(t or b"") for t in [*v.a, *v.b])
    assert alignment._possible_pairs([b"ab", b"b", None], [b"b", b"cab", b"x"]).tolist() == [0, 1, 3, 4]


def test_empty_table_and_clashing_names(spark, v):
    assert alignment.op13_cross_tokenizer_alignment(cases.empty(spark)).count() == 0
    docs = cases.awkward(spark).selectExpr("doc_id", "text", "1 as links", "2 as n_a", "3 as a_ids", "4 as pair")
    assert alignment.op13_cross_tokenizer_alignment(docs).where("n_a = 2").count() < len(cases.ROWS)
    out = alignment.align_tokens(docs, v)
    assert sorted(out.columns) == ["a_ids", "a_sizes", "b_ids", "b_sizes", "doc_id", "links", "n_a", "pair", "text"]
    assert out.where("links <> 1 or n_a <> 2 or pair <> 4").count() == 0
