from __future__ import annotations

import hashlib

import cases
import xxhash

from forgelens.llm import sentences


def expected(rows, span=3):
    order = lambda d: (d is not None, d or 0)
    mark = lambda t: (xxhash.xxh64_intdigest((t or "").encode(), 42) + (1 << 63)) % (1 << 64)
    first: dict[tuple, tuple] = {}
    plain = lambda s: " ".join(s.split()).lower()
    for doc_id, text in rows:
        pieces = [plain(s) for s in sentences.sentences(text)]
        for i in range(len(pieces) - span + 1):
            place, run = (order(doc_id), i, mark(text)), tuple(pieces[i : i + span])
            first[run] = min(first.get(run, place), place)
    out = []
    for doc_id, text in rows:
        pieces = sentences.sentences(text)
        gone = set()
        for i in range(len(pieces) - span + 1):
            if first[tuple(plain(s) for s in pieces[i : i + span])] < (order(doc_id), i, mark(text)):
                gone |= set(range(i, i + span))
        kept = "".join(s for i, s in enumerate(pieces) if i not in gone)
        out.append((doc_id, len(pieces), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_awkward_and_driver_documents(spark):
    for docs in (cases.awkward(spark), cases.driver_rows(spark, sf="0.01")):
        found = sorted([tuple(r) for r in sentences.op10_substring_dedup(docs).collect()], key=str)
        assert found == expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        assert any(r[2] for r in found)


def test_texts_without_an_id_or_with_the_same_one_remove_each_other(spark):
    same = "One more day. Two more nights. Three more words. "
    rows = [(None, same + "Left alone."), (None, same + "Left behind."), (5, same), (7, "Four. Five. Six. Seven."), (7, "Four. Five. Six. Eight."), (7, "Four. Five. Six. Eight.")]
    out = sorted([tuple(r) for r in sentences.op10_substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()], key=str)
    assert out == expected(rows)
    assert sorted(r[2] for r in out if r[0] is None) == [0, 3] and [r[2] for r in out if r[0] == 5] == [3]
    assert sorted(r[2] for r in out if r[0] == 7) in ([0, 3, 3], [0, 0, 3])


def test_sentences_make_up_the_text():
    for _, text, *_ in cases.ROWS:
        assert "".join(sentences.sentences(text)) == (text or "")
    assert sentences.sentences("One. Two!  Three\n\nFour") == ["One. ", "Two!  ", "Three\n\n", "Four"]


def test_empty_table_and_clashing_names(spark):
    assert sentences.op10_substring_dedup(cases.empty(spark)).count() == 0
    docs = cases.awkward(spark).selectExpr("doc_id", "text", "1 as h", "2 as c", "3 as at", "4 as n_removed", "5 as number")
    out = sentences.cut_repeated_spans(docs)
    assert sorted(out.columns) == ["at", "c", "doc_id", "h", "n_removed", "n_sentences", "number", "text"]
    assert out.where("h <> 1 or c <> 2 or at <> 3 or number <> 5").count() == 0
    assert out.where("doc_id = 4 and text is null and n_sentences = 0").count() == 1


def test_sentence_ends_of_other_scripts(spark):
    texts = {
        "zh": ("\u6668\u5149\u7167\u4eae\u6e2f\u53e3\u3002\u8239\u968f\u6f6e\u6c34\u8fdb\u6765\uff01\u8c01\u5728\u8bf4\u8bdd\uff1f", "\u949f\u54cd\u4e86\u3002"),
        "hi": ("\u0938\u0941\u092c\u0939 \u0939\u0941\u0908\u0964 \u0928\u093e\u0935 \u0906\u0908\u0964 \u0938\u092c \u091a\u0941\u092a \u0925\u0947\u0964 ", "\u0918\u0902\u091f\u0940 \u092c\u091c\u0940\u0964"),
        "ur": ("\u0635\u0628\u062d \u06c1\u0648\u0626\u06cc\u06d4 \u06a9\u0634\u062a\u06cc \u0622\u0626\u06cc\u06d4 \u06a9\u0648\u0646 \u06c1\u06d2\u061f ", "\u06af\u06be\u0646\u0679\u06cc \u0628\u062c\u06cc\u06d4"),
    }
    docs = []
    for k, (three, last) in enumerate(texts.values()):
        assert len(sentences.sentences(three + last)) == 4 and "".join(sentences.sentences(three + last)) == three + last
        docs += [(10 * k, three + last), (10 * k + 1, three)]
    out = sentences.cut_repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in out} == {d: "" if d % 10 else t for d, t in docs}


def test_short_texts_are_one_run_if_asked(spark):
    long = " ".join(f"word{i}" for i in range(160)) + "."
    docs = spark.createDataFrame(
        [(1, long), (2, long.upper()), (3, f"{long} {long}"), (4, "One. Two!"), (5, "one.  two!"), (6, "One."), (7, ""), (8, ""), (9, " "), (9, " "), (10, None), (11, "One. Two! Three?"), (11, "One. Two! Three?")],
        "doc_id long, text string",
    )
    out = {r.doc_id: (r.text, r.n_removed) for r in sentences.cut_repeated_spans(docs, short=True).collect()}
    assert {d: n for d, (_, n) in out.items() if n} == {2: 1, 5: 2}
    assert out[2][0] == out[5][0] == "" and out[3][0] == f"{long} {long}" and out[10][0] is None
    assert not any(r.n_removed for r in sentences.cut_repeated_spans(docs).collect())


def test_long_sentences_are_cut_alike_wherever_they_stand(spark):
    passage = " ".join(f"stone{i * i % 89} river{i}" for i in range(60))
    around = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcd"]
    docs = [(1, f"{around[0]} {passage} {around[1]}."), (2, f"{around[2]} {passage} {around[3]}."), (3, f"{around[0]} and nothing else")]
    assert all("".join(sentences.sentences(t)) == t for _, t in docs)
    assert all(len(p.split()) >= 4 for p in sentences.sentences(docs[0][1])[:-1])
    out = {r.doc_id: r for r in sentences.cut_repeated_spans(spark.createDataFrame(docs, "doc_id long, text string"), longest=12).collect()}
    assert out[1].n_removed == 0 and out[1].text == docs[0][1] and len(out[2].text.split()) < 110
    assert {w for w in out[2].text.split() if w[0] in "cd"} == {w.rstrip() for w in f"{around[2]} {around[3]}.".split()}
