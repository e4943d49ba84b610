from __future__ import annotations

import cases

from forgelens.llm import language


def test_held_out_accuracy(spark):
    docs = cases.driver_rows(spark, sf="0.01")
    out = language.op2_language_id(docs)
    both = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = [r.lang == r.lang_pred for r in both]
    assert len(right) > 200 and sum(right) / len(right) > 0.97
    sure = [r.lang == r.lang_pred for r in both if not r.rejected]
    assert sum(sure) / len(sure) >= sum(right) / len(right)
    assert out.where("score < 0 or score > 1").count() == 0


def test_only_the_text_counts(spark):
    docs = cases.driver_rows(spark)
    known = language.learn(docs)
    plain = {r.doc_id: (r.lang_pred, r.score) for r in language.classify(docs, known).collect()}
    other = docs.selectExpr("doc_id", "text", "'q' as lang", "'q' as lang_pred", "1 as score")
    assert {r.doc_id: (r.lang_pred, r.score) for r in language.classify(other, known).collect()} == plain


def test_awkward_documents(spark):
    out = {r.doc_id: r for r in language.op2_language_id(cases.awkward(spark)).collect()}
    assert all(out[k].lang_pred == "und" and out[k].score == 0 and out[k].rejected for k in (4, 5, 6))
    assert {out[k].lang_pred for k in (1, 7, 8, 11, 15)} <= {"en", "de", "xx", "fr"}
    assert language.op2_language_id(cases.empty(spark)).count() == 0
    nothing = language.op2_language_id(cases.awkward(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert len(nothing) == len(cases.ROWS) and {r.lang_pred for r in nothing} == {"und"}
    one = language.op2_language_id(cases.awkward(spark).selectExpr("doc_id", "text", "'en' as lang")).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("en", 1.0), ("und", 0.0)}


def test_numerals_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "\u00b2"), (2, "\u00bd 10"), (3, "\u2167 \u0663"), (4, "42 a"), (5, "\u05d0"), (6, "\u02b0")], "doc_id long, text string")
    known = language.learn(cases.driver_rows(spark))
    found = {r.doc_id: r.lang_pred for r in language.classify(docs, known).collect()}
    assert [found[k] for k in (1, 2, 3)] == ["und"] * 3 and "und" not in [found[k] for k in (4, 5, 6)]


def test_dictionaries_take_pieces_of_whole_texts_in_turn(spark, monkeypatch):
    texts = [" ".join(f"{c}{i}" for i in range(5_000)) for c in "abcdef"]
    docs = spark.createDataFrame([(k, t, "l") for k, t in enumerate(texts)] + [(9, "short one", "l"), (10, "", "l")], "doc_id long, text string, lang string")
    content = language.learn(docs).content["l"].decode()
    assert "\nshort one\n" in f"\n{content}\n" and all(f"\n{c}" in content or f" {c}" in content for c in "abcdef")
    openings = sum(content.count(t[:256]) for t in texts)
    late = [w for w in content.split() if w[0] in "abcdef" and w[1:].isdigit() and int(w[1:]) > 4_000]
    assert openings <= 1 and late
    monkeypatch.setattr(language, "DICTIONARY", 2_000)
    small = language.learn(docs).content["l"].decode()
    assert len(small) == 2_000 and all(f"{c}" in {w[0] for w in small.split()} for c in "abcdef")
