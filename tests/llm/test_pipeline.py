from __future__ import annotations

import re
import shutil

import cases
import corpus_pipeline
import pytest

from forgelens.llm import decontaminate, mixing, pipeline_stages, quality, simhash
from test_decontaminate import expected as passages
from test_repeats import brute_force as repeats_by_window
from test_simhash import expected as groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The driver's tables in a folder where documents can be changed."""
    root = tmp_path_factory.mktemp("sf")
    for name in ("labels", "benchmark"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", root)
    cases.driver_rows(spark).write.parquet(str(root / "documents.parquet"))
    return str(root)


def rows(frame):
    return sorted([tuple(r) for r in frame.collect()], key=str)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    steps = dict(corpus_pipeline.STAGES)

    good = steps["quality classifier"](spark, docs, folder).cache()
    scores = {r.doc_id: r.predicted for r in quality.classify(docs, quality.train(docs, labels)).collect()}
    assert rows(good) == rows(docs.where(docs.doc_id.isin([d for d, p in scores.items() if p == 1])))

    kept = steps["SimHash near-dedup"](spark, good, folder).cache()
    wanted = {d for d, _, c in groups([(r.doc_id, r.text) for r in good.collect()]) if d == c}
    assert {r.doc_id for r in kept.collect()} == wanted and kept.count() == len(wanted) < good.count()

    cut = steps["suffix-array dedup"](spark, kept, folder).cache()
    digest = {r[0]: r for r in repeats_by_window([(r.doc_id, r.text) for r in kept.collect()])}
    whole = {r.doc_id: r for r in kept.collect()}
    assert {r.doc_id for r in cut.collect()} == {d for d, r in digest.items() if r[1] == 0 or r[2] < r[1]}
    for r in cut.collect():
        if digest[r.doc_id][2] == 0:
            assert tuple(r) == tuple(whole[r.doc_id])
        else:
            left = digest[r.doc_id][1] - digest[r.doc_id][2]
            assert left - 6 * digest[r.doc_id][3] <= len(r.text.encode()) <= left and r.n_chars == len(r.text)

    clean = steps["benchmark decontamination"](spark, cut, folder).cache()
    hits = {r[0]: r for r in passages([(r.doc_id, r.text) for r in cut.collect()], [tuple(i) for i in items.collect()])}
    before = {r.doc_id: r for r in cut.collect()}
    assert clean.columns == COLUMNS and {r.doc_id for r in clean.collect()} == set(before)
    for r in clean.collect():
        assert len(decontaminate.words(r.text)) == hits[r.doc_id][1] - hits[r.doc_id][2]
        assert hits[r.doc_id][2] > 0 or tuple(r) == tuple(before[r.doc_id])

    mixed = steps["mixing sources to target weights"](spark, clean, folder)
    taken = {r.doc_id: r.taken for r in mixing.mix(clean).collect() if r.taken > 0}
    assert {r.doc_id: r.taken for r in mixed.collect()} == taken
    assert mixed.columns[:5] == COLUMNS

    whole_run = corpus_pipeline.run(spark, folder)
    assert rows(whole_run) == rows(mixed)


def test_every_stage_takes_awkward_documents(spark, folder):
    odd = cases.awkward(spark).selectExpr("*", "'s' as score", "1 as predicted", "2 as kept", "3 as size", "4 as fp", "5 as n_removed", "6 as hit_spans")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, odd, folder)
        last = name == corpus_pipeline.STAGES[-1][0]
        assert last or out.columns == odd.columns, name
        extra = [c for c in odd.columns[5:] if c in out.columns and not (last and c == "size")]
        assert {tuple(r) for r in out.select(*extra).distinct().collect()} <= {tuple(r) for r in odd.select(*extra).distinct().collect()}, name
        assert step(spark, cases.empty(spark), folder).count() == 0, name


def test_operator_modules_do_not_hide_import_errors():
    for module in (pipeline_stages, simhash, corpus_pipeline):
        assert not re.search(r"except (Import|ModuleNotFound)Error", open(module.__file__).read())
