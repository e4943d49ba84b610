from __future__ import annotations

import cases
import duckdb
import pytest

from forgelens.llm import mixing


def sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    return sorted([tuple(r) for r in con.execute(mixing.OP6_SQL).fetchall()], key=str)


def test_awkward_and_driver_documents_as_in_sql(spark):
    for docs in (cases.awkward(spark), cases.driver_rows(spark, sf="0.01")):
        found = sorted([tuple(r) for r in mixing.op6_mixing_sources(docs).collect()], key=str)
        wanted = sql(docs)
        assert [r[:3] + r[4:] for r in found] == [r[:3] + r[4:] for r in wanted]
        assert [r[3] for r in found] == pytest.approx([r[3] for r in wanted])


def test_targets_by_resharing(spark):
    sizes = {"a": 900, "b": 10, "c": 40, "d": 0, "e": 300, None: 77}
    weights = dict(zip(["a", "b", "c", "d", "e", None], [5, 2, 1, 5, 2, 1], strict=True))
    target, left = dict.fromkeys(sizes, 0.0), 1.5 * sum(sizes.values())
    while left > 1e-9:  # share, cut at twice the size, share the excess
        free = [s for s in sizes if target[s] < 2 * sizes[s] - 1e-12]
        whole, over = sum(weights[s] for s in free), 0.0
        for s in free:
            target[s] += left * weights[s] / whole
            over += max(0.0, target[s] - 2 * sizes[s])
            target[s] = min(target[s], 2 * sizes[s])
        left = over
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(frame, (5, 2, 1), 1.5, 2.0).collect()}
    assert found == pytest.approx(target)


def test_sums_limits_and_reruns(spark):
    docs = cases.driver_rows(spark, sf="0.01")
    first = mixing.mix(docs, carry=("lang", "n_chars")).collect()
    assert sorted(first, key=str) == sorted(mixing.mix(docs.repartition(7), carry=("lang", "n_chars")).collect(), key=str)
    taken: dict = {}
    for r in first:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {r.source: round(r.target) for r in first}


def test_python_is_not_used(spark, plan_of):
    plan = plan_of(mixing.op6_mixing_sources(cases.awkward(spark)))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table_and_clashing_names(spark):
    assert mixing.op6_mixing_sources(cases.empty(spark)).count() == 0
    docs = cases.awkward(spark).selectExpr("doc_id", "text", "source", "1 as size", "2 as key", "3 as bin", "4 as rest")
    out = mixing.mix(docs, carry=tuple(docs.columns))
    assert out.where("row.size <> 1 or row.key <> 2 or row.bin <> 3 or row.rest <> 4").count() == 0 and out.count() == len(cases.ROWS)
