from __future__ import annotations

import hashlib
import re

import cases
import pytest

from forgelens.llm import personal

# The contract's patterns, as they are stated.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRICKY = [
    "a@b.c_d@e.fg, x@y.z@w.vu and a.b%c+d-e@f-g.h.i.. @no.pe no@pe a@b. a@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.2.3 1.2.3 10.0.0.1.x 999999999999999999999.1.1.1 1.2.3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1111; 4111--1111 41111111111111111 4111111111111111 0000000000000 1-2 3 4",
    "+1 (017) 555-7713, +49 30 1234567. +12345678 +1234567890123456 ++1 2 3 4 5 6 7 8 9 (+1)-(2.3.4.5.6.7.8.9",
    "\U0001f600 münchen@x.de \U0001f600 1.2.3.4 ÄÖ +4912345678901 4111 1111 1111 1111",
    "+1 234 567 890@x.yz 12345678901.2.3.4",
    "",
]


def base(text):
    spans = {k: [] for k in personal.KINDS}
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c.isdigit()]
            luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0
            good = {
                "email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else None,
                "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                spans[kind].append((m.start(), m.end()))
    joined = ",".join(f"{k}:{a}:{b}" for k in personal.KINDS for a, b in spans[k])
    return (*[len(spans[k]) for k in personal.KINDS], hashlib.sha256(joined.encode()).hexdigest()), joined


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    found = personal.op11_personal_data(docs).collect()
    assert sorted([tuple(r[:6]) for r in found], key=str) == sorted([(r.doc_id, *base(r.text)[0]) for r in rows], key=str)
    wanted = sorted(base(r.text)[1] for r in rows)
    kept = sorted(r.spans for r in found if not r.n_added)
    assert sorted(wanted) == kept if len(kept) == len(rows) else set(kept) <= set(wanted)
    for r in found:
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert [(personal.KINDS.index(k), int(a), int(b)) for k, a, b in spans] == sorted((personal.KINDS.index(k), int(a), int(b)) for k, a, b in spans)
        assert len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
    return found


def test_base_spans_as_stated(spark):
    tricky = spark.createDataFrame([(100 + k, t) for k, t in enumerate(TRICKY)], "doc_id long, text string")
    check(cases.awkward(spark).select("doc_id", "text").union(tricky))
    check(cases.driver_rows(spark, sf="0.01"))


def test_trees_add_look_alikes_only(spark):
    """Phones without a plus are learned from those with one; plain numbers and failed base matches are left."""
    docs = []
    for k in range(300):
        tail = f"{k % 10}{k * 7 % 1000:03d}"
        docs.append((k, f"Please call +1 (2{k % 10}4) 555-{tail} at once, order 77{k:05d}{k * 13 % 100:02d} is ready."))
    docs += [(1000, "Please call 1 (204) 555-1234 at once."), (1001, "order 770012399 is ready."), (1002, "4111 1111 1111 1112 is no card."), (1003, "+1 (204) 5 is short.")]
    found = {r.doc_id: r for r in check(spark.createDataFrame(docs, "doc_id long, text string"))}
    assert found[1000].spans == "phone:12:28" and found[1000].n_phone == 0 and found[1000].n_added == 1
    assert not any(r.n_added for d, r in found.items() if d != 1000)


def test_no_text_takes_quadratic_time(spark):
    texts = ["1" * 300_000, "a" * 300_000, "a." * 150_000, "1 " * 150_000, "+1" * 100_000, "a@" * 100_000, "1." * 100_000, "a@b.c " * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in personal.op11_personal_data(docs).collect()}
    assert found[7].n_email == 30_000 and found[6].n_ip == 25_000 and found[0].n_card == 0


def test_python_is_not_used(spark, plan_of):
    plan = plan_of(personal.op11_personal_data(cases.driver_rows(spark)))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_best_split_and_thresholds(spark):
    cells = [(k, d, 1, 1, 1, 0, 1, 0, 0, 0, y, n) for k, d, y, n in ((0, 5, 90, 0), (0, 6, 0, 50), (1, 5, 10, 30), (1, 7, 25, 1))]
    frame = spark.createDataFrame(cells, ", ".join(f"{f} int" for f in personal.FEATURES) + ", yes long, no long")
    model = personal.fit(frame, rounds=8, depth=2)
    scores = {(r.kind, r.digits): r.p for r in frame.select("kind", "digits", model.probability().alias("p")).collect()}
    assert scores[0, 5] > 0.9 and scores[0, 6] < 0.1 and scores[1, 5] == pytest.approx(0.25, abs=0.08) and scores[1, 7] > 0.85
    known = personal.thresholds(frame, model)
    assert scores[0, 6] < known["email"] <= scores[0, 5] and "ip" not in known
    assert known != personal.thresholds(frame, model, precision=0.95) and personal.fit(frame.where("no = 0")) is None


def test_empty_table_and_clashing_names(spark):
    assert personal.op11_personal_data(cases.empty(spark)).count() == 0
    docs = cases.awkward(spark).selectExpr("doc_id", "text", "1 as rid", "2 as kind", "3 as `start`", "'x' as match", "4 as base")
    check(docs)
