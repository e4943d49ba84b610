"""Personal data: span proposals, boosted trees and calibrated thresholds; DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, card and phone numbers; those that pass their
checks are always reported. High-recall generators propose more, overlapping spans: addresses
with ``(at)`` or ``[dot]``, any longer number with separators (as card and as phone), dotted
quads with masked dots. Boosted trees score the proposals by format (digits, groups, separators,
size) and context (neighbours, cue words), without the mark that makes a base match: the plus of a
phone number, the Luhn sum of a card, the @ of an address. So trees learn from the proposals that
meet a base span how such data look, and find look-alikes that the patterns miss.

Trees are fitted by aggregations over the counts of equal feature values of all proposals: each
level of a tree is one sum of gradients by (node, feature, value), of which the driver gets at most
8 rows for each value of each feature, some hundreds. They are scored as one column expression. Documents
whose crc32 of the id is divisible by 4 don't teach: of their proposals, by score in steps of a
thousandth, each kind's threshold is the lowest at which ``PRECISION`` of those above it are base spans.

Texts are scanned once. Spans are rows from then on, grouped by their document only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelens.llm.common import held_out
from forgelens.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")
ROUNDS, DEPTH, RATE, PENALTY = 6, 3, 0.6, 1.0
PRECISION, SUPPORT = 0.98, 20

# The patterns match what the plain ones do. A run of characters is tried from its first one or
# from the end of the last match only, and repeats don't give back: no text takes quadratic time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_DOT = r"(?:\.|\x20?[(\[]dot[)\]]\x20?|[(\[]\.[)\]])"
PROPOSALS = {
    "address": rf"(?:\G|(?<![\p{{L}}\p{{N}}._%+-]))[\p{{L}}\p{{N}}._%+-]{{1,64}}+(?:@|\x20?[(\[]at[)\]]\x20?|[(\[]@[)\]])[\p{{L}}\p{{N}}-]++(?:{_DOT}[\p{{L}}\p{{N}}-]++)*+",
    "quad": rf"(?=[0-9])(?:\G|(?<![0-9]))[0-9]{{1,6}}+(?:{_DOT}[0-9]{{1,6}}+){{3}}",
    "number": r"[+(]?[0-9](?:[\x20(). ‑/_-]{0,3}[0-9]){6,22}",
}
CUES = {
    "email": r"(?i)(mail|contact|write to|reach)",
    "ip": r"(?i)(\bip\b|host|server|addr|client)",
    "card": r"(?i)(card|visa|credit|debit|payment|account)",
    "phone": r"(?i)(tel|phone|call|fax|mobile|cell|\bsms\b)",
}
FEATURES = ("kind", "digits", "groups", "first", "last", "sep", "size", "before", "after", "cue")


def _matches(by: str, pattern: str) -> Column:
    """Array of the matches in ``__text``, each with what stands before and after it."""

    def row(x, i):
        before, after = F.right(x["p"], F.lit(24)), F.left(x["q"], F.lit(1))
        return F.struct(F.lit(by).alias("by"), i.alias("at"), F.length(x["p"]).alias("gap"), x["m"].alias("match"), before.alias("before"), after.alias("after"))

    def rows(s):
        behind = F.slice(s["p"], F.lit(2), F.size(s["p"]))
        return F.transform(F.arrays_zip(s["p"].alias("p"), s["m"].alias("m"), behind.alias("q")), row)

    # A lambda's argument is computed once, what the lambda only refers to once for each element.
    pieces = F.split("__text", pattern, -1)
    matches = F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))
    return F.transform(F.array(F.struct(pieces.alias("p"), matches.alias("m"))), rows)[0]


def _may_match(by: str) -> Column:
    """What every match holds and most texts don't: cheap to find, so that few texts are split."""
    text = F.col("__text")
    needs = {
        "email": F.contains(text, F.lit("@")), "address": F.contains(text, F.lit("@")) | text.rlike(r"[(\[]at[)\]]"),
        "ip": text.rlike(r"[0-9]\.[0-9]"), "quad": text.rlike(r"[0-9][.(\[\x20]"), "phone": F.contains(text, F.lit("+")),
    }
    return needs.get(by, text.rlike("[0-9]"))


def _found(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, by, at, gap, match, before, after): every match, and one row without a match for each document.

    ``gap`` is the number of characters between the match before and this one.
    """
    spans = [F.when(_may_match(by), F.filter(_matches(by, pattern), lambda x: x["match"].isNotNull())).otherwise(F.array()) for by, pattern in {**BASE, **PROPOSALS}.items()]
    nothing = F.array(F.struct(F.lit("none").alias("by"), F.lit(0).alias("at"), F.lit(0).alias("gap"), F.lit("").alias("match"), F.lit("").alias("before"), F.lit("").alias("after")))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("__text"))
    return rows.select("rid", "doc_id", F.explode(F.concat(nothing, *spans)).alias("x")).select("rid", "doc_id", "x.*")


def _luhn(digits: Column) -> Column:
    """Whether a number of at most 19 digits has a sum divisible by 10 with every second digit doubled, from the right."""
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(digits)))
    value = lambda i: F.coalesce(F.substr(F.reverse(digits), i, F.lit(1)).try_cast("int"), F.lit(0))
    doubled = lambda i: F.when(i % 2 == 1, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0))
    return F.aggregate(F.when(F.length(digits) <= 19, at).otherwise(F.array(F.lit(1))), F.lit(0), lambda a, i: a + doubled(i)) % 10 == 0


def _valid() -> Column:
    """Whether a base match passes the checks of its kind."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    small = lambda p: F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.when(F.ltrim(p, F.lit("0")) == "", 0).otherwise(256)) <= 255
    return (
        F.when(F.col("by") == "email", True)
        .when(F.col("by") == "ip", F.forall(F.split("match", r"\."), small))
        .when(F.col("by") == "card", F.length(digits).between(13, 19) & _luhn(digits))
        .when(F.col("by") == "phone", F.length(digits).between(9, 15))
    )


def _placed(found: DataFrame) -> DataFrame:
    """Spans with their kind, start and end; a number is proposed as card and as phone where its digits allow it."""
    upto = Window.partitionBy("rid", "by").orderBy("at")
    end = F.sum(F.col("gap") + F.length("match")).over(upto)
    digits = F.length(F.regexp_replace("match", "[^0-9]", ""))
    as_number = F.array_compact(F.array(F.when(digits >= 12, "card"), F.when(digits <= 15, "phone")))
    kinds = (
        F.when(F.col("by") == "address", F.array(F.lit("email"))).when(F.col("by") == "quad", F.array(F.lit("ip")))
        .when(F.col("by") == "number", as_number).otherwise(F.array("by"))
    )
    part = F.when(F.col("by").isin(*PROPOSALS), "proposal").when(F.col("by") == "none", "none").when(_valid(), "base").otherwise("dropped")
    rows = found.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.length("match")).withColumn("part", part)
    return rows.select("rid", "doc_id", "part", F.explode(kinds).alias("kind"), "start", "end", "match", "before", "after")


def _compared(placed: DataFrame) -> DataFrame:
    """Spans with ``meets`` (a base span of the kind) and ``near`` (any base span, or a dropped match of the kind)."""

    def overlaps(keys: tuple[str, ...], of: Column) -> Column:
        # Both from the beginning on: a frame to the end is summed up anew for every row.
        order, document = ("start", "end", "part"), Window.partitionBy(*keys)
        upto = lambda by: document.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        left = F.max(F.when(of, F.col("end"))).over(upto([F.asc(c) for c in order]))
        right = F.min(F.when(of, F.col("start"))).over(upto([F.desc(c) for c in order]))
        return F.coalesce(left > F.col("start"), F.lit(False)) | F.coalesce(right < F.col("end"), F.lit(False))

    base, dropped = F.col("part") == "base", F.col("part") == "dropped"
    own = placed.withColumn("meets", overlaps(("rid", "kind"), base)).withColumn("failed", overlaps(("rid", "kind"), dropped))
    return own.withColumn("near", overlaps(("rid",), base) | F.col("failed"))


def _features() -> dict[str, Column]:
    """Small whole numbers that describe a proposal; none tells a base match by itself."""
    body = F.regexp_replace("match", r"[0-9+\p{L}@\[\]]|\(at\)|\(dot\)", "")
    groups = F.regexp_extract_all("match", F.lit("[0-9]+"), F.lit(0))
    group = lambda i: F.least(F.coalesce(F.length(F.try_element_at(groups, F.lit(i))), F.lit(0)), F.lit(8))
    one = lambda c: F.length(F.translate(body, c, "")) == 0
    numeric = F.col("kind").isin("card", "phone")
    sep = F.when(~numeric | (body == ""), 0).when(one(" "), 1).when(one("-"), 2).when(one("."), 3).when(F.contains(body, F.lit("(")), 4).otherwise(5)
    near = lambda c: F.when((c == "") | c.rlike(r"^\s"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike(r"^[.,;:!?)\]'\"]"), 3).otherwise(4)
    cue = F.lit(0)
    for kind, words in CUES.items():
        cue = F.when((F.col("kind") == kind) & F.col("before").rlike(words), 1).otherwise(cue)
    return {
        "kind": F.array_position(F.lit(list(KINDS)), F.col("kind")) - 1,
        "digits": F.least(F.length(F.regexp_replace("match", "[^0-9]", "")), F.lit(24)),
        "groups": F.least(F.size(groups), F.lit(8)),
        "first": group(1), "last": group(-1), "sep": sep,
        "size": F.least(F.floor(F.length("match") / 4), F.lit(8)),
        "before": near(F.right("before", F.lit(1))), "after": near(F.col("after")), "cue": cue,
    }


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """Goes left where the feature is at most ``value``, or is ``value`` if ``equal``."""

    feature: str
    value: int
    equal: bool
    left: Split | Leaf
    right: Split | Leaf

    def test(self) -> Column:
        return F.col(self.feature) == self.value if self.equal else F.col(self.feature) <= self.value


def _score(tree: Split | Leaf) -> Column:
    if isinstance(tree, Leaf):
        return F.lit(tree.value)
    return F.when(tree.test(), _score(tree.left)).otherwise(_score(tree.right))


@dataclass(frozen=True)
class Trees:
    start: float
    trees: tuple[Split | Leaf, ...]

    def probability(self) -> Column:
        """Of a proposal with the columns ``FEATURES``."""
        raw = F.lit(self.start)
        for tree in self.trees:
            raw = raw + _score(tree)
        return 1 / (1 + F.exp(-raw))


def fit(cells: DataFrame, rounds: int = ROUNDS, depth: int = DEPTH) -> Trees | None:
    """Boosted trees over counted proposals (``FEATURES``, yes, no); None without rows of both classes."""
    whole = cells.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).first()
    if not whole.yes or not whole.no:
        return None
    model = Trees(math.log(whole.yes / whole.no), ())
    for _ in range(rounds):
        p = model.probability()
        steps = cells.select(*FEATURES, (F.col("yes") * (1 - p) - F.col("no") * p).alias("g"), ((F.col("yes") + F.col("no")) * p * (1 - p)).alias("h"))
        model = Trees(model.start, (*model.trees, _grow(steps, depth)))
    return model


def _grow(steps: DataFrame, depth: int) -> Split | Leaf:
    """One tree, level by level; each level is one aggregation for all its nodes."""
    splits: dict[int, tuple[str, int, bool]] = {}
    weights: dict[int, float] = {}
    for level in range(depth):
        sums: dict[int, dict[tuple[str, int], tuple[float, float]]] = {}
        values = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("int").alias("value")) for f in FEATURES]))
        rows = steps.select(_node(splits, level).alias("node"), "g", "h", values.alias("x")).where("node is not null")
        for r in rows.groupBy("node", "x.feature", "x.value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            sums.setdefault(r.node, {})[r.feature, r.value] = (r.g, r.h)
        for node, by_value in sums.items():
            chosen = _best(by_value)
            g, h = (sum(v[k] for (f, _), v in by_value.items() if f == FEATURES[0]) for k in (0, 1))
            weights[node] = g / (h + PENALTY)
            if chosen is not None:
                splits[node], (left, right) = chosen
                weights[2 * node], weights[2 * node + 1] = left, right

    def tree(node: int) -> Split | Leaf:
        if node not in splits:
            return Leaf(RATE * max(-4.0, min(4.0, weights.get(node, 0.0))))
        return Split(*splits[node], tree(2 * node), tree(2 * node + 1))

    return tree(1)


def _node(splits: dict[int, tuple[str, int, bool]], level: int) -> Column:
    """The number of a row's node at a level, null below a leaf: 1 at the top, 2n and 2n+1 under n."""

    def number(node: int, left: int) -> Column:
        if not left:
            return F.lit(node)
        if node not in splits:
            return F.lit(None).cast("int")
        test = Split(*splits[node], Leaf(0), Leaf(0)).test()
        return F.when(test, number(2 * node, left - 1)).otherwise(number(2 * node + 1, left - 1))

    return number(1, level)


def _best(sums: dict[tuple[str, int], tuple[float, float]]) -> tuple[tuple[str, int, bool], tuple[float, float]] | None:
    """The split with the largest gain and both weights; ties by feature and value."""
    best = None
    for feature in FEATURES:
        values = sorted((v, *gh) for (f, v), gh in sums.items() if f == feature)
        all_g, all_h = sum(v[1] for v in values), sum(v[2] for v in values)
        below_g = below_h = 0.0
        for value, g, h in values:
            below_g, below_h = below_g + g, below_h + h
            for equal, (lg, lh) in ((False, (below_g, below_h)), (True, (g, h))):
                rg, rh = all_g - lg, all_h - lh
                if lh <= 1e-6 or rh <= 1e-6:
                    continue
                gain = lg * lg / (lh + PENALTY) + rg * rg / (rh + PENALTY) - all_g * all_g / (all_h + PENALTY)
                key = (round(gain, 6), -FEATURES.index(feature), -value, not equal)
                if gain > 1e-6 and (best is None or key > best[0]):
                    best = (key, (feature, value, equal), (lg / (lh + PENALTY), rg / (rh + PENALTY)))
    return best and best[1:]


def thresholds(cells: DataFrame, model: Trees, precision: float = PRECISION, support: int = SUPPORT) -> dict[str, float]:
    """For each kind the lowest score from which on ``precision`` of the counted proposals meet a base span.

    Kinds without ``support`` of them have none. The driver gets a row for each kind and thousandth.
    """
    step = F.floor(model.probability() * 1000).cast("int")
    rows = cells.groupBy("kind", step.alias("step")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).orderBy(F.desc("step")).collect()
    found: dict[str, float] = {}
    yes, no = [0] * len(KINDS), [0] * len(KINDS)
    for r in rows:
        yes[r.kind] += r.yes
        no[r.kind] += r.no
        if yes[r.kind] >= max(support, precision * (yes[r.kind] + no[r.kind])):
            found[KINDS[r.kind]] = r.step / 1000
    return found


def find_personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """(doc_id, base, added) for every row of ``docs`` (doc_id, text): arrays of (kind, start, end).

    ``base`` holds the checked base matches, ``added`` the proposals that the trees select: they
    overlap no base span and no base match of their kind that failed its check. Both are sorted
    by kind as in ``KINDS``, start and end; offsets count code points, end exclusive. Null and empty texts have
    none. Rows repeated stay repeated, ids may be null; other columns are left out. Without proposals of
    both classes, as in an empty table, nothing is added.
    """
    placed = stage(_placed(stage(_found(docs))))
    compared = _compared(placed)
    proposals = stage(compared.where("part = 'proposal'").select("rid", "doc_id", "start", "end", "meets", "near", *[c.alias(n) for n, c in _features().items()]))
    apart = held_out("doc_id", 4, 0)
    counts = [F.sum(F.col("meets").cast("long")).alias("yes"), F.sum((~F.col("meets")).cast("long")).alias("no")]
    cells = stage(proposals.groupBy(*FEATURES, apart.alias("apart")).agg(*counts))
    model = fit(cells.where("not apart"))
    known = thresholds(cells.where("apart"), model, precision) if model else {}
    spans = placed.select("rid", "doc_id", "part", (F.array_position(F.lit(list(KINDS)), F.col("kind")) - 1).alias("kind"), "start", "end").where("part in ('base', 'none')")
    if known:
        level = F.element_at(F.lit([known.get(k, 2.0) for k in KINDS]), F.col("kind").cast("int") + 1)
        chosen = proposals.where(~F.col("near") & (F.floor(model.probability() * 1000) / 1000 >= level))
        spans = spans.unionByName(chosen.select("rid", "doc_id", F.lit("added").alias("part"), "kind", "start", "end"))
    of = lambda part: F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("kind", "start", "end"))))
    named = lambda c: F.transform(c, lambda x: F.struct(F.element_at(F.lit(list(KINDS)), x["kind"].cast("int") + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    whole = spans.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), of("base").alias("base"), of("added").alias("added"))
    return whole.select("doc_id", named("base").alias("base"), named("added").alias("added"))


def _is(kind: str):
    return lambda x: x["kind"] == kind


def op11_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of all documents; n_added besides."""
    out = find_personal_data(docs.select("doc_id", "text"))
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    joined = lambda c: F.array_join(F.transform(c, text), ",")
    number = lambda x: F.struct((F.array_position(F.lit(list(KINDS)), x["kind"])).alias("k"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))
    every = F.array_sort(F.transform(F.concat("base", "added"), number))
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(every).alias("spans"), F.size("added").cast("long").alias("n_added"))
