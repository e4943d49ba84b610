"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text becomes a sparse vector x: hashed words, weighed by the log of their count, and a few
shares and sizes of the text (``STATISTICS``). Its score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ],

which holds the interaction of every two inputs in time linear in their number.

The machine is fitted on at most ``per_class`` labelled documents of each class, those with
the smallest hash of their id: that bound is the only sample here. Every document is scored
by its whole text, in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelens.llm.common import append_columns, held_out

WORD_SLOTS = 1 << 14
FACTORS = 6
THRESHOLD = 0.3

STATISTICS = (
    "bytes", "words", "bytes per word", "distinct words", "most frequent word", "upper case", "digits",
    "sentence marks", "other symbols", "line ends", "non-ASCII", "repeated lines", "stored characters",
)
SLOTS = WORD_SLOTS + len(STATISTICS)


def _byte_classes() -> np.ndarray:
    kinds = np.zeros((256, 6))
    for b in range(256):
        c = chr(b)
        kinds[b] = (
            b < 128 and c.isupper(), b < 128 and c.isdigit(), c in ".,;:!?", b < 128 and c.isprintable() and not c.isalnum() and c not in " .,;:!?", c == "\n", b >= 128,
        )
    return kinds


_CLASSES = _byte_classes()


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text. A null text is an empty one, a null size the text's own."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    counts = Counter(words)
    n, lines = len(words), raw.split(b"\n")
    shares = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES / max(1, len(raw))
    chars = len(text or "") if n_chars is None else max(0, n_chars)
    stats = [
        np.log1p(len(raw)) / 12, np.log1p(n) / 12, min(1.0, len(raw) / max(1, n) / 20), len(counts) / max(1, n),
        max(counts.values(), default=0) / max(1, n), *shares, 1 - len(set(lines)) / len(lines), np.log1p(chars) / 12,
    ]
    slots = np.fromiter((zlib.crc32(w) % WORD_SLOTS for w in counts), np.int32, len(counts))
    values = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    values /= max(1.0, float(np.sqrt(values @ values)))
    return np.append(slots, np.arange(WORD_SLOTS, SLOTS, dtype=np.int32)), np.append(values, np.float32(stats)).astype(np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        v = self.factors[slots]
        sums = values @ v
        raw = self.bias + values @ self.linear[slots] + 0.5 * float(sums @ sums - (values * values) @ (v * v).sum(1))
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int, rate: float, decay: float) -> Machine:
    """Adam on the logistic loss over the whole sample, both classes with equal weight."""
    random = np.random.default_rng(11)
    n1, n0 = float(labels.sum()), float(len(labels) - labels.sum())
    bias, linear = np.log((n1 + 1) / (n0 + 1)), np.zeros(SLOTS)
    factors = random.normal(0, 0.02, (SLOTS, FACTORS))
    if not n1 or not n0:
        return Machine(float(bias), linear.astype(np.float32), np.zeros((SLOTS, FACTORS), np.float32))
    bias = 0.0
    slots = np.concatenate([s for s, _ in rows])
    x = np.concatenate([v for _, v in rows]).astype(float)
    starts = np.cumsum([0, *[len(s) for s, _ in rows]])[:-1]
    row = np.repeat(np.arange(len(rows)), [len(s) for s, _ in rows])
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    state = [[np.zeros(SLOTS), np.zeros(SLOTS)] for _ in range(FACTORS + 1)] + [[0.0, 0.0]]
    summed = lambda values: np.add.reduceat(values, starts)

    def step(t: int, s: list, grad):
        s[0], s[1] = 0.9 * s[0] + 0.1 * grad, 0.99 * s[1] + 0.01 * grad * grad
        return rate * (s[0] / (1 - 0.9**t)) / (np.sqrt(s[1] / (1 - 0.99**t)) + 1e-8)

    for t in range(1, steps + 1):
        raw, sums = bias + summed(x * linear[slots]), []
        for f in range(FACTORS):
            vx = x * factors[slots, f]
            sums.append(summed(vx))
            raw += 0.5 * (sums[-1] ** 2 - summed(vx * vx))
        off = weight * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels)
        each = off[row] * x
        for f in range(FACTORS):
            grad = np.bincount(slots, each * (sums[f][row] - x * factors[slots, f]), SLOTS) + decay * factors[:, f]
            factors[:, f] -= step(t, state[f], grad)
        linear -= step(t, state[FACTORS], np.bincount(slots, each, SLOTS) + decay * linear)
        bias -= step(t, state[-1], off.sum())
    return Machine(float(bias), linear.astype(np.float32), factors.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000, steps: int = 60, rate: float = 0.05, decay: float = 1e-5) -> Machine:
    """Fit on up to ``per_class`` documents of each class among ``labels`` (doc_id, quality).

    Labels other than 0 and 1 and ids with both labels teach nothing; of repeated rows of a
    document one counts. With no label, or one class only, the machine is a constant.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most").drop("most")
    )
    ids = [r for q in (0, 1) for r in known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    if not ids:
        return _fit([], np.zeros(0), steps, rate, decay)
    chosen = docs.sparkSession.createDataFrame([(r.doc_id, r.quality) for r in ids], "__id bigint, __label int")

    def rows(batches):
        for batch in batches:
            found = [features(t, n) for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield [pa.array([s.tobytes() for s, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary())]

    # At most 2 * per_class ids: a bounded broadcast.
    text = docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    adds = T.StructType([T.StructField("__slots", T.BinaryType()), T.StructField("__values", T.BinaryType())])
    made = append_columns(text.select("__id", "__label", "text", "n_chars"), ["text", "n_chars"], adds, rows)
    sample = made.groupBy("__id", "__label").agg(F.min(F.struct("__slots", "__values")).alias("x")).orderBy("__id").collect()
    return _fit(
        [(np.frombuffer(r.x[0], np.int32), np.frombuffer(r.x[1], np.float32)) for r in sample],
        np.array([r["__label"] for r in sample], float), steps, rate, decay,
    )


def classify(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: quality 1 likelier) and ``predicted`` (1 from ``threshold``).

    Null and empty texts get a score too, that of an empty text. Columns named ``score`` or
    ``predicted`` are replaced; rows, repeated ones too, stay as they are.
    """

    def rows(batches):
        for batch in batches:
            scores = np.array([machine.score(*features(t, n)) for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)])
            yield [pa.array(scores, pa.float64()), pa.array(scores >= threshold).cast(pa.int32())]

    adds = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return append_columns(docs, ["text", "n_chars"], adds, rows)


def op8_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents; learns from the rows not held out."""
    machine = train(docs, labels.where(~held_out("doc_id", 5, 0)))
    out = classify(docs.select("doc_id", "text", "n_chars"), machine)
    return out.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")
