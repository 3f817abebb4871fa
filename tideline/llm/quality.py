"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered
thresholds cut the score into them: P(grade <= j) = sigmoid(threshold_j - w.x).
That gives an expected grade and tail probabilities P(grade >= j) for selection.

Features are the presence of hashed words (A-Z lower-cased, punctuation taken
off) and how large a part of the words has a shape (capitals, signs, digits,
repeats). The fit is stochastic gradient descent with per-coordinate rates and
soft thresholding, in one task, over a bounded sample of rated rows chosen by
hash: ``max_rows`` of them or so, the same whatever the corpus. A fifth of the
documents, by the CRC of their id, is held out of it to judge the fit by. Scoring
reads every whole text.

Defined results: ratings of one document that differ count as the lowest; of
several texts with one doc_id that with the least hash is learned from; null
and empty texts have only the bias; with no rated rows all grades are equally
likely; repeated rows give repeated results; an empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import ship, slices

BITS = 18
_SHAPES = 8
_LETTERS = re.compile(r"[^\W\d_]+")
_BUCKETS = (0.0, 0.02, 0.1, 0.3, 0.6)


def _hash(word: str) -> int:
    h = 2166136261
    for b in word.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) & ((1 << BITS) - 1)


class Features:
    """Hashed features of a text; hashes of frequent words are remembered, within a bound."""

    def __init__(self, memo: int = 300_000):
        self.memo: dict[str, int] = {}
        self.size = memo

    def of(self, text: str | None) -> np.ndarray:
        tokens = Counter((text or "").split())
        n, shapes, at = max(1, tokens.total()), [0] * _SHAPES, set()
        memo = self.memo
        for t, k in tokens.items():
            letters = len(t) if t.isalpha() else sum(map(len, _LETTERS.findall(t)))
            signs = len(t) - letters
            shapes[0] += k * (t.isupper() and letters > 1)
            shapes[1] += k * (signs > 1)
            shapes[2] += k * (letters == 0)
            shapes[3] += k * any(c.isdigit() for c in t) if signs else 0
            shapes[4] += k * (t in "|-_*#=~")
            word = (t if signs == 0 else "".join(_LETTERS.findall(t))).lower()
            if word:
                h = memo.get(word)
                if h is None:
                    if len(memo) >= self.size:
                        memo.clear()
                    h = memo[word] = _hash(word)
                at.add(h)
        shapes[5] = n - len(tokens)  # repeats
        shapes[6] = tokens.most_common(1)[0][1] if tokens else 0
        base = 1 << BITS
        for i, s in enumerate(shapes):
            at.add(base + i * len(_BUCKETS) + sum(s / n > b for b in _BUCKETS[1:]))
        return np.array(sorted(at), np.int32)


N_FEATURES = (1 << BITS) + _SHAPES * len(_BUCKETS)


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, at: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - self.weights[at].sum(), -40, 40)))


def fit_rows(rows: list[tuple[int, np.ndarray]], n_grades: int, epochs: int = 15, rate: float = 0.3, l1: float = 0.04) -> Ordinal:
    """Gradient descent on the negative log likelihood; thresholds stay in order as the first plus positive steps."""
    w, g2 = np.zeros(N_FEATURES), np.full(N_FEATURES, 1e-2)
    share = np.cumsum(np.bincount([y for y, _ in rows], minlength=n_grades)[:-1] + 1.0) / (len(rows) + n_grades)
    cut = np.log(share / (1 - share))
    first, steps = cut[0], np.log(np.maximum(np.diff(cut), 1e-3))
    sigma = lambda v: 1 / (1 + np.exp(-np.clip(v, -40, 40)))
    for epoch in range(epochs):
        for y, at in rows if epoch % 2 == 0 else rows[::-1]:
            cut = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
            s = w[at].sum()
            upper, lower = (sigma(cut[y] - s) if y < n_grades - 1 else 1.0), (sigma(cut[y - 1] - s) if y else 0.0)
            p = max(upper - lower, 1e-9)
            du, dl = upper * (1 - upper), lower * (1 - lower)
            g = (du - dl) / p  # of the loss by the score
            if abs(g) < 1e-4:
                continue
            g2[at] += g * g
            a = rate / np.sqrt(g2[at])
            v = w[at] - a * g
            w[at] = np.sign(v) * np.maximum(np.abs(v) - a * l1, 0)
            d = np.zeros(n_grades - 1)
            if y < n_grades - 1:
                d[y] -= du / p
            if y:
                d[y - 1] += dl / p
            first -= 0.01 * d.sum()
            steps -= 0.01 * np.exp(steps) * np.cumsum(d[::-1])[::-1][1:]
    return Ordinal(w, first + np.concatenate([[0.0], np.cumsum(np.exp(steps))]))


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, from whose ratings nothing is learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int, max_rows: int = 6000) -> Ordinal:
    """``ratings``: doc_id, grade (0 to n_grades - 1). About ``max_rows`` of the rated documents that are not held out are learned from."""
    spark = docs.sparkSession
    ship(spark)
    graded = ratings.where("grade IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    n = graded.count()
    chosen = graded.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 11) < int(2**53 * min(1.0, max_rows / max(1, n))))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Features()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f.of(t.as_py()).tobytes() for t in batch.column(2)], pa.binary())], ["h", "grade", "at"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted({(h, y, a) for b in batches for h, y, a in zip(*(c.to_pylist() for c in b.columns))})
        m = fit_rows([(y, np.frombuffer(a, np.int32)) for _, y, a in rows], n_grades)
        yield pa.RecordBatch.from_arrays([pa.array([m.weights.astype("<f4").tobytes()], pa.binary()), pa.array([m.thresholds.tolist()], pa.list_(pa.float64()))], ["w", "cut"])

    # chosen is bounded by max_rows, and of the texts of an id that with the least hash is learned from
    rated = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").withColumn("h", F.xxhash64("doc_id", "text"))
    least = rated.groupBy("doc_id").agg(F.min(F.struct("h", "grade", "text")).alias("x"))
    sample = least.select("x.h", "x.grade", "x.text")
    row = sample.mapInArrow(vectors, "h long, grade int, at binary").repartition(1).mapInArrow(train, "w binary, cut array<double>").first()
    return Ordinal(np.frombuffer(row["w"], "<f4").astype(float), np.array(row["cut"]))


def score(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, expected_grade, p_top (the top grade's tail probability) of every row."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # one weight per hashed feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, f = sent.value, Features()
        for batch in batches:
            for part in slices(batch, 1):
                tails = [m.tails(f.of(t.as_py())) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([float(t.sum()) for t in tails], pa.float64()), pa.array([float(t[-1]) for t in tails], pa.float64())], ["doc_id", "expected_grade", "p_top"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, expected_grade double, p_top double")
