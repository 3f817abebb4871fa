"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams (1 to 3 code points of the lower-cased text),
weighted 1 + ln(tf), times idf, scaled to length one. Document frequencies are
counted over all learnable documents by Spark. The weights are fitted by
follow-the-regularised-leader (proximal, per-coordinate rates) with L1 and L2
penalties, which leaves most of them zero, on a bounded sample: about
``per_language`` distinct texts of each language, or all if it has fewer, chosen
by hash at a rate set by the number of distinct texts, however many copies each
has. That sample, never the corpus, meets in one task. A fifth of it is kept from the fit to set a
softmax temperature. Predictions read whole texts, in blocks.

Whether a text is in any learned language cannot be told by its score: a softmax
is sure of foreign texts too. It is told by how usual its n-grams are, their mean
idf, which is low in learned languages and about that of a random feature in
others. Passages of many lengths are cut from the texts kept from the fit; the
mean that all but ``REJECTED`` of a length's passages stay below, moved by
``MARGIN`` of the way towards a random feature's, is that length's limit.

Documents with crc32(doc_id as text) mod 3 = 1 are held out; only text and
non-null lang of the others are learned from, and predictions depend on text
alone.

Defined results: a null text or one without a letter is ``und`` with score 0, and
so is every text if nothing can be learned; a null doc_id is not held out;
repeated rows give repeated results; an empty table gives an empty table; extra
columns are ignored by ``predict`` and kept by ``recognised_rows``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import save, ship, slices

DIM_BITS = 15
LETTER = regex.compile(r"\p{L}")
BLOCK = 1 << 20
#: Code points of the passages by which limits are set, the share of them beyond the limit, and the margin.
LENGTHS = [8 << k for k in range(9)]
REJECTED, MARGIN = 0.005, 0.25
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def counts(text: str, bits: int = DIM_BITS) -> np.ndarray:
    """How often each hashed n-gram occurs in the whole text; a few MB whatever its length."""
    out = np.zeros(1 << bits, np.int64)
    shift = np.uint64(64 - bits)
    for at in range(0, len(text), BLOCK):
        # n-grams that start in the block
        c = np.frombuffer(text[at : at + BLOCK + 2].lower().encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        n = min(BLOCK, len(text) - at) if len(text) > BLOCK else len(c)
        code = np.zeros(len(c), np.uint64)
        for k in range(3):
            code = (code[: len(c) - k] * np.uint64(0x100000001B3) + c[k:]) * _MIX[k]
            out += np.bincount((code[:n] >> shift).astype(np.int64), minlength=len(out))
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # languages x features
    bias: np.ndarray
    temperature: float = 1.0
    limits: tuple[float, ...] = ()  # of the mean idf, by LENGTHS

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        tf = counts(text)
        at = np.flatnonzero(tf)
        x = (1 + np.log(tf[at])) * self.idf[at]
        return at, x / max(np.sqrt(x @ x), 1e-12)

    def strangeness(self, text: str) -> float:
        """The mean idf of the text's n-grams."""
        tf = counts(text)
        return float(tf @ self.idf / max(1, tf.sum()))

    def probabilities(self, text: str) -> np.ndarray:
        at, x = self.vector(text)
        return softmax((self.weights[:, at] @ x + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not LETTER.search(text):
            return "und", 0.0
        p = self.probabilities(text)
        k = int(p.argmax())
        return self.languages[k], float(p[k])

    def recognises(self, text: str | None) -> bool:
        """Whether the text's n-grams are as usual as those of texts of its length in a learned language."""
        return self.predict(text)[0] != "und" and self.strangeness(text) <= self.limits[length_class(len(text))]


def length_class(n: int) -> int:
    """The longest of LENGTHS that n code points reach, or the first."""
    return max(0, min(len(LENGTHS), (n // LENGTHS[0]).bit_length()) - 1)


def strangeness_limits(passages: list[list[float]], idf: np.ndarray) -> tuple[float, ...]:
    """The largest mean idf per length, from that of known passages; no less for shorter texts, and none where too few are known."""
    out, random = [], float(idf.mean())
    for s in passages:
        q = np.quantile(s, 1 - REJECTED) if len(s) >= 20 else None
        out.append(None if q is None else float(q + MARGIN * max(0.0, random - q)))
    known = [x for x in out if x is not None]
    last = min(known) if known else math.inf
    for k in reversed(range(len(out))):
        last = out[k] = last if out[k] is None else max(last, out[k])
    return tuple(out)


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader for a softmax; a weight is worked out from its sums when it is used."""

    def __init__(self, n_classes: int, n_features: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros((n_classes, n_features + 1)), np.zeros((n_classes, n_features + 1))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(w @ x)
        p[label] -= 1
        g = np.outer(p, x)
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[:, at] += g * g


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least negative log likelihood, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return -float(np.log(softmax(scores / math.exp(t))[np.arange(len(labels)), labels] + 1e-12).mean())

    lo, hi, r = math.log(0.02), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Over all texts; the driver gets one sum per hashed feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << DIM_BITS, np.int64), 0
        for batch in batches:
            for part in slices(batch, 0):
                for t in part.column(0):
                    df += counts(t.as_py()) > 0
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["feature", "n"])

    out, n = np.zeros(1 << DIM_BITS, np.int64), 0
    for feature, k in texts.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False):
        if feature < 0:
            n = int(k)
        else:
            out[feature] = k
    return out, n


def fit(docs: DataFrame, per_language: int = 500, most_languages: int = 300, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01) -> Model:
    """Learn from what is not held out. ``per_language`` bounds the sample: about so many distinct texts of a language."""
    spark = docs.sparkSession
    ship(spark)
    learnable = docs.where(~held_out(F.col("doc_id"))).select("text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    hashed = learnable.withColumn("h", F.xxhash64("lang", "text"))
    # distinct texts, as all copies of one are drawn or left together; a row per language
    sizes = {r["lang"]: r["n"] for r in hashed.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).limit(most_languages + 1).collect()}
    if len(sizes) > most_languages:  # a model holds languages x 2 ** DIM_BITS numbers, and is broadcast
        raise ValueError(f"more than {most_languages} values of lang: clean the column, or raise most_languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(1 << DIM_BITS), np.zeros((0, 1 << DIM_BITS)), np.zeros(0))
    df, n = document_frequencies(learnable.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    start = Model(languages, idf, np.zeros((len(languages), 1 << DIM_BITS)), np.zeros(len(languages)))

    rate = F.element_at(F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, per_language / v))]), F.col("lang"))
    sample = hashed.where(F.shiftrightunsigned("h", 11) < rate * (1 << 53)).groupBy("h", "lang").agg(F.first("text").alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append((h, languages.index(lang), -1, *start.vector(text)))
                for k, n in enumerate(LENGTHS):  # passages, at places that the hash sets
                    if h % 5 == 0 and len(text) >= n:
                        at = h % (len(text) - n + 1)
                        if LETTER.search(passage := text[at : at + n]):
                            rows.append((h, languages.index(lang), k, np.zeros(0), np.array([start.strangeness(passage)])))
            cols = [[r[i] for r in rows] for i in range(3)] + [[r[3].astype("<i4").tobytes() for r in rows], [r[4].astype("<f4").tobytes() for r in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["h", "label", "part", "at", "x"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = sorted((h, part, y, a, x) for b in batches for h, y, part, a, x in zip(*(c.to_pylist() for c in b.columns)))
        bias = 1 << DIM_BITS
        vector = lambda a, x: (np.append(np.frombuffer(a, "<i4"), bias), np.append(np.frombuffer(x, "<f4").astype(float), 1.0))
        rows = [(h, y, *vector(a, x)) for h, part, y, a, x in every if part < 0]
        size = np.bincount([r[1] for r in rows], minlength=len(languages))
        # no language of a few texts is left to the tuning alone
        tuned = lambda h, y: h % 5 == 0 and size[y] >= 10
        tune = [r for r in rows if tuned(r[0], r[1])]
        learner = Ftrl(len(languages), 1 << DIM_BITS, alpha, beta, l1, l2)
        for epoch in range(epochs):
            for h, y, a, x in rows if epoch % 2 == 0 else rows[::-1]:
                if len(rows) < 50 or not tuned(h, y):
                    learner.learn(a, x, y)
        w = learner.weights(slice(None))
        t = temperature(np.array([w[:, a] @ x for _, _, a, x in tune]), np.array([y for _, y, _, _ in tune]))
        passages: list[list[float]] = [[] for _ in LENGTHS]
        for h, part, y, _, x in every:
            if part >= 0 and tuned(h, y):
                passages[part].append(float(np.frombuffer(x, "<f4")[0]))
        limits = list(strangeness_limits(passages, idf))
        yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f4").tobytes()], pa.binary()), pa.array([t]), pa.array([limits], pa.list_(pa.float64()))], ["w", "t", "limits"])

    features = sample.select("h", "lang", "text").mapInArrow(vectors, "h long, label int, part int, at binary, x binary")
    row = features.repartition(1).mapInArrow(train, "w binary, t double, limits array<double>").first()
    w = np.frombuffer(row["w"], "<f4").reshape(len(languages), -1).astype(float)
    return Model(languages, idf, np.ascontiguousarray(w[:, :-1]), w[:, -1].copy(), row["t"], tuple(row["limits"]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x 2 ** DIM_BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for part in slices(batch, 2):
                found = [m.predict(t.as_py()) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def recognised_rows(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` in a language the model knows; all columns kept."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(texts):
        import pandas as pd

        return pd.Series(list(map(sent.value.recognises, texts)), dtype=bool)

    return docs.where(known(F.col("text")))
