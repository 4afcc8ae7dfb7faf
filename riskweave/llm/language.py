"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic net,
then calibrated by one temperature.

Features are the 1- to 3-grams of a lower-case text, hashed to ``1 << BITS``;
log term frequency times inverse document frequency, unit length. Document
frequencies count every training row; the weights are learned from at most
``TRAIN_ROWS`` rows of each language, those with the least hash of id and text
(a repeated row counts once there), of which one in five is kept for the temperature. Prediction covers whole texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows with a null language are not learned from; without any training row every
prediction is ``und`` with score 0; ties go to the language first in order;
repeated rows count each; columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.fitting import fit_in_task
from riskweave.session import materialize

BITS = 15
TRAIN_ROWS = 1500
EPOCHS = 2
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def gram_counts(text: str) -> np.ndarray:
    """How often each hashed 1-, 2- and 3-gram occurs in the lower-case text."""
    size = 1 << BITS
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    counts = np.zeros(size, dtype=np.int64)
    shift = np.uint32(32 - BITS)
    for at in range(0, len(c), 1 << 16):
        x = c[at : at + (1 << 16) + 2]
        own = min(len(x), 1 << 16)
        k = x * np.uint32(0x9E3779B1)
        counts += np.bincount((k[:own] >> shift), minlength=size)
        k2 = (k[:-1] ^ np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35) + k[1:]
        counts += np.bincount(((k2[:own] * np.uint32(0x27D4EB2F)) >> shift), minlength=size)
        k3 = (k2[:-1] ^ np.uint32(0x165667B1)) * np.uint32(0x9E3779B1) + k[2:]
        counts += np.bincount(((k3[:own] * np.uint32(0x85EBCA77)) >> shift), minlength=size)
    return counts


@dataclass
class Model:
    names: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        counts = gram_counts(text)
        at = np.flatnonzero(counts)
        x = np.log1p(counts[at]) * self.idf[at]
        norm = np.sqrt((x * x).sum())
        return at, x / norm if norm else x

    def probabilities(self, text: str) -> np.ndarray:
        at, x = self.features(text)
        return softmax((x @ self.weights[at] + self.bias) / self.temperature)


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = EPOCHS, seed: int = 5):
    """FTRL-proximal with L1 and L2 over sparse rows; returns weights and bias."""
    alpha, beta, l1, l2 = 1.0, 1.0, 0.02, 0.01
    size = (1 << BITS) + 1
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = np.append(rows[i][0], size - 1), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[y[i]] -= 1
            g = np.outer(x, p)
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(np.arange(size))
    return w[:-1], w[-1]


def best_temperature(margins: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""

    def loss(t: float) -> float:
        p = softmax(margins / np.exp(t))
        return -float(np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).mean())

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, held_out: Column, train_rows: int = TRAIN_ROWS) -> Model:
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(~F.coalesce(held_out, F.lit(False))).select("doc_id", "text", "lang")

    def frequencies(batches):
        total, n = np.zeros(1 << BITS, dtype=np.int64), 0
        for b in batches:
            for t in b.column("text"):
                total += gram_counts(t.as_py()) > 0
                n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], n), pa.int64())], names=["gram", "n"])

    counted = known.select("text").mapInArrow(frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # at most one row per hashed gram
    df = np.zeros((1 << BITS) + 1)
    df[found["gram"].to_numpy(dtype=np.int64)] = found["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    # one row per id and text, ranked by both: copies neither fill the places nor come along
    rows = known.withColumn("_digest", F.xxhash64("text"))
    key = F.xxhash64("doc_id", "_digest")
    chosen = rows.select("doc_id", "lang", "_digest").distinct()
    # first within parts of a language: each task keeps train_rows of a part, so a common one does not fill a task
    for group in (["lang", F.pmod(F.xxhash64("doc_id", "_digest", F.lit(1)), F.lit(8))], ["lang"]):
        first = F.row_number().over(Window.partitionBy(*group).orderBy(key, "doc_id", "_digest"))
        chosen = chosen.withColumn("place", first).where(F.col("place") <= train_rows).drop("place")
    chosen = materialize(chosen.select(F.col("doc_id").alias("_doc"), F.col("lang").alias("_lang"), F.col("_digest").alias("_text")), "lang-rows")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("lang") == F.col("_lang")) & (F.col("_digest") == F.col("_text"))
    sample = rows.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "lang", "_digest"]).select("text", "lang", key.alias("key"))

    def learn(batches):
        texts = sorted((r["key"], r["text"], r["lang"]) for b in batches for r in b.to_pylist())
        names = sorted({x[2] for x in texts})
        model = Model(names, idf, np.zeros((1 << BITS, len(names))), np.zeros(len(names)))
        if not names:
            return vars(model)
        rows = [model.features(x[1]) for x in texts]
        y = np.array([names.index(x[2]) for x in texts])
        apart = np.arange(len(y)) % 5 == 4
        model.weights, model.bias = train([r for r, a in zip(rows, apart, strict=True) if not a], y[~apart], len(names))
        if apart.any():
            margins = np.array([rows[i][1] @ model.weights[rows[i][0]] + model.bias for i in np.flatnonzero(apart)])
            model.temperature = best_temperature(margins, y[apart])
        return vars(model)

    return Model(**fit_in_task(sample, learn))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row."""

    def local(batches):
        for b in batches:
            names, scores = [], []
            for text in b.column("text"):
                t = text.as_py()
                if t is None or not model.names or not LETTER.search(t):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = model.probabilities(t)
                names.append(model.names[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(local, f"doc_id {kind}, lang_pred string, score double")
