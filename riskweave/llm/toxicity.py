"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct words of a text and the beginnings (4 and 5 letters) of
longer ones, hashed. The score is the logistic of

    bias + sum w_i + sum over pairs of <v_i, v_j>

so a pair such as an insult and a group mention counts beyond its two terms.
Linear weights are learned by follow-the-regularised-leader (L1 keeps them
sparse), factors by AdaGrad, from at most ``TRAIN_ROWS`` labelled rows, those
with the least hash of their id, one for each id and text. Every term of these rows has a weight and
factors, also one that tells only beside another. Against the noise of long
texts, L1 holds weights at zero, factors decay, and a text's step of the factors
is divided by its number of terms. A third of the rows is first set aside: the
margin of best F1 on it, halved because the set is small, moves the bias, so that
0.5 is the threshold to use. Scoring covers every whole text.

Defined cases: a null or empty text has the bias alone; without labelled rows,
or with one class only, the score is the share of toxic rows (0 when there are
none); a document with several labels counts as toxic if one says so; null
labels and ids are not learned from; repeated documents are scored each;
columns other than doc_id, text and toxic are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.fitting import fit_in_task
from riskweave.session import materialize

TRAIN_ROWS = 20_000
BITS = 18
FACTORS = 4
EPOCHS = 8
#: What a toxic row counts in training; the others count 1.
TOXIC_WEIGHT = 2.0
WORD = re.compile(r"[^\W\d_]+")
#: Words a task remembers the terms of, before it starts anew.
REMEMBERED = 200_000
#: Terms of texts that are scored together.
HELD_TERMS = 1_000_000


def word_terms(word: str) -> list[int]:
    """Hashed terms of a lower-case word."""
    parts = [word] + [f"^{word[:n]}" for n in (4, 5) if len(word) > n]
    return [zlib.crc32(p.encode()) & ((1 << BITS) - 1) for p in parts]


def terms(text: str) -> np.ndarray:
    """The distinct terms of a text, sorted."""
    found = {t for w in set(WORD.findall(text.lower())) for t in word_terms(w)}
    return np.array(sorted(found), dtype=np.int32)


@dataclass
class Machine:
    """Parameters of the terms in ``kept`` (sorted)."""

    kept: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, at: np.ndarray) -> float:
        """``at``: rows of the kept terms that the text has."""
        return float(self.margins(at, np.array([len(at)]))[0])

    def margins(self, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The same for many texts: their rows one after the other, and how many each has."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        made = self.bias + np.bincount(owner, self.weights[at], minlength=len(sizes))
        for k in range(self.factors.shape[1]):  # pairs: half of (sum squared less sum of squares)
            v = self.factors[at, k]
            made += 0.5 * (np.bincount(owner, v, minlength=len(sizes)) ** 2 - np.bincount(owner, v * v, minlength=len(sizes)))
        return made


def best_cut(margins: np.ndarray, labels: np.ndarray) -> float:
    """The margin that divides the rows with the greatest F1; 0 without positive rows."""
    if not labels.sum():
        return 0.0
    order = np.argsort(-margins, kind="stable")
    m = margins[order]
    f1 = 2 * np.cumsum(labels[order]) / (np.arange(1, len(m) + 1) + labels.sum())
    last = np.append(m[1:] != m[:-1], True)
    best = int(np.argmax(np.where(last, f1, -1.0)))
    return float((m[best] + (m[best + 1] if best + 1 < len(m) else m[best] - 1.0)) / 2)


def train_cut(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """A machine whose margin 0 is the threshold chosen on rows set aside."""
    apart = np.arange(len(labels)) % 3 == 2
    tried = train([r for r, a in zip(rows, apart, strict=True) if not a], labels[~apart])
    aside = [r for r, a in zip(rows, apart, strict=True) if a]
    machine = train(rows, labels)
    if len(tried.kept) and len(machine.kept) and aside:
        local = [np.searchsorted(tried.kept, r[np.isin(r, tried.kept, assume_unique=True)]) for r in aside]
        margins = tried.margins(np.concatenate(local), np.array([len(x) for x in local]))
        machine.bias -= best_cut(margins, labels[apart]) / 2
    return machine


def telling_terms(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Terms with parameters, sorted: all that a row has, for any may tell beside another."""
    return np.unique(np.concatenate(rows)).astype(np.int32)


def train(rows: list[np.ndarray], labels: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """FTRL for the weights, AdaGrad for the factors; rows in a seeded order."""
    n, n1 = len(labels), float(labels.sum())
    if n1 in (0.0, float(n)):
        rate = min(max(n1 / n if n else 0.0, 1e-6), 1 - 1e-6)
        return Machine(np.zeros(0, np.int32), float(np.log(rate / (1 - rate))), np.zeros(0), np.zeros((0, factors)))
    kept = telling_terms(rows, labels)
    local = [np.searchsorted(kept, r[np.isin(r, kept, assume_unique=True)]) for r in rows]
    rng = np.random.default_rng(seed)
    alpha, beta, l1, l2, rate, decay = 0.3, 1.0, 16.0, 0.1, 0.3, 1e-2
    z, g2 = np.zeros(len(kept)), np.zeros(len(kept))
    v, v2 = rng.normal(0, 0.02, (len(kept), factors)), np.ones((len(kept), factors))
    bias, b2 = float(np.log(n1 / (n - n1))), 1.0

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(g2[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(epochs):
        for i in rng.permutation(n):
            at = local[i]
            w, f = weights(at), v[at]
            total = f.sum(axis=0)
            m = bias + w.sum() + 0.5 * (total**2 - (f**2).sum(axis=0)).sum()
            g = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - labels[i]) * (TOXIC_WEIGHT if labels[i] else 1.0)
            b2 += g * g
            bias -= 0.1 * g / np.sqrt(b2)
            if len(at):
                sigma = (np.sqrt(g2[at] + g * g) - np.sqrt(g2[at])) / alpha
                z[at] += g - sigma * w
                g2[at] += g * g
                gv = g * (total - f) + decay * f
                v2[at] += gv * gv
                v[at] = f - rate / len(at) * gv / np.sqrt(v2[at])
    return Machine(kept, bias, weights(np.arange(len(kept))), v)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, train_rows: int = TRAIN_ROWS) -> Machine:
    """A machine from at most ``train_rows`` labelled documents."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # bounded: at most train_rows ids, so the planner may broadcast them
    chosen = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows), "toxic-rows")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("key", F.xxhash64("doc_id", "text"))
    rows = rows.dropDuplicates(["doc_id", "key"])

    def local(batches):
        for b in batches:
            found = [terms(t.as_py() or "") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), b.column("toxic").cast(pa.int32()), b.column("key")], names=["terms", "toxic", "key"]
            )

    def learn(batches):
        found, y, keys = [], [], []
        for b in batches:
            column = b.column("terms")
            flat, ends = column.flatten().to_numpy(), np.cumsum(pa.compute.list_value_length(column).to_numpy())
            found += np.split(flat.copy(), ends[:-1])
            y += b.column("toxic").to_pylist()
            keys += b.column("key").to_pylist()
        order = sorted(range(len(keys)), key=keys.__getitem__)  # the shuffle's order differs from run to run
        return vars(train_cut([found[i] for i in order], np.array(y, dtype=np.float64)[order]))

    sample = rows.select("text", "toxic", "key").mapInArrow(local, "terms array<int>, toxic int, key long")
    # an id may stand with many texts: the bound is of rows
    return Machine(**fit_in_task(sample.orderBy("key").limit(train_rows), learn))


def score(docs: DataFrame, machine: Machine, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, then score and predicted, for every row."""

    def local(batches):
        place = {int(t): i for i, t in enumerate(machine.kept)}
        known: dict[str, tuple[int, ...]] = {}
        for b in batches:
            rows: list[int] = []
            sizes = []
            parts = []

            def close():
                parts.append(machine.margins(np.array(rows, dtype=np.int64), np.array(sizes, dtype=np.int64)))
                rows.clear()
                sizes.clear()

            for text in b.column("_text"):
                at: set[int] = set()
                for w in set(WORD.findall((text.as_py() or "").lower())):
                    own = known.get(w)
                    if own is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        own = known[w] = tuple(place[t] for t in word_terms(w) if t in place)
                    at.update(own)
                rows += sorted(at)
                sizes.append(len(at))
                if len(rows) > HELD_TERMS:
                    close()
            close()
            s = 1 / (1 + np.exp(-np.clip(np.concatenate(parts), -500, 500)))
            columns = [*(b.column(i) for i in range(len(keep))), pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "predicted"])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(local, schema)
