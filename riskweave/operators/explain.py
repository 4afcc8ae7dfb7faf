"""Per-row attributions: which features pushed a score, and which way."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.labels import FACTOR_DIRECTION


def rank_contributions(
    df: DataFrame, keys: Sequence[str], contributions: Mapping[str, Column], top_n: int = 5, language: str = "en"
) -> DataFrame:
    """The ``top_n`` contributions of largest size per row, one row each.

    Sorted inside an array per row, so nothing is shuffled.
    """
    up, down = FACTOR_DIRECTION[language]
    entries = F.array(
        *[
            F.struct((-F.abs(c)).alias("order"), F.lit(i).alias("pos"), F.lit(name).alias("feature"), c.alias("contribution"))
            for i, (name, c) in enumerate(contributions.items())
        ]
    )
    top = F.slice(F.array_sort(entries), 1, top_n)
    rows = df.select(*keys, F.posexplode(top).alias("_i", "_e"))
    return rows.select(
        *keys,
        (F.col("_i") + 1).alias("rank"),
        F.col("_e.feature").alias("feature"),
        F.round("_e.contribution", 4).alias("contribution"),
        F.when(F.col("_e.contribution") > 0, up).otherwise(down).alias("direction"),
    )


def linear_contributions(coefficients: Mapping[str, float], means: Mapping[str, float]) -> dict[str, Column]:
    """Exact attribution of a linear score: ``coef * (x - mean)``."""
    return {c: F.lit(float(w)) * (F.col(c).cast("double") - F.lit(float(means[c]))) for c, w in coefficients.items()}


def fit_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return {c: row[c] if row[c] is not None else 0.0 for c in columns}


@dataclass(frozen=True)
class Leaf:
    """One leaf: its value and, per feature on the path, the interval that leads
    there and the share of training rows that follow it."""

    value: float
    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    share: tuple[float, ...]


def leaves_of_trees(nodes: pd.DataFrame, weights: Mapping[int, float], scale: float = 1.0) -> list[Leaf]:
    """Leaves from a node table ``(tree, id, prediction, rows, left, right,
    feature, threshold)``; its size is that of the model."""
    made: list[Leaf] = []
    for tree, table in nodes.groupby("tree"):
        by_id = table.set_index("id").to_dict("index")
        stack = [(0, {})]
        while stack:
            node_id, path = stack.pop()
            node = by_id[node_id]
            if node["left"] < 0:
                items = sorted(path.items())
                made.append(
                    Leaf(
                        scale * weights[tree] * node["prediction"],
                        tuple(f for f, _ in items),
                        tuple(v[0] for _, v in items),
                        tuple(v[1] for _, v in items),
                        tuple(v[2] for _, v in items),
                    )
                )
                continue
            f, cut = int(node["feature"]), node["threshold"]
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            left, right = by_id[node["left"]], by_id[node["right"]]
            stack.append((node["left"], {**path, f: (low, min(high, cut), share * left["rows"] / node["rows"])}))
            stack.append((node["right"], {**path, f: (max(low, cut), high, share * right["rows"] / node["rows"])}))
    return made


def tree_attribution(x: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Shapley values of the path-dependent expectation, rows x features.

    Inside a leaf, feature j contributes a factor 1 or 0 when known (the row
    follows the path or not) and its share when unknown. The sum over subsets
    of the other features is read from the coefficients of
    ``prod (share_j + follows_j * t)``.
    """
    out = np.zeros_like(x)
    for leaf in leaves:
        m = len(leaf.features)
        if m == 0:
            continue
        picked = x[:, leaf.features]
        follows = ((picked > np.array(leaf.low)) & (picked <= np.array(leaf.high))).astype(float)
        weight = np.array([factorial(s) * factorial(m - 1 - s) / factorial(m) for s in range(m)])
        for i, f in enumerate(leaf.features):
            coefficients = np.zeros((len(x), m))
            coefficients[:, 0] = 1.0
            for j in range(m):
                if j != i:
                    shifted = np.zeros_like(coefficients)
                    shifted[:, 1:] = coefficients[:, :-1] * follows[:, [j]]
                    coefficients = coefficients * leaf.share[j] + shifted
            out[:, f] += leaf.value * (follows[:, i] - leaf.share[i]) * (coefficients @ weight)
    return out


def tree_contributions(df: DataFrame, keys: Sequence[str], features: Sequence[str], leaves: Sequence[Leaf]) -> DataFrame:
    """``(keys, one double per feature)`` for a tree ensemble, batch by batch."""
    features = list(features)
    kinds = dict(df.dtypes)
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"`{f}` double" for f in features])

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = tree_attribution(batch[features].to_numpy(dtype=float), leaves)
            yield pd.concat([batch[list(keys)].reset_index(drop=True), pd.DataFrame(values, columns=features)], axis=1)

    return df.select(*keys, *[F.col(f).cast("double").alias(f) for f in features]).mapInPandas(attribute, schema)
