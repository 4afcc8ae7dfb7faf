"""Radial kernels by random Fourier features.

A pair of rows has kernel ``exp(-gamma * |x - y|^2)``. The map
``z_j(x) = sqrt(2 / D) * cos(w_j . x + b_j)`` with normal ``w_j`` of variance
``2 * gamma`` and uniform ``b_j`` has ``z(x) . z(y)`` close to that kernel, with
an error of about ``1 / sqrt(D)`` whatever the number of rows. A linear model on
``z`` is then a kernel model, and fitting it needs no pairs of rows.

Weights are drawn from MD5 digests of (seed, row, column) by Box-Muller, so the
map is fixed by its parameters alone: a saved stage holds no matrix, and SQL can
state the same numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed, Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 512
_UNIT = 16**8


def _uniform(seed: int, name: str, j: int, i: int) -> float:
    """In (0, 1): the first 32 bits of a digest, plus a half."""
    digits = hashlib.md5(f"{seed}:{name}:{j}:{i}".encode()).hexdigest()[:8]
    return (int(digits, 16) + 0.5) / _UNIT


def fourier_map(width: int, dimensions: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (dimensions x width) and phases of the map."""
    spread = math.sqrt(2.0 * gamma)
    w = np.array(
        [
            [
                spread * math.sqrt(-2.0 * math.log(_uniform(seed, "r", j, i))) * math.cos(2.0 * math.pi * _uniform(seed, "a", j, i))
                for i in range(width)
            ]
            for j in range(dimensions)
        ]
    ).reshape(dimensions, width)
    return w, np.array([2.0 * math.pi * _uniform(seed, "b", j, 0) for j in range(dimensions)])


class _FourierParams(HasInputCol, HasOutputCol, HasSeed):
    dimensions = Param(Params._dummy(), "dimensions", "number of features made", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)


class FourierFeatures(Transformer, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the features of a vector column as a vector column."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, dimensions=DIMENSIONS, gamma=1.0, seed=42):
        super().__init__()
        self._setDefault(dimensions=DIMENSIONS, gamma=1.0, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        dimensions, gamma, seed = self.getOrDefault(self.dimensions), self.getOrDefault(self.gamma), self.getSeed()

        @F.pandas_udf("array<double>")
        def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            drawn = None  # once a task: the width is that of the first vector
            for batch in batches:
                if not len(batch):
                    yield pd.Series([], dtype=object)
                    continue
                x = np.stack(batch.to_numpy())
                drawn = drawn or fourier_map(x.shape[1], dimensions, gamma, seed)
                yield pd.Series(list(math.sqrt(2.0 / dimensions) * np.cos(x @ drawn[0].T + drawn[1])))

        return df.withColumn(self.getOutputCol(), array_to_vector(features(vector_to_array(self.getInputCol()))))


def scale_gamma(df: DataFrame, vector: str) -> float:
    """1 / (width * variance of all components), from one pass over the rows."""
    if df.isEmpty():
        return 1.0
    found = df.agg(Summarizer.metrics("mean", "variance", "count").summary(F.col(vector)).alias("s")).select("s.*").first()
    mean, n = found["mean"].toArray(), found["count"]
    within = found["variance"].toArray() * (n - 1) / n
    total = float(np.mean(within) + np.mean((mean - mean.mean()) ** 2))
    return 1.0 / (len(mean) * total) if total > 0 else 1.0


class FourierKernel(Estimator, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    """Chooses the kernel's width from the rows, unless ``gamma`` is set."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, dimensions=DIMENSIONS, gamma=None, seed=42):
        super().__init__()
        self._setDefault(dimensions=DIMENSIONS, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> FourierFeatures:
        gamma = self.getOrDefault(self.gamma) if self.isSet(self.gamma) else scale_gamma(df, self.getInputCol())
        return FourierFeatures(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), dimensions=self.getOrDefault(self.dimensions), gamma=gamma, seed=self.getSeed()
        )


def kernel_svc(vector: str, label: str, dimensions: int = DIMENSIONS, gamma: float | None = None, seed: int = 42, **svc) -> Pipeline:
    """A radial support-vector classifier: a pipeline of the map and a linear one."""
    made = f"{vector}_kernel"
    stages = [
        FourierKernel(inputCol=vector, outputCol=made, dimensions=dimensions, gamma=gamma, seed=seed),
        LinearSVC(featuresCol=made, labelCol=label, **svc),
    ]
    return Pipeline(stages=stages)
