"""Fitting a small model in one task from a bounded sample."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def fit_in_task(sample: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], object]) -> object:
    """What ``fit`` makes of the rows of ``sample`` (bounded by its maker): plain
    values and arrays.

    Runs in one task, so a lost executor repeats it; only the model comes back.
    """

    def run(batches):
        model = pickle.dumps(fit(batches))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row[0]) if row else fit(iter(()))  # an empty table may have no partition
