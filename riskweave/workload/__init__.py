"""Registered queries by area."""

from __future__ import annotations

from importlib import import_module

from pyspark import cloudpickle

import riskweave

# Python functions travel to the executors by value, so a cluster needs no
# installed copy of this package.
cloudpickle.register_pickle_by_value(riskweave)

AREAS = ("drift", "profiling", "preparing", "splitting", "quality", "serving", "streams", "models", "learning", "comparing")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for area in AREAS:
        for key, value in getattr(import_module(f"riskweave.workload.{area}"), attribute).items():
            if key in merged:
                raise ValueError(f"query {key} is registered twice")
            merged[key] = value
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLE")
