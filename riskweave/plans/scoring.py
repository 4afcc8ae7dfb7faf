"""Batch scoring: encoded rows -> probability, class and risk band."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.encoding import CUSTOMER_CODES, map_encode
from riskweave.functions.labels import apply_threshold, recommendation_table, risk_band
from riskweave.operators.features import Interactions, align_schema
from riskweave.operators.registry import Registry
from riskweave.operators.training import VECTOR, add_score
from riskweave.sources.models import META_SCHEMA, load_package
from riskweave.sources.tables import rename

INFO_SCHEMA = (
    "model_name string, model_version int, threshold double, metrics map<string,double>, run_id string, trained_at string, n_features int"
)

# fixed values: what an absent answer counts as
REQUEST_DEFAULTS = {
    "FrequentFlyer": "No",
    "AnnualIncomeClass": "Low Income",
    "AccountSyncedToSocialMedia": "No",
    "BookedHotelOrNot": "No",
}


@dataclass(frozen=True)
class LinearScorer:
    """Logistic score as a plain column expression."""

    coefficients: Mapping[str, float]
    intercept: float = 0.0

    def probability(self) -> Column:
        z = F.lit(float(self.intercept))
        for c, w in self.coefficients.items():
            z = z + F.lit(float(w)) * F.col(c).cast("double")
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def encode_requests(df: DataFrame, codes: Mapping[str, Mapping[str, int]] = CUSTOMER_CODES) -> DataFrame:
    """Request names to table names, then the category codes of the training
    data. A field that is not in the table at all counts as its default."""
    named = rename(df)
    changes = {}
    for c, mapping in codes.items():
        source = F.col(c) if c in named.columns else F.lit(REQUEST_DEFAULTS.get(c))
        changes[c] = map_encode(source, mapping)
    return named.withColumns(changes)


def decide(df: DataFrame, threshold: float | Column) -> DataFrame:
    """Class and risk band from ``probability``."""
    return df.withColumn("prediction", apply_threshold(F.col("probability"), threshold)).withColumn(
        "risk_level", risk_band(F.col("probability"))
    )


def score_linear(df: DataFrame, scorer: LinearScorer, threshold: float = 0.5) -> DataFrame:
    return decide(df.withColumn("probability", scorer.probability()), threshold)


def score_model(
    df: DataFrame,
    model,
    feature_names: Sequence[str],
    threshold: float = 0.5,
    interactions: Interactions | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Score raw encoded rows with a fitted model or stack; columns the model
    knows but the table lacks count as 0."""
    wide = interactions.transform(df) if interactions is not None else df
    aligned = align_schema(wide, [*keep, *feature_names], on_missing="zero")
    vectors = VectorAssembler(inputCols=list(feature_names), outputCol=VECTOR, handleInvalid="error").transform(aligned)
    return decide(add_score(vectors.select(*keep, VECTOR), model, "probability").select(*keep, "probability"), threshold)


def score_champion(df: DataFrame, registry: Registry, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """Score with the package that the champion alias of ``name`` points to."""
    version = registry.champion(name).first()
    if version is None or version["package_path"] is None:
        raise ValueError(f"{name} has no champion with a package")
    model, meta = load_package(df.sparkSession, version["package_path"])
    return score_model(df, model, meta["feature_names"], meta["threshold"], meta["interactions"], keep)


def model_info(registry: Registry, name: str) -> DataFrame:
    """One row that says what the champion is: model, version, threshold,
    metrics, run, training time and number of features; none without a champion."""
    version = registry.champion(name).first()
    if version is None or version["package_path"] is None:
        return registry.spark.createDataFrame([], INFO_SCHEMA)
    meta = registry.spark.read.schema(META_SCHEMA).parquet(f"{version['package_path']}/meta")
    return meta.select(
        "model_name", F.lit(version["version"]).alias("model_version"), "threshold", "metrics", "run_id", "trained_at",
        F.size("feature_names").alias("n_features"),
    )


def with_recommendation(scored: DataFrame, language: str = "en") -> DataFrame:
    """Advice text per risk level; the lookup has three rows."""
    return scored.join(F.broadcast(recommendation_table(scored.sparkSession, language)), "risk_level", "left")
