"""Runs, model versions and aliases as append-only tables.

``runs``     run_id, experiment, run_name, status, start_time, threshold, tags
``metrics``  run_id, metric, value
``params``   run_id, param, value
``versions`` name, version, run_id, created, package_path
``aliases``  name, alias, version, set_at        (events, newest wins)
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

SCHEMAS = {
    "runs": "run_id string, experiment string, run_name string, status string, start_time bigint, "
    "threshold double, pipeline string, best boolean",
    "metrics": "run_id string, metric string, value double",
    "params": "run_id string, param string, value string",
    "versions": "name string, version int, run_id string, created bigint, package_path string",
    "aliases": "name string, alias string, version int, set_at bigint",
}
METRIC_NAMES = ("accuracy", "f1_score", "roc_auc", "precision", "recall")
CHAMPION = "champion"


class Registry:
    """A folder with the five tables."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """The table, or an empty one of its schema before the first append."""
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{name}")

    def _append_rows(self, name: str, rows: list[tuple]) -> None:
        if rows:
            self.append(name, self.spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1))

    def log_results(
        self,
        results: list[dict],
        best: str,
        experiment: str,
        thresholds: Mapping[str, float] | None = None,
        params: Mapping[str, object] | None = None,
        model_name: str | None = None,
        package_path: str | None = None,
    ) -> dict:
        """One run per model; the best one becomes a new version and champion.

        ``results`` is the model comparison, one entry per trained model.
        """
        now = int(time.time() * 1000)
        runs, metrics, settings, run_ids, best_run = [], [], [], [], None
        for i, r in enumerate(results):
            run_id = uuid.uuid4().hex
            run_ids.append(run_id)
            is_best = r["model_name"] == best
            best_run = run_id if is_best else best_run
            threshold = round(float((thresholds or {}).get(r["model_name"], 0.5)), 3)
            runs.append((run_id, experiment, r["model_name"], "FINISHED", now + i, threshold, "improved", is_best))
            metrics += [(run_id, m, float(r[m])) for m in METRIC_NAMES if isinstance(r.get(m), (int, float))]
            settings += [(run_id, k, str(v)) for k, v in (params or {}).items()]
        self._append_rows("runs", runs)
        self._append_rows("metrics", metrics)
        self._append_rows("params", settings)
        version = self.register(model_name, best_run, package_path) if model_name and best_run else None
        return {"run_ids": run_ids, "best_run_id": best_run, "model_version": version}

    def register(self, name: str, run_id: str, package_path: str | None = None) -> int:
        """Next version of ``name``; the champion alias moves to it."""
        last = self.table("versions").filter(F.col("name") == name).agg(F.max("version")).first()[0]
        version, now = (last or 0) + 1, int(time.time() * 1000)
        self._append_rows("versions", [(name, version, run_id, now, package_path)])
        self.set_alias(name, CHAMPION, version)
        return version

    def set_alias(self, name: str, alias: str, version: int) -> None:
        self._append_rows("aliases", [(name, alias, version, int(time.time() * 1000))])

    def champion(self, name: str) -> DataFrame:
        """The champion's row: version, run and package path."""
        return registry_view(self.table("versions"), self.table("aliases")).filter(
            (F.col("name") == name) & F.array_contains("aliases", CHAMPION)
        )


def latest_runs(runs: DataFrame, per: str = "experiment", start: str = "start_time", tie: str = "run_id", k: int = 5) -> DataFrame:
    """The ``k`` newest rows per experiment. Spark limits each group before the
    shuffle, so an experiment with very many runs stays cheap."""
    rank = F.row_number().over(Window.partitionBy(per).orderBy(F.col(start).desc(), F.col(tie)))
    return runs.withColumn("run_rank", rank).filter(F.col("run_rank") <= k)


def with_metrics(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Attach a run's metrics (rounded to 4) as a map and shorten its id."""
    packed = metrics.groupBy("run_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", F.round("value", 4).alias("value"))))).alias("metrics")
    )
    return runs.join(packed, "run_id", "left").withColumn("run_id", F.substring("run_id", 1, 8))


def current_aliases(alias_events: DataFrame) -> DataFrame:
    return alias_events.groupBy("name", "alias").agg(
        F.max_by("version", F.struct("set_at", "version")).alias("version")
    )


def registry_view(versions: DataFrame, alias_events: DataFrame) -> DataFrame:
    """Versions with the aliases that point at them now."""
    pointing = current_aliases(alias_events).groupBy("name", "version").agg(
        F.array_sort(F.collect_list("alias")).alias("aliases")
    )
    return versions.join(pointing, ["name", "version"], "left").withColumn(
        "aliases", F.coalesce("aliases", F.array().cast("array<string>"))
    )


def status_counts(runs: DataFrame, versions: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: experiments, registered models and whether drift was flagged."""
    experiments = runs.select("experiment").distinct().agg(F.count(F.lit(1))).scalar()
    models = versions.select("name").distinct().agg(F.count(F.lit(1))).scalar()
    return alerts.agg(F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("drift_detected")).select(
        experiments.alias("experiments_count"), models.alias("models_registered"), "drift_detected"
    )
