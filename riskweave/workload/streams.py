"""Registered streaming queries: the stream runs to its end, its table is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.plans import views
from riskweave.plans.views import with_views
from riskweave.session import new_path
from riskweave.streaming import jobs
from riskweave.workload.common import rounded

CATEGORICAL = ["event_type"]


def _event_stream(spark, sf):
    schema = views.load(spark, sf, "events").schema
    return jobs.read_parquet_stream(spark, f"{sf}/events.parquet*", schema)


def _score(df):
    """Risk of an event from its own columns."""
    from riskweave.plans.scoring import LinearScorer, decide

    scorer = LinearScorer({"value": 0.05, "is_error": 1.0}, -1.5)
    ready = df.select("event_id", "value", (F.col("event_type") == "error").cast("int").alias("is_error"))
    scored = decide(ready.withColumn("probability", scorer.probability()), 0.5)
    return scored.select("event_id", F.round("probability", 6).alias("probability"), "prediction", "risk_level")


def stream_score(spark, sf):
    path = new_path(spark, "scores")
    jobs.score_stream(_event_stream(spark, sf), _score, path, new_path(spark, "progress"))
    return spark.read.parquet(path)


def _edges(spark, sf):
    reference = views.event_periods(spark, sf).filter("is_ref")
    return jobs.reference_edges(reference, ["value"])


def daily_feature_counts(spark, sf):
    path = new_path(spark, "daily")
    long = jobs.long_features(_event_stream(spark, sf), "ts", CATEGORICAL, _edges(spark, sf))
    jobs.daily_counts_stream(long, path, new_path(spark, "progress"))
    return jobs.daily_counts(spark, path)


def _shares(spark, sf, edges):
    reference = views.event_periods(spark, sf).filter("is_ref")
    return jobs.reference_shares(jobs.long_features(reference, "ts", CATEGORICAL, edges))


def daily_psi(spark, sf):
    """Drift per day, computed while the stream runs."""
    edges = _edges(spark, sf)
    long = jobs.long_features(_event_stream(spark, sf), "ts", CATEGORICAL, edges)
    out = new_path(spark, "drift")
    jobs.daily_drift_stream(long, _shares(spark, sf, edges), new_path(spark, "daily"), out, new_path(spark, "progress"))
    return rounded(jobs.newest_drift(spark, out))


def daily_psi_batch(spark, sf):
    edges = _edges(spark, sf)
    counts = jobs.daily_counts_batch(jobs.long_features(views.load(spark, sf, "events"), "ts", CATEGORICAL, edges))
    return rounded(jobs.daily_drift(counts, _shares(spark, sf, edges)))


QUERIES = {f.__name__: f for f in (stream_score, daily_feature_counts, daily_psi, daily_psi_batch)}

_P = "1 / (1 + exp(-(-1.5::DOUBLE + 0.05::DOUBLE * value + 1.0::DOUBLE * CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)))"
_LONG = """
  pts AS (SELECT list_distinct(quantile_cont(value, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0])) AS p FROM event_periods WHERE is_ref),
  edg AS (SELECT list_filter(p, lambda x: x > list_min(p) AND x < list_max(p)) AS e FROM pts),
  longf AS (SELECT strftime(ts, '%Y-%m-%d') AS day, is_ref, 'event_type' AS feature, event_type AS value FROM event_periods
            UNION ALL SELECT strftime(ts, '%Y-%m-%d'), is_ref, 'value', CAST(len(list_filter(e, lambda x: x <= value)) AS VARCHAR)
            FROM event_periods, edg WHERE value IS NOT NULL),
  daily AS (SELECT day, feature, value, count(*) AS n FROM longf GROUP BY 1, 2, 3)"""
_DRIFT = """
  refs AS (SELECT feature, value, count(*) / sum(count(*)) OVER (PARTITION BY feature)::DOUBLE AS r FROM longf WHERE is_ref GROUP BY 1, 2),
  days AS (SELECT day, feature, sum(n) AS t FROM daily GROUP BY 1, 2),
  vals AS (SELECT feature, value FROM daily UNION SELECT feature, value FROM refs),
  cells AS (SELECT d.day, d.feature, d.t, coalesce(c.n, 0) / d.t::DOUBLE AS cs, coalesce(r.r, 0) AS rs
            FROM days d JOIN vals v USING (feature) LEFT JOIN daily c ON c.day = d.day AND c.feature = d.feature AND c.value = v.value
            LEFT JOIN refs r ON r.feature = v.feature AND r.value = v.value
            WHERE c.n IS NOT NULL OR r.r IS NOT NULL),
  psis AS (SELECT day, feature, max(t)::BIGINT AS n, sum((greatest(cs, 0.0001::DOUBLE) - greatest(rs, 0.0001::DOUBLE)) *
             ln(greatest(cs, 0.0001::DOUBLE) / greatest(rs, 0.0001::DOUBLE))) AS psi, 0.5::DOUBLE * sum(abs(cs - rs)) AS tv FROM cells GROUP BY 1, 2)"""
_PSI = (
    with_views(["event_periods"], _LONG + "," + _DRIFT)
    + "SELECT day, feature, n, round(psi, 6) AS psi, round(tv, 6) AS tv_distance, "
    "CASE WHEN psi > 0.25 THEN 'significant' WHEN psi >= 0.1 THEN 'moderate' ELSE 'stable' END AS psi_level FROM psis"
)

ORACLE = {
    "stream_score": f"SELECT event_id, round(p, 6) AS probability, CASE WHEN p >= 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction, "
    f"CASE WHEN p < 0.3::DOUBLE THEN 'Low' WHEN p < 0.7::DOUBLE THEN 'Medium' ELSE 'High' END AS risk_level FROM (SELECT event_id, {_P} AS p FROM events)",
    "daily_feature_counts": with_views(["event_periods"], _LONG) + "SELECT day, feature, value, n FROM daily",
    "daily_psi": _PSI,
    "daily_psi_batch": _PSI,
}
