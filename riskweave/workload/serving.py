"""Registered scoring, explanation, neighbour and registry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions.labels import readable_factor
from riskweave.operators import explain, neighbors, registry
from riskweave.plans import scoring, views
from riskweave.plans.views import with_views
from riskweave.session import new_path
from riskweave.workload.common import rounded
from riskweave.workload.quality import RESULTS_SQL, scored_sql

WEIGHTS = {
    "Age": -0.0005,
    "FrequentFlyer": 1.1,
    "AnnualIncomeClass": 0.4,
    "ServicesOpted": -0.2,
    "AccountSyncedToSocialMedia": 0.3,
    "BookedHotelOrNot": -0.6,
}
INTERCEPT = -0.25
THRESHOLD = 0.41
SCORER = scoring.LinearScorer(WEIGHTS, INTERCEPT)


def _requests(spark, sf):
    """Customers in the field names of a scoring request."""
    return views.customer_table(spark, sf).select(
        "c_custkey",
        F.col("Age").alias("age"),
        F.col("FrequentFlyer").alias("frequent_flyer"),
        F.col("AnnualIncomeClass").alias("annual_income_class"),
        F.col("ServicesOpted").alias("services_opted"),
        F.col("AccountSyncedToSocialMedia").alias("account_synced_to_social_media"),
        F.col("BookedHotelOrNot").alias("booked_hotel_or_not"),
    )


def _scored(spark, sf):
    encoded = scoring.encode_requests(_requests(spark, sf))
    return rounded(scoring.score_linear(encoded, SCORER, THRESHOLD))


def batch_score(spark, sf):
    return _scored(spark, sf).select("c_custkey", "probability", "prediction", "risk_level")


def risk_recommendation(spark, sf):
    df = scoring.with_recommendation(_scored(spark, sf))
    return df.select("c_custkey", "risk_level", "description", "recommendation")


def top_factors(spark, sf):
    df = views.customer_codes(spark, sf)
    means = explain.fit_means(df, list(WEIGHTS))
    ranked = explain.rank_contributions(df, ["c_custkey"], explain.linear_contributions(WEIGHTS, means), 3)
    return ranked.select("c_custkey", "rank", "feature", F.round("contribution", 3).alias("contribution"), "direction")


def top_factors_named(spark, sf):
    """The factors under their readable names."""
    return top_factors(spark, sf).withColumn("feature", readable_factor(F.col("feature"), {}))


def encoding_parity(spark, sf):
    """Rows that the serving path encodes differently from the training table."""
    served = scoring.encode_requests(_requests(spark, sf)).select("c_custkey", *WEIGHTS)
    trained = views.customer_codes(spark, sf).select("c_custkey", *WEIGHTS)
    lost = trained.exceptAll(served).agg(F.count(F.lit(1)).alias("n_missing"))
    extra = served.exceptAll(trained).agg(F.count(F.lit(1))).scalar()
    return lost.select("n_missing", extra.alias("n_extra"))


def knn_neighbours(spark, sf):
    e = views.load(spark, sf, "embeddings")
    found = neighbors.nearest(e, e, "vec_id", "embedding", 5, "label", exclude_same_key=True)
    return rounded(found.select("query_key", "train_key", "distance", "rank"), 5)


def knn_classify(spark, sf):
    e = views.load(spark, sf, "embeddings")
    found = neighbors.nearest(e, e, "vec_id", "embedding", 5, "label", exclude_same_key=True)
    return neighbors.classify(found, "label")


def latest_runs(spark, sf):
    """Orders as runs: the five newest per customer."""
    runs = views.load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.round("o_totalprice", 4).alias("price"))
    top = registry.latest_runs(runs, "o_custkey", "o_orderdate", "o_orderkey", 5)
    return top.select("o_custkey", "o_orderkey", "price", "run_rank")


def _versions(spark, sf):
    o = views.load(spark, sf, "orders")
    name = F.concat(F.lit("model "), F.col("o_custkey").cast("string"))
    versions = o.select(name.alias("name"), F.col("o_orderkey").cast("int").alias("version"))
    alias = F.when(F.col("o_orderstatus") == "F", "champion").when(F.col("o_orderstatus") == "P", "candidate")
    events = o.select(
        name.alias("name"),
        alias.alias("alias"),
        F.col("o_orderkey").cast("int").alias("version"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("set_at"),
    ).filter("alias is not null")
    return versions, events


def registry_view(spark, sf):
    return registry.registry_view(*_versions(spark, sf)).select("name", "version", F.array_join("aliases", ",").alias("aliases"))


def status_counts(spark, sf):
    versions, _ = _versions(spark, sf)
    runs = views.load(spark, sf, "orders").select(F.col("o_orderpriority").alias("experiment"))
    alerts = views.load(spark, sf, "events").select((F.col("event_type") == "error").alias("drift_detected"))
    return registry.status_counts(runs, versions, alerts)


def run_log(spark, sf):
    """Two training rounds logged, then runs with metrics, version and aliases."""
    from riskweave.workload.quality import _results

    results = [r.asDict() for r in _results(spark, sf).orderBy("model_name").collect()]
    store = registry.Registry(spark, new_path(spark, "registry"))
    ranked = sorted(results, key=lambda r: (-r["f1_score"], r["model_name"]))
    for best in (ranked[1], ranked[0]):
        store.log_results(results, best["model_name"], "churn", {best["model_name"]: THRESHOLD}, {"n": len(results)}, "churn model")
    runs = registry.with_metrics(store.table("runs"), store.table("metrics"))
    versions = registry.registry_view(store.table("versions"), store.table("aliases"))
    named = runs.join(versions.select(F.substring("run_id", 1, 8).alias("run_id"), "version", "aliases"), "run_id", "left")
    return named.select(
        "run_name",
        "best",
        "threshold",
        "version",
        F.array_join("aliases", ",").alias("aliases"),
        F.col("metrics")["f1_score"].alias("f1_score"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        batch_score, risk_recommendation, top_factors, encoding_parity, knn_neighbours, knn_classify, latest_runs,
        registry_view, status_counts, run_log, top_factors_named,
    )
}

_Z = f"{INTERCEPT}::DOUBLE + " + " + ".join(f'({w}::DOUBLE) * "{c}"' for c, w in WEIGHTS.items())
_SC = f"""sc AS (SELECT c_custkey, round(1 / (1 + exp(-({_Z}))), 6) AS probability FROM customer_codes),
          sd AS (SELECT *, CASE WHEN 1 / (1 + exp(-z)) >= {THRESHOLD}::DOUBLE THEN 1 ELSE 0 END AS prediction,
                        CASE WHEN 1 / (1 + exp(-z)) < 0.3::DOUBLE THEN 'Low' WHEN 1 / (1 + exp(-z)) < 0.7::DOUBLE THEN 'Medium' ELSE 'High' END AS risk_level
                 FROM (SELECT c_custkey, {_Z} AS z FROM customer_codes))"""
_CC = with_views(["customer_codes"], _SC)
_FACTORS = " UNION ALL ".join(
    f"SELECT c_custkey, {i} AS pos, '{c}' AS feature, ({w}::DOUBLE) * (\"{c}\" - (SELECT avg(\"{c}\") FROM customer_codes)) AS v FROM customer_codes"
    for i, (c, w) in enumerate(WEIGHTS.items())
)
_NEAR = """near AS (SELECT q.vec_id AS query_key, t.vec_id AS train_key, t.label,
              sqrt(list_sum(list_transform(list_zip(q.embedding, t.embedding), lambda z: power(z[1]::DOUBLE - z[2]::DOUBLE, 2)))) AS distance
            FROM embeddings q JOIN embeddings t ON q.vec_id <> t.vec_id),
          knn AS (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY distance, train_key) AS rank FROM near QUALIFY rank <= 5)"""

ORACLE = {
    "batch_score": _CC + "SELECT c_custkey, probability, prediction, risk_level FROM sc JOIN sd USING (c_custkey)",
    "risk_recommendation": _CC
    + """SELECT c_custkey, risk_level, CASE risk_level WHEN 'Low' THEN 'Very likely to stay' WHEN 'Medium' THEN 'May leave but can be retained'
           ELSE 'High risk of loss' END AS description, CASE risk_level WHEN 'Low' THEN 'Loyal customer: offer the loyalty programme.'
           WHEN 'Medium' THEN 'May leave: personal offer with 10-15% discount and a manager call.'
           ELSE 'Likely to leave: urgent 20-30% discount and a personal manager.' END AS recommendation FROM sd""",
    "top_factors": with_views(["customer_codes"], f"f AS ({_FACTORS})")
    + """SELECT c_custkey, rank, feature, round(round(v, 4), 3) AS contribution, CASE WHEN v > 0 THEN 'raises risk' ELSE 'retains' END AS direction
         FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(v) DESC, pos) AS rank FROM f) WHERE rank <= 3""",
    "top_factors_named": with_views(["customer_codes"], f"f AS ({_FACTORS})")
    + """SELECT c_custkey, rank, CASE feature WHEN 'Age' THEN 'age' WHEN 'FrequentFlyer' THEN 'frequent flyer' WHEN 'AnnualIncomeClass' THEN 'income class'
           WHEN 'ServicesOpted' THEN 'number of services' WHEN 'AccountSyncedToSocialMedia' THEN 'synced to social media'
           WHEN 'BookedHotelOrNot' THEN 'booked a hotel' ELSE feature END AS feature,
           round(round(v, 4), 3) AS contribution, CASE WHEN v > 0 THEN 'raises risk' ELSE 'retains' END AS direction
         FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(v) DESC, pos) AS rank FROM f) WHERE rank <= 3""",
    "run_log": scored_sql(
        RESULTS_SQL + ", ranked AS (SELECT model_name, f1_score, row_number() OVER (ORDER BY f1_score DESC, model_name) AS place FROM res), "
        "rounds AS (SELECT *, i, place = 3 - i AS best FROM ranked, (VALUES (1), (2)) AS t(i))"
    )
    + f"""SELECT model_name AS run_name, best, CASE WHEN best THEN {THRESHOLD}::DOUBLE ELSE 0.5::DOUBLE END AS threshold, CASE WHEN best THEN i END AS version,
            CASE WHEN best THEN CASE WHEN i = 2 THEN 'champion' ELSE '' END END AS aliases, round(f1_score, 4) AS f1_score FROM rounds""",
    "encoding_parity": with_views(
        ["customer_codes"],
        """codes(col, v, code) AS (VALUES ('f', 'Yes', 1), ('i', 'Middle Income', 1), ('i', 'High Income', 2), ('s', 'Yes', 1), ('h', 'No', 1)),
           served AS (SELECT c_custkey, "Age", coalesce(f.code, 0) AS f, coalesce(i.code, 0) AS i, "ServicesOpted", coalesce(s.code, 0) AS s,
                             coalesce(h.code, 0) AS h FROM customer_table t
             LEFT JOIN codes f ON f.col = 'f' AND f.v = t."FrequentFlyer" LEFT JOIN codes i ON i.col = 'i' AND i.v = t."AnnualIncomeClass"
             LEFT JOIN codes s ON s.col = 's' AND s.v = t."AccountSyncedToSocialMedia" LEFT JOIN codes h ON h.col = 'h' AND h.v = t."BookedHotelOrNot"),
           trained AS (SELECT * EXCLUDE ("Target") FROM customer_codes)""",
    )
    + "SELECT (SELECT count(*) FROM (FROM trained EXCEPT ALL FROM served)) AS n_missing, "
    "(SELECT count(*) FROM (FROM served EXCEPT ALL FROM trained)) AS n_extra",
    "knn_neighbours": f"WITH {_NEAR} SELECT query_key, train_key, round(distance, 5) AS distance, rank FROM knn",
    "knn_classify": f"WITH {_NEAR} SELECT query_key, label AS predicted, v AS votes FROM (SELECT query_key, label, count(*) AS v, "
    "row_number() OVER (PARTITION BY query_key ORDER BY count(*) DESC, label) AS r FROM knn GROUP BY query_key, label) WHERE r = 1",
    "latest_runs": """SELECT o_custkey, o_orderkey, price, run_rank FROM (SELECT o_custkey, o_orderkey, round(o_totalprice, 4) AS price,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS run_rank FROM orders) WHERE run_rank <= 5""",
    "registry_view": """
        WITH v AS (SELECT 'model ' || o_custkey AS name, o_orderkey::INT AS version, o_orderdate AS set_at,
                          CASE o_orderstatus WHEN 'F' THEN 'champion' WHEN 'P' THEN 'candidate' END AS alias FROM orders),
             a AS (SELECT name, alias, version FROM v WHERE alias IS NOT NULL
                   QUALIFY row_number() OVER (PARTITION BY name, alias ORDER BY set_at DESC, version DESC) = 1)
        SELECT v.name, v.version, coalesce(string_agg(a.alias, ',' ORDER BY a.alias), '') AS aliases
        FROM v LEFT JOIN a ON a.name = v.name AND a.version = v.version GROUP BY v.name, v.version""",
    "status_counts": "SELECT (SELECT count(DISTINCT o_orderpriority) FROM orders) AS experiments_count, "
    "(SELECT count(DISTINCT o_custkey) FROM orders) AS models_registered, bool_or(event_type = 'error') AS drift_detected FROM events",
}
