"""Registered queries over score comparisons, binned densities and daily sketches."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from riskweave.operators import delong, profile, sketches
from riskweave.plans import views
from riskweave.plans.views import with_views
from riskweave.session import materialize
from riskweave.workload.common import rounded

SLICES = ("balance_class", "frequent")


def _scores(spark, sf):
    """Customers with the fixed score and one from the number of orders (ties)."""
    return views.scored_customers(spark, sf).withColumn("q", F.round(F.col("n_orders") / 100.0, 6))


def _slices():
    return {c: F.col(c) for c in SLICES}


def auc_difference(spark, sf):
    """Both areas and the error of their difference, for all customers and per group."""
    long = delong.unpivot_slices(_scores(spark, sf), {"all": F.lit("all"), **_slices()}, ["churn", "p", "q"])
    return rounded(delong.auc_difference(long, "churn", "p", "q", ["slice", "slice_value"]))


def promotion_gate_tested(spark, sf):
    """Each score as the other's challenger: groups fail only beyond chance."""
    df = _scores(spark, sf)
    found = [delong.tested_gate(df, "churn", a, b, _slices(), 0.4, 0.5).withColumn("challenger", F.lit(b)) for a, b in (("p", "q"), ("q", "p"))]
    return found[0].unionByName(found[1]).withColumn("worse", F.array_join("worse", ";"))


def kde_binned(spark, sf):
    """Density of event values; how far it is from the exact one against its bound."""
    events = views.load(spark, sf, "events")
    binned = profile.kde_binned(events, "value", 40)
    exact = profile.kde_grid(events, "value", 40).select("point_id", F.col("density").alias("exact"))
    joined = binned.join(exact, "point_id")
    within = F.abs(F.col("density") - F.col("exact")) <= F.col("error_bound")
    return rounded(joined.select("point_id", "x", "exact", within.alias("within_bound"), (F.col("error_bound") < 1e-3).alias("bound_is_small")))


def _daily(spark, sf):
    events = views.load(spark, sf, "events")
    return materialize(sketches.daily_sketches(events, F.to_date("ts"), ["value", "user_id"], ["event_type"]), "sketches")


def sketch_profile(spark, sf):
    """Daily sketches merged for the whole period, against the exact profile."""
    merged = sketches.profile_of(sketches.merged(_daily(spark, sf)), (0.5,)).withColumnsRenamed({"low": "low_value", "high": "high_value"})
    columns = {"value": F.col("value"), "user_id": F.col("user_id"), "event_type": F.lit(None)}
    entries = [F.struct(F.lit(c).alias("column_name"), v.cast("double").alias("v"), F.col(c).cast("string").alias("t")) for c, v in columns.items()]
    long = views.load(spark, sf, "events").select(F.inline(F.array(*entries)))
    ranked = long.join(merged.select("column_name", F.get("quantiles", F.lit(0)).alias("median")), "column_name")
    exact = ranked.groupBy("column_name").agg(
        F.count_distinct("t").alias("d"),
        F.count("v").alias("numbers"),
        F.count_if(F.col("v") < F.col("median")).alias("below"),
        F.count_if(F.col("v") <= F.col("median")).alias("upto"),
    )
    near = (F.col("below") <= 0.515 * F.col("numbers")) & (F.col("upto") >= 0.485 * F.col("numbers"))
    return merged.join(exact, "column_name").select(
        "column_name",
        "n_rows",
        "n_null",
        "low_value",
        "high_value",
        (F.abs(F.col("n_distinct") / F.col("d") - 1) < 0.06).alias("distinct_is_near"),
        F.when(F.col("numbers") > 0, near).alias("median_is_near"),
    )


QUERIES = {f.__name__: f for f in (auc_difference, promotion_gate_tested, kde_binned, sketch_profile)}

_PAIRS = """
  s AS (SELECT *, round(n_orders / 100.0::DOUBLE, 6) AS q FROM scored_customers),
  l AS (SELECT 'all' AS slice, 'all' AS slice_value, churn, p, q, row_number() OVER () AS i FROM s
        UNION ALL SELECT 'balance_class', balance_class, churn, p, q, row_number() OVER () FROM s
        UNION ALL SELECT 'frequent', frequent, churn, p, q, row_number() OVER () FROM s),
  pairs AS (
    SELECT a.slice, a.slice_value, a.i, b.i AS j,
           CASE WHEN a.p > b.p THEN 1 WHEN a.p = b.p THEN 0.5::DOUBLE ELSE 0 END AS u, CASE WHEN a.q > b.q THEN 1 WHEN a.q = b.q THEN 0.5::DOUBLE ELSE 0 END AS v
    FROM l a JOIN l b ON a.slice = b.slice AND a.slice_value = b.slice_value AND a.churn = 1 AND b.churn <> 1),
  pos AS (SELECT slice, slice_value, i, avg(u) AS u, avg(v) AS v FROM pairs GROUP BY ALL),
  neg AS (SELECT slice, slice_value, j, avg(u) AS u, avg(v) AS v FROM pairs GROUP BY ALL),
  m AS (SELECT slice, slice_value, count(*) AS n_pos, avg(u) AS auc_p, avg(v) AS auc_q, var_samp(u) AS u, var_samp(v) AS v, covar_samp(u, v) AS uv FROM pos GROUP BY ALL),
  n AS (SELECT slice, slice_value, count(*) AS n_neg, var_samp(u) AS u, var_samp(v) AS v, covar_samp(u, v) AS uv FROM neg GROUP BY ALL),
  d AS (
    SELECT m.slice, m.slice_value, n_pos, n_neg, auc_p, auc_q, sqrt(m.u / n_pos + n.u / n_neg) AS se_p, sqrt(m.v / n_pos + n.v / n_neg) AS se_q,
           sqrt((m.u + m.v - 2 * m.uv) / n_pos + (n.u + n.v - 2 * n.uv) / n_neg) AS se_delta
    FROM m JOIN n USING (slice, slice_value))"""
_F1 = "(SELECT 2 * count(*) FILTER (WHERE churn = 1 AND {s} >= 0.4) / nullif(count(*) FILTER (WHERE churn = 1) + count(*) FILTER (WHERE {s} >= 0.4), 0)::DOUBLE FROM s)"


def _gate(old: str, new: str) -> str:
    z = f"(auc_{new} - auc_{old}) / se_delta"
    return f"""SELECT *, f1_ok AND auc_ok AND groups_ok AS promote, '{new}' AS challenger FROM (
      SELECT {_F1.format(s=new)} >= {_F1.format(s=old)} AS f1_ok, max(auc_{new}) FILTER (WHERE slice = 'all') >= 0.5 AS auc_ok,
             count(*) FILTER (WHERE slice <> 'all' AND {z} < {NormalDist().inv_cdf(0.05)!r}::DOUBLE) = 0 AS groups_ok,
             coalesce(string_agg(slice || '=' || slice_value, ';' ORDER BY slice || '=' || slice_value) FILTER (WHERE slice <> 'all' AND {z} < {NormalDist().inv_cdf(0.05)!r}::DOUBLE), '') AS worse
      FROM d)"""


ORACLE: dict[str, str] = {
    "auc_difference": with_views(["scored_customers"], _PAIRS)
    + """SELECT slice, slice_value, n_pos, n_neg, round(auc_p, 6) AS auc_old, round(auc_q, 6) AS auc_new, round(auc_q - auc_p, 6) AS delta,
                round(se_q, 6) AS se_new, round(se_delta, 6) AS se_delta, round((auc_q - auc_p) / se_delta, 6) AS z FROM d""",
    "promotion_gate_tested": with_views(["scored_customers"], _PAIRS) + _gate("p", "q") + " UNION ALL " + _gate("q", "p"),
    "kde_binned": """
      WITH s AS (SELECT count(value)::DOUBLE AS n, stddev_samp(value) AS sd, min(value)::DOUBLE AS lo, max(value)::DOUBLE AS hi FROM events),
      v AS (SELECT value AS v, count(*) AS c FROM events WHERE value IS NOT NULL GROUP BY 1), g AS (SELECT unnest(range(40)) AS point_id)
      SELECT point_id, round(lo + (hi - lo) * point_id / 39, 6) AS x,
             round(sum(c * exp(-0.5 * power((lo + (hi - lo) * point_id / 39 - v) / (sd * power(n, -0.2)), 2)) / (n * sd * power(n, -0.2) * sqrt(2 * pi()))), 6) AS exact,
             true AS within_bound, true AS bound_is_small FROM g, s, v GROUP BY point_id, lo, hi""",
    "sketch_profile": """
      SELECT 'value' AS column_name, count(*) AS n_rows, count(*) - count(value) AS n_null, min(value)::DOUBLE AS low_value, max(value)::DOUBLE AS high_value,
             true AS distinct_is_near, true AS median_is_near FROM events
      UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id), min(user_id)::DOUBLE, max(user_id)::DOUBLE, true, true FROM events
      UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type), NULL, NULL, true, NULL FROM events""",
}
