"""Registered profile queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import profile
from riskweave.plans import views
from riskweave.plans.views import with_views
from riskweave.workload.common import rounded

CORR = ["n_orders", "total_spend", "tenure_days", "recency_days", "n_priorities"]
BAND_EDGES = [0, 500, 1000, 1500, 2000, 2500]
BAND_LABELS = ["to 500", "501-1000", "1001-1500", "1501-2000", "2001+"]
BALANCE_EDGES = [-2000, -1500, 2500, 5000, 7500, 10000]
BALANCE_LABELS = ["deep red", "low", "mid", "upper", "top"]
RANGES = {"n_orders": (2, 15), "tenure_days": (200, 2035), "recency_days": (1, 900)}


def customers(spark, sf):
    return views.customer_features(spark, sf)


def null_profile(spark, sf):
    return rounded(profile.null_profile(views.customer_nulls(spark, sf)))


def range_check(spark, sf):
    return profile.range_check(customers(spark, sf), RANGES)


def table_profile(spark, sf):
    return profile.table_profile(views.customer_nulls(spark, sf))


def value_counts(spark, sf):
    return profile.value_counts(customers(spark, sf), "churn")


def label_shares(spark, sf):
    return rounded(profile.value_shares(views.load(spark, sf, "labels"), "quality"))


def churn_by_services(spark, sf):
    return rounded(profile.group_rate(customers(spark, sf), ["n_orders"], "churn"))


def churn_by_age_band(spark, sf):
    return rounded(profile.rate_by_band(customers(spark, sf), "tenure_days", "churn", BAND_EDGES, BAND_LABELS))


def churn_by_balance_band(spark, sf):
    return rounded(profile.rate_by_band(customers(spark, sf), "c_acctbal", "churn", BALANCE_EDGES, BALANCE_LABELS))


def churn_by_category(spark, sf):
    return rounded(profile.rate_by_category(customers(spark, sf), views.TEXT, "churn", high=0.22))


def segment_profile(spark, sf):
    age = F.when(F.col("tenure_days") <= 1000, "new").when(F.col("tenure_days") <= 1800, "known").otherwise("old")
    segments = {"balance_class": F.col("balance_class"), "tenure": age, "frequent": F.col("frequent")}
    return rounded(profile.segment_profile(customers(spark, sf), segments, "churn"))


def histogram20(spark, sf):
    return rounded(profile.histogram(customers(spark, sf), "tenure_days"))


def histogram_value(spark, sf):
    return rounded(profile.histogram(views.load(spark, sf, "lineitem"), "l_extendedprice"), 4)


def box_stats(spark, sf):
    return rounded(profile.box_stats(customers(spark, sf), "tenure_days", "churn"))


def corr_matrix(spark, sf):
    return rounded(profile.corr_matrix(customers(spark, sf), CORR))


def corr_with_target(spark, sf):
    return rounded(profile.corr_with_target(customers(spark, sf), CORR, "churn"))


def distinct_profile(spark, sf):
    return profile.distinct_profile(customers(spark, sf), views.NUMERIC + views.TEXT)


def histogram_nan(spark, sf):
    """NaN values count as null: they neither spoil the edges nor a bin."""
    df = views.load(spark, sf, "lineitem")
    return rounded(profile.histogram(df.select(F.when(F.col("l_linenumber") == 1, F.lit(float("nan"))).otherwise(F.col("l_extendedprice")).alias("v")), "v"), 4)


def kde_grid(spark, sf):
    return rounded(profile.kde_grid(customers(spark, sf), "n_orders", 50))


def class_weights(spark, sf):
    return rounded(profile.class_weights(customers(spark, sf), "churn"))


def outlier_counts(spark, sf):
    return rounded(profile.outlier_counts(views.load(spark, sf, "events"), ["value"]), 4)


def outlier_counts_customers(spark, sf):
    return rounded(profile.outlier_counts(customers(spark, sf), views.NUMERIC), 4)


QUERIES = {
    f.__name__: f
    for f in (
        null_profile, range_check, table_profile, value_counts, label_shares, churn_by_services, churn_by_age_band,
        churn_by_balance_band, churn_by_category, segment_profile, histogram20, histogram_value, histogram_nan, box_stats,
        corr_matrix, corr_with_target, distinct_profile, kde_grid, class_weights, outlier_counts,
        outlier_counts_customers,
    )
}

_CF = with_views(["customer_features"])
_NULL_COLUMNS = ["c_custkey", "c_acctbal", *views.NUMERIC, *views.TEXT, "churn"]


def _band_sql(value: str, edges: list, labels: list) -> str:
    cases = " ".join(f"WHEN {value} <= {hi} THEN '{lab}'" for hi, lab in zip(edges[1:], labels))
    listed = ", ".join(f"({i}, '{lab}')" for i, lab in enumerate(labels))
    return (
        f"SELECT b.band_id, b.band, coalesce(r.n, 0) AS n, r.churn_rate FROM (VALUES {listed}) b(band_id, band) LEFT JOIN "
        f"(SELECT CASE WHEN {value} <= {edges[0]} THEN NULL {cases} END AS band, count(*) AS n, round(avg(churn), 6) AS churn_rate "
        "FROM customer_features GROUP BY 1) r ON r.band = b.band"
    )


def _hist_sql(source: str, column: str, digits: int) -> str:
    return (
        f"(SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {source}) "
        f"SELECT g.bin_id, round(m.lo + (m.hi - m.lo) / 20 * g.bin_id, {digits}) AS bin_low, "
        f"round(m.lo + (m.hi - m.lo) / 20 * (g.bin_id + 1), {digits}) AS bin_high, coalesce(c.n, 0) AS n "
        f"FROM m CROSS JOIN (SELECT unnest(range(20)) AS bin_id) g LEFT JOIN "
        f"(SELECT CASE WHEN m.hi = m.lo THEN 0 ELSE least(19, floor(({column} - m.lo) / ((m.hi - m.lo) / 20))) END AS bin_id, "
        f"count(*) AS n FROM {source} CROSS JOIN m WHERE {column} IS NOT NULL GROUP BY 1) c ON c.bin_id = g.bin_id"
    )


_QUART = "quantile_cont({c}, 0.25::DOUBLE) AS q1, quantile_cont({c}, 0.75::DOUBLE) AS q3"


def _outlier_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(max(q1 - 1.5 * (q3 - q1)), 4) AS lower_bound, "
        f"round(max(q3 + 1.5 * (q3 - q1)), 4) AS upper_bound, "
        f"count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers "
        f"FROM {source}, (SELECT {_QUART.format(c=c)} FROM {source})"
        for c in columns
    )


ORACLE = {
    "null_profile": with_views(["customer_nulls"])
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
        f"round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS null_ratio, "
        f"(count(*) - count({c})) / count(*)::DOUBLE < 0.5 AS acceptable FROM customer_nulls"
        for c in _NULL_COLUMNS
    ),
    "range_check": _CF
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n_values, count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS n_outside, "
        f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) = 0 AS in_range FROM customer_features"
        for c, (lo, hi) in RANGES.items()
    ),
    "table_profile": with_views(["customer_nulls"])
    + f"SELECT count(*) AS n_rows, {len(_NULL_COLUMNS)} AS n_columns, "
    + " + ".join(f"count(*) - count({c})" for c in _NULL_COLUMNS)
    + " AS n_missing FROM customer_nulls",
    "value_counts": _CF + "SELECT churn, count(*) AS n FROM customer_features GROUP BY churn",
    "label_shares": "SELECT quality, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share FROM labels "
    "WHERE quality IS NOT NULL GROUP BY quality",
    "churn_by_services": _CF
    + "SELECT n_orders, count(*) AS n, round(avg(churn), 6) AS churn_rate FROM customer_features GROUP BY n_orders",
    "churn_by_age_band": _CF + _band_sql("tenure_days", BAND_EDGES, BAND_LABELS),
    "churn_by_balance_band": _CF + _band_sql("c_acctbal", BALANCE_EDGES, BALANCE_LABELS),
    "churn_by_category": _CF
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n, round(avg(churn), 6) AS churn_rate, avg(churn) > 0.22 AS high_risk "
        f"FROM customer_features GROUP BY {c}"
        for c in views.TEXT
    ),
    "segment_profile": _CF
    + "SELECT segment, segment_value, count(*) AS n, round(avg(churn), 6) AS churn_rate FROM ("
    "SELECT 'balance_class' AS segment, balance_class AS segment_value, churn FROM customer_features UNION ALL "
    "SELECT 'tenure', CASE WHEN tenure_days <= 1000 THEN 'new' WHEN tenure_days <= 1800 THEN 'known' ELSE 'old' END, churn "
    "FROM customer_features UNION ALL SELECT 'frequent', frequent, churn FROM customer_features) GROUP BY 1, 2",
    "histogram20": with_views(["customer_features"]).rstrip() + ", m AS " + _hist_sql("customer_features", "tenure_days", 6),
    "histogram_value": "WITH m AS " + _hist_sql("lineitem", "l_extendedprice", 4),
    "histogram_nan": "WITH h AS (SELECT CASE WHEN l_linenumber <> 1 THEN l_extendedprice END AS v FROM lineitem), m AS " + _hist_sql("h", "v", 4),
    "box_stats": _CF
    + "SELECT c.churn, count(*) AS n, max(q1) AS q1, max(med) AS median, max(q3) AS q3, "
    "min(tenure_days) FILTER (WHERE tenure_days >= q1 - 1.5 * (q3 - q1) AND tenure_days <= q3 + 1.5 * (q3 - q1))::DOUBLE AS whisker_low, "
    "max(tenure_days) FILTER (WHERE tenure_days >= q1 - 1.5 * (q3 - q1) AND tenure_days <= q3 + 1.5 * (q3 - q1))::DOUBLE AS whisker_high, "
    "count(*) FILTER (WHERE NOT (tenure_days >= q1 - 1.5 * (q3 - q1) AND tenure_days <= q3 + 1.5 * (q3 - q1))) AS n_outliers "
    "FROM customer_features c JOIN (SELECT churn, "
    + _QUART.format(c="tenure_days")
    + ", quantile_cont(tenure_days, 0.5::DOUBLE) AS med FROM customer_features GROUP BY churn) q ON q.churn = c.churn GROUP BY c.churn",
    "corr_matrix": _CF
    + " UNION ALL ".join(
        [
            f"SELECT '{a}' AS left_col, '{b}' AS right_col, round(corr({a}, {b}), 6) AS corr FROM customer_features"
            for i, a in enumerate(CORR)
            for b in CORR[i + 1 :]
        ]
        + [f"SELECT '{c}', '{c}', 1.0::DOUBLE" for c in CORR]
    ),
    "corr_with_target": _CF
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr({c}, churn), 6) AS corr, round(abs(corr({c}, churn)), 6) AS abs_corr FROM customer_features"
        for c in CORR
    ),
    "distinct_profile": _CF
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM customer_features"
        for c in views.NUMERIC + views.TEXT
    ),
    "kde_grid": with_views(
        ["customer_features"],
        """s AS (SELECT count(n_orders)::DOUBLE AS n, stddev_samp(n_orders) AS sd, min(n_orders)::DOUBLE AS lo,
                 max(n_orders)::DOUBLE AS hi FROM customer_features),
           v AS (SELECT n_orders AS v, count(*) AS c FROM customer_features GROUP BY 1),
           g AS (SELECT unnest(range(50)) AS point_id)""",
    )
    + "SELECT point_id, round(lo + (hi - lo) * point_id / 49, 6) AS x, round(sum(c * exp(-0.5 * power((lo + (hi - lo) * point_id / 49 - v) "
    "/ (sd * power(n, -0.2)), 2)) / (n * sd * power(n, -0.2) * sqrt(2 * pi()))), 6) AS density FROM g, s, v GROUP BY point_id, lo, hi",
    "class_weights": _CF
    + "SELECT churn, n, round(sum(n) OVER ()::DOUBLE / (count(*) OVER () * n), 6) AS class_weight, "
    "round(first_value(n) OVER (ORDER BY churn)::DOUBLE / n, 6) AS ratio_to_first "
    "FROM (SELECT churn, count(*) AS n FROM customer_features GROUP BY churn)",
    "outlier_counts": _outlier_sql("events", ["value"]),
    "outlier_counts_customers": _CF + _outlier_sql("customer_features", views.NUMERIC),
}
