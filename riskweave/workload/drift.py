"""Registered drift queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import drift
from riskweave.plans import views
from riskweave.plans.views import with_views
from riskweave.session import new_path
from riskweave.sources import tables
from riskweave.streaming import jobs
from riskweave.workload.common import rounded

FEATURES = ["value", "k", "event_type"]


def value_shares(spark, sf):
    return rounded(drift.value_shares(drift.category_counts(views.event_periods(spark, sf), ["event_type"])), 6)


def psi_categorical(spark, sf):
    return rounded(drift.psi_by_value(drift.category_counts(views.event_shifted(spark, sf), ["event_type"])))


def tv_distance(spark, sf):
    return rounded(drift.total_variation(drift.category_counts(views.event_shifted(spark, sf), ["event_type"])))


def _numeric_report(spark, sf, view):
    return drift.numeric_report(drift.numeric_counts(view(spark, sf), ["value", "k"]))


def _distances(spark, sf, view):
    return drift.ks_distances(drift.numeric_counts(view(spark, sf), ["value", "k"]))


def ks_statistic(spark, sf):
    return rounded(_distances(spark, sf, views.event_shifted))


def ks_pvalue_asym(spark, sf):
    df = drift.with_ks_pvalue(_distances(spark, sf, views.event_periods), "limit")
    return rounded(df.select("feature", "ks", "p_value"))


def ks_pvalue_auto(spark, sf):
    df = drift.with_ks_pvalue(_distances(spark, sf, views.event_periods), "auto")
    return rounded(df.select("feature", "n_ref", "n_cur", "ks", "p_value", "p_method"))


def psi_numeric(spark, sf):
    return rounded(_numeric_report(spark, sf, views.event_shifted).select("feature", "psi"))


def psi_level(spark, sf):
    from riskweave.functions.labels import psi_level as level

    df = _numeric_report(spark, sf, views.event_shifted).select("feature", F.round("psi", 4).alias("psi"))
    return df.withColumn("psi_level", level(F.col("psi")))


def _report(spark, sf, view=views.event_shifted):
    return drift.drift_report(view(spark, sf).select("is_ref", *FEATURES), FEATURES, p_mode="limit")


def drift_report(spark, sf):
    return _report(spark, sf)


def drift_report_stable(spark, sf):
    return _report(spark, sf, views.event_periods)


def drift_summary(spark, sf):
    return drift.drift_summary(_report(spark, sf)).select(
        "total_features",
        "drift_features",
        "max_psi",
        "reference_size",
        "current_size",
        "alert",
        "message",
        F.array_join("affected_columns", ",").alias("affected_columns"),
    )


def drift_alert(spark, sf):
    alert = drift.drift_alert(drift.drift_summary(_report(spark, sf)))
    return alert.select(
        "alert_type", "drift_detected", F.array_join("affected_columns", ",").alias("affected_columns"), "message"
    )


def retrain_trigger(spark, sf):
    return drift.retrain_trigger(_report(spark, sf))


def _fit_sides(spark, sf):
    # halves of equal size per user pair keep the totals equal for odd keys only
    df = views.event_periods(spark, sf)
    return df.select("event_type", (F.col("event_id") % 2 == 0).alias("is_ref"))


def chi_square_fit(spark, sf):
    same = drift.chi_square_fit(drift.category_counts(_fit_sides(spark, sf), ["event_type"])).withColumn(
        "feature", F.lit("equal totals")
    )
    other = drift.chi_square_fit(drift.category_counts(views.event_shifted(spark, sf), ["event_type"])).withColumn(
        "feature", F.lit("event_type")
    )
    return rounded(
        same.unionByName(other).select("feature", "chi_square", "dof", "p_value", "status", "drift_detected"), 4
    )


def chi_square_homog(spark, sf):
    df = drift.chi_square_homogeneity(drift.category_counts(views.event_periods(spark, sf), ["event_type"]))
    return rounded(df.select("feature", "chi_square", "dof", "p_value", "drift_detected"), 4)


def drift_monitor(spark, sf):
    df = drift.drift_monitor(views.event_shifted(spark, sf), [*FEATURES, "absent"], p_mode="limit")
    return rounded(df, 4)


def drift_source_gate(spark, sf):
    dataset = views.customer_features(spark, sf)
    journal = views.load(spark, sf, "events").filter("event_type = 'signup'")
    return drift.source_gate(dataset, journal)


def chi_square_many(spark, sf):
    """500 degrees of freedom: the same law as for a few."""
    df = views.event_periods(spark, sf).select("is_ref", (F.col("event_id") % 501).cast("string").alias("bucket"))
    return rounded(drift.chi_square_homogeneity(drift.category_counts(df, ["bucket"])).select("feature", "chi_square", "dof", "p_value"), 6)


def _appended(spark, sf):
    """A quiet and a shifted report appended as two batches, the second repeated."""
    history, alerts = new_path(spark, "history"), new_path(spark, "alerts")
    for batch, view in ((0, views.event_periods), (1, views.event_shifted), (1, views.event_shifted)):
        jobs.append_drift(_report(spark, sf, view), f"2024-01-0{batch + 1}", batch, history, alerts)
    return history, alerts


def drift_history_append(spark, sf):
    stored = spark.read.parquet(_appended(spark, sf)[0])
    return drift.newest_first(stored, "timestamp").select(
        "timestamp", F.col("batch_id").cast("bigint").alias("batch_id"), "total_features", "drift_features", "max_psi", "alert", "message"
    )


def alert_append(spark, sf):
    stored = spark.read.parquet(_appended(spark, sf)[1])
    return stored.select("timestamp", F.col("batch_id").cast("bigint").alias("batch_id"), "alert_type", "drift_detected", F.array_join("affected_columns", ",").alias("affected_columns"), "message")


def drift_report_live(spark, sf):
    """The report on the side that the source gate chooses: enough journal rows
    are compared with the whole data set."""
    events = views.event_periods(spark, sf)
    sides, source = drift.choose_current(events.drop("is_ref"), events.filter("event_type = 'signup'").drop("is_ref"), F.col("event_id") % 5 > 0)
    report = drift.drift_report(sides.select("is_ref", *FEATURES), FEATURES, p_mode="limit")
    return report.withColumn("source", F.lit(source))


def min_rows_gate(spark, sf):
    return drift.min_rows_gate(views.event_periods(spark, sf))


def _daily_summaries(spark, sf):
    """A history of summaries: one row per day with counts of that day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return (
        views.load(spark, sf, "events")
        .groupBy(day.alias("timestamp"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("event_type") == "error").alias("n_errors"))
    )


def latest_report(spark, sf):
    return drift.latest(_daily_summaries(spark, sf), "timestamp")


def drift_status(spark, sf):
    """Days with many errors raise an alert; the newest one is the status."""
    days = _daily_summaries(spark, sf).select(
        "timestamp",
        (F.col("n_errors") * 4 > F.col("n_rows")).alias("alert"),
        F.concat(F.lit("errors: "), F.col("n_errors").cast("string")).alias("message"),
    )
    alerts = days.filter("alert").select("timestamp", F.col("alert").alias("drift_detected"), "message")
    return drift.current_status(alerts, days)


def drift_history(spark, sf):
    return drift.newest_first(_daily_summaries(spark, sf), "timestamp", limit=10)


def json_summary_normalize(spark, sf):
    """Old summary rows made from events; each variant misses other fields."""
    e = views.load(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    kind = F.when(F.col("event_id") % 2 == 0, "numeric").otherwise("categorical")
    variant = F.col("event_id") % 3
    null = F.lit(None).cast("double")
    rows = e.select(
        "event_id",
        kind.alias("type"),
        F.when(variant == 0, k / 100).alias("statistic"),
        F.when((variant == 1) & (kind == "numeric"), k / 100).alias("ks_statistic"),
        F.when((variant >= 1) & (kind == "categorical"), k / 100).alias("js_divergence"),
        F.when(variant == 0, "given").alias("test"),
        F.when(variant == 0, 0.01).otherwise(null).alias("threshold"),
        F.when(variant == 1, 0.07).otherwise(null).alias("p_threshold"),
    )
    return tables.normalize_summary_rows(rows).select("event_id", "type", "statistic", "test", "threshold")


def json_roundtrip(spark, sf):
    """A nested summary written as JSON, read back and flattened."""
    path = new_path(spark, "summary")
    tables.write_json(drift.drift_summary(_report(spark, sf)).drop("affected_columns"), path)
    rows = tables.summary_rows(spark.read.schema(tables.SUMMARY_SCHEMA).json(path))
    return rows.select("feature", "type", "test", "statistic", "p_value", "psi", "psi_level", "drift_detected", "threshold")


QUERIES = {
    f.__name__: f
    for f in (
        value_shares, psi_categorical, tv_distance, ks_statistic, ks_pvalue_asym, ks_pvalue_auto, psi_numeric,
        psi_level, drift_report, drift_report_stable, drift_summary, drift_alert, retrain_trigger, chi_square_fit,
        chi_square_homog, drift_monitor, drift_source_gate, drift_report_live, chi_square_many, drift_history_append, alert_append, min_rows_gate, latest_report, drift_history, drift_status,
        json_summary_normalize, json_roundtrip,
    )
}


def _psi(r: str, c: str) -> str:
    r, c = f"greatest({r}, 0.0001::DOUBLE)", f"greatest({c}, 0.0001::DOUBLE)"
    return f"(({c}) - ({r})) * ln(({c}) / ({r}))"


def _side_sql(view: str) -> str:
    """Long tables, counts and every statistic per feature, in plain SQL."""
    share = "n_ref / tot_ref::DOUBLE", "n_cur / tot_cur::DOUBLE"
    bshare = "b_ref / n_ref::DOUBLE", "b_cur / n_cur::DOUBLE"
    return f"""
      longnum AS (SELECT 'value' AS feature, value AS v, is_ref FROM {view} WHERE value IS NOT NULL
                  UNION ALL SELECT 'k', CAST(k AS DOUBLE), is_ref FROM {view} WHERE k IS NOT NULL),
      cnum AS (SELECT feature, v, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
               FROM longnum GROUP BY feature, v),
      cumnum AS (SELECT *, sum(n_ref) OVER w AS c_ref, sum(n_cur) OVER w AS c_cur,
                        sum(n_ref) OVER (PARTITION BY feature) AS tot_ref,
                        sum(n_cur) OVER (PARTITION BY feature) AS tot_cur
                 FROM cnum WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
      kstab AS (SELECT feature, max(tot_ref)::BIGINT AS n_ref, max(tot_cur)::BIGINT AS n_cur,
                       max(abs(c_ref / tot_ref::DOUBLE - c_cur / tot_cur::DOUBLE)) AS ks,
                       count(*) FILTER (WHERE n_ref > 0) AS distinct_ref,
                       sum({_psi(*share)}) AS psi_values
                FROM cumnum GROUP BY feature),
      moments AS (SELECT feature, avg(v) FILTER (WHERE is_ref) AS ref_mean, avg(v) FILTER (WHERE NOT is_ref) AS curr_mean,
                         stddev_samp(v) FILTER (WHERE is_ref) AS ref_std,
                         stddev_samp(v) FILTER (WHERE NOT is_ref) AS curr_std,
                         list_distinct(quantile_cont(v, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0])
                                       FILTER (WHERE is_ref)) AS points
                  FROM longnum GROUP BY feature),
      edges AS (SELECT feature, list_filter(points, lambda x: x > list_min(points) AND x < list_max(points)) AS inner_edges
                FROM moments),
      bins AS (SELECT feature, bin, sum(n_ref) AS b_ref, sum(n_cur) AS b_cur
               FROM (SELECT c.feature, len(list_filter(e.inner_edges, lambda x: x <= c.v)) AS bin, c.n_ref, c.n_cur
                     FROM cnum c JOIN edges e USING (feature)) GROUP BY feature, bin),
      psibins AS (SELECT b.feature, sum({_psi(*bshare)}) AS psi_bins FROM bins b JOIN kstab k USING (feature) GROUP BY b.feature),
      numrep AS (SELECT k.feature, k.n_ref, k.n_cur, k.ks, m.ref_mean, m.curr_mean, m.ref_std, m.curr_std,
                        CASE WHEN k.distinct_ref > 10 THEN p.psi_bins ELSE k.psi_values END AS psi,
                        k.ks * sqrt(k.n_ref * k.n_cur / (k.n_ref + k.n_cur)::DOUBLE) AS x
                 FROM kstab k JOIN moments m USING (feature) JOIN psibins p USING (feature)),
      nump AS (SELECT *, CASE WHEN x < 0.04 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 102),
                        lambda j: (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0::DOUBLE * j * j * x * x))))) END AS p_value
               FROM numrep),
      ccat AS (SELECT 'event_type' AS feature, event_type AS v, count(*) FILTER (WHERE is_ref) AS n_ref,
                      count(*) FILTER (WHERE NOT is_ref) AS n_cur FROM {view} WHERE event_type IS NOT NULL GROUP BY event_type),
      tcat AS (SELECT *, sum(n_ref) OVER () AS tot_ref, sum(n_cur) OVER () AS tot_cur FROM ccat),
      catrep AS (SELECT feature, max(tot_ref)::BIGINT AS n_ref, max(tot_cur)::BIGINT AS n_cur,
                        0.5::DOUBLE * sum(abs({share[0]} - {share[1]})) AS tv, sum({_psi(*share)}) AS psi
                 FROM tcat GROUP BY feature)"""


_LEVEL = "CASE WHEN psi > 0.25 THEN 'significant' WHEN psi >= 0.1 THEN 'moderate' ELSE 'stable' END"
_REPORT = f"""
      report AS (
        SELECT feature, 'numeric' AS type, 'Kolmogorov-Smirnov' AS test, round(ks, 4) AS statistic,
               round(p_value, 4) AS p_value, (p_value < 0.05 OR psi > 0.25) AS drift_detected,
               round(ref_mean, 4) AS ref_mean, round(curr_mean, 4) AS curr_mean, round(ref_std, 4) AS ref_std,
               round(curr_std, 4) AS curr_std, 0.05::DOUBLE AS threshold, round(psi, 4) AS psi, {_LEVEL} AS psi_level,
               n_ref, n_cur FROM nump
        UNION ALL
        SELECT feature, 'categorical', 'Total variation distance', round(tv, 4), NULL, (tv > 0.2 OR psi > 0.25),
               NULL, NULL, NULL, NULL, 0.2::DOUBLE, round(psi, 4), {_LEVEL}, n_ref, n_cur FROM catrep)"""


def _sides(view: str, tail: str = "") -> str:
    return with_views([view], _side_sql(view) + tail)


_MESSAGE = (
    "CASE WHEN count(*) FILTER (WHERE drift_detected) > 0 THEN 'Drift found in ' || "
    "count(*) FILTER (WHERE drift_detected) || ' features. Attention required.' "
    "ELSE 'No drift found. The data is stable.' END"
)
_AFFECTED = "coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drift_detected), '')"
_DAILY = """daily AS (SELECT strftime(ts, '%Y-%m-%d') AS timestamp, count(*) AS n_rows,
              count(*) FILTER (WHERE event_type = 'error') AS n_errors FROM events GROUP BY 1)"""
# upper tail of chi-square with 4 degrees of freedom: exp(-x/2) (1 + x/2)
_CHI4 = "exp(-chi / 2) * (1 + chi / 2)"

def _two_reports(select: str) -> str:
    """``select`` over the report of either batch."""
    parts = []
    for batch, view in enumerate(("event_periods", "event_shifted")):
        query = _sides(view, "," + _REPORT) + f"SELECT '2024-01-0{batch + 1}' AS timestamp, {batch}::BIGINT AS batch_id, {select} FROM report"
        parts.append(f"SELECT * FROM ({query})")
    return " UNION ALL ".join(parts)


ORACLE = {
    "drift_history_append": _two_reports(
        f"count(*) AS total_features, count(*) FILTER (WHERE drift_detected) AS drift_features, max(psi) AS max_psi, bool_or(drift_detected) AS alert, {_MESSAGE} AS message"
    ),
    "alert_append": "SELECT * FROM ("
    + _two_reports(f"'data_drift' AS alert_type, bool_or(drift_detected) AS drift_detected, {_AFFECTED} AS affected_columns, {_MESSAGE} AS message")
    + ") WHERE drift_detected",
    "value_shares": _sides("event_periods")
    + "SELECT feature, v AS value, n_ref, n_cur, round(n_ref / tot_ref::DOUBLE, 6) AS ref_share, "
    "round(n_cur / tot_cur::DOUBLE, 6) AS cur_share FROM tcat",
    "psi_categorical": _sides("event_shifted") + "SELECT feature, round(psi, 6) AS psi FROM catrep",
    "tv_distance": _sides("event_shifted") + "SELECT feature, round(tv, 6) AS tv_distance FROM catrep",
    "ks_statistic": _sides("event_shifted") + "SELECT feature, n_ref, n_cur, round(ks, 6) AS ks FROM kstab",
    "ks_pvalue_asym": _sides("event_periods")
    + "SELECT feature, round(ks, 6) AS ks, round(p_value, 6) AS p_value FROM nump",
    "psi_numeric": _sides("event_shifted") + "SELECT feature, round(psi, 6) AS psi FROM numrep",
    "psi_level": _sides("event_shifted")
    + f"SELECT feature, psi, {_LEVEL} AS psi_level FROM (SELECT feature, round(psi, 4) AS psi FROM numrep)",
    "drift_report": _sides("event_shifted", "," + _REPORT) + "SELECT * FROM report",
    "drift_report_stable": _sides("event_periods", "," + _REPORT) + "SELECT * FROM report",
    "chi_square_many": with_views(
        ["event_periods"],
        """c AS (SELECT count(*) FILTER (WHERE is_ref)::DOUBLE AS r, count(*) FILTER (WHERE NOT is_ref)::DOUBLE AS u FROM event_periods GROUP BY event_id % 501),
           e AS (SELECT *, sum(r) OVER () * (r + u) / (sum(r) OVER () + sum(u) OVER ()) AS er, sum(u) OVER () * (r + u) / (sum(r) OVER () + sum(u) OVER ()) AS eu FROM c),
           x AS (SELECT sum((r - er) * (r - er) / er + (u - eu) * (u - eu) / eu) AS chi, count(*) - 1 AS dof FROM e)""",
    )
    + "SELECT 'bucket' AS feature, round(chi, 6) AS chi_square, dof, round((SELECT sum(exp(k * ln(chi / 2) - chi / 2 - lgamma(k + 1))) "
    "FROM (SELECT unnest(range(250)) AS k)), 6) AS p_value FROM x",
    "drift_report_live": with_views(
        ["event_periods"],
        "live AS (SELECT * REPLACE (true AS is_ref) FROM event_periods UNION ALL SELECT * REPLACE (false AS is_ref) FROM event_periods "
        "WHERE event_type = 'signup'), " + _side_sql("live") + "," + _REPORT,
    )
    + "SELECT *, 'live' AS source FROM report",
    "drift_summary": _sides("event_shifted", "," + _REPORT)
    + f"SELECT count(*) AS total_features, count(*) FILTER (WHERE drift_detected) AS drift_features, max(psi) AS max_psi, "
    f"max(n_ref) AS reference_size, max(n_cur) AS current_size, bool_or(drift_detected) AS alert, {_MESSAGE} AS message, "
    f"{_AFFECTED} AS affected_columns FROM report",
    "drift_alert": _sides("event_shifted", "," + _REPORT)
    + f"SELECT 'data_drift' AS alert_type, bool_or(drift_detected) AS drift_detected, {_AFFECTED} AS affected_columns, "
    f"{_MESSAGE} AS message FROM report",
    "retrain_trigger": _sides("event_shifted", "," + _REPORT)
    + "SELECT bool_or(psi > 0.25) AS psi_trigger, bool_or(type = 'numeric' AND coalesce(p_value < 0.05, false)) AS ks_trigger, "
    "bool_or(type = 'categorical' AND statistic > 0.2) AS tv_trigger, bool_or(psi > 0.25 OR (type = 'numeric' AND "
    "coalesce(p_value < 0.05, false)) OR (type = 'categorical' AND statistic > 0.2)) AS retrain FROM report",
    "chi_square_fit": with_views(
        ["event_shifted"],
        f"""fitc AS (SELECT 'equal totals' AS feature, event_type, count(*) FILTER (WHERE event_id % 2 = 0) AS r,
                     count(*) FILTER (WHERE event_id % 2 = 1) AS c FROM event_periods GROUP BY event_type
              UNION ALL SELECT 'event_type', event_type, count(*) FILTER (WHERE is_ref),
                     count(*) FILTER (WHERE NOT is_ref) FROM event_shifted GROUP BY event_type),
            fits AS (SELECT feature, CASE WHEN sum(r) = sum(c) THEN sum((r - c) * (r - c) / c::DOUBLE) END AS chi,
                     count(*) - 1 AS dof, sum(r) = sum(c) AS ok FROM fitc GROUP BY feature)""",
    )
    + f"SELECT feature, round(chi, 4) AS chi_square, dof, round({_CHI4}, 4) AS p_value, "
    f"CASE WHEN ok THEN 'ok' ELSE 'could not calculate' END AS status, coalesce({_CHI4} < 0.05, false) AS drift_detected FROM fits",
    "chi_square_homog": _sides("event_periods")
    + f"SELECT feature, round(chi, 4) AS chi_square, dof, round({_CHI4}, 4) AS p_value, ({_CHI4} < 0.05) AS drift_detected "
    "FROM (SELECT feature, count(*) - 1 AS dof, sum(power(n_ref - tot_ref * (n_ref + n_cur) / (tot_ref + tot_cur)::DOUBLE, 2) / "
    "(tot_ref * (n_ref + n_cur) / (tot_ref + tot_cur)::DOUBLE) + power(n_cur - tot_cur * (n_ref + n_cur) / (tot_ref + tot_cur)::DOUBLE, 2) / "
    "(tot_cur * (n_ref + n_cur) / (tot_ref + tot_cur)::DOUBLE)) AS chi FROM tcat GROUP BY feature)",
    "drift_monitor": _sides(
        "event_shifted",
        """, chim AS (SELECT feature, CASE WHEN max(tot_ref) = max(tot_cur) THEN sum(power(n_ref - n_cur, 2) / n_cur::DOUBLE) END AS chi,
             max(tot_ref) = max(tot_cur) AS ok FROM tcat GROUP BY feature)""",
    )
    + f"""SELECT feature, 'numeric' AS type, round(ks, 4) AS statistic, round(p_value, 4) AS p_value, p_value < 0.05 AS drift_detected,
            'ok' AS status, round(ref_mean, 4) AS ref_mean, round(curr_mean, 4) AS curr_mean, round(ref_std, 4) AS ref_std,
            round(curr_std, 4) AS curr_std FROM nump
          UNION ALL SELECT feature, 'categorical', round(chi, 4), round({_CHI4}, 4), coalesce({_CHI4} < 0.05, false),
            CASE WHEN ok THEN 'ok' ELSE 'could not calculate' END, NULL, NULL, NULL, NULL FROM chim""",
    "drift_source_gate": "SELECT count(*) AS live_rows, CASE WHEN count(*) >= 50 THEN 'live' ELSE 'split' END AS source "
    "FROM events WHERE event_type = 'signup'",
    "min_rows_gate": with_views(["event_periods"])
    + "SELECT n_ref, n_cur, n_ref >= 10 AND n_cur >= 10 AS enough FROM (SELECT count(*) FILTER (WHERE is_ref) AS n_ref, "
    "count(*) FILTER (WHERE NOT is_ref) AS n_cur FROM event_periods)",
    "latest_report": f"WITH {_DAILY} SELECT * FROM daily ORDER BY timestamp DESC LIMIT 1",
    "drift_status": f"""WITH {_DAILY} SELECT timestamp, alert AS drift_detected, 'errors: ' || n_errors AS message FROM (
        SELECT *, n_errors * 4 > n_rows AS alert FROM daily) ORDER BY alert DESC, timestamp DESC LIMIT 1""",
    "drift_history": f"WITH {_DAILY} SELECT * FROM daily ORDER BY timestamp DESC LIMIT 10",
    "json_summary_normalize": """
        WITH r AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'numeric' ELSE 'categorical' END AS type,
                          event_id % 3 AS variant, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
        SELECT event_id, type,
               CASE WHEN variant = 2 AND type = 'numeric' THEN NULL ELSE k / 100 END AS statistic,
               CASE WHEN variant = 0 THEN 'given' WHEN type = 'numeric' THEN 'Kolmogorov-Smirnov'
                    ELSE 'Jensen-Shannon divergence' END AS test,
               CASE WHEN variant = 0 THEN 0.01::DOUBLE WHEN type = 'categorical' THEN 0.2::DOUBLE
                    WHEN variant = 1 THEN 0.07::DOUBLE ELSE 0.05::DOUBLE END AS threshold
        FROM r""",
    "json_roundtrip": _sides("event_shifted", "," + _REPORT)
    + "SELECT feature, type, test, statistic, p_value, psi, psi_level, drift_detected, threshold FROM report",
}
