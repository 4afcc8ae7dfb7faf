"""Registered queries over the parts of training that SQL can state: split
tables, kernel features, folds, calibration pools, comparison, exact p-values."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from riskweave.operators import boosting, drift, kernels, quality, training
from riskweave.operators.registry import Registry
from riskweave.plans import scoring, training_job, views
from riskweave.plans.views import with_views
from riskweave.session import new_path
from riskweave.sources import models as packages
from riskweave.workload.common import rounded

KEY, TARGET = "c_custkey", "Target"
BASE = ["Age", "FrequentFlyer", "AnnualIncomeClass", "ServicesOpted", "AccountSyncedToSocialMedia", "BookedHotelOrNot"]
POSITIVE_WEIGHT = 3.0
AGE_STEP, AGE_EDGES = 100, 24


def _binned(spark, sf):
    """Customers with every 7th age missing, in bins, and their derivatives at margin 0."""
    df = views.customer_codes(spark, sf)
    values = {c: F.col(c).cast("double") for c in BASE}
    values["Age"] = F.when(F.col(KEY) % 7 != 0, values["Age"])
    edges = {c: [float(i) for i in range(1, 8)] for c in BASE} | {"Age": [float(AGE_STEP * i) for i in range(1, AGE_EDGES + 1)]}
    weight = F.when(F.col(TARGET) == 1, POSITIVE_WEIGHT).otherwise(1.0)
    return df.select(
        ((F.lit(0.5) - F.col(TARGET)) * weight).alias("g"), (0.25 * weight).alias("h"), *[boosting.bin_of(values[c], edges[c]).alias(c) for c in BASE]
    )


def boost_level_splits(spark, sf):
    """The best splits of the first two levels of a boosted tree."""
    rows = _binned(spark, sf)
    first = boosting.split_table(boosting.level_histogram(rows, "1", BASE, "g", "h"))
    tree = {r["node"]: {"feature": r["feature"], "bin": r["bin"], "nulls_left": r["nulls_left"]} for r in first.collect()}
    second = boosting.split_table(boosting.level_histogram(rows, boosting.node_sql(tree, BASE), BASE, "g", "h"))
    return rounded(first.unionByName(second))


KERNEL_DIMENSIONS, KERNEL_SEED = 8, 5


def kernel_scores(spark, sf):
    """Random Fourier features of the customers, a row for each."""
    rows, _, _ = training_job.prepare(views.customer_codes(spark, sf), KEY, TARGET, features=BASE)
    spec = kernels.FourierKernel(inputCol="features", outputCol="z", dimensions=KERNEL_DIMENSIONS, seed=KERNEL_SEED)
    made = spec.fit(rows).transform(rows).select(KEY, F.posexplode(vector_to_array("z")).alias("component", "value"))
    return rounded(made)


def ks_pvalue_exact(spark, sf):
    """Balances of one market segment against the others, for each nation: exact p-values."""
    rows = views.load(spark, sf, "customer")
    is_ref = F.col("c_mktsegment") == "BUILDING"
    counts = rows.groupBy(F.col("c_nationkey").cast("string").alias("feature"), F.col("c_acctbal").cast("double").alias("value")).agg(
        F.count_if(is_ref).alias("n_ref"), F.count_if(~is_ref).alias("n_cur")
    )
    found = drift.with_ks_pvalue(drift.ks_distances(counts).where("n_ref > 0 and n_cur > 0"), "auto")
    return rounded(found.where("p_method = 'exact'").select("feature", "n_ref", "n_cur", "ks", "p_value"))


def _scores(spark, sf):
    """Three fixed scores of every customer in long form."""
    df = views.scored_customers(spark, sf)
    made = {"linear": F.col("p"), "orders": F.round(1 / F.col("n_orders"), 6), "recency": F.round(F.col("recency_days") / 4000, 6)}
    entries = F.array(*[F.struct(F.lit(n).alias("model_name"), p.alias("p")) for n, p in made.items()])
    return df.select(KEY, F.col("churn").alias("y"), F.explode(entries).alias("e")).select(KEY, "y", "e.*")


def compare_scores(spark, sf):
    """All metrics of three stored score columns at thresholds of their own."""
    return rounded(training.compare(_scores(spark, sf), {"linear": 0.4, "orders": 0.2}).drop("rank_metric"))


def stack_folds(spark, sf):
    """The folds that stacking and calibration use."""
    rows, _, _ = training_job.prepare(views.customer_codes(spark, sf), KEY, TARGET, features=BASE)
    return training.with_folds(rows, KEY, 5).select(KEY, F.col("label").cast("int").alias("y"), "fold")


def isotonic_pools(spark, sf):
    """Calibrated value of every score (to two digits) of the customers."""
    rows = views.scored_customers(spark, sf).select(F.round("p", 2).alias("score"), F.col("churn").cast("double").alias("label"))
    model = IsotonicRegression(featuresCol="score", labelCol="label", predictionCol="calibrated").fit(rows)
    return rounded(model.transform(rows.select("score").distinct()))


def model_info(spark, sf):
    """The record of a champion that was registered with the metrics of its scores."""
    scored = views.scored_customers(spark, sf)
    found = quality.binary_metrics(scored.withColumn("q", (F.col("p") >= 0.4).cast("int")), "churn", "q").first()
    rows, names, _ = training_job.prepare(views.customer_codes(spark, sf), KEY, TARGET, features=BASE)
    model = training.logistic(1, True, 1).fit(rows)
    path, store = new_path(spark, "package"), Registry(spark, new_path(spark, "registry"))
    packages.save_package(spark, path, model, "LogisticRegression_Balanced", 0.4, names, {"f1_score": found["f1_score"], "recall": found["recall"]})
    store.register("churn", "run", path)
    info = scoring.model_info(store, "churn")
    return rounded(
        info.select("model_name", "model_version", "threshold", "n_features", F.col("metrics.f1_score").alias("f1_score"), F.col("metrics.recall").alias("recall"))
    )


QUERIES = {
    f.__name__: f
    for f in (boost_level_splits, kernel_scores, ks_pvalue_exact, compare_scores, stack_folds, isotonic_pools, model_info)
}

_CC = with_views(["customer_codes"])
_BIN = {c: f'least(greatest(floor("{c}"::DOUBLE), 0), 7)::INT' for c in BASE}
_BIN["Age"] = f'CASE WHEN c_custkey % 7 <> 0 THEN least(greatest(floor("Age" / {float(AGE_STEP)}::DOUBLE), 0), {AGE_EDGES})::INT END'


def _splits(name: str, source: str) -> str:
    """CTEs from ``source`` (node, g, h, bins) to the best split of each node."""
    long = " UNION ALL ".join(f'SELECT node, {i} AS feature, "{c}" AS bin, g, h FROM {source}' for i, c in enumerate(BASE))
    return f"""
      {name}_h AS (SELECT node, feature, bin, sum(g) AS g, sum(h) AS h FROM ({long}) GROUP BY node, feature, bin),
      {name}_s AS (
        SELECT *, max(bin) OVER f AS last, sum(g) OVER f AS ga, sum(h) OVER f AS ha,
               sum(CASE WHEN bin IS NULL THEN g ELSE 0 END) OVER f AS g0, sum(CASE WHEN bin IS NULL THEN h ELSE 0 END) OVER f AS h0,
               coalesce(sum(CASE WHEN bin IS NOT NULL THEN g END) OVER u, 0) AS gu, coalesce(sum(CASE WHEN bin IS NOT NULL THEN h END) OVER u, 0) AS hu
        FROM {name}_h WINDOW f AS (PARTITION BY node, feature), u AS (PARTITION BY node, feature ORDER BY bin NULLS FIRST ROWS UNBOUNDED PRECEDING)),
      {name}_d AS (
        SELECT *, gu + CASE WHEN nulls_left THEN g0 ELSE 0 END AS gl, hu + CASE WHEN nulls_left THEN h0 ELSE 0 END AS hl
        FROM {name}_s, (VALUES (true), (false)) AS v(nulls_left) WHERE bin IS NOT NULL AND (bin < last OR NOT nulls_left)),
      {name}_g AS (
        SELECT *, round(0.5 * (gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)), 9) AS gain
        FROM {name}_d WHERE hl >= 1 AND ha - hl >= 1),
      {name} AS (
        SELECT node, feature, bin, nulls_left, gain, gl AS g_left, hl AS h_left, ga - gl AS g_right, ha - hl AS h_right FROM {name}_g WHERE gain > 0
        QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin, nulls_left DESC) = 1)"""


_CHOSEN = "CASE feature " + " ".join(f"WHEN {i} THEN \"{c}\"" for i, c in enumerate(BASE)) + " END"
_ROUND6 = ", ".join(f"round({c}, 6) AS {c}" for c in ("gain", "g_left", "h_left", "g_right", "h_right"))


def _uniform(name: str, i: str) -> str:
    return f"(CAST('0x' || substr(md5('{KERNEL_SEED}:{name}:' || j || ':' || {i}), 1, 8) AS BIGINT) + 0.5::DOUBLE) / {16**8}::DOUBLE"


_ALL_VALUES = "unnest([" + ", ".join(f'"{c}"::DOUBLE' for c in BASE) + "])"
_MODELS = "(VALUES ('linear', 0.4::DOUBLE), ('orders', 0.2::DOUBLE), ('recency', 0.5::DOUBLE)) AS t(model_name, threshold)"

ORACLE: dict[str, str] = {
    "boost_level_splits": with_views(
        ["customer_codes"],
        "b AS (SELECT 1 AS node, (0.5::DOUBLE - \"Target\") * w AS g, 0.25::DOUBLE * w AS h, "
        + ", ".join(f'{sql} AS "{c}"' for c, sql in _BIN.items())
        + f' FROM (SELECT *, CASE WHEN "Target" = 1 THEN {POSITIVE_WEIGHT}::DOUBLE ELSE 1 END AS w FROM customer_codes)), '
        + _splits("one", "b")
        + f""", b2 AS (SELECT b.* REPLACE (CASE WHEN coalesce({_CHOSEN} <= one.bin, nulls_left) THEN 2 ELSE 3 END AS node)
                      FROM b, (SELECT feature, bin, nulls_left FROM one) AS one(feature, bin, nulls_left)), """
        + _splits("two", "b2"),
    )
    + f"SELECT node, feature, bin, nulls_left, {_ROUND6} FROM (SELECT * FROM one UNION ALL SELECT * FROM two)",
    "kernel_scores": with_views(
        ["customer_codes"],
        f"""x AS (SELECT c_custkey, generate_subscripts([{', '.join(f'"{c}"' for c in BASE)}], 1) - 1 AS i, {_ALL_VALUES} AS v FROM customer_codes),
        gamma AS (SELECT 1 / ({len(BASE)} * var_pop(v)) AS gamma FROM x),
        w AS (SELECT j, i, sqrt(2 * gamma) * sqrt(-2 * ln({_uniform('r', 'i')})) * cos(2 * pi() * ({_uniform('a', 'i')})) AS w
              FROM range({KERNEL_DIMENSIONS}) AS a(j), range({len(BASE)}) AS b(i), gamma),
        s AS (SELECT c_custkey, j, sum(w * v) AS dot FROM x JOIN w USING (i) GROUP BY c_custkey, j)""",
    )
    + f"SELECT c_custkey, j::INT AS component, round(sqrt(2.0::DOUBLE / {KERNEL_DIMENSIONS}) * cos(dot + 2 * pi() * ({_uniform('b', '0')})), 6) AS value FROM s",
    # the lattice recursion by diagonals: P(i, j) = P(i-1, j) i/(i+j) + P(i, j-1) j/(i+j) inside the band
    "ks_pvalue_exact": """
      WITH RECURSIVE d AS (
        SELECT c_nationkey::VARCHAR AS feature, c_acctbal::DOUBLE AS v, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS r,
               count(*) FILTER (WHERE c_mktsegment <> 'BUILDING') AS c FROM customer GROUP BY ALL),
      g AS (
        SELECT feature, sum(r) OVER f AS n, sum(c) OVER f AS m, sum(r) OVER u AS cr, sum(c) OVER u AS cc
        FROM d WINDOW f AS (PARTITION BY feature), u AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
      k AS (
        SELECT feature, max(n)::BIGINT AS n, max(m)::BIGINT AS m, max(abs(cr * m - cc * n))::BIGINT AS t FROM g GROUP BY feature
        HAVING max(n) > 0 AND max(m) > 0 AND greatest(max(n), max(m)) <= 10000),
      path AS (
        SELECT feature, n, m, t, 0::BIGINT AS s, 0::BIGINT AS i, 1::DOUBLE AS p FROM k WHERE t > 0
        UNION ALL
        SELECT feature, n, m, t, s + 1, i + e, sum(p * CASE WHEN e = 1 THEN i + 1 ELSE s + 1 - i END / (s + 1)::DOUBLE)
        FROM path, (VALUES (0), (1)) AS v(e)
        WHERE s < n + m AND i + e <= n AND s + 1 - i - e <= m AND abs((i + e) * m - (s + 1 - i - e) * n) < t
        GROUP BY feature, n, m, t, s, i + e)
      SELECT k.feature, k.n AS n_ref, k.m AS n_cur, round(k.t / (k.n * k.m)::DOUBLE, 6) AS ks,
             round(CASE WHEN k.t = 0 THEN 1 ELSE 1 - coalesce(p.p, 0) END, 6) AS p_value
      FROM k LEFT JOIN path p ON p.feature = k.feature AND p.s = p.n + p.m""",
    "compare_scores": with_views(
        ["scored_customers"],
        f"""s AS (
          SELECT model_name, churn AS y, threshold,
                 CASE model_name WHEN 'linear' THEN p WHEN 'orders' THEN round(1 / n_orders::DOUBLE, 6) ELSE round(recency_days / 4000::DOUBLE, 6) END AS p
          FROM scored_customers, {_MODELS}),
        c AS (
          SELECT model_name, threshold, count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp, count(*) FILTER (WHERE y <> 1 AND p >= threshold) AS fp,
                 count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn, count(*) FILTER (WHERE y <> 1 AND p < threshold) AS tn FROM s GROUP BY ALL),
        a AS (
          SELECT model_name, sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg))::DOUBLE AS roc_auc FROM (
            SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_name ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
              SELECT model_name, p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM s GROUP BY ALL)) GROUP BY model_name)""",
    )
    + """SELECT model_name, round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6) AS accuracy, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1_score,
                round(roc_auc, 6) AS roc_auc, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
                round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall, threshold FROM c JOIN a USING (model_name)""",
    "stack_folds": _CC
    + """SELECT c_custkey, "Target" AS y, ((row_number() OVER (PARTITION BY "Target" ORDER BY md5(c_custkey::VARCHAR)) - 1) % 5)::INT AS fold FROM customer_codes""",
    # the isotonic value is the greatest over beginnings of the least over ends of the mean between
    "isotonic_pools": with_views(
        ["scored_customers"],
        """d AS (SELECT round(p, 2) AS score, count(*) AS n, sum(churn) AS y FROM scored_customers GROUP BY 1),
        c AS (SELECT *, row_number() OVER (ORDER BY score) AS i, sum(n) OVER (ORDER BY score) AS cn, sum(y) OVER (ORDER BY score) AS cy FROM d),
        means AS (SELECT a.i AS a, b.i AS b, (b.cy - a.cy + a.y) / (b.cn - a.cn + a.n)::DOUBLE AS mean FROM c a JOIN c b ON a.i <= b.i),
        lows AS (SELECT a, t.i, min(mean) AS low FROM means JOIN c t ON t.i BETWEEN a AND b GROUP BY a, t.i)""",
    )
    + "SELECT c.score, round(max(low), 6) AS calibrated FROM c JOIN lows USING (i) GROUP BY c.score",
    "model_info": with_views(["scored_customers"])
    + """SELECT 'LogisticRegression_Balanced' AS model_name, 1 AS model_version, 0.4::DOUBLE AS threshold, 6 AS n_features,
                round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1_score, round(tp / (tp + fn)::DOUBLE, 6) AS recall
         FROM (SELECT count(*) FILTER (WHERE churn = 1 AND p >= 0.4) AS tp, count(*) FILTER (WHERE churn <> 1 AND p >= 0.4) AS fp,
                      count(*) FILTER (WHERE churn = 1 AND p < 0.4) AS fn FROM scored_customers)""",
}
