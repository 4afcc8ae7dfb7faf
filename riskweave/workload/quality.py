"""Registered model-quality queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions.labels import apply_threshold as at_threshold
from riskweave.functions.labels import risk_band as band
from riskweave.operators import quality
from riskweave.plans import views
from riskweave.plans.views import with_views
from riskweave.workload.common import rounded

CUT = 0.4


def _scored(spark, sf):
    df = views.scored_customers(spark, sf)
    return df.withColumn("pred", at_threshold(F.col("p"), CUT))


def _labelled(spark, sf):
    """Real labels: long documents are predicted to be good ones."""
    docs = views.load(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    return (
        views.load(spark, sf, "labels")
        .join(docs, "doc_id")
        .withColumn("pred", (F.col("n_chars") >= 500).cast("int"))
    )


def binary_metrics(spark, sf):
    return rounded(quality.binary_metrics(_scored(spark, sf), "churn", "pred"))


def label_metrics(spark, sf):
    return rounded(quality.binary_metrics(_labelled(spark, sf), "quality", "pred", ["lang"]))


def confusion_matrix(spark, sf):
    return quality.confusion_matrix(_scored(spark, sf), "churn", "pred")


def roc_auc(spark, sf):
    return rounded(quality.roc_auc(_scored(spark, sf), "churn", "p"))


def label_auc(spark, sf):
    return rounded(quality.roc_auc(_labelled(spark, sf), "quality", "n_chars"))


def roc_curve(spark, sf):
    return rounded(quality.roc_curve(_scored(spark, sf), "churn", "p"))


def threshold_sweep(spark, sf):
    return rounded(quality.threshold_sweep(_scored(spark, sf), "churn", "p"))


def threshold_sweep_groups(spark, sf):
    return rounded(quality.threshold_sweep(_scored(spark, sf), "churn", "p", ["c_mktsegment"]))


def best_threshold(spark, sf):
    sweep = quality.threshold_sweep(_scored(spark, sf), "churn", "p")
    return rounded(quality.best_threshold(sweep, ["f1_score", "recall", "precision"]))


def apply_threshold(spark, sf):
    return _scored(spark, sf).select("c_custkey", "p", "pred")


def risk_band(spark, sf):
    return _scored(spark, sf).select("c_custkey", "p", band(F.col("p")).alias("risk_level"))


def sliced_metrics(spark, sf):
    tenure = F.when(F.col("tenure_days") <= 1000, "new").when(F.col("tenure_days") <= 1800, "known").otherwise("old")
    slices = {"balance_class": F.col("balance_class"), "tenure": tenure, "frequent": F.col("frequent")}
    return rounded(quality.sliced_metrics(_scored(spark, sf), slices, "churn", "p", CUT))


def _results(spark, sf):
    """One 'model' per market segment."""
    df = quality.binary_metrics(_scored(spark, sf), "churn", "pred", ["c_mktsegment"])
    return df.select(
        F.col("c_mktsegment").alias("model_name"), "accuracy", "f1_score", "precision", "recall"
    )


def leaderboard(spark, sf):
    return rounded(quality.leaderboard(_results(spark, sf)))


def leaderboard_by_accuracy(spark, sf):
    return rounded(quality.leaderboard(_results(spark, sf).select("model_name", "accuracy")))


def best_model(spark, sf):
    return rounded(quality.best_model(_results(spark, sf)))


def leaderboard_union(spark, sf):
    external = quality.binary_metrics(_labelled(spark, sf), "quality", "pred", ["lang"]).select(
        F.concat(F.lit("external "), F.col("lang")).alias("model_name"), "accuracy", "f1_score"
    )
    return rounded(quality.merge_results(_results(spark, sf), external))


def quality_delta(spark, sf):
    df = _scored(spark, sf).withColumn("is_ref", F.col("tenure_days") > 1700)
    return rounded(quality.quality_delta(df, "churn", "pred"))


def _gate_table(spark, sf, score):
    slices = {"all": F.lit("all"), "balance_class": F.col("balance_class"), "frequent": F.col("frequent")}
    df = _scored(spark, sf).withColumn("q", score)
    m = quality.sliced_metrics(df, slices, "churn", "q", CUT)
    f1 = F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
    )
    return m.select("slice", "slice_value", F.round(f1, 9).alias("f1_score"), "roc_auc")


def promotion_gate(spark, sf):
    champion = _gate_table(spark, sf, F.col("p"))
    rival = _gate_table(spark, sf, F.round(1 - F.col("p"), 6))
    parts = [
        quality.promotion_gate(rival, champion).withColumn("challenger", F.lit("inverted")),
        quality.promotion_gate(champion, champion, min_auc=0.3).withColumn("challenger", F.lit("same")),
    ]
    return parts[0].unionByName(parts[1])


def promotion_gate_missing_group(spark, sf):
    """The champion against itself without one group: not promoted."""
    champion = _gate_table(spark, sf, F.col("p"))
    lacking = champion.filter("NOT (slice = 'frequent' AND slice_value = 'Yes')")
    return quality.promotion_gate(lacking, champion, min_auc=0.3)


def scenario_unscored(spark, sf):
    """Every third customer has no score: those scenarios fail and are counted."""
    scores = _scored(spark, sf).filter("c_custkey % 3 <> 0")
    scores = scores.select("c_custkey", F.col("p").alias("probability"), band(F.col("p")).alias("risk_level"))
    return quality.scenario_check(quality.scenario_results(_scenarios(spark, sf), scores, "c_custkey"), "category")


def label_auc_null_group(spark, sf):
    """AUC per language where short documents have none: a null group stays."""
    df = _labelled(spark, sf).withColumn("lang", F.when(F.col("n_chars") >= 300, F.col("lang")))
    return rounded(quality.roc_auc(df, "quality", "n_chars", ["lang"]))


def _scenarios(spark, sf):
    c = views.customer_features(spark, sf)
    many = F.col("frequent") == "Yes"
    return c.select(
        "c_custkey",
        F.col("c_mktsegment").alias("category"),
        F.when(many, "Low").otherwise("Medium").alias("expected_risk"),
        F.when(many, 0.35).alias("probability_max"),
        F.when(F.col("has_open") == "Yes", 0.25).alias("probability_min"),
    )


def _scenario_results(spark, sf, strict=False):
    scores = _scored(spark, sf).select("c_custkey", F.col("p").alias("probability"), band(F.col("p")).alias("risk_level"))
    return quality.scenario_results(_scenarios(spark, sf), scores, "c_custkey", strict)


def scenario_check(spark, sf):
    return quality.scenario_check(_scenario_results(spark, sf), "category")


def scenario_check_strict(spark, sf):
    return quality.scenario_check(_scenario_results(spark, sf, True), "category")


def scenario_failures(spark, sf):
    failed = quality.filter_results(_scenario_results(spark, sf), "fail")
    return quality.filter_results(failed, "BUILDING").select("c_custkey", "category", "probability", "risk_match")


QUERIES = {
    f.__name__: f
    for f in (
        binary_metrics, label_metrics, confusion_matrix, roc_auc, label_auc, roc_curve, threshold_sweep,
        threshold_sweep_groups, best_threshold, apply_threshold, risk_band, sliced_metrics, leaderboard,
        leaderboard_by_accuracy, best_model, leaderboard_union, quality_delta, promotion_gate, scenario_check,
        scenario_check_strict, scenario_failures, promotion_gate_missing_group, scenario_unscored, label_auc_null_group,
    )
}


def _s(more: str = "") -> str:
    pred = f"s AS (SELECT *, CASE WHEN p >= {CUT}::DOUBLE THEN 1 ELSE 0 END AS pred FROM scored_customers)"
    return with_views(["scored_customers"], pred + (", " + more if more else ""))


_LAB = "lab AS (SELECT l.doc_id, l.quality, d.n_chars, d.lang, CASE WHEN d.n_chars >= 500 THEN 1 ELSE 0 END AS pred FROM labels l JOIN documents d USING (doc_id))"


def _cells(y: str, q: str = "pred") -> str:
    return (
        f"count(*) AS n, count(*) FILTER (WHERE {y} = 1 AND {q} = 1) AS tp, count(*) FILTER (WHERE {y} <> 1 AND {q} = 1) AS fp, "
        f"count(*) FILTER (WHERE {y} = 1 AND {q} <> 1) AS fn, count(*) FILTER (WHERE {y} <> 1 AND {q} <> 1) AS tn"
    )


def _ratio(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0)"


_M = {
    "accuracy": _ratio("tp + tn", "tp + fp + fn + tn"),
    "precision": _ratio("tp", "tp + fp"),
    "recall": _ratio("tp", "tp + fn"),
    "f1_score": _ratio("2 * tp", "2 * tp + fp + fn"),
}
_MR = ", ".join(f"round({v}, 6) AS {k}" for k, v in _M.items())
_CELLS_AUC = "sum(pos * (cneg - neg + neg / 2::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg))"
_CELLS_AUC_SAFE = "sum(pos * (cneg - neg + neg / 2::DOUBLE)) / nullif(sum(pos)::DOUBLE * sum(neg), 0)"
_RES = f"""res AS (SELECT c_mktsegment AS model_name, {_M['accuracy']} AS accuracy, {_M['f1_score']} AS f1_score,
            {_M['precision']} AS precision, {_M['recall']} AS recall FROM (SELECT c_mktsegment, {_cells('churn')} FROM s GROUP BY c_mktsegment))"""
_THR = "thr AS (SELECT i AS threshold_id, 0.1::DOUBLE + i * ((0.1::DOUBLE + 0.01::DOUBLE) - 0.1::DOUBLE) AS threshold FROM (SELECT unnest(range(80)) AS i))"


def _sweep(group: str = "") -> str:
    g = f"{group}, " if group else ""
    return f"""sweep AS (SELECT {g}threshold_id, threshold, tp, fp, {', '.join(f'{v} AS {k}' for k, v in _M.items())} FROM (
        SELECT {g}threshold_id, threshold, count(*) FILTER (WHERE churn = 1 AND p >= threshold) AS tp,
               count(*) FILTER (WHERE churn <> 1 AND p >= threshold) AS fp, count(*) FILTER (WHERE churn = 1 AND p < threshold) AS fn,
               count(*) FILTER (WHERE churn <> 1 AND p < threshold) AS tn FROM s, thr GROUP BY {g}threshold_id, threshold))"""


_SWEEP_OUT = "threshold_id, round(threshold, 6) AS threshold, tp, fp, " + ", ".join(f"round({k}, 6) AS {k}" for k in _M)


def _slices(score: str, name: str, with_all: bool = False) -> str:
    """Per-slice quality of one score expression."""
    parts = [("balance_class", "balance_class"), ("frequent", "frequent")]
    parts += [("all", "'all'")] if with_all else [
        ("tenure", "CASE WHEN tenure_days <= 1000 THEN 'new' WHEN tenure_days <= 1800 THEN 'known' ELSE 'old' END")
    ]
    union = " UNION ALL ".join(f"SELECT '{n}' AS slice, {e} AS slice_value, churn, {score} AS q FROM s" for n, e in parts)
    return f"""{name}_long AS ({union}),
      {name}_cnt AS (SELECT slice, slice_value, q, count(*) FILTER (WHERE churn = 1) AS pos, count(*) FILTER (WHERE churn <> 1) AS neg
                     FROM {name}_long GROUP BY 1, 2, 3),
      {name}_cum AS (SELECT *, sum(neg) OVER (PARTITION BY slice, slice_value ORDER BY q ROWS UNBOUNDED PRECEDING) AS cneg FROM {name}_cnt),
      {name} AS (SELECT slice, slice_value, (sum(pos) + sum(neg))::BIGINT AS n, sum(pos)::DOUBLE / (sum(pos) + sum(neg)) AS churn_rate,
                        {_CELLS_AUC} AS roc_auc, sum(pos) AS pos_all,
                        coalesce(sum(pos) FILTER (WHERE q >= {CUT}::DOUBLE), 0) AS tp, coalesce(sum(neg) FILTER (WHERE q >= {CUT}::DOUBLE), 0) AS fp
                 FROM {name}_cum GROUP BY slice, slice_value)"""


def _gate(new: str, old: str, auc: float, name: str) -> str:
    f1 = "round(coalesce(2 * {t}.tp::DOUBLE / nullif({t}.pos_all + {t}.tp + {t}.fp, 0), 0), 9)"
    a, b = f1.format(t="a"), f1.format(t="b")
    return f"""SELECT f1_ok, auc_ok, groups_ok, f1_ok AND auc_ok AND groups_ok AS promote, '{name}' AS challenger FROM (
        SELECT coalesce(bool_and(a.n IS NOT NULL AND {a} >= {b}) FILTER (WHERE slice = 'all'), false) AS f1_ok,
               coalesce(bool_and(a.roc_auc >= {auc}) FILTER (WHERE slice = 'all'), false) AS auc_ok,
               coalesce(bool_and(a.n IS NOT NULL AND {a} >= {b} - 0.05::DOUBLE) FILTER (WHERE slice <> 'all'), true) AS groups_ok
        FROM {old} b LEFT JOIN {new} a USING (slice, slice_value))"""


_SCEN = """scen AS (SELECT c_custkey, c_mktsegment AS category, CASE WHEN frequent = 'Yes' THEN 'Low' ELSE 'Medium' END AS expected_risk,
             CASE WHEN frequent = 'Yes' THEN 0.35::DOUBLE END AS pmax, CASE WHEN has_open = 'Yes' THEN 0.25::DOUBLE END AS pmin, p,
             CASE WHEN p < 0.3::DOUBLE THEN 'Low' WHEN p < 0.7::DOUBLE THEN 'Medium' ELSE 'High' END AS risk_level FROM s)"""
_PASS = "CASE WHEN pmax IS NOT NULL THEN p <= pmax WHEN pmin IS NOT NULL THEN p >= pmin ELSE true END"
_PASS_STRICT = "coalesce(p <= pmax, true) AND coalesce(p >= pmin, true)"


def _check(rule: str) -> str:
    return (
        f"SELECT category, count(*) AS total, count(*) FILTER (WHERE {rule}) AS passed, count(*) FILTER (WHERE NOT ({rule})) AS failed, "
        f"floor(count(*) FILTER (WHERE {rule}) * 100.0::DOUBLE / count(*) + 0.5::DOUBLE)::BIGINT AS pass_rate FROM scen GROUP BY category"
    )


def _auc_sql(source: str, y: str, score: str) -> str:
    return f"""SELECT sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg, round({_CELLS_AUC}, 6) AS roc_auc FROM (
        SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg FROM (
          SELECT {score} AS score, count(*) FILTER (WHERE {y} = 1) AS pos, count(*) FILTER (WHERE {y} <> 1) AS neg FROM {source} GROUP BY 1))"""


ORACLE = {
    "binary_metrics": _s() + f"SELECT n, tp, fp, fn, tn, {_MR} FROM (SELECT {_cells('churn')} FROM s)",
    "label_metrics": f"WITH {_LAB} SELECT lang, n, tp, fp, fn, tn, {_MR} FROM (SELECT lang, {_cells('quality')} FROM lab GROUP BY lang)",
    "confusion_matrix": _s()
    + "SELECT a AS actual, q AS predicted, (SELECT count(*) FROM s WHERE churn = a AND pred = q) AS n "
    "FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(q)",
    "roc_auc": _s() + _auc_sql("s", "churn", "p"),
    "label_auc": f"WITH {_LAB} " + _auc_sql("lab", "quality", "n_chars"),
    "roc_curve": _s()
    + "SELECT threshold, round(sum(pos) OVER w / (sum(pos) OVER ())::DOUBLE, 6) AS tpr, round(sum(neg) OVER w / (sum(neg) OVER ())::DOUBLE, 6) AS fpr "
    "FROM (SELECT p AS threshold, count(*) FILTER (WHERE churn = 1) AS pos, count(*) FILTER (WHERE churn <> 1) AS neg FROM s GROUP BY p) "
    "WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)",
    "threshold_sweep": _s(f"{_THR}, {_sweep()}") + f"SELECT {_SWEEP_OUT} FROM sweep",
    "threshold_sweep_groups": _s(f"{_THR}, {_sweep('c_mktsegment')}") + f"SELECT c_mktsegment, {_SWEEP_OUT} FROM sweep",
    "best_threshold": _s(f"{_THR}, {_sweep()}")
    + " UNION ALL ".join(
        f"(SELECT round(CASE WHEN {m} > 0 THEN threshold ELSE 0.5::DOUBLE END, 6) AS threshold, round({m}, 6) AS score, '{m}' AS metric "
        f"FROM sweep ORDER BY {m} DESC, threshold_id LIMIT 1)"
        for m in ("f1_score", "recall", "precision")
    ),
    "apply_threshold": _s() + "SELECT c_custkey, p, pred FROM s",
    "risk_band": _s()
    + "SELECT c_custkey, p, CASE WHEN p < 0.3::DOUBLE THEN 'Low' WHEN p < 0.7::DOUBLE THEN 'Medium' ELSE 'High' END AS risk_level FROM s",
    "sliced_metrics": _s(_slices("p", "sl"))
    + "SELECT slice, slice_value, n, round(churn_rate, 6) AS churn_rate, round(roc_auc, 6) AS roc_auc, "
    "round(coalesce(tp::DOUBLE / nullif(pos_all, 0), 0), 6) AS recall, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision FROM sl",
    "leaderboard": _s(_RES)
    + "SELECT model_name, round(accuracy, 6) AS accuracy, round(f1_score, 6) AS f1_score, round(precision, 6) AS precision, "
    "round(recall, 6) AS recall, 0.0::DOUBLE AS roc_auc, 'f1_score' AS rank_metric FROM res",
    "leaderboard_by_accuracy": _s(_RES)
    + "SELECT model_name, round(accuracy, 6) AS accuracy, 0.0::DOUBLE AS f1_score, 0.0::DOUBLE AS roc_auc, 0.0::DOUBLE AS precision, "
    "0.0::DOUBLE AS recall, 'accuracy' AS rank_metric FROM res",
    "best_model": _s(_RES)
    + "SELECT model_name, round(accuracy, 6) AS accuracy, round(f1_score, 6) AS f1_score, round(precision, 6) AS precision, "
    "round(recall, 6) AS recall FROM res ORDER BY res.f1_score DESC, model_name LIMIT 1",
    "leaderboard_union": _s(f"{_RES}, {_LAB}")
    + f"""SELECT model_name, round(accuracy, 6) AS accuracy, round(f1_score, 6) AS f1_score, round(precision, 6) AS precision,
            round(recall, 6) AS recall, 0.0::DOUBLE AS roc_auc, 'f1_score' AS rank_metric FROM (
            SELECT * FROM res UNION ALL SELECT 'external ' || lang, {_M['accuracy']}, {_M['f1_score']}, NULL, NULL
            FROM (SELECT lang, {_cells('quality')} FROM lab GROUP BY lang))""",
    "quality_delta": _s(
        f"c AS (SELECT tenure_days > 1700 AS is_ref, {_cells('churn')} FROM s GROUP BY 1), "
        f"m AS (SELECT is_ref, {', '.join(f'{v} AS {k}' for k, v in _M.items())} FROM c)"
    )
    + " UNION ALL ".join(
        f"SELECT '{k}' AS metric, round(r.{k}, 6) AS reference, round(u.{k}, 6) AS current, round(u.{k} - r.{k}, 6) AS delta "
        f"FROM (SELECT * FROM m WHERE is_ref) r, (SELECT * FROM m WHERE NOT is_ref) u"
        for k in _M
    ),
    "promotion_gate": _s(_slices("p", "champ", True) + ", " + _slices("round(1 - p, 6)", "rival", True))
    + _gate("rival", "champ", 0.90, "inverted")
    + " UNION ALL "
    + _gate("champ", "champ", 0.3, "same"),
    "promotion_gate_missing_group": _s(_slices("p", "champ", True))
    + "SELECT f1_ok, auc_ok, groups_ok, promote FROM ("
    + _gate("(SELECT * FROM champ WHERE NOT (slice = 'frequent' AND slice_value = 'Yes'))", "champ", 0.3, "same")
    + ")",
    "scenario_unscored": _s(_SCEN) + _check(f"c_custkey % 3 <> 0 AND ({_PASS})"),
    "label_auc_null_group": f"WITH {_LAB}, own AS (SELECT CASE WHEN n_chars >= 300 THEN lang END AS lang, quality, n_chars FROM lab) "
    f"""SELECT lang, sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg, round({_CELLS_AUC_SAFE}, 6) AS roc_auc FROM (
        SELECT *, sum(neg) OVER (PARTITION BY lang ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg FROM (
          SELECT lang, n_chars AS score, count(*) FILTER (WHERE quality = 1) AS pos, count(*) FILTER (WHERE quality <> 1) AS neg
          FROM own WHERE quality IS NOT NULL GROUP BY 1, 2)) GROUP BY lang""",
    "scenario_check": _s(_SCEN) + _check(_PASS),
    "scenario_check_strict": _s(_SCEN) + _check(_PASS_STRICT),
    "scenario_failures": _s(_SCEN)
    + f"SELECT c_custkey, category, p AS probability, risk_level = expected_risk AS risk_match FROM scen WHERE NOT ({_PASS}) AND category = 'BUILDING'",
}

scored_sql, RESULTS_SQL = _s, _RES
