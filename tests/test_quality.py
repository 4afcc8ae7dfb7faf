import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import quality


def scored(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


def brute_auc(y, p):
    y, p = np.array(y), np.array(p)
    pos, neg = p[y == 1], p[y == 0]
    return float(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))


def test_known_metrics(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 1, 0.6), (1, 1, 0.8), (1, 1, 0.9)], "y int, q int, p double")
    m = quality.binary_metrics(df, "y", "q").first()
    assert (m["accuracy"], m["recall"]) == (0.75, 1.0) and m["precision"] == pytest.approx(2 / 3)
    assert quality.roc_auc(df, "y", "p").first()["roc_auc"] == 1.0
    cells = {(r["actual"], r["predicted"]): r["n"] for r in quality.confusion_matrix(df, "y", "q").collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 2}


def test_prediction_monitor_numbers(spark):
    rows = [(y, q) for q, y in zip([0, 1, 1, 0] * 10, [0, 1, 0, 0] * 10)]
    m = quality.binary_metrics(spark.createDataFrame(rows, "y int, q int"), "y", "q").first()
    assert (m["accuracy"], m["precision"], m["recall"]) == (0.75, 0.5, 1.0)


def test_zero_divisions(spark):
    df = spark.createDataFrame([(0, 0)], "y int, q int")
    m = quality.binary_metrics(df, "y", "q").first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1_score"]) == (1.0, 0.0, 0.0, 0.0)
    assert quality.roc_auc(scored(spark, [1, 1], [0.2, 0.3]), "y", "p").first()["roc_auc"] is None


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_auc_with_ties(spark, digits):
    rng = np.random.default_rng(digits)
    y = rng.integers(0, 2, 300)
    p = (0.3 * y + rng.random(300)).round(digits)
    df = scored(spark, y, p)
    auc = quality.roc_auc(df, "y", "p").first()["roc_auc"]
    assert auc == pytest.approx(brute_auc(y, p), abs=1e-12)
    flipped = quality.roc_auc(df.withColumn("p", -F.col("p")), "y", "p").first()["roc_auc"]
    assert flipped == pytest.approx(1 - auc, abs=1e-12)


def test_curve_area_equals_auc(spark):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 200)
    p = (0.4 * y + rng.random(200)).round(1)
    df = scored(spark, y, p)
    points = sorted((r["fpr"], r["tpr"]) for r in quality.roc_curve(df, "y", "p").collect())
    x, t = zip(*[(0.0, 0.0), *points])
    assert np.trapezoid(t, x) == pytest.approx(quality.roc_auc(df, "y", "p").first()["roc_auc"])


def test_threshold_choice(spark):
    df = scored(spark, [0, 0, 0, 1, 1, 1], [0.1, 0.2, 0.35, 0.4, 0.7, 0.9])
    best = quality.best_threshold(quality.threshold_sweep(df, "y", "p")).first()
    assert best["score"] == 1.0 and 0.35 < best["threshold"] <= 0.4
    none = quality.best_threshold(quality.threshold_sweep(scored(spark, [0, 0], [0.5, 0.6]), "y", "p")).first()
    assert (none["threshold"], none["score"]) == (0.5, 0.0)


def test_sweep_against_brute_force(spark):
    rng = np.random.default_rng(4)
    y, p = rng.integers(0, 2, 250), rng.random(250).round(2)
    rows = quality.threshold_sweep(scored(spark, y, p), "y", "p").orderBy("threshold_id").collect()
    assert len(rows) == 80 and [r["threshold"] for r in rows] == quality.THRESHOLDS
    assert quality.THRESHOLDS[31] == 0.4099999999999998
    for r in rows:
        hit = p >= r["threshold"]
        assert (r["tp"], r["fp"]) == (int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()))


def test_slices_match_single_runs(spark):
    rng = np.random.default_rng(6)
    rows = [(int(a), float(b), "hot" if i % 3 else "cold") for i, (a, b) in enumerate(zip(rng.integers(0, 2, 300), rng.random(300).round(2)))]
    df = spark.createDataFrame(rows, "y int, p double, g string")
    got = {r["slice_value"]: r for r in quality.sliced_metrics(df, {"g": F.col("g")}, "y", "p", 0.4).collect()}
    for g in ("hot", "cold"):
        part = [(y, p) for y, p, h in rows if h == g]
        assert got[g]["n"] == len(part)
        assert got[g]["roc_auc"] == pytest.approx(brute_auc(*zip(*part)))
        tp = sum(y for y, p in part if p >= 0.4)
        assert got[g]["recall"] == pytest.approx(tp / sum(y for y, _ in part))


def test_leaderboard_and_best(spark):
    df = spark.createDataFrame([("Forest", 0.95, 0.70), ("Boosting", 0.90, 0.80)], "model_name string, accuracy double, f1_score double")
    top = quality.leaderboard(df).first()
    assert top["model_name"] == "Boosting" and top["rank_metric"] == "f1_score" and top["recall"] == 0.0
    by_accuracy = quality.leaderboard(df.drop("f1_score")).first()
    assert by_accuracy["model_name"] == "Forest" and by_accuracy["rank_metric"] == "accuracy"
    assert quality.best_model(df).first()["model_name"] == "Boosting"
    external = spark.createDataFrame([("Auto", 0.85)], "model_name string, f1_score double")
    assert quality.merge_results(df, external).first()["model_name"] == "Auto"


def test_promotion_rules(spark):
    schema = "slice string, slice_value string, f1_score double, roc_auc double"
    champion = spark.createDataFrame([("all", "all", 0.8, 0.95), ("g", "a", 0.7, 0.9)], schema)

    def decide(rows):
        return quality.promotion_gate(spark.createDataFrame(rows, schema), champion).first()["promote"]

    assert decide([("all", "all", 0.8, 0.9), ("g", "a", 0.66, 0.9)])
    assert not decide([("all", "all", 0.79, 0.95), ("g", "a", 0.7, 0.9)])
    assert not decide([("all", "all", 0.85, 0.89), ("g", "a", 0.7, 0.9)])
    assert not decide([("all", "all", 0.85, 0.95), ("g", "a", 0.6, 0.9)])
    # a group that the challenger lacks, or has no number for, fails
    assert not decide([("all", "all", 0.85, 0.95)])
    assert not decide([("all", "all", 0.85, 0.95), ("g", "a", None, 0.9)])


def test_scenarios(spark):
    s = spark.createDataFrame(
        [("pos_1", "positive", "Low", None, 0.3), ("neg_1", "negative", "High", 0.7, None), ("edge_1", "edge", "Low", 0.5, 0.9),
         ("edge_2", "edge", "Low", None, 0.0)],
        "id string, category string, expected_risk string, probability_min double, probability_max double",
    )
    scores = spark.createDataFrame([("pos_1", 0.2, "Low"), ("neg_1", 0.6, "Medium"), ("edge_1", 0.1, "Low"), ("edge_2", 0.9, "High")],
                                   "id string, probability double, risk_level string")
    loose = {r["id"]: r["passed"] for r in quality.scenario_results(s, scores, "id").collect()}
    assert loose == {"pos_1": True, "neg_1": False, "edge_1": True, "edge_2": True}
    strict = {r["id"]: r["passed"] for r in quality.scenario_results(s, scores, "id", strict=True).collect()}
    assert strict["edge_1"] is False
    totals = {r["category"]: (r["total"], r["pass_rate"]) for r in quality.scenario_check(quality.scenario_results(s, scores, "id"), "category").collect()}
    assert totals == {"positive": (1, 100), "negative": (1, 0), "edge": (2, 100)}
    assert quality.filter_results(quality.scenario_results(s, scores, "id"), "fail").count() == 1
    # without a score a scenario fails and still counts
    few = quality.scenario_results(s, scores.filter("id <> 'edge_2'"), "id")
    assert few.count() == 4 and not {r["id"]: r["passed"] for r in few.collect()}["edge_2"]


def test_null_groups_and_nan_scores(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), (None, 1, 0.2), (None, 0, 0.8), (None, 1, 0.9), ("a", 1, float("nan"))]
    df = spark.createDataFrame(rows, "g string, y int, p double")
    got = {r["g"]: (r["n_pos"], r["n_neg"], r["roc_auc"]) for r in quality.roc_auc(df, "y", "p", ["g"]).collect()}
    assert got == {"a": (1, 1, 1.0), None: (2, 1, 0.5)}
