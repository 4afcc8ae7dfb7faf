"""Classifier quality from scored rows ``(y, p)``, optionally per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.binning import uniform_grid_position
from riskweave.functions.encoding import nan_to_null
from riskweave.operators.ordered import prefix_counts

# fixed values: the doubles of an arange from 0.1 with step 0.01
_STEP = (0.1 + 0.01) - 0.1
THRESHOLDS = [0.1 + i * _STEP for i in range(80)]
DEFAULT_THRESHOLD = 0.5
METRICS = ("accuracy", "f1_score", "roc_auc", "precision", "recall")


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def metrics_of_counts(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    return {
        "accuracy": _zero(F.try_divide(tp + tn, tp + fp + fn + tn)),
        "precision": _zero(F.try_divide(tp, tp + fp)),
        "recall": _zero(F.try_divide(tp, tp + fn)),
        "f1_score": _zero(F.try_divide(2 * tp, 2 * tp + fp + fn)),
    }


def confusion_counts(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    y, q = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y & q).alias("tp"),
        F.count_if(~y & q).alias("fp"),
        F.count_if(y & ~q).alias("fn"),
        F.count_if(~y & ~q).alias("tn"),
    )


def binary_metrics(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1; an empty denominator gives 0."""
    counts = confusion_counts(df, label, prediction, keys)
    m = metrics_of_counts(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return counts.select(*keys, "n", "tp", "fp", "fn", "tn", *[c.alias(k) for k, c in m.items()])


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Four rows, empty cells included."""
    one = confusion_counts(df, label, prediction)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    structs = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n")) for a, p, c in cells
    ]
    return one.select(F.explode(F.array(*structs)).alias("_c")).select("_c.*")


def _score_counts(df: DataFrame, label: str, score: str, keys: Sequence[str]) -> DataFrame:
    """One row per (group, score); a null key is a group of its own, NaN scores
    count as missing. The filter keeps both counts alive in every consumer so
    that all of them share one shuffle."""
    value = nan_to_null(F.col(score).cast("double"))
    return (
        df.filter(value.isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, value.alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
        .filter("pos + neg > 0")
    )


def roc_auc(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with mid-ranks for ties; null for one class."""
    prefix = prefix_counts(_score_counts(df, label, score, keys), keys, "score", ["pos", "neg"])
    below = F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0
    return prefix.groupBy(*keys).agg(
        F.max("tot_pos").alias("n_pos"),
        F.max("tot_neg").alias("n_neg"),
        F.try_divide(
            F.sum(F.col("pos") * below), F.max("tot_pos").cast("double") * F.max("tot_neg")
        ).alias("roc_auc"),
    )


def roc_curve(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(threshold, tpr, fpr)`` for every distinct score (``p >= threshold``)."""
    prefix = prefix_counts(_score_counts(df, label, score, keys), keys, "score", ["pos", "neg"])
    tp = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    return prefix.select(
        *keys,
        F.col("score").alias("threshold"),
        F.try_divide(tp.cast("double"), F.col("tot_pos").cast("double")).alias("tpr"),
        F.try_divide(fp.cast("double"), F.col("tot_neg").cast("double")).alias("fpr"),
    )


def threshold_sweep(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Quality at each of the 80 thresholds, from one pass over the rows.

    Rows are counted by how many thresholds they reach (81 buckets a group);
    a reverse running sum over the buckets gives the counts per threshold.
    """
    keys = list(keys)
    placed = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *keys,
        uniform_grid_position(F.col(score).cast("double"), THRESHOLDS).alias("_b"),
        (F.col(label) == 1).cast("int").alias("_y"),
    )
    counts = placed.groupBy(*keys, "_b").agg(
        F.sum("_y").cast("bigint").alias("_pos"), F.sum(1 - F.col("_y")).cast("bigint").alias("_neg")
    )
    # an array with one entry per bucket: 81 small structs a group
    filled = counts.groupBy(*keys).agg(
        F.sum("_pos").alias("_P"),
        F.sum("_neg").alias("_N"),
        F.collect_list(F.struct("_b", "_pos", "_neg")).alias("_cells"),
    )
    points = filled.select(
        "*", F.posexplode(F.array(*[F.lit(t) for t in THRESHOLDS])).alias("threshold_id", "threshold")
    )

    def reached(name: str) -> Column:
        return F.aggregate(
            F.filter("_cells", lambda c: c["_b"] > F.col("threshold_id")),
            F.lit(0).cast("bigint"),
            lambda acc, c: acc + c[name],
        )

    counted = points.select(
        *keys,
        "threshold_id",
        "threshold",
        reached("_pos").alias("tp"),
        reached("_neg").alias("fp"),
        "_P",
        "_N",
    )
    m = metrics_of_counts(F.col("tp"), F.col("fp"), F.col("_P") - F.col("tp"), F.col("_N") - F.col("fp"))
    return counted.select(*keys, "threshold_id", "threshold", "tp", "fp", *[c.alias(k) for k, c in m.items()])


def best_threshold(sweep: DataFrame, metric: str | Sequence[str] = "f1_score", keys: Sequence[str] = ()) -> DataFrame:
    """First threshold with the highest score; 0.5 when every score is 0.

    Several metrics are answered in one aggregation, one row each.
    """
    names = [metric] if isinstance(metric, str) else list(metric)
    best = sweep.groupBy(*keys).agg(
        *[
            F.max_by(F.struct("threshold", F.col(m).alias("score")), F.struct(F.col(m), -F.col("threshold_id"))).alias(f"_{m}")
            for m in names
        ]
    )
    rows = F.explode(
        F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"_{m}").alias("b")) for m in names])
    )
    score = F.col("_m.b.score")
    return best.select(*keys, rows.alias("_m")).select(
        *keys,
        "_m.metric",
        F.when(score > 0, F.col("_m.b.threshold")).otherwise(DEFAULT_THRESHOLD).alias("threshold"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )


def unpivot_slices(df: DataFrame, slices: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    """Each row once per slicing: ``(slice, slice_value, keep)``."""
    structs = [F.struct(F.lit(n).alias("slice"), c.cast("string").alias("slice_value")) for n, c in slices.items()]
    return df.select(*keep, F.explode(F.array(*structs)).alias("_s")).select("_s.*", *keep)


def grouped_quality(df: DataFrame, keys: Sequence[str], label: str, score: str, threshold: Column | float) -> DataFrame:
    """Every metric per group from one ordered pass over the distinct scores.

    ``threshold`` is a number or an expression over the keys.
    """
    keys = list(keys)
    prefix = prefix_counts(_score_counts(df, label, score, keys), keys, "score", ["pos", "neg"])
    below = F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0
    hit = F.col("score") >= threshold
    sums = prefix.groupBy(*keys).agg(
        F.max("tot_pos").alias("n_pos"),
        F.max("tot_neg").alias("n_neg"),
        F.sum(F.col("pos") * below).alias("_u"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("fp"),
    )
    m = metrics_of_counts(F.col("tp"), F.col("fp"), F.col("n_pos") - F.col("tp"), F.col("n_neg") - F.col("fp"))
    n = F.col("n_pos") + F.col("n_neg")
    return sums.select(
        *keys,
        n.alias("n"),
        F.try_divide(F.col("n_pos").cast("double"), n.cast("double")).alias("churn_rate"),
        F.try_divide(F.col("_u"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("roc_auc"),
        *[c.alias(k) for k, c in m.items()],
    )


def sliced_metrics(df: DataFrame, slices: dict[str, Column], label: str, score: str, threshold: float) -> DataFrame:
    """Size, label share, AUC, recall and precision per customer group."""
    long = unpivot_slices(df, slices, [label, score])
    return grouped_quality(long, ["slice", "slice_value"], label, score, threshold).select(
        "slice", "slice_value", "n", "churn_rate", "roc_auc", "recall", "precision"
    )


def quality_delta(df: DataFrame, label: str, prediction: str, side: str = "is_ref") -> DataFrame:
    """Reference and current quality side by side, one row per metric."""
    parts = {True: "ref", False: "cur"}
    aggregates = []
    for flag, tag in parts.items():
        here = F.col(side) == flag
        y, q = F.col(label) == 1, F.col(prediction) == 1
        aggregates += [
            F.count_if(here & y & q).alias(f"{tag}_tp"),
            F.count_if(here & ~y & q).alias(f"{tag}_fp"),
            F.count_if(here & y & ~q).alias(f"{tag}_fn"),
            F.count_if(here & ~y & ~q).alias(f"{tag}_tn"),
        ]
    one = df.agg(*aggregates)
    by_tag = {
        tag: metrics_of_counts(*[F.col(f"{tag}_{c}") for c in ("tp", "fp", "fn", "tn")]) for tag in parts.values()
    }
    structs = [
        F.struct(
            F.lit(name).alias("metric"), by_tag["ref"][name].alias("reference"), by_tag["cur"][name].alias("current")
        )
        for name in ("accuracy", "f1_score", "precision", "recall")
    ]
    return (
        one.select(F.explode(F.array(*structs)).alias("_m"))
        .select("_m.*")
        .withColumn("delta", F.col("current") - F.col("reference"))
    )


def leaderboard(results: DataFrame) -> DataFrame:
    """Models, best first: by F1, or by accuracy where there is no F1 column.
    Metrics the table lacks are 0."""
    rank = "f1_score" if "f1_score" in results.columns else "accuracy"
    if rank not in results.columns:
        raise ValueError("results need f1_score or accuracy")
    missing = [m for m in METRICS if m not in results.columns]
    return (
        results.select("*", *[F.lit(0.0).alias(m) for m in missing])
        .withColumn("rank_metric", F.lit(rank))
        .orderBy(F.col(rank).desc_nulls_last(), "model_name")
    )


def best_model(results: DataFrame, metric: str = "f1_score", tie: str = "model_name") -> DataFrame:
    """The row with the highest metric; the smallest ``tie`` wins a draw."""
    others = F.struct(*results.columns)
    top = results.filter(F.col(metric).isNotNull()).agg(
        F.min_by(others, F.struct(-F.col(metric), F.col(tie))).alias("_r")
    )
    return top.select("_r.*")


def merge_results(ours: DataFrame, external: DataFrame) -> DataFrame:
    return leaderboard(ours.unionByName(external, allowMissingColumns=True))


def promotion_gate(
    challenger: DataFrame, champion: DataFrame, min_auc: float = 0.90, group_tolerance: float = 0.05
) -> DataFrame:
    """Whether a challenger may replace the champion.

    Both tables: ``(slice, slice_value, f1_score, roc_auc)``, where the row
    ``('all', 'all')`` holds the overall quality. Rules: overall F1 not lower,
    overall AUC at least ``min_auc``, no group more than ``group_tolerance``
    below the champion's F1. A group of the champion that the challenger lacks,
    or has no F1 for, fails.
    """
    new = challenger.select(
        F.col("slice").alias("_slice"), F.col("slice_value").alias("_value"), F.col("f1_score").alias("f1_new"), F.col("roc_auc").alias("auc_new")
    )
    joined = champion.select("slice", "slice_value", F.col("f1_score").alias("f1_old")).join(
        new, F.col("slice").eqNullSafe(F.col("_slice")) & F.col("slice_value").eqNullSafe(F.col("_value")), "left"
    )
    overall = F.col("slice") == "all"

    def holds(rule: Column) -> Column:
        return F.when(F.col("f1_old").isNotNull(), F.coalesce(rule, F.lit(False)))

    return joined.agg(
        F.coalesce(F.bool_and(F.when(overall, holds(F.col("f1_new") >= F.col("f1_old")))), F.lit(False)).alias("f1_ok"),
        F.coalesce(F.bool_and(F.when(overall, F.coalesce(F.col("auc_new") >= min_auc, F.lit(False)))), F.lit(False)).alias("auc_ok"),
        F.coalesce(
            F.bool_and(F.when(~overall, holds(F.col("f1_new") >= F.col("f1_old") - group_tolerance))), F.lit(True)
        ).alias("groups_ok"),
    ).withColumn("promote", F.col("f1_ok") & F.col("auc_ok") & F.col("groups_ok"))


def scenario_results(scenarios: DataFrame, scores: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Expected against actual: adds ``passed`` and ``risk_match``.

    The upper limit decides when there is one, else the lower limit; with
    ``strict`` both are checked. A limit of 0 counts as absent, as does null.
    The risk level is informative only. A scenario without a score fails.
    """
    joined = scenarios.join(scores, key, "left")
    upper = F.col("probability_max").isNotNull() & (F.col("probability_max") != 0)
    lower = F.col("probability_min").isNotNull() & (F.col("probability_min") != 0)
    upper_ok = ~upper | (F.col("probability") <= F.col("probability_max"))
    lower_ok = ~lower | (F.col("probability") >= F.col("probability_min"))
    passed = (upper_ok & lower_ok) if strict else F.when(upper, upper_ok).otherwise(lower_ok)
    return joined.withColumn("passed", F.col("probability").isNotNull() & F.coalesce(passed, F.lit(False))).withColumn(
        "risk_match", F.col("risk_level") == F.col("expected_risk")
    )


def scenario_check(results: DataFrame, category: str) -> DataFrame:
    """Totals and pass rate (whole percent) per category."""
    passed = F.count_if("passed")
    total = F.count(F.lit(1))
    return results.groupBy(category).agg(
        total.alias("total"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.floor(passed * 100.0 / total + 0.5).cast("bigint").alias("pass_rate"),
    )


def filter_results(results: DataFrame, wanted: str, type_column: str = "category") -> DataFrame:
    """Rows of one scenario type, or only passed / failed ones, or ``all``."""
    if wanted == "pass":
        return results.filter("passed")
    if wanted == "fail":
        return results.filter("not passed")
    return results if wanted == "all" else results.filter(F.col(type_column) == wanted)
