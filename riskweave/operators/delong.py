"""Whether one score ranks worse than another, per group, with its sampling error.

The area under the ROC curve is a mean over positive rows of the share of
negative rows below them (ties half), and likewise over negative rows. The
sample variances of these shares give the variance of the area; their
covariances over the rows that two scores share give that of a difference.
Shares come from running counts of the distinct scores, so nothing is compared
pair by pair, and rows with equal scores are one row with a count.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.encoding import nan_to_null
from riskweave.operators.ordered import prefix_counts
from riskweave.operators.quality import grouped_quality, unpivot_slices


def _shares(counts: DataFrame, keys: Sequence[str], score: str, name: str) -> DataFrame:
    """``(keys, score)`` with the share of the other class that a row of it beats."""
    own = counts.groupBy(*keys, score).agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    prefix = prefix_counts(own, keys, score, ["_pos", "_neg"])
    below = F.col("cum__neg") - F.col("_neg") + F.col("_neg") / 2.0
    above = F.col("tot__pos") - F.col("cum__pos") + F.col("_pos") / 2.0
    return prefix.select(
        *keys, score, F.try_divide(below, F.col("tot__neg")).alias(f"{name}_of_pos"), F.try_divide(above, F.col("tot__pos")).alias(f"{name}_of_neg")
    )


def auc_difference(df: DataFrame, label: str, old: str, new: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, n_pos, n_neg, auc_old, auc_new, delta, se_new, se_delta, z)``.

    Rows without a label or without one of the scores take no part. Errors are
    null where a class has fewer than two rows; z is null where the difference
    has no error and 0 where it is none.
    """
    keys = list(keys)
    a, b = nan_to_null(F.col(old).cast("double")), nan_to_null(F.col(new).cast("double"))
    rows = df.where(F.col(label).isNotNull()).select(*keys, (F.col(label) == 1).alias("_y"), a.alias("_a"), b.alias("_b")).where("_a is not null and _b is not null")
    counts = rows.groupBy(*keys, "_a", "_b").agg(F.count_if("_y").alias("pos"), F.count_if(~F.col("_y")).alias("neg"))
    joined = counts
    for score, name in (("_a", "a"), ("_b", "b")):
        shares = _shares(counts, keys, score, name).withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)} | {score: "_score"})
        same = F.col(score) == F.col("_score")
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        joined = joined.join(shares, same).drop("_score", *[f"_k{i}" for i in range(len(keys))])
    sums = []
    for side in ("pos", "neg"):
        x, y = F.col(f"a_of_{side}"), F.col(f"b_of_{side}")
        for name, value in (("a", x), ("b", y), ("aa", x * x), ("bb", y * y), ("ab", x * y)):
            sums.append(F.sum(F.col(side) * value).alias(f"{side}_{name}"))
    found = joined.groupBy(*keys).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), *sums)

    def spread(side: str, of: str) -> Column:
        """Sample covariance of the shares of a class, over its number of rows."""
        n = F.col(f"n_{side}")
        first, second = (F.col(f"{side}_{c}") for c in of)
        both = F.when(n > 1, (F.col(f"{side}_{of}") - first * second / n) / (n - 1))
        return both / n

    variance = {of: spread("pos", of) + spread("neg", of) for of in ("aa", "bb", "ab")}
    of_delta = F.greatest(F.lit(0.0), variance["aa"] + variance["bb"] - 2.0 * variance["ab"])
    out = found.select(
        *keys,
        "n_pos",
        "n_neg",
        F.try_divide(F.col("pos_a"), F.col("n_pos")).alias("auc_old"),
        F.try_divide(F.col("pos_b"), F.col("n_pos")).alias("auc_new"),
        F.sqrt(F.greatest(F.lit(0.0), variance["bb"])).alias("se_new"),
        F.sqrt(of_delta).alias("se_delta"),
    )
    out = out.withColumns({c: F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col(c)) for c in ("auc_old", "auc_new")})
    delta = F.col("auc_new") - F.col("auc_old")
    # differences of equal scores are rounding
    z = F.when(F.abs(delta) < 1e-12, 0.0).otherwise(F.when(F.col("se_delta") > 1e-12, delta / F.col("se_delta")))
    return out.select(*keys, "n_pos", "n_neg", "auc_old", "auc_new", delta.alias("delta"), "se_new", "se_delta", z.alias("z"))


def tested_gate(
    df: DataFrame, label: str, old: str, new: str, slices: dict[str, Column], threshold: float, min_auc: float = 0.90, alpha: float = 0.05
) -> DataFrame:
    """Whether the new score may replace the old one: overall F1 not lower,
    overall AUC at least ``min_auc``, and in no group an AUC that is lower beyond
    chance (one-sided, level ``alpha``). ``worse`` names the groups that fail; a
    group whose error is unknown cannot fail."""
    long = unpivot_slices(df, {"all": F.lit("all"), **slices}, [label, old, new])
    keys = ["slice", "slice_value"]
    compared = auc_difference(long, label, old, new, keys)
    overall = F.col("slice") == "all"
    whole = df.select(label, old, new, F.lit("all").alias("slice"))
    f1 = [grouped_quality(whole, ["slice"], label, s, threshold).select(F.col("f1_score").alias(f"f1_{n}")).scalar() for s, n in ((old, "old"), (new, "new"))]
    critical = NormalDist().inv_cdf(alpha)
    worse = ~overall & (F.col("z") < critical)
    verdict = compared.agg(
        F.max(F.when(overall, F.col("auc_new"))).alias("auc_new"),
        F.array_sort(F.collect_list(F.when(worse, F.concat_ws("=", *keys)))).alias("worse"),  # names of groups
    )
    verdict = verdict.select("auc_new", "worse", f1[0].alias("f1_old"), f1[1].alias("f1_new"))
    rules = {
        "f1_ok": F.coalesce(F.col("f1_new") >= F.col("f1_old"), F.lit(False)),
        "auc_ok": F.coalesce(F.col("auc_new") >= min_auc, F.lit(False)),
        "groups_ok": F.size("worse") == 0,
    }
    return verdict.select(*[r.alias(n) for n, r in rules.items()], (rules["f1_ok"] & rules["auc_ok"] & rules["groups_ok"]).alias("promote"), "worse")
