"""Two-sample drift statistics over one table with a boolean side column.

Numeric features are counted once to ``(feature, value, n_ref, n_cur)`` and
categorical ones likewise; all statistics are read from these counts, so the
raw rows are shuffled once per kind of feature. Spark reuses that exchange for
the split points, the bucket offsets, the running sums and the bin counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from riskweave.functions.labels import (
    PSI_BINS,
    PSI_FLOOR,
    PSI_MAX_CATEGORIES,
    PSI_SIGNIFICANT,
    drift_message,
    psi_level,
)
from riskweave.operators.ks import KS_EXACT_LIMIT, ks_pvalue_exact, ks_pvalue_finite, ks_pvalue_limit
from riskweave.operators.ordered import (
    long_numeric,
    long_text,
    numeric_columns,
    prefix_counts,
    quantile_aggregates,
    quantile_values,
    text_columns,
)

SIDE = "is_ref"
MIN_SIDE_ROWS = 10
MIN_LIVE_ROWS = 50


def pair(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Both samples as one table with the side column ``is_ref``."""
    columns = list(columns or [c for c in reference.columns if c in current.columns])
    return reference.select(*columns, F.lit(True).alias(SIDE)).unionByName(
        current.select(*columns, F.lit(False).alias(SIDE))
    )


def choose_current(dataset: DataFrame, journal: DataFrame | None, split_side: Column) -> tuple[DataFrame, str]:
    """Side table and its source: the journal against the whole data set when
    at least ``MIN_LIVE_ROWS`` rows came in, else two parts of the data set.

    The gate looks at no more than ``MIN_LIVE_ROWS`` rows of the journal.
    """
    if journal is not None and len(journal.select(F.lit(1)).take(MIN_LIVE_ROWS)) >= MIN_LIVE_ROWS:
        return pair(dataset, journal), "live"
    return dataset.withColumn(SIDE, split_side), "split"


def _side_counts(long: DataFrame) -> DataFrame:
    # The (always true) filter makes every consumer need both counts, so that
    # all of them share one shuffle.
    return (
        long.groupBy("feature", "value")
        .agg(F.count_if(SIDE).alias("n_ref"), F.count_if(~F.col(SIDE)).alias("n_cur"))
        .filter("n_ref + n_cur > 0")
    )


def numeric_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, value double, n_ref, n_cur)``; nulls and NaN are dropped."""
    return _side_counts(long_numeric(df, features, [SIDE]).filter(f"{SIDE} is not null"))


def category_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, value string, n_ref, n_cur)``; nulls are dropped."""
    return _side_counts(long_text(df, features, [SIDE]).filter(f"{SIDE} is not null"))


def split_features(df: DataFrame, features: Sequence[str] | None, label: str | None) -> tuple[list[str], list[str]]:
    """Numeric and categorical features among ``features`` (default: all)."""
    skip = {SIDE, label}
    wanted = [c for c in (features or df.columns) if c in df.columns and c not in skip]
    return [c for c in numeric_columns(df) if c in wanted], [c for c in text_columns(df) if c in wanted]


def _share(count: str, total: str) -> Column:
    return F.try_divide(F.col(count).cast("double"), F.col(total).cast("double"))


def _psi_term(ref_share: Column, cur_share: Column) -> Column:
    r = F.greatest(ref_share, F.lit(PSI_FLOOR))
    c = F.greatest(cur_share, F.lit(PSI_FLOOR))
    return (c - r) * F.ln(c / r)


def with_totals(counts: DataFrame) -> DataFrame:
    """Add ``tot_n_ref`` and ``tot_n_cur`` per feature.

    The totals have one row per feature, at most the width of the table, so
    they are broadcast.
    """
    totals = counts.groupBy("feature").agg(F.sum("n_ref").alias("tot_n_ref"), F.sum("n_cur").alias("tot_n_cur"))
    return counts.join(F.broadcast(totals), "feature")


def value_shares(counts: DataFrame) -> DataFrame:
    return with_totals(counts).select(
        "feature",
        "value",
        "n_ref",
        "n_cur",
        _share("n_ref", "tot_n_ref").alias("ref_share"),
        _share("n_cur", "tot_n_cur").alias("cur_share"),
    )


def total_variation(counts: DataFrame) -> DataFrame:
    """Half the L1 distance of the two share vectors, per feature."""
    return (
        with_totals(counts)
        .groupBy("feature")
        .agg((0.5 * F.sum(F.abs(_share("n_ref", "tot_n_ref") - _share("n_cur", "tot_n_cur")))).alias("tv_distance"))
    )


def psi_by_value(counts: DataFrame) -> DataFrame:
    """Stability index over the union of values, per feature."""
    return (
        with_totals(counts)
        .groupBy("feature")
        .agg(F.sum(_psi_term(_share("n_ref", "tot_n_ref"), _share("n_cur", "tot_n_cur"))).alias("psi"))
    )


def numeric_statistics(counts: DataFrame) -> DataFrame:
    """One row per numeric feature: KS, value-wise PSI, moments, bin edges."""
    prefix = prefix_counts(counts, ["feature"], "value", ["n_ref", "n_cur"])
    # the same doubles as a linspace of PSI_BINS + 1 points
    probs = [i * (1.0 / PSI_BINS) for i in range(PSI_BINS)] + [1.0]
    gap = F.abs(_share("cum_n_ref", "tot_n_ref") - _share("cum_n_cur", "tot_n_cur"))
    stats = prefix.groupBy("feature").agg(
        F.max("tot_n_ref").alias("n_ref"),
        F.max("tot_n_cur").alias("n_cur"),
        F.count_if(F.col("n_ref") > 0).alias("distinct_ref"),
        F.max(gap).alias("ks"),
        F.sum(_psi_term(_share("n_ref", "tot_n_ref"), _share("n_cur", "tot_n_cur"))).alias("psi_values"),
        F.try_divide(F.sum(F.col("value") * F.col("n_ref")), F.max("tot_n_ref")).alias("ref_mean"),
        F.try_divide(F.sum(F.col("value") * F.col("n_cur")), F.max("tot_n_cur")).alias("curr_mean"),
        *quantile_aggregates(probs, "value", "cum_n_ref", "tot_n_ref"),
    )
    points = F.expr(f"array_distinct(array({', '.join(quantile_values(len(probs)))}))")
    return stats.select(
        "feature",
        "n_ref",
        "n_cur",
        "distinct_ref",
        "ks",
        "psi_values",
        "ref_mean",
        "curr_mean",
        points.alias("_points"),
    ).select(
        "*",
        # outer edges are open, so only the inner ones are kept
        F.when(
            F.col("distinct_ref") > PSI_MAX_CATEGORIES, F.slice("_points", F.lit(2), F.size("_points") - 2)
        ).alias("edges"),
    ).drop("_points")


def _bin_of(value: str, edges: str) -> Column:
    """Number of inner edges ``<= value`` (at most ``PSI_BINS - 1`` of them)."""
    reached = [f"cast(coalesce(get({edges}, {j}) <= {value}, false) as int)" for j in range(PSI_BINS - 1)]
    return F.expr(" + ".join(reached))


STAT_COLUMNS = ("n_ref", "n_cur", "distinct_ref", "ks", "psi_values", "ref_mean", "curr_mean")


def binned_counts(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """Counts and squared deviations per ``(feature, bin)``, with the feature's
    statistics carried along.

    ``stats`` has one row per feature and is broadcast.
    """
    joined = counts.select("feature", "value", F.col("n_ref").alias("_r"), F.col("n_cur").alias("_c")).join(
        F.broadcast(stats), "feature"
    )
    return joined.groupBy("feature", _bin_of("value", "edges").alias("bin")).agg(
        F.sum("_r").alias("b_ref"),
        F.sum("_c").alias("b_cur"),
        F.sum(F.col("_r") * F.pow(F.col("value") - F.col("ref_mean"), 2)).alias("ss_ref"),
        F.sum(F.col("_c") * F.pow(F.col("value") - F.col("curr_mean"), 2)).alias("ss_cur"),
        *[F.max(c).alias(c) for c in STAT_COLUMNS],
    )


def ks_distances(counts: DataFrame) -> DataFrame:
    """The KS distance alone, ``(feature, n_ref, n_cur, ks)``: no bins, no second
    look at the counts."""
    prefix = prefix_counts(counts, ["feature"], "value", ["n_ref", "n_cur"])
    gap = F.abs(_share("cum_n_ref", "tot_n_ref") - _share("cum_n_cur", "tot_n_cur"))
    return prefix.groupBy("feature").agg(F.max("tot_n_ref").alias("n_ref"), F.max("tot_n_cur").alias("n_cur"), F.max(gap).alias("ks"))


def numeric_report(counts: DataFrame) -> DataFrame:
    """KS, PSI, means and sample deviations per numeric feature (unrounded)."""
    bins = binned_counts(counts, numeric_statistics(counts))
    term = _psi_term(_share("b_ref", "n_ref"), _share("b_cur", "n_cur"))
    # at most PSI_BINS rows per feature from here on
    return bins.groupBy("feature").agg(
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
        F.max("ks").alias("ks"),
        F.max("ref_mean").alias("ref_mean"),
        F.max("curr_mean").alias("curr_mean"),
        F.sqrt(F.try_divide(F.sum("ss_ref"), F.max("n_ref") - 1)).alias("ref_std"),
        F.sqrt(F.try_divide(F.sum("ss_cur"), F.max("n_cur") - 1)).alias("curr_std"),
        F.when(F.max("distinct_ref") > PSI_MAX_CATEGORIES, F.sum(term)).otherwise(F.max("psi_values")).alias("psi"),
    )


def category_report(counts: DataFrame) -> DataFrame:
    """Total variation distance and PSI per categorical feature (unrounded)."""
    ref, cur = _share("n_ref", "tot_n_ref"), _share("n_cur", "tot_n_cur")
    return (
        with_totals(counts)
        .groupBy("feature")
        .agg(
            F.max("tot_n_ref").alias("n_ref"),
            F.max("tot_n_cur").alias("n_cur"),
            (0.5 * F.sum(F.abs(ref - cur))).alias("tv_distance"),
            F.sum(_psi_term(ref, cur)).alias("psi"),
        )
    )


def with_ks_pvalue(report: DataFrame, mode: str = "auto") -> DataFrame:
    """Add ``p_value`` and ``p_method`` (the law that gave it) to a numeric report.

    ``limit``: Kolmogorov's series. ``finite``: the law of one sample of the
    effective size, at any size. ``auto``: the exact two-sample probability when
    both samples have at most ``KS_EXACT_LIMIT`` rows, else ``finite``.
    """
    effective = F.try_divide(F.col("n_ref") * F.col("n_cur"), F.col("n_ref") + F.col("n_cur"))
    if mode == "limit":
        return report.withColumn("p_value", ks_pvalue_limit(F.col("ks"), effective)).withColumn("p_method", F.lit("limit"))
    if mode not in ("auto", "finite"):
        raise ValueError(f"unknown p-value mode {mode!r}")
    small = (F.greatest("n_ref", "n_cur") <= KS_EXACT_LIMIT) if mode == "auto" else F.lit(False)
    # one row per feature: spread the features, then one vectorised call each
    spread = report.repartition("feature")
    exact = ks_pvalue_exact(
        F.when(small, F.col("ks")), F.when(small, F.col("n_ref")), F.when(small, F.col("n_cur"))
    )
    finite = ks_pvalue_finite(F.when(~small, F.col("ks")), F.when(~small, effective))
    return spread.withColumn("_exact", exact).withColumn("_finite", finite).withColumn(
        "p_value", F.when(small, F.col("_exact")).otherwise(F.col("_finite"))
    ).withColumn("p_method", F.when(small, "exact").otherwise("finite")).drop("_exact", "_finite")


def drift_report(
    df: DataFrame,
    features: Sequence[str] | None = None,
    label: str | None = None,
    p_threshold: float = 0.05,
    tv_threshold: float = 0.2,
    p_mode: str = "auto",
    language: str = "en",
    digits: int = 4,
) -> DataFrame:
    """One row per feature: test, statistic, p-value, PSI and the drift flag.

    A feature drifts when its test says so or when its PSI is above 0.25.
    The statistic of categorical features is the total variation distance
    (half the L1 distance of the shares).
    """
    numeric, categorical = split_features(df, features, label)
    parts = []
    null_double = F.lit(None).cast("double")
    if numeric:
        rep = with_ks_pvalue(numeric_report(numeric_counts(df, numeric)), p_mode)
        parts.append(
            rep.select(
                "feature",
                F.lit("numeric").alias("type"),
                F.lit("Kolmogorov-Smirnov").alias("test"),
                F.col("ks").alias("statistic"),
                "p_value",
                (F.col("p_value") < p_threshold).alias("_test_flag"),
                "ref_mean",
                "curr_mean",
                "ref_std",
                "curr_std",
                F.lit(float(p_threshold)).alias("threshold"),
                "psi",
                "n_ref",
                "n_cur",
            )
        )
    if categorical:
        rep = category_report(category_counts(df, categorical))
        parts.append(
            rep.select(
                "feature",
                F.lit("categorical").alias("type"),
                F.lit("Total variation distance").alias("test"),
                F.col("tv_distance").alias("statistic"),
                null_double.alias("p_value"),
                (F.col("tv_distance") > tv_threshold).alias("_test_flag"),
                null_double.alias("ref_mean"),
                null_double.alias("curr_mean"),
                null_double.alias("ref_std"),
                null_double.alias("curr_std"),
                F.lit(float(tv_threshold)).alias("threshold"),
                "psi",
                "n_ref",
                "n_cur",
            )
        )
    if not parts:
        raise ValueError("no feature columns to compare")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    flagged = F.coalesce(F.col("_test_flag"), F.lit(False)) | F.coalesce(F.col("psi") > PSI_SIGNIFICANT, F.lit(False))
    rounded = {
        c: F.round(F.col(c), digits)
        for c in ("statistic", "p_value", "ref_mean", "curr_mean", "ref_std", "curr_std", "psi")
    }
    return (
        rows.withColumn("drift_detected", flagged)
        .withColumn("psi_level", psi_level(F.col("psi"), language))
        .withColumns(rounded)
        .select(
            "feature",
            "type",
            "test",
            "statistic",
            "p_value",
            "drift_detected",
            "ref_mean",
            "curr_mean",
            "ref_std",
            "curr_std",
            "threshold",
            "psi",
            "psi_level",
            "n_ref",
            "n_cur",
        )
    )


def drift_summary(
    report: DataFrame,
    language: str = "en",
    p_threshold: float = 0.05,
    test_size: float | None = 0.2,
    source: str = "split",
    source_label: str | None = None,
) -> DataFrame:
    """One nested row over a report (one row per feature)."""
    columns = [c for c in report.columns if c not in ("n_ref", "n_cur")]
    return report.agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_if("drift_detected").alias("drift_features"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.max("n_ref").alias("reference_size"),
        F.max("n_cur").alias("current_size"),
        F.array_sort(F.collect_list(F.struct(*columns))).alias("results"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))).alias("affected_columns"),
    ).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "total_features",
        "drift_features",
        F.lit(float(p_threshold)).alias("p_threshold"),
        F.lit(PSI_SIGNIFICANT).alias("psi_threshold"),
        "max_psi",
        F.lit(test_size).cast("double").alias("test_size"),
        F.lit(source).alias("source"),
        F.lit(source_label).cast("string").alias("source_label"),
        "reference_size",
        "current_size",
        "results",
        (F.col("drift_features") > 0).alias("alert"),
        drift_message(F.col("drift_features"), language).alias("message"),
        "affected_columns",
    )


def drift_alert(summary: DataFrame) -> DataFrame:
    """The alert row of a summary."""
    return summary.select(
        F.lit("data_drift").alias("alert_type"),
        "timestamp",
        F.col("alert").alias("drift_detected"),
        "affected_columns",
        "message",
    )


def retrain_trigger(report: DataFrame, p_threshold: float = 0.05, tv_threshold: float = 0.2) -> DataFrame:
    """One row: should the model be trained again, and why."""
    psi_hit = F.coalesce(F.col("psi") > PSI_SIGNIFICANT, F.lit(False))
    ks_hit = F.coalesce((F.col("type") == "numeric") & (F.col("p_value") < p_threshold), F.lit(False))
    tv_hit = F.coalesce((F.col("type") == "categorical") & (F.col("statistic") > tv_threshold), F.lit(False))
    return report.agg(
        F.bool_or(psi_hit).alias("psi_trigger"),
        F.bool_or(ks_hit).alias("ks_trigger"),
        F.bool_or(tv_hit).alias("tv_trigger"),
        F.bool_or(psi_hit | ks_hit | tv_hit).alias("retrain"),
    )


def chi_square_fit(counts: DataFrame, p_threshold: float = 0.05) -> DataFrame:
    """Reference counts against current counts as expected frequencies.

    Defined only when both totals agree and no expected count is zero for a
    seen value; otherwise ``status`` says so and the feature is not flagged.
    """
    stats = (
        with_totals(counts)
        .groupBy("feature")
        .agg(
            F.max("tot_n_ref").alias("n_ref"),
            F.max("tot_n_cur").alias("n_cur"),
            (F.count(F.lit(1)) - 1).alias("dof"),
            F.count_if(F.col("n_cur") == 0).alias("_zero"),
            F.sum(F.try_divide(F.pow(F.col("n_ref") - F.col("n_cur"), 2), F.col("n_cur"))).alias("_chi"),
        )
    )
    valid = F.col("n_ref") == F.col("n_cur")
    chi = F.when(valid & (F.col("_zero") > 0), F.lit(float("inf"))).when(valid, F.col("_chi"))
    return (
        stats.withColumn("chi_square", chi)
        .withColumn("status", F.when(valid, "ok").otherwise("could not calculate"))
        .withColumn("p_value", chi_square_pvalue(F.col("chi_square"), F.col("dof")))
        .withColumn("drift_detected", F.coalesce(F.col("p_value") < p_threshold, F.lit(False)))
        .select("feature", "chi_square", "dof", "p_value", "status", "drift_detected", "n_ref", "n_cur")
    )


def chi_square_homogeneity(counts: DataFrame, p_threshold: float = 0.05) -> DataFrame:
    """Pearson test that both samples come from one distribution."""
    total = F.col("n_ref") + F.col("n_cur")
    grand = F.col("tot_n_ref") + F.col("tot_n_cur")
    e_ref = F.try_divide((F.col("tot_n_ref") * total).cast("double"), grand)
    e_cur = F.try_divide((F.col("tot_n_cur") * total).cast("double"), grand)
    term = F.try_divide(F.pow(F.col("n_ref") - e_ref, 2), e_ref) + F.try_divide(F.pow(F.col("n_cur") - e_cur, 2), e_cur)
    return (
        with_totals(counts)
        .groupBy("feature")
        .agg(
            F.max("tot_n_ref").alias("n_ref"),
            F.max("tot_n_cur").alias("n_cur"),
            (F.count(F.lit(1)) - 1).alias("dof"),
            F.sum(term).alias("chi_square"),
        )
        .withColumn("p_value", chi_square_pvalue(F.col("chi_square"), F.col("dof")))
        .withColumn("drift_detected", F.coalesce(F.col("p_value") < p_threshold, F.lit(False)))
        .select("feature", "chi_square", "dof", "p_value", "drift_detected", "n_ref", "n_cur")
    )


def _gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: series below ``a + 1``,
    continued fraction (Lentz) above."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 100_000_000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or tiny)
        c = (b + an / c) or tiny
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return min(1.0, front * h)


@F.pandas_udf(DoubleType())
def chi_square_pvalue(chi: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-square law, the same formula for any degrees of
    freedom. Null for a null statistic or no degree of freedom. The callers
    have one row per feature."""
    values = [
        None if pd.isna(c) or pd.isna(k) or k <= 0 else 0.0 if math.isinf(c) else _gamma_tail(k / 2, c / 2)
        for c, k in zip(chi, dof, strict=True)
    ]
    return pd.Series(values, dtype="float64")



def drift_monitor(df: DataFrame, features: Sequence[str], p_threshold: float = 0.05, p_mode: str = "auto") -> DataFrame:
    """KS for numeric, chi-square fit for categorical features of a list.

    Absent columns and features with an empty side are left out.
    """
    numeric, categorical = split_features(df, features, None)
    parts = []
    if numeric:
        rep = with_ks_pvalue(numeric_report(numeric_counts(df, numeric)), p_mode)
        parts.append(
            rep.filter("n_ref > 0 and n_cur > 0").select(
                "feature",
                F.lit("numeric").alias("type"),
                F.col("ks").alias("statistic"),
                "p_value",
                (F.col("p_value") < p_threshold).alias("drift_detected"),
                F.lit("ok").alias("status"),
                "ref_mean",
                "curr_mean",
                "ref_std",
                "curr_std",
            )
        )
    if categorical:
        rep = chi_square_fit(category_counts(df, categorical), p_threshold)
        empty = F.lit(None).cast("double")
        parts.append(
            rep.filter("n_ref > 0 and n_cur > 0").select(
                "feature",
                F.lit("categorical").alias("type"),
                F.col("chi_square").alias("statistic"),
                "p_value",
                "drift_detected",
                "status",
                empty.alias("ref_mean"),
                empty.alias("curr_mean"),
                empty.alias("ref_std"),
                empty.alias("curr_std"),
            )
        )
    if not parts:
        raise ValueError("none of the listed features is in the table")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def min_rows_gate(df: DataFrame, minimum: int = MIN_SIDE_ROWS) -> DataFrame:
    """One row: rows per side and whether both reach ``minimum``."""
    return df.agg(
        F.count_if(SIDE).alias("n_ref"), F.count_if(~F.col(SIDE)).alias("n_cur")
    ).withColumn("enough", (F.col("n_ref") >= minimum) & (F.col("n_cur") >= minimum))


def source_gate(dataset: DataFrame, journal: DataFrame, minimum: int = MIN_LIVE_ROWS) -> DataFrame:
    """One row: which current sample a report has to use."""
    live = journal.agg(F.count(F.lit(1)).alias("live_rows"))
    return live.withColumn("source", F.when(F.col("live_rows") >= minimum, "live").otherwise("split")).select(
        "live_rows", "source"
    )


def latest(history: DataFrame, timestamp: str, keys: Sequence[str] = ()) -> DataFrame:
    """The newest row (per key): one aggregation, no sort."""
    others = [c for c in history.columns if c not in keys]
    newest = history.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(timestamp, *[o for o in others if o != timestamp])).alias("_row"))
    return newest.select(*keys, *[F.col("_row")[c].alias(c) for c in others])


def current_status(alerts: DataFrame, summaries: DataFrame, language: str = "en") -> DataFrame:
    """One row: the newest alert, else the newest summary, else "no data"."""
    fields = ["timestamp", "drift_detected", "message"]
    nothing = {"en": "No drift data", "ru": "Нет данных о дрейфе"}[language]
    empty = alerts.sparkSession.createDataFrame([(None, False, nothing)], "timestamp string, drift_detected boolean, message string")
    ranked = (
        alerts.select(*fields, F.lit(2).alias("_p"))
        .unionByName(summaries.select("timestamp", F.col("alert").alias("drift_detected"), "message", F.lit(1).alias("_p")))
        .unionByName(empty.select("*", F.lit(0).alias("_p")))
    )
    return ranked.agg(F.max_by(F.struct(*fields), F.struct("_p", "timestamp")).alias("_r")).select("_r.*")


def newest_first(history: DataFrame, timestamp: str, limit: int = 10, tie: Sequence[str] = ()) -> DataFrame:
    return history.orderBy(F.col(timestamp).desc(), *[F.col(t) for t in tie]).limit(limit)

