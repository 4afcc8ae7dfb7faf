"""Profiles and exploratory tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.binning import right_closed_band
from riskweave.functions.encoding import nan_to_null
from riskweave.operators.ordered import exact_quantiles, long_numeric, numeric_columns
from riskweave.session import broadcast_if_small

AGE_EDGES = [0, 25, 35, 45, 55, 100]
AGE_LABELS = ["18-25", "26-35", "36-45", "46-55", "55+"]


def _rows_of(one_row: DataFrame, fields: dict[str, list[str]], key: str) -> DataFrame:
    """Turn a one-row aggregate into one row per entry.

    ``fields`` maps an output column to the list of aggregate columns, in the
    order of ``fields[key]`` which holds literal names.
    """
    structs = []
    for i, name in enumerate(fields[key]):
        parts = [F.lit(name).alias(key)]
        parts += [F.col(cols[i]).alias(out) for out, cols in fields.items() if out != key]
        structs.append(F.struct(*parts))
    return one_row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Names in ``required`` that the table lacks (schema only, no job)."""
    return [c for c in required if c not in df.columns]


def validate_columns(df: DataFrame, required: Sequence[str]) -> tuple[bool, list[str]]:
    missing = missing_columns(df, required)
    return not missing, missing


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``(column_name, present, n_rows, n_null)`` of each required column; an
    absent one counts as null in every row."""
    nulls = [F.count_if(F.col(c).isNull()) if c in df.columns else F.count(F.lit(1)) for c in required]
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[n.alias(f"_{i}") for i, n in enumerate(nulls)])
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(c in df.columns).alias("present"), F.col("_n").alias("n_rows"), F.col(f"_{i}").alias("n_null"))
            for i, c in enumerate(required)
        ]
    )
    return one.select(F.inline(entries))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, max_ratio: float = 0.5) -> DataFrame:
    columns = list(columns or df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    long = _rows_of(
        one,
        {"column_name": columns, "n_null": [f"_{i}" for i in range(len(columns))], "n_rows": ["_n"] * len(columns)},
        "column_name",
    )
    ratio = F.coalesce(F.try_divide(F.col("n_null").cast("double"), F.col("n_rows").cast("double")), F.lit(0.0))
    return long.select(
        "column_name", "n_rows", "n_null", ratio.alias("null_ratio"), (ratio < max_ratio).alias("acceptable")
    )


def range_check(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows outside the trained range per column (nulls are not counted)."""
    names = list(ranges)
    aggregates = []
    for i, c in enumerate(names):
        low, high = ranges[c]
        aggregates.append(F.count(c).alias(f"_n{i}"))
        aggregates.append(F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(f"_o{i}"))
    one = df.agg(*aggregates)
    return _rows_of(
        one,
        {
            "column_name": names,
            "n_values": [f"_n{i}" for i in range(len(names))],
            "n_outside": [f"_o{i}" for i in range(len(names))],
        },
        "column_name",
    ).withColumn("in_range", F.col("n_outside") == 0)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Counts and shares; null is not a value. The total is a one-row subquery
    over the counted values, not over the rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", (F.col("n").cast("double") / total).alias("share"))


def group_rate(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("churn_rate"))


def rate_by_band(df: DataFrame, value: str, label: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Mean label per right-closed band; empty bands stay with a null rate.

    The band list has a fixed handful of rows and is broadcast.
    """
    bands = df.sparkSession.createDataFrame(
        [(i, b) for i, b in enumerate(labels)], "band_id int, band string"
    )
    rates = (
        df.withColumn("band", right_closed_band(F.col(value), edges, labels))
        .filter("band is not null")
        .groupBy("band")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("churn_rate"))
    )
    return bands.join(rates, "band", "left").select(
        "band_id", "band", F.coalesce("n", F.lit(0)).alias("n"), "churn_rate"
    )


def rate_by_category(df: DataFrame, columns: Sequence[str], label: str, high: float = 0.4) -> DataFrame:
    """Label rate of every value of several columns in one pass."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    long = df.selectExpr(f"`{label}` as _y", f"stack({len(columns)}, {pairs}) as (feature, value)")
    return (
        long.filter("value is not null")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("churn_rate"))
        .withColumn("high_risk", F.col("churn_rate") > high)
    )


def segment_profile(df: DataFrame, segments: dict[str, Column], label: str) -> DataFrame:
    """Size and rate per group of several segmentations (grouping sets)."""
    prepared = df.select(*[c.alias(name) for name, c in segments.items()], F.col(label).alias("_y"))
    sets = [[F.col(name)] for name in segments]
    grouped = prepared.groupingSets(sets, *[F.col(n) for n in segments]).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_y").alias("churn_rate"),
        *[F.grouping(n).alias(f"_g_{n}") for n in segments],
    )
    name = F.coalesce(*[F.when(F.col(f"_g_{n}") == 0, F.lit(n)) for n in segments])
    value = F.coalesce(*[F.when(F.col(f"_g_{n}") == 0, F.col(n).cast("string")) for n in segments])
    return grouped.select(name.alias("segment"), value.alias("segment_value"), "n", "churn_rate")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed; empties kept.
    NaN counts as null."""
    df = df.select(nan_to_null(F.col(column).cast("double")).alias(column))
    limits = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    bounds = limits.select(F.struct("lo", "hi").alias("b")).scalar()
    placed = df.select(F.col(column).cast("double").alias("_v"), bounds.alias("_b")).filter("_v is not null")
    width = (F.col("_b.hi") - F.col("_b.lo")) / bins
    bin_id = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col("_v") - F.col("_b.lo"), width)).cast("int"))
    )
    counts = placed.groupBy(bin_id.alias("bin_id")).agg(F.count(F.lit(1)).alias("n"))
    grid = limits.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin_id"))
    step = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, "bin_id", "left").select(
        "bin_id",
        (F.col("lo") + step * F.col("bin_id")).alias("bin_low"),
        (F.col("lo") + step * (F.col("bin_id") + 1)).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles and whiskers (furthest data within 1.5 IQR) per group."""
    rows = df.select(group, nan_to_null(F.col(value).cast("double")).alias("_v")).filter("_v is not null")
    quartiles = exact_quantiles(rows, [group], "_v", [0.25, 0.5, 0.75]).select(
        F.col(group).alias("_group"), "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    spread = F.col("q3") - F.col("q1")
    inside = F.col("_v").between(F.col("q1") - 1.5 * spread, F.col("q3") + 1.5 * spread)
    counted = rows.groupBy(group, "_v").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 0")
    return (
        counted.join(broadcast_if_small(quartiles), F.col(group).eqNullSafe(F.col("_group")))
        .groupBy(group)
        .agg(
            F.max("n").alias("n"),
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.sum(F.when(~inside, F.col("_c")).otherwise(0)).alias("n_outliers"),
        )
    )


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Upper triangle (with diagonal) of the Pearson matrix, in one pass."""
    columns = list(columns or numeric_columns(df))
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    structs = [
        F.struct(F.lit(a).alias("left_col"), F.lit(b).alias("right_col"), F.col(f"_{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    structs += [F.struct(F.lit(c).alias("left_col"), F.lit(c).alias("right_col"), F.lit(1.0).alias("corr")) for c in columns]
    return one.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def corr_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """|corr(feature, target)|, largest first."""
    one = df.agg(*[F.corr(c, target).alias(f"_{i}") for i, c in enumerate(columns)])
    long = _rows_of(
        one, {"feature": list(columns), "corr": [f"_{i}" for i in range(len(columns))]}, "feature"
    )
    return long.withColumn("abs_corr", F.abs("corr")).orderBy(F.col("abs_corr").desc_nulls_last(), "feature")


def distinct_profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column.

    Exact mode groups ``(column, value)`` first, so no task holds a set of all
    values of a column; ``approximate`` uses a sketch in one pass.
    """
    if approximate:
        one = df.agg(*[F.approx_count_distinct(c).alias(f"_{i}") for i, c in enumerate(columns)])
        return _rows_of(
            one, {"column_name": list(columns), "n_distinct": [f"_{i}" for i in range(len(columns))]}, "column_name"
        )
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, value)")
    return (
        long.groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("_c"))
        .groupBy("column_name")
        .agg(F.count("value").alias("n_distinct"))
    )


def kde_grid(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian density on an even grid from min to max.

    Bandwidth is ``n^(-1/5)`` sample deviations. Rows are counted per value
    first; each counted value adds its kernel to a fixed number of grid points,
    summed map-side.
    """
    values = (
        df.select(F.col(column).cast("double").alias("_v"))
        .filter("_v is not null")
        .groupBy("_v")
        .agg(F.count(F.lit(1)).alias("_c"))
        .filter("_c > 0")
    )
    stats = df.agg(
        F.count(column).cast("double").alias("n"),
        F.stddev_samp(F.col(column).cast("double")).alias("sd"),
        F.min(F.col(column).cast("double")).alias("lo"),
        F.max(F.col(column).cast("double")).alias("hi"),
    )
    s = stats.select(F.struct("n", "sd", "lo", "hi").alias("s")).scalar()
    placed = values.select("_v", "_c", s.alias("_s")).select(
        "_v", "_c", "_s", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point_id")
    )
    width = F.col("_s.sd") * F.pow(F.col("_s.n"), F.lit(-0.2))
    x = F.col("_s.lo") + (F.col("_s.hi") - F.col("_s.lo")) * F.col("point_id") / (points - 1)
    z = (x - F.col("_v")) / width
    kernel = F.col("_c") * F.exp(-0.5 * z * z) / (F.col("_s.n") * width * F.sqrt(F.lit(2.0) * F.pi()))
    return placed.groupBy("point_id", x.alias("x")).agg(F.sum(kernel).alias("density"))


def kde_binned(df: DataFrame, column: str, points: int = 200, cells: int = 2048, reach: float = 6.0) -> DataFrame:
    """The density of :func:`kde_grid` for columns of very many values.

    Each row's weight is divided between the two nearest of ``cells`` even nodes,
    so whatever the number of values there are at most ``cells`` rows; the kernel
    is cut at ``reach`` bandwidths. With node distance d and bandwidth h the
    result is off by at most ``error_bound``: d^2 / (8 h^3 sqrt(2 pi)) from the
    division and the kernel's value at its cut.
    """
    v = F.col(column).cast("double")
    value = F.when(~F.isnan(v), v)
    s = df.agg(
        F.count(value).cast("double").alias("n"), F.stddev_samp(value).alias("sd"), F.min(value).alias("lo"), F.max(value).alias("hi")
    ).select(F.struct("n", "sd", "lo", "hi").alias("s")).scalar()
    at = (F.col("_v") - F.col("_s.lo")) / (F.col("_s.hi") - F.col("_s.lo")) * (cells - 1)
    placed = df.select(value.alias("_v"), s.alias("_s")).where("_v is not null and _s.hi > _s.lo").select("_s", at.alias("_at"))
    lower = F.least(F.floor("_at"), F.lit(cells - 2)).cast("int")
    both = F.array(
        F.struct(lower.alias("node"), (lower + 1 - F.col("_at")).alias("w")), F.struct((lower + 1).alias("node"), (F.col("_at") - lower).alias("w"))
    )
    nodes = placed.select("_s", F.inline(both)).groupBy("_s", "node").agg(F.sum("w").alias("w"))
    h = F.col("_s.sd") * F.pow(F.col("_s.n"), F.lit(-0.2))
    span = F.col("_s.hi") - F.col("_s.lo")
    step = span / (cells - 1)
    # the grid points within reach of a node
    ratio = F.lit((points - 1) / (cells - 1))
    near = reach * h / span * (points - 1)
    first = F.greatest(F.lit(0), F.ceil(F.col("node") * ratio - near)).cast("int")
    last = F.least(F.lit(points - 1), F.floor(F.col("node") * ratio + near)).cast("int")
    sent = nodes.select("_s", "node", "w", F.explode(F.when(first <= last, F.sequence(first, last))).alias("point_id"))
    # every point has a row, also where no value is near
    empty = nodes.select("_s").distinct().select("_s", F.lit(0).alias("node"), F.lit(0.0).alias("w"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point_id"))
    sent = sent.unionByName(empty)
    x = F.col("_s.lo") + span * F.col("point_id") / (points - 1)
    z = (x - F.col("_s.lo") - step * F.col("node")) / h
    root = math.sqrt(2.0 * math.pi)
    error = step * step / (8.0 * h * h * h * root) + math.exp(-0.5 * reach * reach) / (h * root)
    return sent.groupBy("point_id", x.alias("x"), error.alias("error_bound")).agg(
        F.sum(F.col("w") * F.exp(-0.5 * z * z) / (F.col("_s.n") * h * root)).alias("density")
    ).select("point_id", "x", "density", "error_bound")


def table_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and missing cells in one row."""
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + F.col(c).isNull().cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.coalesce(F.sum(nulls), F.lit(0)).alias("n_missing"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight ``n / (k * n_c)`` and the ratio to the first class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.struct(
            F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"), F.min_by("n", label).alias("first")
        ).alias("t")
    ).scalar()
    joined = counts.select(label, "n", totals.alias("_t"))
    weight = F.col("_t.rows").cast("double") / (F.col("_t.classes") * F.col("n"))
    return joined.select(
        label,
        "n",
        weight.alias("class_weight"),
        (F.col("_t.first").cast("double") / F.col("n")).alias("ratio_to_first"),
    )


def outlier_counts(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Rows outside ``[Q1 - k*IQR, Q3 + k*IQR]`` per column.

    Works on the counted values; the quartile table has one row per column.
    """
    long = long_numeric(df, columns)
    counted = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 0")
    quartiles = exact_quantiles(long, ["feature"], "value", [0.25, 0.75])
    spread = F.col("q1") - F.col("q0")
    low, high = F.col("q0") - k * spread, F.col("q1") + k * spread
    return (
        counted.join(F.broadcast(quartiles.select("feature", "q0", "q1")), "feature")
        .groupBy("feature")
        .agg(
            F.max(low).alias("lower_bound"),
            F.max(high).alias("upper_bound"),
            F.sum(F.when((F.col("value") < low) | (F.col("value") > high), F.col("_c")).otherwise(0)).alias("n_outliers"),
        )
    )
