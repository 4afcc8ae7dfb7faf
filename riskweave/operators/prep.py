"""Imputation, clipping, scaling and category codes with a fit / apply split.

``fit_*`` runs jobs and returns parameters whose size is bounded by the table
width (numbers per column) or a dictionary table; applying parameters is a
projection, so batch and stream share it. Dictionaries stay tables: small ones
become a literal map, large ones a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.binning import tercile_label
from riskweave.functions.encoding import map_encode
from riskweave.operators.ordered import (
    dense_codes,
    exact_quantiles,
    long_numeric,
    long_text,
    numeric_columns,
    text_columns,
)
from riskweave.session import materialize

LITERAL_CODES = 500
NULL_TEXT = "nan"
TERCILES = (1.0 / 3.0, 2.0 / 3.0)


def fit_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], approximate: bool = False) -> dict[str, list[float]]:
    """Quantiles per numeric column; a column without values is left out.

    Exact by default. ``approximate`` trades exactness for one pass without a
    value-level shuffle (relative rank error 1e-4).
    """
    if not columns:
        return {}
    if approximate:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), 10_000).alias(c) for c in columns]).first()
        return {c: list(row[c]) for c in columns if row[c] is not None}
    rows = exact_quantiles(long_numeric(df, columns), ["feature"], "value", probs).collect()
    return {r["feature"]: [r[f"q{i}"] for i in range(len(probs))] for r in rows}


def columns_with_nulls(df: DataFrame) -> set[str]:
    """Columns that hold a null (or NaN), from one pass."""
    kinds = dict(df.dtypes)

    def empty(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNull()

    if not kinds:
        return set()
    row = df.agg(*[F.coalesce(F.bool_or(empty(c)), F.lit(False)).alias(f"_{i}") for i, c in enumerate(kinds)]).first()
    return {c for i, c in enumerate(kinds) if row[f"_{i}"]}


def fit_medians(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> dict[str, float]:
    columns = numeric_columns(df) if columns is None else columns
    return {c: q[0] for c, q in fit_quantiles(df, columns, [0.5], approximate).items()}


def fit_modes(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """Most frequent text per column; the smallest one wins a draw."""
    columns = text_columns(df) if columns is None else columns
    if not columns:
        return {}
    counts = long_text(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_c"))
    best = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("_c"), F.col("value"))).alias("mode"))
    return {r["feature"]: r["mode"] for r in best.collect()}


def impute(df: DataFrame, medians: Mapping[str, float], modes: Mapping[str, str]) -> DataFrame:
    """Fill nulls (and NaN) from fitted values; numbers become doubles."""
    changes = {}
    for c, v in medians.items():
        if c in df.columns:
            x = F.col(c).cast("double")
            changes[c] = F.coalesce(F.when(~F.isnan(x), x), F.lit(float(v)))
    for c, v in modes.items():
        if c in df.columns:
            changes[c] = F.coalesce(F.col(c), F.lit(v))
    return df.withColumns(changes) if changes else df


def bounds_from_quartiles(quartiles: Mapping[str, Sequence[float]], k: float = 1.5) -> dict[str, tuple[float, float]]:
    return {c: (q1 - k * (q3 - q1), q3 + k * (q3 - q1)) for c, (q1, q3) in quartiles.items()}


def fit_clip(df: DataFrame, columns: Sequence[str] | None = None, label: str | None = None, k: float = 1.5) -> dict[str, tuple[float, float]]:
    """IQR bounds per numeric column. The label is never clipped, nor is a
    column the table lacks."""
    columns = numeric_columns(df) if columns is None else [c for c in columns if c in df.columns]
    columns = [c for c in columns if c != label]
    return bounds_from_quartiles(fit_quantiles(df, columns, [0.25, 0.75]), k)


def clip(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Limit values to their bounds; nulls stay null."""
    changes = {}
    for c, (low, high) in bounds.items():
        if c in df.columns:
            x = F.col(c).cast("double")
            changes[c] = F.when(x < low, low).when(x > high, high).otherwise(x)
    return df.withColumns(changes) if changes else df


def fit_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column (nulls ignored), one pass."""
    if not columns:
        return {}
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns) if row[f"m{i}"] is not None}


def standard_scale(df: DataFrame, stats: Mapping[str, tuple[float, float]]) -> DataFrame:
    """``(x - mean) / std``; a constant column is only centred."""
    changes = {
        c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in stats.items() if c in df.columns
    }
    return df.withColumns(changes) if changes else df


def sorted_dictionary(df: DataFrame, columns: Sequence[str], null_text: str | None = NULL_TEXT) -> DataFrame:
    """``(feature, value, code, n)``, codes by ascending text. Null counts as
    the text ``null_text`` (or is left out when that is None); ``n`` is how
    often the value itself occurs, so the mode needs no second look at the rows.
    """
    marked = df.select(
        *[F.col(c).cast("string").alias(c) for c in columns]
        if null_text is None
        else [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n" + null_text)).alias(c) for c in columns]
    )
    values = long_text(marked, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    if null_text is not None:
        real = F.when(F.substring("value", 1, 1) == "v", F.col("n")).otherwise(0)
        values = values.groupBy("feature", F.expr("substring(value, 2)").alias("value")).agg(F.sum(real).alias("n"))
        values = values.filter("n >= 0")
    return materialize(dense_codes(values, ["feature"], "value").select("feature", "value", "code", "n"), "dictionary")


def modes_of_dictionary(dictionary: DataFrame) -> dict[str, str]:
    best = (
        dictionary.filter("n > 0")
        .groupBy("feature")
        .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    )
    return {r["feature"]: r["mode"] for r in best.collect()}


def first_seen_dictionary(df: DataFrame, columns: Sequence[str], order_key: str) -> DataFrame:
    """``(feature, value, code)``, codes by first appearance along ``order_key``
    (unique per row). Nulls are left out."""
    first = (
        long_text(df, columns, [order_key])
        .groupBy("feature", "value")
        .agg(F.min(order_key).alias("_first"))
        .filter("_first is not null")
    )
    coded = dense_codes(first, ["feature"], "_first").select("feature", "value", "code")
    return materialize(coded, "dictionary")


def literal_codes(dictionary: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, int] | None]:
    """Map per column, or None where there are more than ``LITERAL_CODES``
    values. Codes are dense, so one bounded fetch answers both questions."""
    maps: dict[str, dict[str, int] | None] = {c: {} for c in columns}
    for r in dictionary.filter((F.col("code") <= LITERAL_CODES) & F.col("feature").isin(list(columns))).collect():
        if r["code"] == LITERAL_CODES:
            maps[r["feature"]] = None
        elif maps[r["feature"]] is not None:
            maps[r["feature"]][r["value"]] = r["code"]
    return maps


def apply_dictionary(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Sequence[str],
    null_text: str | None = None,
    default: int = 0,
    maps: Mapping[str, dict[str, int] | None] | None = None,
) -> DataFrame:
    """Replace texts by codes; unseen values and nulls get ``default``.

    Columns with at most ``LITERAL_CODES`` entries use a literal map inside one
    projection. Larger ones are joined; the dictionary has unique keys, the
    planner picks broadcast or a skew-safe merge join from its real size.
    """
    maps = literal_codes(dictionary, columns) if maps is None else maps

    def text(c: str):
        value = F.col(c).cast("string")
        return value if null_text is None else F.coalesce(value, F.lit(null_text))

    order = df.columns
    small = {c: map_encode(text(c), maps[c], default) for c in columns if maps.get(c) is not None}
    out = df.withColumns(small) if small else df
    for c in columns:
        if c in small:
            continue
        codes = dictionary.filter(F.col("feature") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
        out = (
            out.join(codes, text(c) == F.col("_v"), "left")
            .withColumn(c, F.coalesce(F.col("_code"), F.lit(default)).cast("int"))
            .drop("_v", "_code")
        )
    return out.select(*order)


def encode_sorted(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Codes by ascending text; returns the table and its dictionary."""
    columns = text_columns(df) if columns is None else [c for c in columns if c in df.columns]
    dictionary = sorted_dictionary(df, columns)
    return apply_dictionary(df, dictionary, columns, NULL_TEXT), dictionary


def encode_first_seen(df: DataFrame, columns: Sequence[str], order_key: str) -> tuple[DataFrame, DataFrame]:
    dictionary = first_seen_dictionary(df, columns, order_key)
    return apply_dictionary(df, dictionary, columns), dictionary


def fit_terciles(df: DataFrame, column: str) -> tuple[float, float] | None:
    """The two cuts; None for a column without values."""
    q = fit_quantiles(df, [column], TERCILES).get(column)
    return (q[0], q[1]) if q else None


def with_tercile(df: DataFrame, column: str, cuts: tuple[float, float] | None, name: str) -> DataFrame:
    if cuts is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    return df.withColumn(name, tercile_label(F.col(column), F.lit(cuts[0]), F.lit(cuts[1])))


def row_sum(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Sum of the columns that exist; null counts as 0."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    total = F.coalesce(F.col(present[0]), F.lit(0))
    for c in present[1:]:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return df.withColumn(name, total)


@dataclass
class Preprocessor:
    """Fitted preprocessing: imputation, category codes, scaling, column order.

    ``mappings`` gives explicit codes for some text columns; the others get
    codes by sorted text. Applying imputes from the fitted values, or from the
    batch itself with ``impute_from="batch"``.
    """

    mappings: dict[str, dict[str, int]] = field(default_factory=dict)
    label: str | None = None
    numeric: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    feature_names: list[str] = field(default_factory=list)
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    dictionary: DataFrame | None = None
    codes: dict[str, dict[str, int] | None] = field(default_factory=dict)

    def fit(self, df: DataFrame, label: str | None = "Target") -> Preprocessor:
        self.label = label
        self.text = text_columns(df, [label] if label else [])
        self.numeric = numeric_columns(df, [label] if label else [])
        self.feature_names = [c for c in df.columns if c != label]
        # three independent jobs that share the cluster; one look at the texts
        # gives both the codes and the modes
        with ThreadPoolExecutor(max_workers=3) as pool:
            medians = pool.submit(fit_medians, df, self.numeric)
            scale = pool.submit(fit_scale, df, self.numeric)
            texts = pool.submit(sorted_dictionary, df, self.text) if self.text else None
            self.medians, self.scale = medians.result(), scale.result()
            self.dictionary = texts.result() if texts else None
        if self.dictionary is not None:
            self.modes = modes_of_dictionary(self.dictionary)
            self.codes = literal_codes(self.dictionary, [c for c in self.text if c not in self.mappings])
        return self

    def transform(self, df: DataFrame, impute_from: str = "fitted", keep: Sequence[str] = ()) -> DataFrame:
        """Features in fitted order; ``keep`` carries further columns along."""
        if not self.feature_names:
            raise ValueError("not fitted")
        missing = [c for c in self.feature_names if c not in df.columns]
        if missing:
            raise ValueError(f"required columns are absent: {missing}")
        if impute_from == "batch":
            medians, modes = fit_medians(df, self.numeric), fit_modes(df, self.text)
        elif impute_from == "fitted":
            medians, modes = self.medians, self.modes
        else:
            raise ValueError("impute_from is 'fitted' or 'batch'")
        out = impute(df, medians, modes)
        mapped = {c: map_encode(F.col(c), m) for c, m in self.mappings.items() if c in self.text}
        if mapped:
            out = out.withColumns(mapped)
        coded = [c for c in self.text if c not in self.mappings]
        if coded and self.dictionary is not None:
            out = apply_dictionary(out, self.dictionary, coded, maps=self.codes)
        return standard_scale(out, self.scale).select(*keep, *self.feature_names)

    def fit_transform(self, df: DataFrame, label: str | None = "Target") -> DataFrame:
        return self.fit(df, label).transform(df)

    def save(self, spark: SparkSession, path: str) -> None:
        """Parameter tables: ``columns``, ``codes`` and ``dictionary``."""
        rows = []
        for i, c in enumerate(self.feature_names):
            kind = "numeric" if c in self.numeric else "text" if c in self.text else "other"
            mean, std = self.scale.get(c, (None, None))
            rows.append((i, c, kind, c in self.mappings, self.medians.get(c), self.modes.get(c), mean, std, self.label))
        spark.createDataFrame(
            rows,
            "position int, feature string, kind string, mapped boolean, median double, mode string, "
            "mean double, std double, label string",
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
        codes = [(c, v, k) for c, m in self.mappings.items() for v, k in m.items()]
        spark.createDataFrame(codes, "feature string, value string, code int").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/codes"
        )
        dictionary = self.dictionary
        if dictionary is None:
            dictionary = spark.createDataFrame([], "feature string, value string, code bigint, n bigint")
        dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        made = cls()
        for r in spark.read.parquet(f"{path}/columns").orderBy("position").collect():
            c = r["feature"]
            made.label = r["label"]
            made.feature_names.append(c)
            if r["kind"] == "numeric":
                made.numeric.append(c)
                if r["median"] is not None:
                    made.medians[c] = r["median"]
                if r["mean"] is not None:
                    made.scale[c] = (r["mean"], r["std"])
            elif r["kind"] == "text":
                made.text.append(c)
                if r["mode"] is not None:
                    made.modes[c] = r["mode"]
            if r["mapped"]:
                made.mappings[c] = {}
        for r in spark.read.parquet(f"{path}/codes").collect():
            made.mappings.setdefault(r["feature"], {})[r["value"]] = r["code"]
        made.dictionary = spark.read.parquet(f"{path}/dictionary")
        made.codes = literal_codes(made.dictionary, [c for c in made.text if c not in made.mappings])
        return made
