"""Order statistics without a one-task sort.

Everything that needs a global order per group (KS distance, AUC, ROC points,
exact quantiles, dense codes) goes through :func:`prefix_counts`:

1.  the caller groups the rows to one row per ``(group, value)``, so a heavily
    repeated value is already a single row with a count;
2.  split points are picked by hash (one value per hash cell, then every
    ``EVERY``-th of them in order), which is deterministic and independent of
    the physical partitioning; they only balance the work, any set of split
    points gives the same result;
3.  bucket totals give exclusive offsets (one row per group and bucket);
4.  a running sum inside ``(group, bucket)`` plus the offset is the global sum.

The split points are shared by all groups. There are ``CELLS`` of them, or four
per shuffle partition where that is more, so the parallelism grows with the
cluster's setting. A bucket spans the ``EVERY`` gaps between picked values, whose
sum is far more even than a single gap: the largest holds about three times
``1 / cells`` of the distinct values. Groups with a null key are groups like any
other: rows meet by a structure of the keys, in which nulls are equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS, EVERY = 512, 8


def cells_of(df: DataFrame) -> int:
    return max(CELLS, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def split_points(values: DataFrame, keys: Sequence[str], value: str, cells: int = CELLS) -> DataFrame:
    """One row: a sorted array of at most ``cells`` values."""
    digest = F.xxhash64(*keys, value)
    picked = values.groupBy(F.pmod(digest, F.lit(cells * EVERY)).alias("_cell")).agg(
        F.min_by(value, digest).alias("_value")
    )
    # bounded: one value per cell
    everything = F.array_sort(F.collect_list("_value"))
    return picked.agg(everything.alias("_all")).select(F.filter("_all", lambda v, i: i % EVERY == EVERY - 1).alias("_edges"))


def with_bucket(df: DataFrame, value: str, cells: int) -> DataFrame:
    """Add ``_bucket``: how many entries of the sorted ``_edges`` are ``<= value``.

    A binary search with one projection per halving. Each position is used
    twice by the next one, so Catalyst keeps the projections apart and fuses
    them in generated code; the array itself is never copied. Past the end the
    lookup is null and the position stays. The result is never null, so a join
    on it adds no null filter that would be pushed to the raw rows.
    """
    out = df.withColumn("_bucket", F.lit(0))
    for step in [1 << j for j in range(max(cells.bit_length(), 1) - 1, -1, -1)]:
        out = out.withColumn(
            "_bucket",
            F.expr(f"_bucket + case when get(_edges, _bucket + {step - 1}) <= `{value}` then {step} else 0 end"),
        )
    return out


def prefix_counts(
    grouped: DataFrame,
    keys: Sequence[str],
    value: str,
    counts: Sequence[str],
    cells: int | None = None,
) -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` and group totals ``tot_<c>``.

    ``grouped`` holds one row per ``(keys, value)``; the value must not be null.
    The order is ascending in ``value``.
    """
    cells = cells or cells_of(grouped)
    columns = grouped.columns
    if keys:
        grouped = grouped.withColumn("_g", F.struct(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]))
        keys = ["_g"]
    keys = list(keys)
    edges = split_points(grouped, keys, value, cells).scalar()
    bucketed = with_bucket(grouped.select("*", edges.alias("_edges")), value, cells).drop("_edges")
    # one exchange serves the totals, the join and the window; the (always true)
    # test of the largest value makes the totals need the same columns
    bucketed = bucketed.repartition(*keys, "_bucket")
    totals = (
        bucketed.groupBy(*keys, "_bucket")
        .agg(F.max(value).alias("_top"), *[F.sum(c).alias(f"_t_{c}") for c in counts])
        .filter("_top is not null")
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in counts],
        *[F.sum(f"_t_{c}").over(whole).alias(f"tot_{c}") for c in counts],
    )
    inside = (
        Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = bucketed.join(offsets, [*keys, "_bucket"])
    return joined.select(
        *columns,
        *[(F.sum(c).over(inside) + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in counts],
        *[f"tot_{c}" for c in counts],
    )


def quantile_aggregates(probs: Sequence[float], value: str, cum: str, total: str) -> list[Column]:
    """Aggregates for linear-interpolated quantiles of a prefix table.

    Per probability ``i``: the two order statistics ``_l<i>`` and ``_h<i>`` and
    the weight ``_f<i>``; :func:`quantile_values` combines them.
    """
    made = []
    for i, prob in enumerate(probs):
        position = f"(({total} - 1) * {float(prob)!r}D)"
        made += [
            F.expr(f"min(case when {cum} > floor({position}) then {value} end) as _l{i}"),
            F.expr(f"min(case when {cum} > least(floor({position}) + 1, {total} - 1) then {value} end) as _h{i}"),
            F.expr(f"max({position} - floor({position})) as _f{i}"),
        ]
    return made


def quantile_values(n: int) -> list[str]:
    """SQL text of the ``n`` interpolated values of :func:`quantile_aggregates`."""
    return [
        f"case when _f{i} < 0.5D then _l{i} + (_h{i} - _l{i}) * _f{i} "
        f"else _h{i} - (_h{i} - _l{i}) * (1.0D - _f{i}) end"
        for i in range(n)
    ]


def quantiles_of_prefix(prefix: DataFrame, keys: Sequence[str], value: str, count: str, probs: Sequence[float]) -> DataFrame:
    """``(keys, n, q0, q1, ...)`` from a prefix table."""
    aggregates = quantile_aggregates(probs, f"`{value}`", f"cum_{count}", f"tot_{count}")
    stats = prefix.groupBy(*keys).agg(F.max(f"tot_{count}").alias("n"), *aggregates)
    values = [F.expr(f"{text} as q{i}") for i, text in enumerate(quantile_values(len(probs)))]
    return stats.select(*keys, "n", *values)


def exact_quantiles(rows: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles per group: ``(keys, n, q0, ...)``."""
    counted = (
        rows.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_c"))
        .filter(F.col("_c") > 0)
    )
    return quantiles_of_prefix(prefix_counts(counted, keys, value, ["_c"]), keys, value, "_c", probs)


def long_numeric(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, feature, value double)`` without nulls and NaN."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    long = df.selectExpr(*[f"`{k}`" for k in keep], f"stack({len(columns)}, {pairs}) as (feature, value)")
    return long.filter("feature is not null and value is not null and not isnan(value)")


def long_text(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, feature, value string)`` without nulls."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    long = df.selectExpr(*[f"`{k}`" for k in keep], f"stack({len(columns)}, {pairs}) as (feature, value)")
    return long.filter("feature is not null and value is not null")


def dense_codes(distinct_values: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Code 0, 1, 2, ... of each row by ``order`` within ``keys``."""
    counted = distinct_values.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = prefix_counts(counted, keys, order, ["_one"])
    return ranked.select(*distinct_values.columns, (F.col("cum__one") - 1).cast("bigint").alias("code"))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    from pyspark.sql.types import NumericType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    from pyspark.sql.types import StringType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]
