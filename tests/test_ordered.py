import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.functions.binning import right_closed_band, uniform_grid_position
from riskweave.operators.ordered import dense_codes, exact_quantiles, prefix_counts, with_bucket
from riskweave.operators.quality import THRESHOLDS


@pytest.mark.parametrize("cells", [1, 3, 64, 512])
def test_prefix_sums_do_not_depend_on_the_split_points(spark, cells):
    rng = np.random.default_rng(cells)
    rows = {(g, float(v)): int(c) for g in "ab" for v, c in zip(rng.normal(size=200).round(2), rng.integers(1, 9, 200))}
    df = spark.createDataFrame([(g, v, c) for (g, v), c in rows.items()], "g string, v double, c bigint")
    got = {(r["g"], r["v"]): (r["cum_c"], r["tot_c"]) for r in prefix_counts(df, ["g"], "v", ["c"], cells).collect()}
    assert len(got) == len(rows)
    for (g, v), (cum, tot) in got.items():
        assert cum == sum(c for (h, w), c in rows.items() if h == g and w <= v)
        assert tot == sum(c for (h, _), c in rows.items() if h == g)


@pytest.mark.parametrize("n", [1, 2, 5, 30, 101])
def test_quantiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = rng.normal(size=n).round(1)
    probs = [0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9, 1]
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    row = exact_quantiles(df, ["g"], "v", probs).first()
    assert row["n"] == n
    for i, p in enumerate(probs):
        assert row[f"q{i}"] == np.quantile(values, p)


def test_dense_codes_of_texts(spark):
    words = ["pear", "Apple", "apple", "fig", "Ωmega", "éclair", "", "z" * 50]
    df = spark.createDataFrame([("f", w) for w in words], "feature string, value string")
    got = {r["value"]: r["code"] for r in dense_codes(df, ["feature"], "value").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


def test_null_groups_keep_their_order(spark):
    df = spark.createDataFrame([(g, k, v, 1) for g in ("a", None) for k in (1, None) for v in range(30)], "g string, k int, v int, c bigint")
    rows = prefix_counts(df, ["g", "k"], "v", ["c"]).collect()
    assert len(rows) == 120 and all(r["cum_c"] == r["v"] + 1 and r["tot_c"] == 30 for r in rows)


def test_buckets_are_even_and_grow(spark):
    """No bucket holds much more than its share of many distinct values."""
    from riskweave.operators.ordered import cells_of, split_points

    df = spark.range(200_000).select(F.xxhash64("id").alias("v"))
    assert cells_of(df) >= 512
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1000")
        assert cells_of(df) == 4000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    edges = split_points(df, [], "v", 512)
    sizes = with_bucket(df.crossJoin(F.broadcast(edges)), "v", 512).groupBy("_bucket").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 3.5 * 200_000 / 512 and sizes[1] >= 450


def test_binary_search(spark):
    edges = [0.5, 1.0, 1.0, 2.5]
    df = spark.createDataFrame([(float(v) / 4,) for v in range(-4, 16)], "v double")
    rows = with_bucket(df.withColumn("_edges", F.array(*[F.lit(e) for e in edges])), "v", 16).collect()
    assert all(r["_bucket"] == sum(e <= r["v"] for e in edges) for r in rows)


def test_threshold_position(spark):
    values = [0.0, 0.05, 0.1, 0.35, 0.89, 0.9, 1.0, *THRESHOLDS, *[np.nextafter(t, 0) for t in THRESHOLDS]]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for r in df.select("v", uniform_grid_position(F.col("v"), THRESHOLDS).alias("k")).collect():
        assert r["k"] == sum(t <= r["v"] for t in THRESHOLDS)


def test_right_closed_bands(spark):
    df = spark.createDataFrame([(0.0,), (25.0,), (25.5,), (100.0,), (101.0,), (None,)], "v double")
    got = [r[0] for r in df.select(right_closed_band(F.col("v"), [0, 25, 100], ["a", "b"])).collect()]
    assert got == [None, "a", "b", "b", None, None]
