import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import functions as F

from riskweave.operators import boosting, kernels, quality, training


def vectors(spark, x, y=None):
    rows = [(i, [float(v) for v in r], float(y[i]) if y is not None else 0.0) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, x array<double>, label double").repartition(3)
    return df.withColumn("features", array_to_vector("x"))


def auc(model, df):
    scored = training.add_score(df, model, "p").select(F.col("label").cast("int").alias("y"), "p")
    return quality.roc_auc(scored, "y", "p").first()["roc_auc"]


def test_products_are_the_kernel(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 5))
    gamma = 0.3
    made = kernels.FourierFeatures(inputCol="features", outputCol="z", dimensions=4096, gamma=gamma).transform(vectors(spark, x))
    rows = made.select("id", vector_to_array("z").alias("z")).orderBy("id").collect()
    z = np.array([r["z"] for r in rows])
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert z.shape == (60, 4096)
    assert np.abs(z @ z.T - exact).max() < 0.09 and np.abs(z @ z.T - exact).mean() < 0.015


def test_gamma_follows_the_spread(spark):
    x = np.random.default_rng(1).normal(size=(200, 4)) * [1, 2, 3, 4] + [5, 0, 0, 1]
    assert kernels.scale_gamma(vectors(spark, x), "features") == pytest.approx(1 / (4 * x.var()))
    assert kernels.scale_gamma(vectors(spark, np.ones((3, 2))), "features") == 1.0
    assert kernels.scale_gamma(vectors(spark, np.ones((0, 2))), "features") == 1.0


@pytest.mark.parametrize("kind", ["rings", "xor"])
def test_kernel_machine_where_a_line_fails(spark, kind, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, size=(900, 2))
    y = (x[:, 0] * x[:, 1] > 0) if kind == "xor" else ((x**2).sum(1) < 0.55)
    df = vectors(spark, x, y.astype(float))
    train, test = df.where("id < 600"), df.where("id >= 600")
    model = kernels.kernel_svc("features", "label", 128, maxIter=40, regParam=1e-4).fit(train)
    line = LinearSVC(featuresCol="features", labelCol="label", maxIter=30).fit(train)
    assert auc(model, test) > 0.95
    assert abs(auc(line, test) - 0.5) < 0.15
    # a saved machine holds no matrix and scores the same
    model.write().overwrite().save(str(tmp_path / "svc"))
    loaded = DefaultParamsReader.loadParamsInstance(str(tmp_path / "svc"), spark)
    before, after = (dict((r["id"], r["p"]) for r in training.add_score(test, m, "p").select("id", "p").collect()) for m in (model, loaded))
    assert before == pytest.approx(after)
    assert set(training.add_score(test, model, "p").columns) == {*test.columns, "p"}


def plain_boosting(x, y, w, edges, rounds, depth, step, reg, least):
    """Trees by brute force over rows; returns margins."""
    margin = np.zeros(len(x))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - y) * w, p * (1 - p) * w

        def grow(rows, level):
            total = g[rows].sum() ** 2 / (h[rows].sum() + reg)
            best = None
            for f in range(x.shape[1]):
                v = x[rows, f]
                seen = np.unique(np.searchsorted(edges[f], v[~np.isnan(v)], side="right"))
                for b in seen:
                    for nulls in (True, False):
                        if nulls and b == seen[-1]:
                            continue
                        left = np.where(np.isnan(v), nulls, np.searchsorted(edges[f], np.nan_to_num(v), side="right") <= b)
                        gl, hl, gr, hr = g[rows][left].sum(), h[rows][left].sum(), g[rows][~left].sum(), h[rows][~left].sum()
                        if min(hl, hr) < least:
                            continue
                        gain = round(0.5 * (gl**2 / (hl + reg) + gr**2 / (hr + reg) - total), 9)
                        key = (-gain, f, b, not nulls)
                        if gain > 0 and (best is None or key < best[0]):
                            best = (key, left)
            if level == depth or best is None:
                margin[rows] -= step * g[rows].sum() / (h[rows].sum() + reg)
                return
            grow(rows[best[1]], level + 1)
            grow(rows[~best[1]], level + 1)

        grow(np.arange(len(x)), 0)
    return margin


def test_trees_equal_brute_force_with_nulls_and_weights(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(300, 3)), 1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0)).astype(float)
    x[rng.random(300) < 0.15, 1] = np.nan
    df = vectors(spark, x, y)
    spec = boosting.SecondOrderBoosting(maxIter=11, maxDepth=3, stepSize=0.4, scalePosWeight=2.5, maxBins=8, minChildWeight=0.5)
    model = spec.fit(df)
    values = vector_to_array("features")
    edges = boosting.quantile_edges(df, [values[i] for i in range(3)], 8)
    want = plain_boosting(x, y, np.where(y == 1, 2.5, 1.0), edges, 11, 3, 0.4, 1.0, 0.5)
    got = [r["m"] for r in model.transform(df).select("id", vector_to_array("rawPrediction")[1].alias("m")).orderBy("id").collect()]
    assert got == pytest.approx(list(want), abs=1e-7)


def test_model_is_saved_whole_learns_and_explains(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, size=(600, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    df = vectors(spark, x, y)
    model = boosting.SecondOrderBoosting(maxIter=12, maxDepth=4, subsamplingRate=0.8, featureRate=0.7).fit(df.where("id < 400"))
    assert auc(model, df.where("id >= 400")) > 0.95
    share = model.featureImportances.toArray()
    assert share.sum() == pytest.approx(1) and share[2] < min(share[:2])
    model.write().overwrite().save(str(tmp_path / "b"))
    loaded = DefaultParamsReader.loadParamsInstance(str(tmp_path / "b"), spark)
    assert loaded.nodes() == model.nodes()
    again = boosting.SecondOrderBoosting(maxIter=12, maxDepth=4, subsamplingRate=0.8, featureRate=0.7).fit(df.where("id < 400"))
    assert again.nodes() == model.nodes()


def test_one_class_and_no_rows(spark):
    same = vectors(spark, np.ones((5, 2)), np.ones(5))
    model = boosting.SecondOrderBoosting(maxIter=2, maxDepth=2).fit(same)
    assert all(set(t) == {1} and t[1]["value"] > 0 for t in model.nodes())
    empty = same.where("id < 0")
    assert boosting.SecondOrderBoosting(maxIter=2).fit(empty).transform(same).select("prediction").distinct().collect()[0][0] == 0.0


def test_equal_rows_are_one_and_a_level_is_summed_by_tasks(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(40, 2)), 1)
    x[::7, 1] = np.nan
    y = (x[:, 0] > 0).astype(float)
    df = vectors(spark, np.tile(x, (30, 1)), np.tile(y, 30))
    seen = []
    grow = boosting.SecondOrderBoosting._grow
    spec = boosting.SecondOrderBoosting(maxIter=2, maxDepth=2, maxBins=64)
    spec._grow = lambda rows, *rest: seen.append(rows.count()) or grow(spec, rows, *rest)
    model = spec._fit(df)
    assert max(seen) <= 40 and len(model.nodes()) == 2
    values = vector_to_array("features")
    edges = boosting.quantile_edges(df, [values[i] for i in range(2)], 64)
    want = plain_boosting(np.tile(x, (30, 1)), np.tile(y, 30), np.ones(1200), edges, 2, 2, 0.3, 1.0, 1.0)
    got = [r["m"] for r in model.transform(df).select("id", vector_to_array("rawPrediction")[1].alias("m")).orderBy("id").collect()]
    assert got == pytest.approx(list(want), abs=1e-9)
    # a task yields a row a node, feature and bin at most
    bins = df.select("id", *[boosting.bin_of(values[i], edges[i]).alias(f"b{i}") for i in range(2)], F.lit(0.5).alias("g")).coalesce(1)
    plan = bins.selectExpr("1 AS node", "g AS _g", "g AS _h", "CAST(coalesce(b0, -1) AS bigint) AS _b0", "CAST(coalesce(b1, -1) AS bigint) AS _b1").toArrow().to_batches(100)
    summed = list(boosting._task_sums(iter(plan), ["_b0", "_b1"]))
    assert len(summed) == 1 and summed[0].num_rows < 100 and sum(summed[0]["g"].to_pylist()) == pytest.approx(1200)
