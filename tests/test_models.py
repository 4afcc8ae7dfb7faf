import itertools
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from riskweave.operators import explain, neighbors, quality, training
from riskweave.operators.registry import Registry
from riskweave.operators.training import Sizes

#: Quick fits: the tests look at behaviour, not at quality.
SMALL = Sizes(trees=10, balanced_trees=10, balanced_depth=5, rounds=5, balanced_rounds=5, boost_depth=3,
              stack_rounds=4, stack_trees=8, iterations=50, folds=3, forest_depth=10, kernel_features=32, newton_rounds=3)
from riskweave.plans import training_job
from riskweave.session import materialize
from riskweave.sources import models as packages

NAMES = ["Age", "FrequentFlyer", "AnnualIncomeClass", "ServicesOpted", "AccountSyncedToSocialMedia", "BookedHotelOrNot"]


@pytest.fixture(scope="module")
def parts(churn):
    rows, names, _ = training_job.prepare(churn, "id", "Target", features=NAMES)
    rows = rows.persist()
    return rows.filter("part = 'train'"), rows.filter("part = 'validation'"), rows.filter("part = 'test'")


def test_balanced_weights(parts):
    train = parts[0]
    by_class = {r["label"]: r["w"] for r in train.groupBy("label").agg(F.avg("weight").alias("w")).collect()}
    assert by_class[1.0] > 1 > by_class[0.0]


def test_models_learn_the_signal(parts):
    train, validation, test = parts
    fitted = training.fit_all(training.balanced_specs(train.count(), SMALL), train)
    thresholds = training.tuned_thresholds(training.predictions(fitted, validation, "id"))
    assert set(thresholds) == set(fitted)
    scores = training.predictions(fitted, test, "id").unionByName(training.knn_predictions(train, test, "id"))
    table = {r["model_name"]: r for r in training.compare(scores, thresholds).collect()}
    assert set(table) == {*fitted, "KNeighbors"} and len(fitted) == 5
    assert table["SecondOrderBoosting_Balanced"]["roc_auc"] > 0.8
    assert table["LogisticRegression_Balanced"]["roc_auc"] > 0.8
    assert table["RandomForest_Balanced"]["roc_auc"] > 0.8
    assert table["KNeighbors"]["threshold"] == 0.5


def test_stack_uses_out_of_fold_scores(parts):
    train, _, test = parts
    specs = {k: v for k, v in training.stacking_specs(train.count(), SMALL).items() if k in ("rf", "lr")}
    stack = training.fit_stack(train, "id", specs, 3, 50)
    scores = training.predictions({"Stacking": stack}, test, "id")
    assert scores.count() == test.count()
    assert quality.roc_auc(scores, "y", "p").first()["roc_auc"] > 0.8


def test_calibration_is_monotone_and_bounded(parts):
    train, _, test = parts
    spec = training.balanced_specs(train.count(), SMALL)["LogisticRegression_Balanced"]
    out = training.calibrate(spec, train, "id").score(test)
    r = out.agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.avg("p").alias("m"), F.avg("label").alias("y")).first()
    assert 0 <= r["lo"] <= r["hi"] <= 1 and abs(r["m"] - r["y"]) < 0.08


def test_random_search_is_reproducible(parts):
    train = parts[0]
    spec = RandomForestClassifier(seed=1, featuresCol="features", labelCol="label")
    a = training.random_search(spec, training.forest_space, train, "id", 2, 2)
    b = training.random_search(spec, training.forest_space, train, "id", 2, 2)
    assert a[1] == b[1] and a[2] == pytest.approx(b[2]) and a[2] > 0.3


def expectation(leaves, x, known):
    """Value of the model when only ``known`` features are given."""
    total = 0.0
    for leaf in leaves:
        part = leaf.value
        for f, lo, hi, share in zip(leaf.features, leaf.low, leaf.high, leaf.share):
            part *= (lo < x[f] <= hi) if f in known else share
        total += part
    return total


def brute_shapley(leaves, x, m):
    out = np.zeros(m)
    for f in range(m):
        others = [g for g in range(m) if g != f]
        for size in range(m):
            for s in itertools.combinations(others, size):
                w = factorial(size) * factorial(m - 1 - size) / factorial(m)
                out[f] += w * (expectation(leaves, x, {*s, f}) - expectation(leaves, x, set(s)))
    return out


def test_tree_attribution(spark, churn, parts):
    train, _, test = parts
    model = GBTClassifier(maxIter=4, maxDepth=3, seed=1, featuresCol="features", labelCol="label").fit(train)
    leaves = packages.tree_leaves(spark, model)
    rows = churn.select("id", *NAMES).limit(6).orderBy("id").collect()
    x = np.array([[float(r[c]) for c in NAMES] for r in rows])
    got = explain.tree_attribution(x, leaves)
    for i in range(len(x)):
        assert got[i] == pytest.approx(brute_shapley(leaves, x[i], len(NAMES)), abs=1e-10)
    # contributions add up to the log-odds minus their mean
    base = expectation(leaves, x[0], set())
    scored = training.add_score(train.limit(50), model, "p").select("id", "p")
    parts_of = explain.tree_contributions(churn, ["id"], NAMES, leaves)
    total = parts_of.select("id", sum(F.col(c) for c in NAMES).alias("s")).join(scored, "id").collect()
    assert len(total) == 50
    for r in total:
        assert r["s"] + base == pytest.approx(np.log(r["p"] / (1 - r["p"])), abs=1e-6)


def test_forest_attribution(spark, churn, parts):
    train = parts[0]
    model = RandomForestClassifier(numTrees=4, maxDepth=3, seed=1, featuresCol="features", labelCol="label", weightCol="weight").fit(train)
    leaves = packages.tree_leaves(spark, model)
    scored = training.add_score(train.limit(30), model, "p").select("id", "p")
    parts_of = explain.tree_contributions(churn, ["id"], NAMES, leaves)
    base = expectation(leaves, np.zeros(len(NAMES)), set())
    for r in parts_of.select("id", sum(F.col(c) for c in NAMES).alias("s")).join(scored, "id").collect():
        assert r["s"] + base == pytest.approx(r["p"], abs=1e-6)


def test_ranked_factors(spark):
    df = spark.createDataFrame([(1, 0.5, -2.0, 0.0)], "id int, a double, b double, c double")
    got = explain.rank_contributions(df, ["id"], {c: F.col(c) for c in "abc"}, 2, "en").collect()
    assert [(r["rank"], r["feature"], r["direction"]) for r in got] == [(1, "b", "retains"), (2, "a", "raises risk")]


def test_importances_sum_to_one(parts):
    train = parts[0]
    model = training.plain_specs(1, SMALL)["RandomForest"].fit(train)
    rows = training.importances(model, NAMES, train).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert rows[0]["feature"] in ("FrequentFlyer", "AnnualIncomeClass")


@pytest.mark.parametrize("block", [7, 64])
def test_neighbours_against_brute_force(spark, block):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (60, 3)).astype(float)  # many ties and copies
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "id int, v array<double>, y int")
    got = {}
    for r in neighbors.nearest(df, df, "id", "v", 4, "y", exclude_same_key=True, block_rows=block, cell_rows=10).collect():
        got.setdefault(r["query_key"], {})[r["rank"]] = r["train_key"]
    for i in range(60):
        d = ((x - x[i]) ** 2).sum(1)
        want = sorted((j for j in range(60) if j != i), key=lambda j: (d[j], j))[:4]
        assert [got[i][k] for k in range(1, 5)] == want


def test_cells_leave_most_pairs_out(spark):
    """Pairs that are looked at grow clearly less than queries times rows, and nothing is lost."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(40, 4)) * 20
    x = centre[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 4))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "id int, v array<double>, y int")
    tree = neighbors.Cells(df.select("v"), "v", 64, 2048).tree
    exact = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    kth = np.sort(exact, axis=1)[:, 5]
    visited = sum(tree.size[w].sum() for w in tree.within(x, kth))
    assert visited < 0.25 * 2000 * 2000
    got = neighbors.nearest(df, df.filter("id < 50"), "id", "v", 5, "y", exclude_same_key=True, centres=64, cell_rows=30)
    found = {(r["query_key"], r["rank"]): r["distance"] for r in got.collect()}
    for i in range(50):
        assert [found[i, n + 1] for n in range(5)] == pytest.approx(np.sort(exact[i])[1:6])
    assert neighbors.nearest(df.limit(0), df, "id", "v").count() == 0


def test_pairs_grow_less_than_quadratically():
    """Ten times the rows of the same clusters: nowhere near a hundred times the pairs, and no near row is lost."""
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(300, 6)) * 15
    looked = []
    for n in (2_000, 20_000):
        x = centre[rng.integers(0, 300, n)] + rng.normal(size=(n, 6))
        tree = neighbors.Tree(x[rng.permutation(n)[: n // 32]])
        cell, away = tree.place(x)
        size = np.bincount(cell, minlength=len(tree.centres))
        radius = np.full(len(tree.centres), -np.inf)
        np.maximum.at(radius, cell, away)
        tree.measured(radius, size)
        asked = x[:: 10]
        d = np.sqrt(np.maximum(0.0, ((asked**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * asked @ x.T)))
        kth = np.partition(d, 5, axis=1)[:, 5]
        wide = tree.within(asked, kth)
        for i in range(0, len(asked), 37):
            assert set(cell[d[i] <= kth[i]].tolist()) <= set(wide[i].tolist())
            first = tree.first(asked[i : i + 1], 6)[0]
            assert size[first].sum() >= 6
        looked.append(sum(int(size[w].sum()) for w in wide))
    assert looked[1] < 40 * looked[0]
    assert looked[1] < 0.05 * 2_000 * 20_000


def test_majority_prefers_the_smaller_label(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (1, 2), (1, 3)], "query_key int, y int")
    assert neighbors.classify(df, "y").first()["predicted"] == 2


def test_whole_job_and_registry(spark, churn, tmp_path):
    store = Registry(spark, str(tmp_path / "registry"))
    first = training_job.run(churn, "id", "Target", SMALL, str(tmp_path / "one"), store, "churn", with_stack=False)
    assert first.model_version == 1 and len(first.feature_names) == 45
    model, meta = packages.load_package(spark, str(tmp_path / "one"))
    assert meta["model_name"] == first.best_name and meta["model_version"] == 1
    assert meta["threshold"] == first.thresholds[first.best_name]
    second = store.register("churn", "another-run")
    assert second == 2
    assert store.champion("churn").first()["version"] == 2
    assert store.table("versions").count() == 2
    assert store.table("runs").filter("best").count() == 1


def test_stack_package_scores_raw_rows(spark, churn, tmp_path):
    """A stack that wins is saved whole, with its interactions, and scores raw rows as before."""
    from riskweave.plans import scoring

    rows, names, interactions = training_job.prepare(churn, "id", "Target")
    rows = materialize(rows, "assembled")
    train = rows.filter("part = 'train'")
    specs = {k: v for k, v in training.stacking_specs(train.count(), SMALL).items() if k in ("rf", "lr")}
    stack = training.fit_stack(train, "id", specs, 2, 20)
    store, path = Registry(spark, str(tmp_path / "registry")), str(tmp_path / "stack")
    packages.save_package(spark, path, stack, "Stacking", 0.3, names, {"f1_score": 0.5}, interactions=interactions)
    store.register("churn", "run", path)
    direct = {r["id"]: r["p"] for r in training.add_score(rows, stack, "p").select("id", "p").collect()}
    scored = scoring.score_champion(churn, store, "churn", ["id"]).collect()
    assert len(scored) == len(direct)
    for r in scored:
        assert r["probability"] == pytest.approx(direct[r["id"]], abs=1e-9)
        assert r["prediction"] == int(direct[r["id"]] >= 0.3)
    info = scoring.model_info(store, "churn").first().asDict()
    assert (info["model_name"], info["model_version"], info["threshold"], info["n_features"]) == ("Stacking", 1, 0.3, len(names))


def test_requests_are_sent_in_bounded_frames_and_parts():
    rng = np.random.default_rng(3)
    asked = pd.DataFrame({"q_key": np.zeros(700, np.int64), "q_vec": list(rng.normal(size=(700, 4)))})
    every = [np.arange(40)]
    parts = np.full(40, 7)
    frames = list(neighbors.send_requests(iter([asked[:300], asked[300:]]), lambda b, x: every * len(b), parts))
    assert max(map(len, frames)) <= neighbors.SENT_AT_ONCE < 700 * 40
    sent = pd.concat(frames)
    # one key for all queries: the parts of a cell are still even
    assert sent.groupby(["cell", "part"]).size().tolist() == [100] * 280
    counted = pd.concat(neighbors.count_requests(iter([asked[:300], asked[300:]]), lambda b, x: every * len(b), 50))
    assert counted["n"].tolist() == [700] * 40


def test_neighbours_of_queries_dealt_over_parts(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-20, 20, (400, 3)).astype(float)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id long, v array<double>").repartition(3)
    got = {}
    for r in neighbors.nearest(df, df, "id", "v", 4, exclude_same_key=True, cell_rows=20, block_rows=30, query_rows=16).collect():
        got.setdefault(r["query_key"], []).append((r["rank"], r["train_key"], round(r["distance"], 9)))
    for q in range(400):
        d = ((x - x[q]) ** 2).sum(1)
        nearest = sorted((d[t], t) for t in range(400) if t != q)[:4]
        assert [t for _, t, _ in sorted(got[q])] == [t for _, t in nearest]


def test_large_training_tables_are_dealt_over_the_cores_and_small_ones_stay(spark, monkeypatch):
    few = spark.range(400).coalesce(1)
    monkeypatch.setattr(training, "ROWS_A_PART", 100)
    dealt = training.written(few, "few")
    counts = [len(p) for p in dealt.rdd.glom().collect()]
    assert len(counts) == 4 and max(counts) < 150 and sorted(r["id"] for r in dealt.collect()) == list(range(400))
    monkeypatch.setattr(training, "ROWS_A_PART", 500)
    assert training.written(few, "few").rdd.getNumPartitions() == 1


def test_longest_fits_begin_first_and_deep_forests_keep_nodes():
    specs = training.stacking_specs(100)
    assert sorted(specs, key=lambda n: -training._steps(specs[n])) == ["lr", "deep", "gb", "rf"]
    assert training.plain_specs(100)["RandomForest"].getCacheNodeIds()


def test_rows_and_queries_are_sent_once_for_a_large_group(spark):
    """Every query asks nearly every cell: what is sent follows the parts and chunks, not the cells."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 12)).astype(np.float32).astype(float)
    x[700:720] = x[0]
    df = spark.createDataFrame([(i, v, i % 4) for i, v in enumerate(x.tolist())], "id long, v array<float>, y int").repartition(3)
    for part_bytes in (8 * 12 * 200, neighbors.PART_BYTES):
        found = neighbors.nearest(df, df, "id", "v", 4, "y", exclude_same_key=True, cell_rows=40, part_bytes=part_bytes)
        got = {}
        for r in found.collect():
            got.setdefault(r["query_key"], []).append((r["rank"], r["train_key"], r["y"]))
        for q in range(1500):
            d = ((x - x[q]) ** 2).sum(1)
            d[q] = np.inf
            assert sorted(got[q]) == [(n + 1, t, t % 4) for n, t in enumerate(np.lexsort((np.arange(1500), d))[:4])]


def test_cells_are_put_together_up_to_a_limit():
    cells = object.__new__(neighbors.Cells)
    cells.tree = neighbors.Tree(np.arange(6.0)[:, None])
    order = np.concatenate(cells.tree.members)
    rows = np.zeros(6, np.int64)
    rows[order] = [3, 4, 0, 25, 2, 1]
    first, many = cells.spans(rows, 10)
    assert first[order].tolist() == [0, 0, 0, 0, 3, 3] and many[order].tolist() == [1, 1, 1, 4, 1, 1]
