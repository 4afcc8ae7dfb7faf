"""Model training on MLlib: comparison, stacking, calibration, search.

Models are named specs; every fitted model ends up as a column expression or a
``transform`` so that scores of all models form one long table
``(model_name, key, y, p)`` and quality is computed once for all of them.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators import boosting, kernels, neighbors, quality, search
from riskweave.operators.profile import class_weights
from riskweave.operators.search import Range
from riskweave.operators.split import stratified_folds
from riskweave.session import materialize

VECTOR, LABEL, WEIGHT, FOLD = "features", "label", "weight", "fold"
SEED = 42
NEIGHBOURS = 5
#: Steps of the linear model on kernel features.
KERNEL_ITERATIONS = 100
#: Fits that run at once; each is a series of small Spark jobs.
PARALLEL = 8
#: Rows for which a training table gets one more part, up to the number of cores.
ROWS_A_PART = 5_000


@dataclass(frozen=True)
class Sizes:
    """How much work the ensembles do; defaults are the full settings."""

    trees: int = 100
    balanced_trees: int = 200
    balanced_depth: int = 10
    rounds: int = 100
    balanced_rounds: int = 200
    boost_depth: int = 5
    stack_rounds: int = 150
    stack_trees: int = 150
    iterations: int = 1000
    folds: int = 5
    #: Depth of the plain forest: the most that MLlib allows.
    forest_depth: int = 30
    kernel_features: int = 512
    #: Rounds of the second-order models; a level of a tree is a Spark job.
    newton_rounds: int = 40


def assemble(df: DataFrame, key: str, label: str, feature_names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(key, label, weight, features)``; the weight balances the classes.

    The weights are joined, whatever the number of classes; rows of a null
    label weigh 1. Columns in ``keep`` come along.
    """
    weights = class_weights(df, label).select(F.col(label).alias("_class"), "class_weight")
    weight = F.coalesce(F.col("class_weight").cast("double"), F.lit(1.0))
    assembler = VectorAssembler(inputCols=list(feature_names), outputCol=VECTOR, handleInvalid="error")
    rows = assembler.transform(df).join(weights, F.col(label) == F.col("_class"), "left")
    return rows.select(key, F.col(label).cast("double").alias(LABEL), weight.alias(WEIGHT), VECTOR, *keep)


def written(rows: DataFrame, name: str) -> DataFrame:
    """Written once: every fit reads right-sized files instead of the whole plan.

    A large table in few files is dealt out evenly over the cores; a small one
    stays as it is.
    """
    rows = materialize(rows, name)
    parts = min(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ROWS_A_PART)
    return rows if rows.rdd.getNumPartitions() >= parts else materialize(rows.repartition(parts), name)


def _common(weighted: bool) -> dict:
    base = {"featuresCol": VECTOR, "labelCol": LABEL}
    return base | {"weightCol": WEIGHT} if weighted else base


def logistic(n_rows: int, weighted: bool, iterations: int = 1000) -> LogisticRegression:
    """L2-regularised with unit strength, i.e. ``1 / n`` per mean loss."""
    return LogisticRegression(
        maxIter=iterations, regParam=1.0 / max(n_rows, 1), elasticNetParam=0.0, standardization=False, **_common(weighted)
    )


def plain_specs(n_rows: int, sizes: Sizes = Sizes()) -> dict[str, Estimator]:
    return {
        "LogisticRegression": logistic(n_rows, False, sizes.iterations),
        # deep trees: with its node kept, a row does not walk from the root at every level
        "RandomForest": RandomForestClassifier(numTrees=sizes.trees, maxDepth=sizes.forest_depth, seed=SEED, cacheNodeIds=True, **_common(False)),
        "GradientBoosting": GBTClassifier(maxIter=sizes.rounds, maxDepth=3, stepSize=0.1, seed=SEED, **_common(False)),
        "SecondOrderBoosting": second_order(sizes.newton_rounds, sizes.boost_depth + 1, 0.3),
        "LinearSVC": LinearSVC(maxIter=sizes.iterations, **_common(False)),
        "KernelSVC": kernels.kernel_svc(
            VECTOR, LABEL, sizes.kernel_features, seed=SEED, maxIter=min(sizes.iterations, KERNEL_ITERATIONS), regParam=1.0 / max(n_rows, 1)
        ),
    }


def second_order(rounds: int, depth: int, step: float, positive_weight: float = 1.0) -> boosting.SecondOrderBoosting:
    return boosting.SecondOrderBoosting(
        featuresCol=VECTOR, labelCol=LABEL, maxIter=rounds, maxDepth=depth, stepSize=step, scalePosWeight=positive_weight, seed=SEED
    )


def positive_weight(train: DataFrame) -> float:
    """How much more a positive row weighs when both classes weigh the same."""
    ones, n = train.agg(F.count_if(F.col(LABEL) == 1), F.count(LABEL)).first()
    return (n - ones) / ones if ones else 1.0


def balanced_specs(n_rows: int, sizes: Sizes = Sizes(), weight_of_ones: float = 1.0) -> dict[str, Estimator]:
    """The plain boosted model takes no weights; its name says so."""
    boost = {"maxIter": sizes.balanced_rounds, "maxDepth": sizes.boost_depth, "stepSize": 0.1, "seed": SEED}
    return {
        "GradientBoosting_Unweighted": GBTClassifier(**boost, **_common(False)),
        "GradientBoosting_Balanced": GBTClassifier(**boost, **_common(True)),
        "SecondOrderBoosting_Balanced": second_order(sizes.newton_rounds, sizes.boost_depth, 0.3, weight_of_ones),
        "RandomForest_Balanced": RandomForestClassifier(
            numTrees=sizes.balanced_trees, maxDepth=sizes.balanced_depth, seed=SEED, **_common(True)
        ),
        "LogisticRegression_Balanced": logistic(n_rows, True, sizes.iterations),
    }


def stacking_specs(n_rows: int, sizes: Sizes = Sizes()) -> dict[str, Estimator]:
    return {
        "gb": GBTClassifier(maxIter=sizes.stack_rounds, maxDepth=3, stepSize=0.1, seed=SEED, **_common(False)),
        "rf": RandomForestClassifier(numTrees=sizes.stack_trees, maxDepth=sizes.balanced_depth, seed=SEED, **_common(True)),
        "deep": GBTClassifier(maxIter=sizes.stack_rounds, maxDepth=sizes.boost_depth + 1, stepSize=0.3, seed=SEED, **_common(False)),
        "lr": logistic(n_rows, True, sizes.iterations),
    }


def fit_all(specs: Mapping[str, Estimator], train: DataFrame, parallelism: int = PARALLEL) -> dict[str, Model]:
    """Fit every spec; the fits are Spark jobs that share the cluster."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        fitted = {name: pool.submit(spec.fit, train) for name, spec in specs.items()}
        return {name: f.result() for name, f in fitted.items()}


def _probability(df: DataFrame) -> Column:
    if "probability" in df.columns:
        return vector_to_array("probability")[1]
    # a margin without probabilities is squashed; 0 maps to 0.5
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-vector_to_array("rawPrediction")[1]))


def add_score(df: DataFrame, model: Model, name: str) -> DataFrame:
    """The model's probability as column ``name``; no other column is added."""
    scored = model.transform(df)
    made = [c for c in scored.columns if c not in df.columns]
    return scored.withColumn("_score", _probability(scored)).drop(*made).withColumnRenamed("_score", name)


def predictions(models: Mapping[str, Model], data: DataFrame, key: str) -> DataFrame:
    """``(model_name, key, y, p)`` for all models."""
    wide = data
    for name, model in models.items():
        wide = add_score(wide, model, f"p_{name}")
    entries = [F.struct(F.lit(n).alias("model_name"), F.col(f"p_{n}").alias("p")) for n in models]
    return wide.select(key, F.col(LABEL).cast("int").alias("y"), F.explode(F.array(*entries)).alias("_e")).select(
        "_e.model_name", key, "y", "_e.p"
    )


def knn_predictions(train: DataFrame, data: DataFrame, key: str, k: int = NEIGHBOURS) -> DataFrame:
    """The nearest-neighbour model in the same long form."""
    vector = vector_to_array(VECTOR).alias("_v")
    found = neighbors.nearest(
        train.select(key, vector, F.col(LABEL).cast("int").alias(LABEL)), data.select(key, vector), key, "_v", k, LABEL
    )
    p = neighbors.positive_share(found, LABEL)
    truth = data.select(F.col(key).alias("query_key"), F.col(LABEL).cast("int").alias("y"))
    return p.join(truth, "query_key").select(
        F.lit("KNeighbors").alias("model_name"), F.col("query_key").alias(key), "y", "p"
    )


def tuned_thresholds(scores: DataFrame, metric: str = "f1_score") -> dict[str, float]:
    """Best threshold per model (one row each reaches the driver)."""
    sweep = quality.threshold_sweep(scores, "y", "p", ["model_name"])
    return {r["model_name"]: r["threshold"] for r in quality.best_threshold(sweep, metric, ["model_name"]).collect()}


def compare(scores: DataFrame, thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """One row per model with all metrics, best F1 first."""
    cut = F.lit(quality.DEFAULT_THRESHOLD)
    if thresholds:
        table = F.create_map(*[F.lit(x) for kv in thresholds.items() for x in kv])
        cut = F.coalesce(F.try_element_at(table, F.col("model_name")), cut)
    found = quality.grouped_quality(scores, ["model_name"], "y", "p", cut)
    return quality.leaderboard(
        found.select("model_name", "accuracy", "f1_score", "roc_auc", "precision", "recall", cut.alias("threshold"))
    )


def with_folds(df: DataFrame, key: str, k: int) -> DataFrame:
    """Add ``fold``: every label is spread over the folds to within one row."""
    return stratified_folds(df, [key], LABEL, k, exact=True)


def _steps(spec: Estimator) -> int:
    """About how many jobs a fit runs one after the other."""
    steps = 1
    for name in ("maxIter", "maxDepth"):
        steps *= spec.getOrDefault(spec.getParam(name)) if spec.hasParam(name) else 1
    return steps


@dataclass
class Stack:
    """Base models, refitted on everything, and the model over their scores."""

    base: dict[str, Model]
    meta: Model
    inputs: list[str] = field(default_factory=list)

    def transform(self, data: DataFrame) -> DataFrame:
        wide = data
        for name, model in self.base.items():
            wide = add_score(wide, model, f"m_{name}")
        stacked = VectorAssembler(inputCols=self.inputs, outputCol="_stack").transform(wide.withColumnRenamed(VECTOR, "_base"))
        renamed = stacked.withColumnRenamed("_stack", VECTOR)
        return self.meta.transform(renamed).drop(VECTOR, *self.inputs).withColumnRenamed("_base", VECTOR)


def fit_stack(
    train: DataFrame, key: str, specs: Mapping[str, Estimator], folds: int = 5, iterations: int = 1000, parallelism: int = PARALLEL
) -> Stack:
    """Meta model on out-of-fold scores: a row is never scored by a model that
    saw it. Scores are added as columns, so nothing is shuffled for them. All
    fits, of the folds and of the final models, share one pool."""
    folded = written(with_folds(train, key, folds), "folds")
    inputs = [f"m_{name}" for name in specs]
    sides = {i: folded.filter(F.col(FOLD) != i) for i in range(folds)} | {folds: train}
    # those with most jobs one after the other begin first, so none of them is left alone at the end
    tasks = sorted(((i, name) for i in sides for name in specs), key=lambda t: -_steps(specs[t[1]]))
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        running = {(i, name): pool.submit(specs[name].copy().fit, sides[i]) for i, name in tasks}
        fitted = {k: f.result() for k, f in running.items()}
    held_out = None
    for i in range(folds):
        part = folded.filter(F.col(FOLD) == i)
        for name in specs:
            part = add_score(part, fitted[i, name], f"m_{name}")
        part = part.select(key, LABEL, WEIGHT, *inputs)
        held_out = part if held_out is None else held_out.unionByName(part)
    meta_rows = VectorAssembler(inputCols=inputs, outputCol=VECTOR).transform(held_out).select(LABEL, WEIGHT, VECTOR)
    # written once: the iterations of the meta model do not repeat the scoring
    meta_rows = materialize(meta_rows, "stacked")
    meta = logistic(meta_rows.count(), True, iterations).fit(meta_rows)
    return Stack({name: fitted[folds, name] for name in specs}, meta, inputs)


@dataclass
class Calibrated:
    """One model and one monotone map per fold; the score is their mean."""

    pairs: list[tuple[Model, Model]]

    def score(self, data: DataFrame, name: str = "p") -> DataFrame:
        wide, parts = data, []
        for i, (model, isotonic) in enumerate(self.pairs):
            wide = add_score(wide, model, f"_raw{i}")
            wide = isotonic.setFeaturesCol(f"_raw{i}").setPredictionCol(f"_cal{i}").transform(wide)
            parts.append(f"_cal{i}")
        mean = sum((F.col(c) for c in parts[1:]), F.col(parts[0])) / len(parts)
        return wide.withColumn(name, mean).drop(*parts, *[f"_raw{i}" for i in range(len(parts))])


def calibrate(spec: Estimator, train: DataFrame, key: str, folds: int = 3) -> Calibrated:
    """Isotonic calibration on out-of-fold scores."""
    folded = written(with_folds(train, key, folds), "folds")

    def fold(i: int) -> tuple[Model, Model]:
        model = spec.copy().fit(folded.filter(F.col(FOLD) != i))
        scored = add_score(folded.filter(F.col(FOLD) == i), model, "_raw")
        isotonic = IsotonicRegression(featuresCol="_raw", labelCol=LABEL, weightCol=WEIGHT)
        return model, isotonic.fit(scored.select("_raw", LABEL, F.lit(1.0).alias(WEIGHT)))

    with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        pairs = list(pool.map(fold, range(folds)))
    return Calibrated(pairs)


#: Ranges of the searched settings.
BOOSTED_RANGES = {
    "maxIter": Range(50, 300, whole=True),
    "maxDepth": Range(2, 10, whole=True),
    "stepSize": Range(0.01, 0.3, log=True),
    "subsamplingRate": Range(0.6, 1.0),
    "featureRate": Range(0.6, 1.0),
}
FOREST_RANGES = {
    "numTrees": Range(50, 300, whole=True),
    "maxDepth": Range(3, 20, whole=True),
    "minInstancesPerNode": Range(1, 10, whole=True),
}


def boosted_space(rng: random.Random) -> dict[str, float]:
    return search.draw(BOOSTED_RANGES, rng)


def forest_space(rng: random.Random) -> dict[str, float]:
    return search.draw(FOREST_RANGES, rng)


def sequential_search(
    estimator: Estimator,
    space: search.Space,
    train: DataFrame,
    key: str,
    trials: int = 30,
    folds: int = 3,
    seed: int = SEED,
    parallelism: int = PARALLEL,
    test: DataFrame | None = None,
) -> tuple[Model, dict, float, dict[str, float]]:
    """Best of ``trials`` settings by mean fold F1 of the positive class.

    Settings are proposed from the scores so far, in batches whose fits run
    together. Returns the model fitted on all rows, its settings, the score and
    its metrics on ``test`` (threshold 0.5).
    """
    folded = written(with_folds(train, key, folds), "folds")
    evaluator = MulticlassClassificationEvaluator(
        labelCol=LABEL, predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0
    )

    def configured(setting: Mapping[str, float]) -> Estimator:
        return estimator.copy({estimator.getParam(n): v for n, v in setting.items()})

    def score(task: tuple[dict, int]) -> float:
        setting, i = task
        model = configured(setting).fit(folded.filter(F.col(FOLD) != i))
        return evaluator.evaluate(model.transform(folded.filter(F.col(FOLD) == i)))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:

        def evaluate(settings: list[dict]) -> list[float]:
            found = list(pool.map(score, [(s, i) for s in settings for i in range(folds)]))
            return [sum(found[j : j + folds]) / folds for j in range(0, len(found), folds)]

        done = search.search(space, evaluate, trials, seed, max(1, parallelism // folds))
    setting, best = search.best_of(done)
    model = configured(setting).fit(train)
    metrics = {}
    if test is not None:
        found = compare(predictions({"tuned": model}, test, key)).first().asDict()
        metrics = {m: found[m] for m in quality.METRICS}
    return model, setting, best, metrics


def random_search(
    estimator: Estimator,
    space,
    train: DataFrame,
    key: str,
    trials: int = 30,
    folds: int = 3,
    seed: int = SEED,
    parallelism: int = PARALLEL,
) -> tuple[Model, dict, float]:
    """Best of ``trials`` random settings by mean fold F1 of the positive class.

    Returns the refitted model, its settings and the score.
    """
    rng = random.Random(seed)
    maps, settings = [], []
    for _ in range(trials):
        drawn = space(rng)
        builder = ParamGridBuilder()
        for name, value in drawn.items():
            builder = builder.addGrid(estimator.getParam(name), [value])
        maps += builder.build()
        settings.append(drawn)
    evaluator = MulticlassClassificationEvaluator(
        labelCol=LABEL, predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0
    )
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=evaluator,
        numFolds=folds,
        foldCol=FOLD,
        parallelism=parallelism,
        seed=seed,
    )
    found = search.fit(with_folds(train, key, folds))
    best = max(range(len(settings)), key=lambda i: found.avgMetrics[i])
    return found.bestModel, settings[best], found.avgMetrics[best]


def importances(model: Model, feature_names: Sequence[str], data: DataFrame) -> DataFrame:
    """``(feature, importance)`` of a tree model, largest first."""
    rows = list(zip(feature_names, [float(v) for v in model.featureImportances.toArray()]))
    table = data.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")
