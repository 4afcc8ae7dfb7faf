from collections import Counter
from math import ceil

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import features, profile, split

NAMES = ["Age", "FrequentFlyer", "AnnualIncomeClass", "ServicesOpted", "AccountSyncedToSocialMedia", "BookedHotelOrNot"]


def test_forty_five_columns(churn):
    x = churn.drop("id", "Target")
    f = features.Interactions().fit(x)
    out = f.transform(x)
    assert len(out.columns) == 45 and out.columns[-1] == "poly_35"
    r = out.first()
    for name, (a, b) in f.labels.items():
        assert r[name] == pytest.approx(r[a] * r[b])
    assert r["services_per_age"] == r["ServicesOpted"] / (r["Age"] + 1)


def test_absent_column_counts_as_zero(churn):
    f = features.Interactions().fit(churn.drop("id", "Target"))
    out = f.transform(churn.drop("id", "Target", "ServicesOpted"))
    hit = [n for n, t in f.labels.items() if "ServicesOpted" in t]
    assert out.agg(*[F.max(F.abs(F.col(n))).alias(n) for n in hit]).first() == tuple([0.0] * len(hit))


def test_degrees_and_guard(spark):
    df = spark.createDataFrame([(2.0, 3.0, 5.0)], "a double, b double, c double")
    f = features.Interactions(3, True, []).fit(df)
    assert [t for t in f.terms] == [("a", "b"), ("a", "c"), ("b", "c"), ("a", "b", "c")]
    assert f.transform(df).first()["poly_3"] == 30.0
    full = features.Interactions(2, False, []).fit(df)
    assert full.terms[0] == ("a", "a") and len(full.terms) == 6
    wide = spark.createDataFrame([tuple([1.0] * 70)], ", ".join(f"c{i} double" for i in range(70)))
    with pytest.raises(ValueError):
        features.Interactions(2, True, []).fit(wide)
    with pytest.raises(ValueError):
        features.Interactions().transform(df)


def test_align_schema(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert features.align_schema(df, ["b", "z"], "zero").first() == (2, 0)
    with pytest.raises(ValueError):
        features.align_schema(df, ["z"])


def test_stratified_split_is_exact(churn):
    sizes = Counter()
    tests = Counter()
    for r in split.stratified_split(churn, ["id"], "Target").select("Target", "is_test").collect():
        sizes[r[0]] += 1
        tests[r[0]] += r[1]
    assert all(tests[y] == ceil(n * 0.2) for y, n in sizes.items())


def test_split_does_not_depend_on_partitions(churn):
    a = split.stratified_split(churn, ["id"], "Target").filter("is_test").select("id")
    b = split.stratified_split(churn.repartition(7), ["id"], "Target").filter("is_test").select("id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_with_null_and_single_labels(spark):
    df = spark.createDataFrame([(i, None if i < 10 else "one" if i == 10 else "many") for i in range(60)], "id int, y string")
    got = Counter((r["y"], r["is_test"]) for r in split.stratified_split(df, ["id"], "y").collect())
    assert got[(None, True)] == 2 and got[("one", True)] == 1 and got[("many", True)] == 10


def test_hash_split_share(churn):
    share = split.hash_split(churn, ["id"], 0.2).agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert abs(share - 0.2) < 0.03


def test_samples(churn):
    assert split.sample_n(churn, ["id"], 123).count() == 123
    assert split.sample_n(churn, ["id"], 5000).count() == 2000
    drawn = split.sample_with_replacement(churn, ["id"], 5000)
    assert drawn.count() == 5000 and drawn.columns == churn.columns
    assert drawn.exceptAll(drawn.distinct()).count() > 0
    some = split.sample_stratified(churn, ["id"], "Target", {0: 0.1, 1: 1.0})
    assert some.filter("Target = 1").count() == churn.filter("Target = 1").count()
    assert abs(some.filter("Target = 0").count() / churn.filter("Target = 0").count() - 0.1) < 0.03


def test_shift(spark):
    df = spark.createDataFrame([(30, "Yes", 1)], "Age int, FrequentFlyer string, other int")
    assert split.covariate_shift(df).first() == (38, "No", 1)


def test_duplicates_and_leakage(spark):
    rows = [(1, "a", 0)] * 3 + [(1, "a", 1)] + [(2, None, 0)] * 2
    df = spark.createDataFrame(rows, "x int, c string, y int")
    r = split.duplicate_profile(df, ["x", "c"]).first()
    assert tuple(r) == (6, 3, 3, 2)
    test = spark.createDataFrame([(2, None), (2, None), (3, "a")], "x int, c string")
    assert split.leakage_overlap(df, test, ["x", "c"]).first()["n_overlap"] == 2


def test_folds(churn):
    groups = split.group_folds(churn, NAMES).groupBy(*NAMES).agg(F.count_distinct("fold").alias("k"))
    assert groups.filter("k > 1").count() == 0
    exact = split.stratified_folds(churn, ["id"], "Target", 5, exact=True).groupBy("Target", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in exact if r["Target"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_append_rows(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    assert split.append_rows(split.append_rows(None, a, ["x"]), a, ["x"]).count() == 2


def test_profile_edges(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, "a")], "x double, c string")
    assert [r["n"] for r in profile.histogram(df, "x", 4).orderBy("bin_id").collect()] == [2, 0, 0, 0]
    assert profile.validate_columns(df, ["x", "z"]) == (False, ["z"])
    nulls = {r["column_name"]: r for r in profile.null_profile(df).collect()}
    assert nulls["c"]["n_null"] == 1 and not nulls["c"]["acceptable"]
    approx = profile.distinct_profile(df, ["x", "c"], approximate=True).collect()
    assert {r[0]: r[1] for r in approx} == {"x": 1, "c": 1}


def test_kde_integrates_to_one(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=400)], "x double")
    rows = profile.kde_grid(df, "x", 200).orderBy("point_id").collect()
    area = np.trapezoid([r["density"] for r in rows], [r["x"] for r in rows])
    assert 0.95 < area < 1.01


def test_golden_group_rates(spark):
    rows = [(0, 386, 104), (1, 409, 28), (2, 159, 92)]
    df = spark.createDataFrame([(c, int(i < k)) for c, n, k in rows for i in range(n)], "income int, Target int")
    got = {r["income"]: round(r["churn_rate"], 6) for r in profile.group_rate(df, ["income"], "Target").collect()}
    assert got == {0: 0.26943, 1: 0.06846, 2: 0.578616}


def test_exact_folds_keep_rows_without_label(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 2).alias("y"))
    rows = split.stratified_folds(df, ["id"], "y", 5, exact=True).groupBy("y", "fold").count().collect()
    assert sum(r["count"] for r in rows) == 1000
    assert {r["count"] for r in rows if r["y"] is None} == {20}


def test_histogram_ignores_nan(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert [r["n"] for r in profile.histogram(df, "x", 2).orderBy("bin_id").collect()] == [1, 2]
