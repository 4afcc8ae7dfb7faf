import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.functions.encoding import coerce_int, map_encode
from riskweave.operators import prep, profile
from riskweave.plans import cleaning


@pytest.fixture(scope="module")
def people(spark):
    rows = [(25.0, 50000.0, "A", 0, 5), (30.0, 60000.0, "B", 1, 10), (None, 70000.0, "A", 0, 15), (35.0, None, "C", 1, 20),
            (40.0, 90000.0, "B", 0, 25)]
    return spark.createDataFrame(rows, "age double, income double, category string, Target int, flight_count int")


def test_median_and_mode(people):
    assert prep.fit_medians(people, ["age", "income"]) == {"age": 32.5, "income": 65000.0}
    assert prep.fit_modes(people) == {"category": "A"}  # draw with B: the smaller text
    filled = prep.impute(people, prep.fit_medians(people), prep.fit_modes(people))
    assert profile.table_profile(filled).first()["n_missing"] == 0


def test_all_null_column_is_left_alone(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert prep.fit_medians(df) == {"b": 1.5}
    assert prep.impute(df, prep.fit_medians(df), {}).filter("a is not null").count() == 0


def test_clip(spark):
    df = spark.createDataFrame([(float(v), 0) for v in (25, 30, 35, 1000, 40)], "age double, Target int")
    bounds = prep.fit_clip(df, label="Target")
    assert bounds == {"age": (15.0, 55.0)}
    once = prep.clip(df, bounds)
    assert once.agg(F.max("age")).first()[0] == 55.0
    assert prep.clip(once, bounds).exceptAll(once).count() == 0
    assert prep.fit_clip(df, ["absent"]) == {}


def test_label_survives_cleaning(spark):
    df = spark.createDataFrame([(i, i % 5, float(i)) for i in range(100)], "id int, k int, x double").withColumn(
        "Target", (F.col("id") < 20).cast("int")
    )
    out = cleaning.generic_cleaning(df, "Target", ["id"])
    assert out.agg(F.sum("Target")).first()[0] == 20


def test_scale(spark):
    df = spark.createDataFrame([(float(a), 7.0) for a in (25, 30, 35, 40, 45)], "age double, flat double")
    out = prep.standard_scale(df, prep.fit_scale(df, ["age", "flat"]))
    r = out.agg(F.avg("age").alias("m"), F.stddev_pop("age").alias("s"), F.max(F.abs("flat")).alias("z")).first()
    assert r["m"] == pytest.approx(0) and r["s"] == pytest.approx(1) and r["z"] == 0


def test_terciles_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (5, 10, 15, 20, 25, 1, 1, 1)], "flight_count int")
    out = prep.with_tercile(df, "flight_count", prep.fit_terciles(df, "flight_count"), "s")
    low, high = np.quantile([5, 10, 15, 20, 25, 1, 1, 1], [1 / 3, 2 / 3])
    for r in out.collect():
        v = r["flight_count"]
        assert r["s"] == ("low" if v <= low else "medium" if v <= high else "high")


def test_sorted_and_first_seen_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c"), (5, "b")], "id int, c string")
    coded = {r["id"]: r["c"] for r in prep.encode_sorted(df, ["c"])[0].collect()}
    assert coded == {1: 1, 2: 0, 3: 3, 4: 2, 5: 1}  # null counts as the text "nan"
    seen = {r["id"]: r["c"] for r in prep.encode_first_seen(df, ["c"], "id")[0].collect()}
    assert seen == {1: 0, 2: 1, 3: 0, 4: 2, 5: 0}


def test_unseen_category_touches_only_its_row(spark):
    known = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    new = spark.createDataFrame([(1, "b"), (2, "zzz"), (3, "c"), (4, None)], "id int, c string")
    out = prep.apply_dictionary(new, prep.sorted_dictionary(known, ["c"]), ["c"])
    assert {r["id"]: r["c"] for r in out.collect()} == {1: 1, 2: 0, 3: 2, 4: 0}


def test_wide_dictionary_is_joined(spark, monkeypatch):
    monkeypatch.setattr(prep, "LITERAL_CODES", 2)
    df = spark.createDataFrame([(i, f"v{i % 7}") for i in range(50)], "id int, c string")
    out, dictionary = prep.encode_sorted(df, ["c"])
    assert dictionary.count() == 7
    assert all(r["c"] == r["id"] % 7 for r in out.collect())


def test_map_and_coercion(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("maybe",), (None,)], "c string")
    assert [r[0] for r in df.select(map_encode(F.col("c"), {"Yes": 1, "No": 0})).collect()] == [1, 0, 0, 0]
    texts = spark.createDataFrame([("3",), ("2.9",), ("x",), ("",), (None,), ("-4",)], "t string")
    assert [r[0] for r in texts.select(coerce_int(F.col("t"))).collect()] == [3, 2, 0, 0, 0, -4]


def test_customer_cleaning_first_rows(spark):
    rows = [(0, 34, "No", "Middle Income", 6, "No", "Yes", 0), (1, 34, "Yes", "Low Income", 5, "Yes", "No", 1),
            (2, 37, "No", "Middle Income", 3, "Yes", "No", 0)]
    df = spark.createDataFrame(
        rows,
        "id int, Age int, FrequentFlyer string, AnnualIncomeClass string, ServicesOpted int, "
        "AccountSyncedToSocialMedia string, BookedHotelOrNot string, Target int",
    )
    got = [tuple(r) for r in cleaning.customer_cleaning(df, "id").orderBy("id").collect()]
    assert got == [(0, 34, 0, 1, 6, 0, 0, 0), (1, 34, 1, 0, 5, 1, 1, 1), (2, 37, 0, 1, 3, 1, 1, 0)]


def test_preprocessor(spark, people, tmp_path):
    p = prep.Preprocessor().fit(people, "Target")
    assert p.feature_names == ["age", "income", "category", "flight_count"]
    out = p.transform(people)
    assert out.columns == p.feature_names and out.filter("age is null").count() == 0
    p.save(spark, str(tmp_path / "prep"))
    again = prep.Preprocessor.load(spark, str(tmp_path / "prep")).transform(people)
    assert out.exceptAll(again).count() == 0 and again.exceptAll(out).count() == 0
    with pytest.raises(ValueError):
        p.transform(people.drop("income"))
    with pytest.raises(ValueError):
        prep.Preprocessor().transform(people)


def test_preprocessor_mapping_and_batch_imputation(spark):
    train = spark.createDataFrame([(1.0, "Yes"), (3.0, "No")], "x double, c string")
    batch = spark.createDataFrame([(None, "Yes"), (10.0, None), (20.0, "No")], "x double, c string")
    p = prep.Preprocessor({"c": {"Yes": 1, "No": 0}}).fit(train, None)
    fitted = [r["x"] for r in p.transform(batch).collect()]
    own = [r["x"] for r in p.transform(batch, impute_from="batch").collect()]
    assert fitted[0] == 0.0 and own[0] == pytest.approx((15.0 - 2.0) / 1.0)
    assert sorted(r["c"] for r in p.transform(batch).collect()) == [0, 0, 1]
