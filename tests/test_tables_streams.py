import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from riskweave.functions.labels import readable_factor, risk_band
from riskweave.operators import drift, registry
from riskweave.plans import scoring
from riskweave.sources import tables
from riskweave.streaming import jobs


def test_csv_with_quotes_and_glob(spark, tmp_path):
    df = spark.createDataFrame([("a", '{"x": 1, "y": [2, 3]}'), ("b", None)], "model_name string, best_params string")
    tables.write_csv(df, str(tmp_path / "one"))
    tables.write_csv(df, str(tmp_path / "two"))
    back = tables.read_csv(spark, str(tmp_path / "one"), df.schema)
    assert back.exceptAll(df).count() == 0 and back.count() == 2
    assert tables.read_csv(spark, str(tmp_path / "*"), df.schema).count() == 4
    assert dict(tables.read_csv(spark, str(tmp_path / "one")).dtypes)["model_name"] == "string"


def test_missing_files(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.read_csv(spark, str(tmp_path / "nowhere"))
    assert tables.read_results(spark, str(tmp_path / "nowhere")).count() == 0
    assert tables.read_journal(spark, str(tmp_path / "nowhere"), "a int").columns == ["a"]


def test_summary_of_any_age(spark, tmp_path):
    (tmp_path / "old.json").write_text(
        '{"timestamp": "2024-01-01 00:00:00", "p_threshold": 0.01, "results": ['
        '{"feature": "a", "type": "numeric", "ks_statistic": 0.5},'
        '{"feature": "b", "type": "categorical", "js_divergence": 0.1, "test": "given", "threshold": 0.3}]}'
    )
    rows = {r["feature"]: r for r in tables.summary_rows(tables.read_summaries(spark, str(tmp_path))).collect()}
    assert rows["a"]["statistic"] == 0.5 and rows["a"]["test"] == "Kolmogorov-Smirnov" and rows["a"]["threshold"] == 0.01
    assert rows["b"]["statistic"] == 0.1 and rows["b"]["test"] == "given" and rows["b"]["threshold"] == 0.3


def test_journal_appends(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    for _ in range(2):
        tables.append_journal(df, str(tmp_path / "j"))
    assert tables.read_journal(spark, str(tmp_path / "j"), "a int").count() == 4


def test_scoring_and_bands(spark):
    df = spark.createDataFrame([(1, 30, "Yes", "High Income", 2), (2, 30, None, "?", 2)],
                               "id int, age int, frequent_flyer string, annual_income_class string, services_opted int")
    encoded = scoring.encode_requests(df)
    assert [tuple(r) for r in encoded.select("FrequentFlyer", "AnnualIncomeClass", "BookedHotelOrNot").orderBy("id").collect()] == [(1, 2, 1), (0, 0, 1)]
    out = scoring.score_linear(encoded, scoring.LinearScorer({"FrequentFlyer": 2.0}, -1.0), 0.5).orderBy("id").collect()
    assert [r["prediction"] for r in out] == [1, 0] and out[0]["risk_level"] == "High"
    bands = spark.createDataFrame([(0.29,), (0.3,), (0.7,), (None,)], "p double").select(risk_band(F.col("p"))).collect()
    assert [b[0] for b in bands] == ["Low", "Medium", "High", None]
    advice = scoring.with_recommendation(scoring.score_linear(encoded, scoring.LinearScorer({}, 0.0)), "ru").first()
    assert "10-15%" in advice["recommendation"]


def test_readable_names(spark):
    df = spark.createDataFrame([("Age",), ("poly_3",), ("other",)], "f string")
    got = [r[0] for r in df.select(readable_factor(F.col("f"), {"poly_3": ("Age", "FrequentFlyer")})).collect()]
    assert got == ["age", "age × frequent flyer", "other"]


def test_latest_runs_and_aliases(spark):
    runs = spark.createDataFrame([(f"r{i:02d}", "e1" if i < 40 else "e2", i) for i in range(42)], "run_id string, experiment string, start_time bigint")
    got = registry.latest_runs(runs)
    assert got.groupBy("experiment").count().orderBy("experiment").collect()[0]["count"] == 5
    assert got.filter("experiment = 'e1'").agg(F.min("start_time")).first()[0] == 35
    versions = spark.createDataFrame([("m", 1), ("m", 2)], "name string, version int")
    moves = spark.createDataFrame([("m", "champion", 1, 10), ("m", "champion", 2, 20), ("m", "old", 1, 20)],
                                  "name string, alias string, version int, set_at bigint")
    view = {r["version"]: r["aliases"] for r in registry.registry_view(versions, moves).collect()}
    assert view == {1: ["old"], 2: ["champion"]}


@pytest.fixture()
def events(spark, tmp_path):
    """Three files of events over four days; the last file also has a late row."""
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=i), ["view", "click", "error"][i % 3], float(i % 17)) for i in range(96)]
    schema = "id int, ts timestamp, kind string, value double"
    folder = tmp_path / "events"
    for k in range(3):
        spark.createDataFrame(rows[k * 32 : (k + 1) * 32], schema).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder), spark.createDataFrame(rows, schema)


def test_stream_scores_equal_batch(spark, events, tmp_path):
    folder, table = events

    def score(df):
        return scoring.score_linear(df, scoring.LinearScorer({"value": 0.2}, -1.0)).select("id", "probability", "risk_level")

    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    stream = lambda: jobs.read_parquet_stream(spark, folder, table.schema, 1)
    jobs.score_stream(stream(), score, out, progress)
    jobs.score_stream(stream(), score, out, progress)  # nothing new: nothing added
    got = spark.read.parquet(out)
    assert got.count() == 96 and got.exceptAll(score(table)).count() == 0


def test_stream_counts_equal_batch(spark, events, tmp_path):
    folder, table = events
    edges = jobs.reference_edges(table, ["value"])
    assert len(edges["value"]) <= 9
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    stream = jobs.read_parquet_stream(spark, folder, table.schema, 1)
    jobs.daily_counts_stream(jobs.long_features(stream, "ts", ["kind"], edges), out, progress, "10 days")
    batch = jobs.daily_counts_batch(jobs.long_features(table, "ts", ["kind"], edges))
    got = jobs.daily_counts(spark, out)
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0


def test_daily_drift_equals_full_join(spark, events, tmp_path):
    folder, table = events
    long = jobs.long_features(table, "ts", ["kind"], {"value": [5.0, 10.0]})
    shares = jobs.reference_shares(long.filter("ts < '2024-01-02'"))
    daily = {(r["day"], r["feature"]): r for r in jobs.daily_drift(jobs.daily_counts_batch(long), shares).collect()}
    assert len(daily) == 8
    for day in ("2024-01-01", "2024-01-03"):
        two = drift.pair(long.filter("ts < '2024-01-02'"), long.filter(F.date_format("ts", "yyyy-MM-dd") == day))
        counts = two.groupBy("feature", "value").agg(F.count_if("is_ref").alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_cur"))
        for r in drift.category_report(counts).collect():
            assert daily[(day, r["feature"])]["psi"] == pytest.approx(r["psi"], abs=1e-9)
            assert daily[(day, r["feature"])]["tv_distance"] == pytest.approx(r["tv_distance"], abs=1e-9)


def test_drift_stream_equals_batch(spark, events, tmp_path):
    folder, table = events
    long = jobs.long_features(table, "ts", ["kind"], {"value": [5.0, 10.0]})
    shares = jobs.reference_shares(long.filter("ts < '2024-01-02'"))
    stream = jobs.long_features(jobs.read_parquet_stream(spark, folder, table.schema), "ts", ["kind"], {"value": [5.0, 10.0]})
    out = str(tmp_path / "drift")
    jobs.daily_drift_stream(stream, shares, str(tmp_path / "counts"), out, str(tmp_path / "progress"))
    got = {(r["day"], r["feature"]): r["psi"] for r in jobs.newest_drift(spark, out).collect()}
    want = {(r["day"], r["feature"]): r["psi"] for r in jobs.daily_drift(jobs.daily_counts_batch(long), shares).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "history")
    df = spark.createDataFrame([("d", 1)], "day string, n int")
    jobs.append_batch(df, 0, path)
    jobs.append_batch(df, 1, path)
    jobs.append_batch(df, 1, path)
    assert spark.read.parquet(path).count() == 2


def test_clean_up_removes_what_was_written(spark, monkeypatch):
    import os

    from riskweave import session

    monkeypatch.setattr(session, "_made", [])
    table = session.materialize(spark.range(3), "gone")
    path = session._made[0].removeprefix("file:")
    assert table.count() == 3 and os.path.isdir(path)
    assert session.clean_up(spark) == 1 and not os.path.exists(path) and session.clean_up(spark) == 0
