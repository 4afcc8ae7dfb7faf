"""Plan shapes that have to hold at any size, and a sample of the oracle."""

import pytest

from riskweave.operators import drift, quality, split
from riskweave.plans import views
from riskweave.workload import all_oracles, all_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_oracle_has_a_query():
    assert set(all_oracles()) <= set(all_queries())
    assert len(all_queries()) > 100


@pytest.mark.parametrize(
    "key", ["drift_report", "roc_auc", "sliced_metrics", "threshold_sweep", "kde_grid", "histogram20", "leakage_overlap", "status_counts"]
)
def test_no_cross_joins(spark, sf, key):
    text = plan(all_queries()[key](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "BatchEvalPython" not in text


def one_task_inputs(text):
    lines = text.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


@pytest.mark.parametrize("key", ["drift_report", "roc_auc", "roc_curve", "sliced_metrics", "box_stats", "stratified_kfold_exact"])
def test_one_task_steps_only_see_reduced_rows(spark, sf, key):
    for line in one_task_inputs(plan(all_queries()[key](spark, sf))):
        assert "partial_" in line or "_bucket" in line, line


def test_value_counts_are_shuffled_once(spark, sf):
    """Split points, offsets, running sums and bins reuse one exchange."""
    df = drift.numeric_report(drift.numeric_counts(views.event_periods(spark, sf), ["value", "k"]))
    df.collect()
    assert plan(df).count("ReusedExchange") >= 3


def test_hash_split_does_not_shuffle(spark, sf):
    df = views.load(spark, sf, "orders")
    assert "Exchange" not in plan(split.hash_split(df, ["o_orderkey"]))
    assert "Exchange hashpartitioning" not in plan(split.stratified_split(df, ["o_orderkey"], "o_orderstatus"))


def test_scan_reads_only_what_is_needed(spark, sf):
    df = quality.roc_auc(views.load(spark, sf, "lineitem").selectExpr("cast(l_discount > 0.05 as int) as y", "l_tax as p"), "y", "p")
    assert "ReadSchema: struct<l_discount:double,l_tax:double>" in plan(df)


def test_latest_runs_limit_before_the_shuffle(spark, sf):
    assert plan(all_queries()["latest_runs"](spark, sf)).count("WindowGroupLimit") == 2


SAMPLE = ["drift_report", "psi_numeric", "chi_square_fit", "preprocess_fit_apply", "etl_churn", "split_stratified", "roc_auc",
          "sliced_metrics", "best_threshold", "batch_score", "knn_classify", "registry_view", "daily_psi_batch"]


@pytest.mark.parametrize("key", SAMPLE)
def test_oracle_sample(spark, sf, key):
    duckdb = pytest.importorskip("duckdb")
    import glob
    import os

    from tools.check_oracle import table

    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = all_queries()[key](spark, sf)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(all_oracles()[key])
    assert got == table([d[0] for d in cursor.description], cursor.fetchall())
