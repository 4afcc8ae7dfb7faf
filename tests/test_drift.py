import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from drift_golden import golden_counts
from riskweave.operators import drift, ks
from riskweave.operators.ks import exact_pvalue, finite_pvalue, ks_pvalue_limit

GOLDEN = {  # KS, exact p, limit p, PSI, reference mean, reference deviation
    "Age": (0.0361, 0.9834, 0.9886, 0.0295, 32.0931, 3.3352),
    "FrequentFlyer": (0.0148, 1.0, 1.0, 0.0011, 0.3028, 0.4598),
    "AnnualIncomeClass": (0.0149, 1.0, 1.0, 0.0017, 0.7602, 0.7201),
    "ServicesOpted": (0.0237, 1.0, 1.0, 0.0146, 2.4417, 1.6193),
    "AccountSyncedToSocialMedia": (0.0332, 0.9935, 0.9959, 0.0048, 0.3840, 0.4867),
    "BookedHotelOrNot": (0.0479, 0.8535, 0.8743, 0.0095, 0.6134, 0.4873),
}


@pytest.fixture(scope="module")
def golden(spark):
    rows = []
    for feature, values in golden_counts().items():
        for v, (r, c) in values.items():
            rows += [(feature, float(v), True)] * r + [(feature, float(v), False)] * c
    return spark.createDataFrame(rows, "feature string, value double, is_ref boolean")


@pytest.mark.parametrize("mode,column", [("auto", 1), ("limit", 2)])
def test_golden_report(golden, mode, column):
    counts = drift._side_counts(golden)
    rep = drift.with_ks_pvalue(drift.numeric_report(counts), mode).collect()
    assert len(rep) == 6
    for r in rep:
        want = GOLDEN[r["feature"]]
        got = (r["ks"], r["p_value"], r["p_value"], r["psi"], r["ref_mean"], r["ref_std"])
        for i in (0, column, 3, 4, 5):
            assert round(got[i], 4) == want[i], (r["feature"], i)


def two_sided(spark, ref, cur, name="x"):
    kind = "string" if isinstance((list(ref) + list(cur))[0], str) else "double"
    cast = (lambda v: v) if kind == "string" else (lambda v: None if v is None else float(v))
    return spark.createDataFrame(
        [(cast(v), True) for v in ref] + [(cast(v), False) for v in cur], f"{name} {kind}, is_ref boolean"
    )


def report(spark, ref, cur, **kw):
    return drift.drift_report(two_sided(spark, ref, cur), **kw).first()


def test_psi_identical_is_zero(spark):
    values = ["Yes", "No", "No", "Yes"] * 10
    r = report(spark, values, values)
    assert r["psi"] == 0.0 and r["statistic"] == 0.0 and r["p_value"] is None and not r["drift_detected"]


def test_psi_known_value_and_symmetry(spark):
    a, b = ["Yes"] * 50 + ["No"] * 50, ["Yes"] * 80 + ["No"] * 20
    assert report(spark, a, b)["psi"] == pytest.approx(0.4159, abs=1e-4)
    assert report(spark, b, a)["psi"] == report(spark, a, b)["psi"]
    assert report(spark, a, b)["statistic"] == 0.3 and report(spark, a, b)["drift_detected"]


def test_new_category(spark):
    psi = report(spark, ["A"] * 100, ["A"] * 90 + ["B"] * 10)["psi"]
    assert math.isfinite(psi) and psi > 0.25


def brute_psi(ref, cur):
    if len(set(ref)) > 10:
        edges = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
        edges[0], edges[-1] = -np.inf, np.inf
        r, c = np.histogram(ref, edges)[0], np.histogram(cur, edges)[0]
    else:
        values = sorted(set(ref) | set(cur))
        r = np.array([list(ref).count(v) for v in values])
        c = np.array([list(cur).count(v) for v in values])
    r, c = np.clip(r / len(ref), 1e-4, None), np.clip(c / len(cur), 1e-4, None)
    return float(np.sum((c - r) * np.log(c / r)))


def brute_ks(ref, cur):
    grid = np.union1d(ref, cur)
    return float(np.max(np.abs((np.array(ref)[:, None] <= grid).mean(0) - (np.array(cur)[:, None] <= grid).mean(0))))


@pytest.mark.parametrize("seed", range(4))
def test_numeric_report_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    ref = rng.normal(0, 1, 300 + seed).round(seed)
    cur = rng.normal(0.3 * seed, 1 + 0.2 * seed, 217).round(seed)
    r = drift.numeric_report(drift.numeric_counts(two_sided(spark, ref, cur), ["x"])).first()
    assert r["ks"] == pytest.approx(brute_ks(ref, cur), abs=1e-12)
    assert r["psi"] == pytest.approx(brute_psi(ref, cur), abs=1e-9)
    assert r["ref_std"] == pytest.approx(np.std(ref, ddof=1), rel=1e-9)
    assert r["curr_mean"] == pytest.approx(np.mean(cur), abs=1e-9)


def test_normal_samples(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(0, 1, 2000)
    same = report(spark, base, rng.normal(0, 1, 2000))
    moved = report(spark, base, rng.normal(1.5, 1, 2000))
    assert same["psi"] < 0.1 and same["psi_level"] == "stable"
    assert moved["psi"] > 0.25 and moved["psi_level"] == "significant" and moved["drift_detected"]
    assert moved["p_value"] == 0.0


def test_heavily_repeated_value(spark):
    """One value holds most rows, on one side only."""
    ref, cur = [0.0] * 900 + list(range(1, 101)), [0.0] * 500 + list(range(50, 550))
    r = drift.numeric_report(drift.numeric_counts(two_sided(spark, ref, cur), ["x"])).first()
    assert r["ks"] == pytest.approx(brute_ks(ref, cur)) and r["psi"] == pytest.approx(brute_psi(ref, cur))


def test_mixed_frame_with_nulls_and_label(spark):
    rows = [
        (None if i % 10 == 0 else float(20 + i % 30), "Yes" if i % 3 else "No", i % 2, i < 120) for i in range(200)
    ]
    df = spark.createDataFrame(rows, "Age double, FrequentFlyer string, Target int, is_ref boolean")
    rep = {r["feature"]: r for r in drift.drift_report(df, label="Target").collect()}
    assert set(rep) == {"Age", "FrequentFlyer"}
    assert rep["Age"]["type"] == "numeric" and rep["Age"]["n_ref"] == 108
    assert rep["FrequentFlyer"]["type"] == "categorical" and rep["FrequentFlyer"]["p_value"] is None


def test_nan_counts_as_null(spark):
    r = report(spark, [1.0, 2.0, float("nan"), 3.0], [1.0, 2.0, 3.0])
    assert r["n_ref"] == 3 and r["statistic"] == 0.0


def test_empty_side(spark):
    """No test value without data; shares of an empty side count as zero."""
    df = two_sided(spark, [1.0, 2.0, 3.0], [None])
    r = drift.drift_report(df).first()
    assert r["statistic"] is None and r["p_value"] is None and r["psi"] > 0.25
    assert drift.drift_monitor(df, ["x", "absent"]).count() == 0


def brute_exact(d, n, m):
    """Share of all interleavings whose distance is at least d."""
    hits = total = 0
    for chosen in itertools.combinations(range(n + m), n):
        i = j = 0
        worst = 0.0
        picked = set(chosen)
        for s in range(n + m):
            i, j = (i + 1, j) if s in picked else (i, j + 1)
            worst = max(worst, abs(i / n - j / m))
        total += 1
        hits += worst >= d - 1e-12
    return hits / total


@pytest.mark.parametrize("n,m", [(3, 4), (5, 5), (6, 4), (1, 5)])
def test_exact_pvalue_by_enumeration(n, m):
    for d in {abs(i / n - j / m) for i in range(n + 1) for j in range(m + 1)}:
        assert exact_pvalue(d, n, m) == pytest.approx(brute_exact(d, n, m), abs=1e-12)


def test_exact_pvalue_of_large_samples_is_near_the_other_laws(spark):
    p = exact_pvalue(0.03, 5000, 4000)
    limit = spark.range(1).select(ks_pvalue_limit(F.lit(0.03), F.lit(5000 * 4000 / 9000))).first()[0]
    assert abs(limit - p) < 5e-3 and abs(finite_pvalue(0.03, round(5000 * 4000 / 9000)) - p) < 5e-3


@pytest.mark.parametrize(
    "n,d,inside",  # published to all digits
    [(10, 0.274, 0.6284796154565043), (2000, 0.04, 0.99676943191713676985), (2000, 0.06, 0.99999893956930568118), (16000, 0.016, 0.99945234913828052085)],
)
def test_finite_law_has_published_values(n, d, inside):
    assert 1.0 - finite_pvalue(d, n) == pytest.approx(inside, abs=1e-10)


def test_finite_law_by_simulation_of_small_samples_and_closed_forms():
    rng = np.random.default_rng(5)
    for n in (3, 7):
        x = np.sort(rng.random((40_000, n)), axis=1)
        i = np.arange(n)
        d = np.maximum(((i + 1) / n - x).max(1), (x - i / n).max(1))
        for q in (0.2, 0.5, 0.8, 0.95):
            at = float(np.quantile(d, q))
            assert finite_pvalue(at, n) == pytest.approx(1 - q, abs=0.01)
    assert finite_pvalue(0.5, 1) == 1.0 and finite_pvalue(0.75, 1) == pytest.approx(0.5) and finite_pvalue(1.0, 9) == 0.0
    assert finite_pvalue(0.1, 5) == 1.0


def test_branches_of_the_finite_law_meet():
    for n in (150, 1000, 5000):
        for x in (0.6, 0.9, 1.2, 1.45):
            d = x / math.sqrt(n)
            assert ks._matrix_power(n, d) == pytest.approx(ks._series(n, d), abs=1e-3 / n)
        d = math.sqrt(2.5 / n)
        assert 2 * ks._one_sided_tail(n, d) == pytest.approx(1 - ks._matrix_power(n, d), rel=1e-5)
    n = 1_200_000
    d = math.sqrt(2.3 / n)
    assert 2 * ks._one_sided_tail(n, d) == pytest.approx(1 - ks._series(n, d), rel=2e-3)
    values = [finite_pvalue(x / 1000, 12_345) for x in range(1, 60)]
    assert all(a >= b for a, b in zip(values, values[1:]))


def test_auto_takes_the_finite_law_for_large_samples(spark):
    rows = [("a", 20_000, 15_000, 0.012), ("b", 40, 30_000, 0.2), ("c", 50, 60, 0.2), ("d", 0, 10, None)]
    df = spark.createDataFrame(rows, "feature string, n_ref long, n_cur long, ks double")
    got = {r["feature"]: (r["p_method"], r["p_value"]) for r in drift.with_ks_pvalue(df, "auto").collect()}
    assert got["a"] == ("finite", pytest.approx(finite_pvalue(0.012, round(20_000 * 15_000 / 35_000))))
    assert got["b"] == ("finite", pytest.approx(finite_pvalue(0.2, round(40 * 30_000 / 30_040))))
    assert got["c"] == ("exact", pytest.approx(exact_pvalue(0.2, 50, 60))) and got["d"] == ("exact", None)


def test_chi_square_pvalues(spark):
    # known upper tails
    cases = [(3.841459, 1, 0.05), (9.487729, 4, 0.05), (11.070498, 5, 0.05), (18.307038, 10, 0.05), (124.342113, 100, 0.05),
             (552.074742, 500, 0.0534)]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "x double, k bigint")
    got = [r[0] for r in df.select(drift.chi_square_pvalue(F.col("x"), F.col("k"))).collect()]
    for g, (_, _, want) in zip(got, cases):
        assert g == pytest.approx(want, abs=2e-3)


def test_chi_square_fit_status(spark):
    unequal = drift.chi_square_fit(drift.category_counts(two_sided(spark, ["a"] * 5, ["a"] * 4 + ["b"] * 3), ["x"])).first()
    assert unequal["status"] == "could not calculate" and not unequal["drift_detected"]
    equal = drift.chi_square_fit(
        drift.category_counts(two_sided(spark, ["a"] * 80 + ["b"] * 20, ["a"] * 50 + ["b"] * 50), ["x"])
    ).first()
    assert equal["chi_square"] == pytest.approx(36.0) and equal["drift_detected"]


def test_summary_alert_and_trigger(spark):
    df = two_sided(spark, ["A"] * 100, ["B"] * 100)
    rep = drift.drift_report(df)
    summary = drift.drift_summary(rep).first()
    assert summary["drift_features"] == 1 and summary["alert"] and summary["affected_columns"] == ["x"]
    assert drift.drift_alert(drift.drift_summary(rep)).first()["drift_detected"]
    assert drift.retrain_trigger(rep).first()["retrain"]
    quiet = drift.drift_summary(drift.drift_report(two_sided(spark, ["A"] * 30, ["A"] * 30), language="ru"), "ru").first()
    assert quiet["drift_features"] == 0 and not quiet["alert"] and quiet["results"][0]["psi_level"] == "стабильно"


def test_live_gate(spark):
    dataset = spark.createDataFrame([(float(20 + i % 30), "Yes" if i % 3 else "No") for i in range(200)], "Age double, F string")
    shifted = spark.createDataFrame([(70.0, "No")] * 50, "Age double, F string")
    side = F.pmod(F.xxhash64("Age", "F"), F.lit(5)) != 0
    few, source = drift.choose_current(dataset, shifted.limit(49), side)
    assert source == "split" and few.count() == 200
    live, source = drift.choose_current(dataset, shifted, side)
    assert source == "live" and live.count() == 250
    assert drift.drift_summary(drift.drift_report(live)).first()["alert"]
    assert drift.choose_current(dataset, None, side)[1] == "split"


def test_history_helpers(spark):
    h = spark.createDataFrame([("2024-01-02", 1), ("2024-01-03", 2), ("2024-01-01", 3)], "ts string, v int")
    assert drift.latest(h, "ts").first()["v"] == 2
    assert [r["v"] for r in drift.newest_first(h, "ts", 2).collect()] == [2, 1]


def test_p_threshold_is_honoured(spark):
    rng = np.random.default_rng(5)
    df = two_sided(spark, rng.normal(0, 1, 100), rng.normal(0.35, 1, 100))
    p = drift.drift_monitor(df, ["x"]).first()["p_value"]
    assert drift.drift_monitor(df, ["x"], p_threshold=p * 1.01).first()["drift_detected"]
    assert not drift.drift_monitor(df, ["x"], p_threshold=p * 0.99).first()["drift_detected"]
