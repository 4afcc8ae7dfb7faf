import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import delong, profile, sketches


def brute(y, a, b):
    pos, neg = np.flatnonzero(y == 1), np.flatnonzero(y != 1)
    def psi(s):
        return (s[pos][:, None] > s[neg][None]) + 0.5 * (s[pos][:, None] == s[neg][None])
    pa, pb = psi(a), psi(b)
    def cov(u, v):
        return np.cov(u, v)[0, 1]
    def spread(x, z):
        return cov(x.mean(1), z.mean(1)) / len(pos) + cov(x.mean(0), z.mean(0)) / len(neg)
    var = spread(pa, pa) + spread(pb, pb) - 2 * spread(pa, pb)
    return pa.mean(), pb.mean(), math.sqrt(spread(pb, pb)), math.sqrt(var)


def table(spark, seed=0, n=400):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    a = np.round(rng.normal(size=n) + y, 1)
    b = np.round(0.6 * a + 0.6 * rng.normal(size=n) + 0.3 * y, 1)
    g = [None if i % 7 == 0 else "xy"[i % 2] for i in range(n)]
    rows = [(int(t), float(p), float(q), k) for t, p, q, k in zip(y, a, b, g)]
    extra = [(None, 1.0, 1.0, "x"), (1, None, 1.0, "x"), (0, 1.0, float("nan"), "y"), (1, 0.3, 0.2, "one"), (1, 0.4, 0.9, "one")]
    return spark.createDataFrame(rows + extra, "y int, a double, b double, g string"), y, a, b, np.array([str(k) for k in g])


def test_differences_and_errors_by_pairs(spark):
    df, y, a, b, g = table(spark)
    got = {r["g"]: r for r in delong.auc_difference(df, "y", "a", "b", ["g"]).collect()}
    assert set(got) == {None, "x", "y", "one"}
    for key in (None, "x", "y"):
        at = g == str(key)
        want = brute(y[at], a[at], b[at])
        r = got[key]
        assert (r["auc_old"], r["auc_new"], r["se_new"], r["se_delta"]) == pytest.approx(want, abs=1e-9)
        assert r["z"] == pytest.approx((want[1] - want[0]) / want[3])
    assert got["one"]["auc_old"] is None and got["one"]["z"] is None and got["one"]["n_neg"] == 0
    same = delong.auc_difference(df, "y", "a", "a").first()
    assert same["delta"] == 0 and same["z"] == 0


def test_z_is_normal_where_both_scores_are_equally_good(spark):
    rng = np.random.default_rng(4)
    parts = []
    for k in range(300):
        y = (rng.random(120) < 0.4).astype(int)
        signal = rng.normal(size=120) + y
        parts += [(k, int(t), float(s + u), float(s + v)) for t, s, u, v in zip(y, signal, rng.normal(size=120), rng.normal(size=120))]
    z = [r["z"] for r in delong.auc_difference(spark.createDataFrame(parts, "k int, y int, a double, b double"), "y", "a", "b", ["k"]).collect()]
    assert abs(np.mean(z)) < 0.2 and 0.85 < np.std(z) < 1.15


def test_gate_fails_only_groups_that_are_worse_beyond_chance(spark):
    rng = np.random.default_rng(5)
    n = 1200
    y = (rng.random(n) < 0.4).astype(int)
    old = rng.normal(size=n) * 0.5 + y
    g = np.where(np.arange(n) % 3 == 0, "bad", "good")
    new = np.where(g == "bad", rng.normal(size=n), old + 0.3 * y)
    df = spark.createDataFrame([(int(t), float(1 / (1 + math.exp(-p))), float(1 / (1 + math.exp(-q))), k) for t, p, q, k in zip(y, old, new, g)], "y int, a double, b double, g string")
    r = delong.tested_gate(df, "y", "a", "b", {"g": F.col("g")}, 0.6, 0.5).first()
    assert not r["groups_ok"] and r["worse"] == ["g=bad"] and not r["promote"]
    r = delong.tested_gate(df, "y", "a", "a", {"g": F.col("g")}, 0.6, 0.5).first()
    assert r["promote"] and r["worse"] == []


def test_sketches_of_days_merge_to_the_whole(spark):
    rng = np.random.default_rng(6)
    n = 6000
    rows = [(dt.date(2024, 1, 1 + i % 20), float(v) if i % 50 else None, f"u{u}", int(u)) for i, (v, u) in enumerate(zip(rng.normal(size=n), rng.integers(0, 900, n)))]
    df = spark.createDataFrame(rows, "d date, v double, t string, u int")
    daily = sketches.daily_sketches(df, F.col("d"), ["v", "u"], ["t"])
    got = {r["column_name"]: r for r in sketches.profile_of(sketches.merged(daily)).collect()}
    whole = {r["column_name"]: r for r in sketches.profile_of(sketches.merged(sketches.daily_sketches(df, F.lit(1), ["v", "u"], ["t"]))).collect()}
    for c in ("v", "u", "t"):
        assert (got[c]["n_rows"], got[c]["n_null"], got[c]["low"], got[c]["high"]) == (whole[c]["n_rows"], whole[c]["n_null"], whole[c]["low"], whole[c]["high"])
        assert got[c]["n_distinct"] == pytest.approx(whole[c]["n_distinct"], rel=0.04)
    assert got["t"]["n_distinct"] == pytest.approx(900, rel=0.06) and got["t"]["quantiles"] is None
    v = np.sort([r[1] for r in rows if r[1] is not None])
    for q, x in zip((0.25, 0.5, 0.75), got["v"]["quantiles"]):
        assert abs(np.searchsorted(v, x) / len(v) - q) < 0.02
    some = sketches.profile_of(sketches.merged(daily.where("day <= '2024-01-03'"))).where("column_name = 'v'").first()
    assert some["n_rows"] == n // 20 * 3


def test_psi_of_sketches_is_near_the_exact_one(spark):
    rng = np.random.default_rng(7)
    ref, cur = rng.normal(size=5000), rng.normal(0.5, 1.2, size=4000)
    edges = np.quantile(ref, np.arange(1, 10) / 10)
    r, c = (np.maximum(np.bincount(np.searchsorted(edges, x, side="right"), minlength=10) / len(x), 1e-4) for x in (ref, cur))
    exact = float(((c - r) * np.log(c / r)).sum())
    parts = [sketches.merged(sketches.daily_sketches(spark.createDataFrame([(float(v),) for v in x], "v double"), F.lit(0), ["v"])) for x in (ref, cur)]
    got = sketches.psi_of(*parts).first()["psi"]
    assert got == pytest.approx(exact, rel=0.12)
    assert sketches.psi_of(parts[0], parts[0]).first()["psi"] == pytest.approx(0.0, abs=1e-9)


def test_binned_density_is_within_its_bound(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=3000), rng.normal(6, 0.5, size=1000)])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "v double")
    for cells in (64, 1024):
        got = sorted(profile.kde_binned(df, "v", 50, cells).collect())
        h = x.std(ddof=1) * len(x) ** -0.2
        assert len(got) == 50
        for r in got:
            want = np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
            assert abs(r["density"] - want) <= r["error_bound"]
    assert got[0]["error_bound"] < 1e-4
    assert profile.kde_binned(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v").count() == 0
