import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskweave.llm import topk


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    clash = {"block": F.lit("x"), "place": F.lit(1), "asked": F.lit(1), "v": F.lit("y"), "low": F.lit(3), "score": F.lit(1.0), "rank": F.lit(2)}
    return df.withColumns(clash).repartition(3)


def brute(rows, k, step):
    def whole(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if whole(v)]
    out = []
    for i, v in ints:
        if i is None or i % step:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j) for j, w in ints if j != i and len(w) == len(v)]
        out += [(i, n, j, -s) for n, (s, _, _, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, k=5, **settings):
    got = topk.search(table(spark, rows), F.col("vec_id") % 50 == 0, k, **settings)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"block_rows": 90, "query_rows": 7, "bins": 16}])
def test_against_brute_force_with_ties_and_repeats(spark, settings):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(600, 8)).astype(np.float32)
    v[200:420] = v[3]  # one vector many times: ties by id
    v[450:500] *= 1e-3  # scores of zero and nearly zero
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(50, v[51].tolist()), (50, v[50].tolist()), (7, v[7].tolist()), (None, v[3].tolist())]
    assert found(spark, rows, **settings) == brute(rows, 5, 50)


def test_vectors_that_take_no_part_other_lengths_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (50, [0.5, -0.501]), (3, None), (100, []), (5, []), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (150, [1.0, 1.0, 1.0]), (None, [9.0, 9.0]), (200, None), (250, [1.0] * 4)]
    assert found(spark, rows) == brute(rows, 5, 50)
    for rows in ([], [(50, None)], [(1, [1.0])], [(50, [1.0])]):
        assert found(spark, rows) == []


def test_scores_beyond_doubles_are_exact_and_huge_vectors_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, x.tolist()) for i, x in enumerate((rng.normal(size=(120, 3)) * 1e6).astype(np.float32))]
    rows.append((500, [float(np.float32(2.0**22)), 1.0, 0.0]))
    assert found(spark, rows, bins=64) == brute(rows, 5, 50)
    assert found(spark, [*rows, (550, [3e30, 0.0, 0.0])], bins=4096) == brute(rows, 5, 50)


def test_a_tile_sends_at_most_k_bins_and_rows(spark):
    rng = np.random.default_rng(2)
    v = np.repeat(rng.normal(size=(4, 4)), 500, axis=0).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    sent = []
    met = topk._met
    def counting(*a):
        out = met(*a)
        sent.append(out.groupBy("block", "place", "bin" if "bin" in out.columns else "query_id").count().groupBy("block", "place").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0])
        return out
    topk._met = counting
    try:
        assert found(spark, rows, k=3) == brute(rows, 3, 50)
    finally:
        topk._met = met
    assert max(sent) <= 3
