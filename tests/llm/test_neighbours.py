import numpy as np
import pytest
from pyspark.sql import functions as F
from riskweave.llm import neighbours as nn


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumns({"part": F.lit(3), "block": F.lit("x"), "score": F.lit(1.0), "rank": F.lit(2)})


def brute(rows, k, step):
    best = {}
    kept = list({(i, tuple(v)) for i, v in rows})
    for i, v in kept:
        if i % step == 0:
            s = sorted(((-float(np.dot(np.float64(v), np.float64(w))), j) for j, w in kept if j != i))[:k]
            best[i] = [j for _, j in s]
    return best


@pytest.mark.parametrize("block_rows", [8192, 100])
def test_recall_ties_and_order(spark, block_rows):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 16))
    v = (centres[rng.integers(0, 12, 1500)] + 0.6 * rng.normal(size=(1500, 16))).astype(np.float32)
    v[700:1000] = v[3]  # one vector many times: ties by id
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got = {}
    for r in nn.search(table(spark, [*rows, rows[5], rows[5]]), F.col("vec_id") % 20 == 0, 20, block_rows).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, 20, 20)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all((a[2], -a[1]) > (b[2], -b[1]) for a, b in zip(found, found[1:]))
        for _, j, s in found:
            assert j != q and abs(s - float(np.dot(np.float64(v[q]), np.float64(v[j])))) < 1e-12
        hits += len({j for _, j, _ in found} & set(want[q]))
    assert hits >= 0.95 * 20 * len(want)
    assert [j for _, j, _ in got[700]] == want[700]


def test_vectors_that_take_no_part_and_small_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (20, [-1.0, 0.0]), (40, None)]
    got = nn.search(table(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [
        (0, 1, 1, 1.0), (0, 2, 2, 0.5), (0, 3, 20, -1.0), (20, 1, 2, -0.5), (20, 2, 0, -1.0), (20, 3, 1, -1.0)]
    for rows in ([], [(3, None)]):
        assert nn.search(table(spark, rows), F.col("vec_id") % 20 == 0).count() == 0
    assert nn.search(table(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 8))
    graph = nn.neighbour_graph(x)
    label = nn.balanced_parts(x, graph, 8)
    sizes = np.bincount(label, minlength=8)
    assert sizes.max() <= np.ceil(100 * 1.1) + 1 and sizes.min() >= 89
    chance = rng.permutation(label)
    assert (label[graph] == label[:, None]).mean() > 2 * (chance[graph] == chance[:, None]).mean()


def test_repeated_ids_with_other_vectors_are_queries_of_their_own(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [1.0, 3.0])]
    got = sorted((r["rank"], r.vec_id, r.score) for r in nn.search(table(spark, rows), F.col("vec_id") % 20 == 0).collect())
    assert got == [(1, 1, 2.0), (1, 2, 3.0), (2, 1, 1.0), (2, 2, 1.0)]
