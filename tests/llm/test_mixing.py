import random
import re

import numpy as np
from helpers import WORDS, documents
from riskweave.llm import mixing


def by_quotients(votes, seats):
    won = [0] * len(votes)
    for _ in range(seats):
        i = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[i] += 1
    return won


def test_sainte_lague_is_the_highest_quotients():
    rng = random.Random(1)
    for _ in range(200):
        votes = [rng.choice([0, 1, 5, rng.randrange(1, 1000)]) for _ in range(rng.randrange(1, 9))]
        seats = rng.randrange(0, 60)
        if sum(votes):
            assert mixing.sainte_lague(np.array(votes), seats).tolist() == by_quotients(votes, seats)
    assert mixing.sainte_lague(np.array([5.0, 5.0, 5.0]), 4).tolist() == [2, 1, 1]
    assert mixing.sainte_lague(np.array([0.0, 0.0]), 4).tolist() == [0, 0]


def targets(sizes):
    """Excess reshared step by step until no source is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: float(i % 3 + 1) for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        full = [s for s in open_ if left * w[s] / total >= 3 * sizes[s]]
        if not full:
            out |= {s: left * w[s] / total for s in open_}
            break
        s = min(full, key=lambda s: 3 * sizes[s] / w[s])
        out[s] = 3.0 * sizes[s]
        left -= out[s]
        open_.remove(s)
    return out


def check(spark, rows, **options):
    got = mixing.mix(documents(spark, rows), **options).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(re.findall(WORDS, r[1] or ""))
    want = targets(sizes)
    for g in got:
        assert abs(g.target - want[g.source]) < 1e-6 * max(1, want[g.source]) and g.source_size == sizes[g.source]
        assert 0 <= g.taken <= 3 * g.size
        taken[g.source] = taken.get(g.source, 0) + g.taken
    return want, taken


def test_targets_are_met_in_one_and_in_many_shards(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        source = rng.choice(["a"] * 8 + ["b", "c", "d", None])
        rows.append((i, " ".join(["w"] * rng.randrange(0, 120)), None, source))
    for options in ({}, {"shard_words": 2_000, "block_words": 8}):
        want, taken = check(spark, rows, **options)
        for s in want:
            assert abs(taken[s] - want[s]) <= 64 + 0.02 * want[s]


def test_many_shards_give_the_rows_of_the_sql(spark):
    import duckdb
    import pandas as pd
    from riskweave.llm import queries

    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 120)), None, rng.choice(["a"] * 8 + ["b", "c", "d", None])) for i in range(600)]
    rows += [(None, "same id", None, "a")] * 3 + [(None, f"other {i}", None, "a") for i in range(40)] + [(700, None, None, "b")]
    for options in ({}, {"shard_words": 1_000}, {"shard_words": 150}):
        words = options.get("shard_words", mixing.SHARD_WORDS)
        with duckdb.connect() as db:
            db.register("documents", pd.DataFrame([(i, t, s) for i, t, _, s in rows], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
            sql = "WITH " + queries.MIX_SQL.format(docs="documents", shard_words=words) + "SELECT doc_id, size, source_size, taken FROM mixed"
            want = sorted(db.execute(sql).fetchall(), key=str)
        got = sorted(((r.doc_id, r.size, r.source_size, r.taken) for r in mixing.mix(documents(spark, rows), **options).collect()), key=str)
        assert len(want) == len(rows) and got == want


def test_each_shard_has_its_quota_and_blocks_are_spread(spark):
    """With one source taken in part, every shard gives its share, from all over its stream."""
    rows = [(i, " ".join(["w"] * 40), None, "a") for i in range(400)] + [(1000 + i, " ".join(["w"] * 40), None, s) for i, s in enumerate("bc" * 500)]
    got = [r for r in mixing.mix(documents(spark, rows), shard_words=4_000, block_words=8).collect() if r.source == "a"]
    taken = sorted(r.taken for r in got)
    assert abs(sum(taken) - got[0].target) <= 64
    # blocks are drawn one by one: most documents give some words and not all
    assert sum(0 < t % 40 < 40 for t in taken) > 200


def test_reruns_agree_and_odd_rows(spark):
    rows = [(1, None, None, "a"), (1, "", None, "a"), (2, "x y", None, None), (None, "x", None, "b"), (3, "p q r", None, "b"), (3, "p q r", None, "b"), (4, "w " * 30_000, None, "c")]
    check(spark, rows)
    a, b = (sorted(map(str, mixing.mix(documents(spark, rows)).collect())) for _ in range(2))
    assert a == b
    assert mixing.mix(documents(spark, [])).count() == 0
    assert {r.taken for r in mixing.mix(documents(spark, [(1, None, None, "a"), (2, " ", None, None)])).collect()} == {0}
