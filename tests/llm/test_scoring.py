import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import WORDS, documents, lower
from pyspark.sql import functions as F
from riskweave.llm import scoring


def brute(rows, held, order, strength):
    stream = [[*re.findall(WORDS, lower(t)), "</s>"] for _, t in rows]
    counts = [Counter() for _ in range(order + 1)]
    begun = sum(not held(i) for i, _ in rows)
    for (i, _), ts in zip(rows, stream):
        if not held(i):
            for k in range(1, order + 1):
                padded = ["<s>"] * (k - 1) + ts
                counts[k].update(tuple(padded[j : j + k]) for j in range(len(ts)))
    n, v = sum(counts[1].values()), len(counts[1])
    out = []
    for (i, _), ts in zip(rows, stream):
        base = score = 0.0
        for j, w in enumerate(ts):
            p = (counts[1][(w,)] + 1) / (n + v + 1)
            base += math.log10(p)
            for k in range(2, order + 1):
                padded = (["<s>"] * (k - 1) + ts)[j : j + k]
                context = padded[:-1]
                c = begun if all(x == "<s>" for x in context) else counts[k - 1][tuple(context)]
                p = (counts[k][tuple(padded)] + strength[k - 2] * p) / (c + strength[k - 2])
            score += math.log10(p)
        out.append((i, held(i), len(ts), sum(counts[1][(w,)] > 0 for w in ts), n, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("order,shard_bytes", [(2, 1 << 20), (2, 700), (3, 700)])
def test_against_brute_force(spark, order, shard_bytes):
    rng = random.Random(order)
    vocabulary = ["a", "B", "cc", "Éd", "e.", "F", " x"]
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 25)))) for i in range(80)]
    rows += [(None, "a B cc"), (7, None), (7, rows[7][1]), (8, ""), (9, "  \n "), (200, "cc a " * 20_000), (201, "y" * 5000)]
    got = scoring.score(documents(spark, rows), F.col("doc_id") % 7 == 2, order, (3.0, 2.0), shard_bytes).collect()
    want = brute(rows, lambda i: i is not None and i % 7 == 2, order, (3.0, 2.0))
    got = sorted((tuple(r) for r in got), key=str)
    assert [(g[0], *g[1:5]) for g in sorted(got, key=lambda g: (str(g[:5]), round(g[5], 6)))] == [
        (w[0], *w[1:5]) for w in sorted(want, key=lambda g: (str(g[:5]), round(g[5], 6)))
    ]
    for g, w in zip(sorted(got, key=lambda g: (str(g[:5]), round(g[5], 6))), sorted(want, key=lambda g: (str(g[:5]), round(g[5], 6)))):
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9)


def test_empty_and_all_held_out(spark):
    assert scoring.score(documents(spark, []), F.lit(False)).count() == 0
    row = scoring.score(documents(spark, [(1, "a b")]), F.lit(True)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score == row.base_score == 0.0


def test_automaton_walked_token_by_token():
    """States, arcs and failure arcs as tables, one token after the other."""
    rng = random.Random(8)
    texts = [[rng.choice("abcd") for _ in range(rng.randrange(1, 12))] + ["</s>"] for _ in range(40)]
    n = {k: Counter() for k in (1, 2, 3)}
    for t in texts[:30]:
        padded = ["<s>", "<s>", *t]
        for k in n:
            n[k].update(tuple(padded[j - k + 1 : j + 1]) for j in range(2, len(padded)))
    total, v, mu = sum(n[1].values()), len(n[1]), (3.0, 2.0)
    def context(h):
        return 30 if set(h) == {"<s>"} else n[len(h)][h]
    def arc(h, w):
        p = (n[1][(w,)] + 1) / (total + v + 1)
        for k in range(1, len(h) + 1):
            own = h[len(h) - k :]
            p = (n[k + 1][(*own, w)] + mu[k - 1] * p) / (context(own) + mu[k - 1])
        return math.log10(p)
    want, counts, contexts = [], [[], [], []], [[], []]
    for t in texts:
        padded = ["<s>", "<s>", *t]
        for j in range(2, len(padded)):
            w, h = padded[j], tuple(padded[j - 2 : j])
            for k in (0, 1, 2):
                counts[k].append(n[k + 1][tuple(padded[j - k : j + 1])])
            contexts[0].append(context(h[1:]))
            contexts[1].append(context(h))
            state = h if context(h) else h[1:] if context(h[1:]) else ()
            cost = 0.0
            while state and not n[len(state) + 1][(*state, w)]:
                m = mu[len(state) - 1]
                cost += math.log10(m / (context(state) + m))
                state = state[1:]
            want.append(cost + arc(state, w))
    a = [np.array(c) for c in counts]
    got = scoring.Automaton(a, [np.array(c) for c in contexts], (a[0] + 1) / (total + v + 1), mu).traverse()
    assert np.allclose(got, want, atol=1e-12)
