import random

import numpy as np
import pytest
from helpers import documents
from riskweave.llm import substrings, suffixes


def brute(rows, length=50):
    ids = [float("inf") if i is None else i for i, _ in rows]
    first = {}
    texts = [(t or "").encode() for _, t in rows]
    for i, b in zip(ids, texts):
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for (doc_id, _), i, b in zip(rows, ids, texts):
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < i:
                gone[s : s + length] = b"\1" * length
        spans, s = [], 0
        while s < len(b):
            e = s
            while e < len(b) and gone[e] == gone[s]:
                e += 1
            if gone[s]:
                spans.append((s, e))
            s = e
        out.append((doc_id, len(b), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    got = substrings.deduplicate(documents(spark, rows), **options).collect()
    return sorted(((r.doc_id, r.n_bytes, [(s.begin, s.end) for s in r.spans], bytes(r.kept)) for r in got), key=str)


def corpus(seed=4):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("ab é\x00") for _ in range(rng.choice([49, 50, 51, 80, 200]))) for _ in range(6)]
    rows = []
    for i in range(70):
        text = "".join(rng.choice("xyzw ü") for _ in range(rng.randrange(0, 150)))
        for _ in range(rng.randrange(0, 3)):
            cut = rng.randrange(0, len(text) + 1)
            text = text[:cut] + rng.choice(passages) + text[cut:]
        rows.append((i, text))
    rows += [(3, rows[5][1]), (None, rows[6][1]), (None, passages[3] + "tail"), (80, None), (81, ""), (82, "a" * 3000), (83, "a" * 2000 + "b" * 60), (84, rows[10][1]), (84, rows[10][1])]
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 1500}, {"shard_bytes": 1500, "hot_runs": 2}, {"shard_bytes": 400, "hot_runs": 1}])
def test_against_brute_force(spark, options):
    rows = corpus()
    assert run(spark, rows, **options) == brute(rows)


def test_several_suffix_arrays_in_a_shard(monkeypatch):
    """A stretch longer than one array is cut without losing windows."""
    starts, sizes = np.array([0, 40, 200]), np.array([40, 25, 10])
    seen = []
    for at, windows in substrings.regions(starts, sizes, 50, 30):
        seen += substrings.spread(at, windows).tolist()
    assert sorted(seen) == [*range(0, 65), *range(200, 210)]


def test_empty_tables_and_kept_columns(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, [], b""), (2, 0, [], b"")]
    kept = substrings.deduplicate(documents(spark, [(1, "é" * 40, "fr", "s"), (2, "x" + "é" * 40, "fr", "t")]), keep=("doc_id", "source"))
    assert {(r.doc_id, r.source, r.kept_text) for r in kept.collect()} == {(1, "s", "é" * 40), (2, "t", "x")}


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(150):
        entries = [rng.integers(0, rng.integers(2, 4), rng.integers(1, 40)).astype(np.uint8) for _ in range(rng.integers(1, 5))]
        data, lengths = np.concatenate(entries), np.array([len(e) for e in entries])
        at = np.cumsum(lengths) - lengths
        x, places, sources = suffixes.concatenated(at, lengths, data)
        entry = np.repeat(np.arange(len(entries)), lengths)
        tail = {int(p): (data[s : at[e] + lengths[e]].tolist(), e) for p, s, e in zip(places, sources, entry)}
        sa, rank = suffixes.suffix_array(x, places)
        want = sorted(tail, key=lambda p: [(c, 0) for c in tail[p][0]] + [(-1, tail[p][1])])
        assert sa.tolist() == want

        def shared(a, b):
            return next((n for n, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))

        exact = [0] + [shared(tail[a][0], tail[b][0]) for a, b in zip(want, want[1:])]
        assert suffixes.common_prefixes(x, sa, rank).tolist() == exact
        depth = int(rng.integers(7, 15))
        sa, rank = suffixes.suffix_array(x, places, depth)
        got = suffixes.common_prefixes(x, sa, rank, depth).tolist()
        for a, b, g in zip(sa[:-1].tolist(), sa[1:].tolist(), got[1:]):
            n = shared(tail[a][0], tail[b][0])
            assert (g >= depth) == (n >= depth) and (g >= depth or g == n)
