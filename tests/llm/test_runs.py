import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import documents
from riskweave.llm import queries, runs


def brute(words):
    """Every run, from the definition."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            part = words[start:end]
            smallest = not any(part[p:] == part[:-p] for p in range(1, q))
            if smallest and end - start >= max(6, 4 * q):
                found.append((start, end - start, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def dropped(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed=1):
    rnd = random.Random(seed)
    out = ["", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "x a b a b a b a b a y", "a a a a a a b b b b b b b", "a b c " * 9]
    for _ in range(300):
        letters = "abcdefgh"[: rnd.randint(1, 8)]
        parts = []
        for _ in range(rnd.randint(1, 8)):
            unit = [rnd.choice(letters) for _ in range(rnd.randint(1, 6))]
            parts += unit * rnd.randint(1, 7) + unit[: rnd.randint(0, len(unit))]
            parts += [rnd.choice("uvwxyzabc") for _ in range(rnd.randint(0, 4))]
        out.append(" ".join(parts))
    a, b = "a", "a b"
    for _ in range(9):  # Fibonacci words: many repeats, no run of four periods
        a, b = b, f"{b} {a}"
    out += [b, " ".join([b] * 5), " ".join(["q"] * 3000), " ".join(f"w{i % 700}" for i in range(3100)), " ".join(f"w{i % 800}" for i in range(3100))]
    return out


def test_every_run_against_brute_force():
    every = texts()
    words, found = runs.runs_of_texts([t.encode() for t in every])
    for t, w, r in zip(every, words, found):
        assert [x.decode() for x in w] == t.split()
        assert r == brute(t.split()), t[:200]


def test_lags_in_small_blocks(monkeypatch):
    monkeypatch.setattr(runs, "BLOCK", 64)
    every = texts(2)[:120]
    _, found = runs.runs_of_texts([t.encode() for t in every])
    assert found == [brute(t.split()) for t in every]


def test_splitting_recurs_until_stable():
    # x occurs four times in the whole, but once in each part that the rare words leave
    text = "x " + "a b a b a b a b r1 x c c c c c c r2 x d e f g r3 x a b"
    w = text.split()
    seen = {}
    codes = np.array([seen.setdefault(x, len(seen)) for x in w])
    begins, ends = runs.surviving_segments(codes, np.array([0, len(w)]))
    assert [w[a:b] for a, b in zip(begins, ends)] == [["a", "b"] * 4, ["c"] * 6]


def planted(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
    return w


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_columns(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts(3)[:200])]
    rnd = random.Random(5)
    rows += [(1000 + i, " ".join(rnd.choice(["ça", "B", "b", "\x1c", "x y", "z"]) for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    rows += [(7, None), (7, "a\tb\na\x0bb\x0ca\rb a b"), (None, "a a a a a a a"), (10, ""), (20, "  \n "), (30, "k " * 6), (30, "k " * 6)]
    documents(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in got.dtypes if c not in ("runs_sha256", "collapsed_sha256")} == {"bigint"}
    want = []
    for i, t in rows:
        w = planted(i, t)
        r = brute(w)
        best = max(r, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if r else None
        digest = sha("".join(f"{s},{n},{q}\n" for s, n, q in r))
        want.append((i, len(r), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest, sha(dropped(w, r))))
    def key(r):
        return tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_tables(spark, rows):
    got = runs.find_runs(documents(spark, rows)).collect()
    assert [(r.doc_id, r.n_words, r.runs, r.collapsed) for r in got] == [(1, 0, [], "")] * len(rows)


def test_a_very_long_text_in_seconds():
    rnd = random.Random(9)
    words = [f"w{rnd.randint(0, 300)}" for _ in range(300_000)]
    words[100_000:140_000] = [f"v{i % 9000}" for i in range(40_000)]
    _, found = runs.runs_of_texts([" ".join(words).encode()])
    assert found == [[(100_000, 40_000, 9000)]]
