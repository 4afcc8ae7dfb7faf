import random
import re

import numpy as np
import xxhash
from helpers import WORDS, documents, lower
from riskweave.llm import simhash
from riskweave.llm.components import components


def brute_fingerprint(text):
    w = re.findall(WORDS, lower(text))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def parts(values, radius=2):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints():
    rng = random.Random(8)
    for n in [0, 1, 2, 3, 4, 50, 5000]:
        text = rng.choice([" ", "\n\t"]).join(rng.choice(["Aé", "b", "C", " d"]) for _ in range(n))
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_stars_of_dense_groups_are_the_components():
    rng = np.random.default_rng(1)
    group, fps = [], []
    for g in range(5):
        centre = int(rng.integers(0, 2**63))
        own = {centre}
        while len(own) < 120:
            x = rng.choice(sorted(own)) if g % 2 else centre
            own.add(int(x) ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
        group += [g] * len(own)
        fps += list(own)
    u, v = simhash.stars(np.array(group), np.array(fps, dtype=np.uint64))
    for g in range(5):
        own = sorted(f for h, f in zip(group, fps) if h == g)
        want = {(own[i], own[p]) for i, p in enumerate(parts(own)) if i != p}
        assert want <= set(zip(u.tolist(), v.tolist()))


def test_links_find_every_pair_within_the_radius(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1, 3, 1 << 63}
    for f in list(fps):
        fps |= {f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(3)}
    own = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in own]
    edges = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    parent = {f: f for f in own}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        a, b = find(e.u % 2**64), find(e.v % 2**64)
        parent[max(a, b)] = min(a, b)
    want = parts(own)
    assert [own.index(find(f)) for f in own] == want


def test_components_of_chains_hubs_and_nulls(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(5, 5), (3, 2), (None, 4), (1000, 7)]
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 1000: 0}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 400]))]
        rows.append((i, " ".join(words)))
        if i % 4 == 0:
            rows.append((1000 + i, " ".join(words)))
            rows.append((900 - i, " ".join([*words, "tail"])))
    rows += [(70, None), (71, ""), (72, " \n"), (None, rows[0][1]), (None, "only null ids"), (5, "A b"), (5, "a B"), (2000, "x " * 40_000)]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    values = [brute_fingerprint(t) for _, t in rows]
    part = parts(values)
    least = {}
    for (i, _), p in zip(rows, part):
        least[p] = min(x for x in (least.get(p), i) if x is not None) if (least.get(p), i) != (None, None) else None
    want = sorted(((i, format(f, "016x"), least[p]) for (i, _), f, p in zip(rows, values, part)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want
    stay = simhash.without_near_duplicates(documents(spark, rows)).collect()
    assert len(stay) == len(set(part))
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
