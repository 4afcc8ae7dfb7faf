import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import documents, lower
from riskweave.llm import phrases


def brute(rows, least=30, top=2000):
    f = defaultdict(Counter)
    n = Counter()
    for row in rows:
        lang = (row[2] if len(row) > 2 else None) or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(row[1])):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        found = []
        for p, a in candidates.items():
            held = (q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if any(100 * candidates[q] >= 80 * a for q in held):
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def corpus(seed, docs=120):
    rnd = random.Random(seed)
    words = ["the", "of", "Ünion", "a", "New", "york", "city", "x1", "\x1cq", "n b", "Be", "or"]
    common = ["New York City hall", "one two three four five", "the of", "ça va"]
    out = []
    for i in range(docs):
        parts = []
        for _ in range(rnd.randint(0, 40)):
            parts.append(rnd.choice(common) if rnd.random() < 0.3 else " ".join(rnd.choices(words, weights=range(len(words), 0, -1), k=rnd.randint(1, 4))))
            parts.append(rnd.choice([" ", " ", "  ", "\t", ". ", ", ", "\n", "!", "\r", "\x0b"]))
        out.append((i, "".join(parts), rnd.choice(["en", "en", "en", "fr", None, "und"])))
    return out


def got(df):
    assert df.dtypes == [(c, "string" if c in ("lang", "phrase") else "bigint") for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("sizes", [{}, {"bucket_bytes": 900, "batch_words": 700}, {"bucket_bytes": 200, "batch_words": 100}])
def test_against_brute_force(spark, sizes):
    rows = corpus(1)
    rows += [rows[3], rows[3], (None, None, "en"), (900, "", None), (901, " . ! ", "fr"), (902, "the of " * 2000, "en")]
    assert got(phrases.collocations(documents(spark, rows).repartition(5), **sizes)) == brute(rows)


def test_top_and_least_are_parameters_and_ties(spark):
    rows = corpus(2, 40) + [(500 + i, "b c. d e. a b c d", "en") for i in range(6)]
    want = brute(rows, 6, 9)
    assert len(want) > 20
    assert got(phrases.collocations(documents(spark, rows), 6, 9, bucket_bytes=500, batch_words=300)) == want


def test_frequent_beginnings_are_spread_and_counted_whole(spark):
    # one pair begins nearly every window and goes on in many ways
    rnd = random.Random(3)
    rows = [(i, " ".join(f"hot pair s{rnd.randint(0, 900)} t{rnd.randint(0, 5)}" for _ in range(80)), "en") for i in range(60)]
    df = documents(spark, rows).repartition(4)
    hot = phrases._frequent_beginnings(df.select("lang", "text"), 1.0, 40, 30)
    assert (b"hot", b"pair") in hot["en"]
    assert got(phrases.collocations(df, bucket_bytes=800, batch_words=500)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, "en")], [(1, ".,;", None)]])
def test_no_words(spark, rows):
    assert got(phrases.collocations(documents(spark, rows))) == []
