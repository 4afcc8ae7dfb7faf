import random

import numpy as np
from helpers import documents
from pyspark.sql import functions as F
from riskweave.llm import language, toxicity


def test_machine_learns_an_interaction():
    """Toxic only if an insult meets a group mention: no additive score can do it as sharply."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(3000):
        insult, group, excuse = (rng.random(3) < 0.5).tolist()
        words = ["insult"] * insult + ["group"] * group + ["excuse"] * excuse + [f"w{rng.integers(0, 40)}" for _ in range(5)]
        rows.append(toxicity.terms(" ".join(words)))
        labels.append(float(insult != group))
    y = np.array(labels)
    kept = np.array(sorted({t for w in ("insult", "group") for t in toxicity.word_terms(w)}), dtype=np.int32)
    try:
        telling, toxicity.telling_terms = toxicity.telling_terms, lambda *_: kept
        m = toxicity.train(rows, y, epochs=20)
    finally:
        toxicity.telling_terms = telling
    at = [np.searchsorted(m.kept, r[np.isin(r, m.kept)]) for r in rows]
    right = np.mean([(m.margin(a) >= 0) == t for a, t in zip(at, labels)])
    assert right > 0.97


def test_pairs_of_neutral_terms_are_learned_among_all_terms():
    """Each of the two terms alone is as frequent in toxic as in clean texts; nothing picks them out beforehand."""
    for fill, vocabulary, often in ((5, 40, 0.5), (60, 2000, 0.5)):
        rng = np.random.default_rng(0)
        rows, labels = [], []
        for _ in range(2500):
            insult, group = (rng.random(2) < often).tolist()
            words = ["insult"] * insult + ["group"] * group + [f"w{rng.integers(0, vocabulary)}" for _ in range(fill)]
            rows.append(toxicity.terms(" ".join(words)))
            labels.append(float(insult != group))
        y = np.array(labels)
        m = toxicity.train(rows[:2000], y[:2000])
        assert set(np.concatenate(rows[:2000]).tolist()) == set(m.kept.tolist())
        at = [np.searchsorted(m.kept, r[np.isin(r, m.kept)]) for r in rows[2000:]]
        assert np.mean([(m.margin(a) >= 0) == t for a, t in zip(at, labels[2000:], strict=True)]) > 0.97


def test_toxicity_end_to_end(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(200)}" for _ in range(rng.randrange(1, 60))]
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randrange(len(words) + 1), rng.choice(["scumbag", "LOSER!", "moronic"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (902, "w1 " * 30_000 + "scumbag"), (903, "w1 " * 30_000), (None, "scumbag"), (904, "x"), (904, "x")]
    table = spark.createDataFrame([*labels, (1, None), (None, 1), (3, 0), (3, 0)], "doc_id long, toxic int").withColumn("text", F.lit("scumbag"))
    docs = documents(spark, rows)
    machine = toxicity.fit(docs, table, F.col("doc_id") % 7 == 0)
    got = toxicity.score(docs, machine).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert np.mean([by[i].predicted == y for i, y in labels]) > 0.98
    assert (by[902].predicted, by[903].predicted, by[None].predicted) == (1, 0, 1)
    assert by[900].score == by[901].score and all(0 <= r.score <= 1 for r in got)
    same = toxicity.fit(docs, table, F.col("doc_id") % 7 == 0)
    assert (same.weights == machine.weights).all()


def test_toxicity_without_labels(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    for labels in ([], [(1, 0)], [(1, None)]):
        m = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(False))
        assert {r.predicted for r in toxicity.score(docs, m).collect()} == {0}
    one = toxicity.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), F.lit(False))
    assert {r.predicted for r in toxicity.score(docs, one).collect()} == {1}
    assert toxicity.score(documents(spark, []), one).count() == 0


def test_language_end_to_end(spark):
    rng = random.Random(2)
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "ung", "ei", "kt"], "cc": ["é", "ou", "x", "ai"]}
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(syllables))
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(rng.randrange(5, 60)))
        rows.append((i, text, lang if i % 10 else None))
    rows += [(400, None), (401, ""), (402, "123 !?"), (403, "kalo " * 40_000), (404, "KALO MITU"), (None, "kalo mitu", "aa"), (1, rows[1][1], rows[1][2])]
    docs = documents(spark, rows)
    model = language.fit(docs, F.col("doc_id") % 5 == 0)
    assert model.names == ["aa", "bb", "cc"] and model.temperature > 0
    got = language.predict(docs, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    known = [(r[0], r[2]) for r in rows[:300] if r[2]]
    assert np.mean([by[i].lang_pred == la for i, la in known]) > 0.98
    assert [(by[i].lang_pred, by[i].score) for i in (400, 401, 402)] == [("und", 0.0)] * 3
    assert by[403].lang_pred == by[404].lang_pred == "aa" and all(0 <= r.score <= 1 for r in got)


def test_language_sample_is_bounded_in_rows(spark, monkeypatch):
    """Copies of one id, and null ids, neither exceed the bound nor crowd out other documents."""
    rows = [(None, "kalo mitu", "aa")] * 300 + [(7, "lomi tuka", "aa")] * 300 + [(1000 + i, f"kami {i} tulo", "aa") for i in range(30)]
    taken = []
    real = language.fit_in_task
    monkeypatch.setattr(language, "fit_in_task", lambda sample, learn: (taken.append([r.text for r in sample.collect()]), real(sample, learn))[1])
    language.fit(documents(spark, rows), F.lit(False), train_rows=32)
    language.fit(documents(spark, rows), F.lit(False), train_rows=10)
    assert len(taken[0]) == len(set(taken[0])) == 32 and len(taken[1]) == len(set(taken[1])) == 10


def test_language_without_training_rows(spark):
    docs = documents(spark, [(1, "text", None), (2, None, "aa")])
    model = language.fit(docs, F.lit(False))
    assert {r.lang_pred for r in language.predict(docs, model).collect()} == {"und"}
    assert language.predict(documents(spark, []), model).count() == 0


def test_temperature_and_long_texts():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 4000)
    margins = rng.normal(0, 1, (4000, 3))
    margins[np.arange(4000), y] += 1.0
    assert abs(language.best_temperature(margins * 4, y) / language.best_temperature(margins, y) - 4) < 0.05
    long = "abc déf " * 30_000
    assert (language.gram_counts(long) >= language.gram_counts(long[:1000])).all()
    assert language.gram_counts(long).sum() == 3 * len(long) - 3


def test_margins_are_the_sum_over_pairs():
    rng = np.random.default_rng(6)
    m = toxicity.Machine(np.arange(40, dtype=np.int32), 0.3, rng.normal(size=40), rng.normal(size=(40, 3)))
    texts = [np.sort(rng.choice(40, n, replace=False)) for n in (0, 1, 2, 7, 0, 25)]
    want = [0.3 + sum(m.weights[i] for i in t) + sum(m.factors[i] @ m.factors[j] for i in t for j in t if i < j) for t in texts]
    got = m.margins(np.concatenate(texts).astype(np.int64), np.array([len(t) for t in texts]))
    assert np.allclose(got, want) and np.allclose([m.margin(t.astype(np.int64)) for t in texts], want)


def test_best_cut_against_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(50):
        y = (rng.random(40) < 0.3).astype(float)
        m = np.round(rng.normal(size=40) + y, 1)
        cut = toxicity.best_cut(m, y)
        def f1(t):
            return 2 * (y * (m >= t)).sum() / max(1e-9, (m >= t).sum() + y.sum())
        assert f1(cut) >= max(f1(t) for t in np.unique(m)) - 1e-12 or not y.sum()
    assert toxicity.best_cut(np.array([1.0, 2.0]), np.zeros(2)) == 0.0


def test_toxicity_sample_is_bounded_in_rows(spark, monkeypatch):
    """Copies of a labelled id, and its other texts, neither exceed the bound nor come twice."""
    rows = [(1, "same text")] * 500 + [(2, f"text {i}") for i in range(200)] + [(i, f"w{i}") for i in range(10, 40)]
    taken = []
    real = toxicity.fit_in_task
    monkeypatch.setattr(toxicity, "fit_in_task", lambda sample, learn: (taken.append([r.key for r in sample.collect()]), real(sample, learn))[1])
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in rows], "doc_id long, toxic int")
    toxicity.fit(documents(spark, rows), labels, F.lit(False), train_rows=25)
    assert len(taken[0]) == len(set(taken[0])) <= 25
