import hashlib
import random
import re

from helpers import documents, lower
from riskweave.llm import decontamination as dc

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(ITEM_WORD, lower(text))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, t in items:
            v = words(t)
            n = min(10, len(v))
            for k in range(len(v) - n + 1) if v else []:
                for s in range(len(w) - n + 1):
                    if w[s : s + n] == v[k : k + n]:
                        hit |= set(range(s, s + n))
                        found.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "'y' AS length")
    got = dc.contamination(documents(spark, docs), table).drop("digest")
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = ["Éa", "b7", "c", "d", "ê", "F"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([0, 1, 3, 9, 10, 11, 14, 14, 30, 10])]
    items += [(2, items[4][1]), (None, items[5][1]), (77, None), (78, "?!"), (8, items[8][1])]
    docs = []
    for i in range(60):
        text = " ".join(rng.choice(["zz", "y", "Éa", "b7"]) for _ in range(rng.randrange(0, 30)))
        if i % 3 == 0:
            item = rng.choice(items)[1] or ""
            text += "... " + item.upper().replace("Ê", "ê").replace(" ", rng.choice([" ", ", ", "\n"])) + " end " + text
        docs.append((i, text))
    docs += [(None, items[6][1]), (3, docs[3][1]), (3, "other"), (90, None), (91, ""), (92, items[8][1] + " " + "q " * 30_000)]
    assert run(spark, docs, items) == brute(docs, items)


def test_long_items_only_and_empty_tables(spark):
    docs = [(1, "a b c d e f g h i j k"), (2, "a b c d e f g h i")]
    items = [(5, "x a b c d e f g h i j")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []
    kept = dc.clean(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert [r.doc_id for r in kept.collect()] == [2]


def test_every_shared_window_shares_a_fingerprint(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("p q r s t u v w x y z a b",), ("k q r s t u v w x y z a m n",)], "text string")
    a, b = (set(r[0]) for r in df.select(dc.winnowed(dc.words_of(F.col("text")))).collect())
    assert a & b


def test_main_path_is_native(spark, sf):
    from riskweave.llm import queries

    for name in ("op1_chat_format", "op10_decontaminate"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
