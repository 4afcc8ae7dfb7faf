"""Small tables for the tests of this folder."""

import re

WORDS = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) with columns that clash with the operators' own names."""
    full = [(*r, *[None] * (4 - len(r))) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in full], schema)
    clash = {c: "x" for c in ("shard", "digest", "fp", "size", "key", "start", "score", "held_out", "bucket", "words", "label", "part", "item_id", "toxic",
                             "_doc", "_digest", "_own", "_told", "_lang", "_text", "_Doc_", "component", "hits")}
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(v) for c, v in clash.items()})
