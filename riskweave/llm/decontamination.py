"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every window of ``WINDOW`` words is represented by the least hash of its
``GRAM``-word grams, so a span of that many words shared with an item always
shares a fingerprint. Documents that share one are candidates; their windows
are then compared with the items' own windows and the hits extended to words.

Windows are compared by two independent 64-bit hashes of their whole text.
Items of fewer words are one window; for every such length that the benchmark
has, all document windows of that length are fingerprints.

Defined cases: a null or empty text has no words; an item without words has no
window; repeated documents and items each keep their row (an item_id that
stands twice counts once); empty tables give no hits; columns other than
doc_id, item_id and text are ignored; a null item_id counts as empty text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import fresh, lower_ascii
from riskweave.session import materialize

WINDOW, GRAM = 10, 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words as an array; none for a null text."""
    parts = F.split(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, " "), " ")
    return F.filter(parts, lambda w: w != "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def positions(n: Column) -> Column:
    """0 .. n-1; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def winnowed(words: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """The fingerprint of each window, in order."""
    span = window - gram + 1

    def of_hashes(h: Column) -> Column:
        grams = F.transform(positions(F.size(h) - gram + 1), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(gram)]))
        return bound(grams, lambda g: F.transform(positions(F.size(g) - span + 1), lambda i: F.least(*[F.get(g, i + j) for j in range(span)])))

    return bound(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def windows(words: Column, length: int) -> Column:
    """(start, length, h1, h2) of each window of so many words."""

    def one(i: Column) -> Column:
        return bound(
            F.array_join(F.slice(words, i + 1, F.lit(length)), " "),
            lambda t: F.struct(i.alias("start"), F.lit(length).alias("length"), F.xxhash64(t).alias("h1"), F.xxhash64(t, F.lit(1)).alias("h2")),
        )

    return F.transform(positions(F.size(words) - length + 1), one)


def item_windows(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """item_id, length, h1, h2, fingerprint; one row per distinct window of an item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("words"))
    long = items.where(F.size("words") >= window).select(
        "item_id", F.inline(F.arrays_zip(windows(F.col("words"), window).alias("w"), winnowed(F.col("words"), window, gram).alias("fingerprint")))
    )
    long = long.select("item_id", "w.*", "fingerprint")
    short = items.where((F.size("words") > 0) & (F.size("words") < window))
    text = F.array_join("words", " ")
    short = short.select(
        "item_id",
        F.lit(0).alias("start"),
        F.size("words").alias("length"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(text, F.lit(1)).alias("h2"),
        F.xxhash64(text).alias("fingerprint"),
    )
    return long.unionByName(short).drop("start").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, digest (a hash of the text), n_words, n_hit, n_items, items_sha256,
    contaminated: one row per document.

    The whole corpus is read twice: once for its fingerprints, which are joined
    with those of the items, and once for the windows of the candidates. Tables
    between are written to the shared folder, so the planner knows their true
    size: a small item table is broadcast, a large one is shuffled with the
    fingerprints.
    """
    items = materialize(item_windows(benchmark, window, gram), "items")
    short = [r[0] for r in items.where(F.col("length") < window).select("length").distinct().collect()]  # at most window - 1 numbers

    def prints(words: Column) -> Column:
        shorter = [F.transform(windows(words, n), lambda w: w["h1"]) for n in sorted(short)]
        return F.array_distinct(F.concat(winnowed(words, window, gram), *shorter))

    text = F.coalesce("text", F.lit(""))
    row = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("digest"))
    scanned = row.select(
        "doc_id",
        "digest",
        bound(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), prints(w).alias("prints"))).alias("x"),
    )
    scanned = materialize(scanned.select("doc_id", "digest", "x.n_words", "x.prints"), "prints")
    shared = (
        scanned.select("doc_id", "digest", F.explode("prints").alias("fingerprint"))
        .join(materialize(items.select("fingerprint").distinct(), "item-prints"), "fingerprint", "left_semi")
        .select("doc_id", "digest")
        .distinct()
    )
    shared = materialize(shared.select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest")), "candidates")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest"))
    candidates = row.join(shared, same, "left_semi")
    every = [*sorted(short), window]
    spans = (
        candidates.dropDuplicates(["doc_id", "digest"])
        .select("doc_id", "digest", F.inline(bound(words_of(F.col("text")), lambda w: F.concat(*[windows(w, n) for n in every]))))
        .join(items, ["length", "h1", "h2"])
        .select("doc_id", "digest", "start", "length", "item_id")
    )
    hit = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "length"))),
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["total"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).alias("total"),
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
        ),
    )
    found = spans.groupBy("doc_id", "digest").agg(hit["total"].alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
    found = materialize(found.select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), "n_hit", "items"), "hits")
    return scanned.join(found, same, "left").select(
        "doc_id",
        "digest",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` without any hit."""
    doc, told = fresh(docs, "_doc", "_told")
    hit = contamination(docs, benchmark, window, gram).where("contaminated").select(F.col("doc_id").alias(doc), F.col("digest").alias(told))
    hit = materialize(hit.distinct(), "contaminated")
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col(doc)) & (digest == F.col(told)), "left_anti")
