"""Deterministic splits, samples, folds and duplicate checks.

All of them order or bucket rows by a digest of a key, so the same row lands on
the same side on every run and on every cluster size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.hashing import digest_number, hash_mod, key_digest
from riskweave.operators.ordered import dense_codes
from riskweave.session import broadcast_if_small

HEAD_DIGITS = 4  # 65 536 digest buckets


def hash_split(df: DataFrame, key: Sequence[str], test_share: float = 0.2, seed: str = "") -> DataFrame:
    """Add ``is_test``: a digest bucket test, no shuffle."""
    limit = round(test_share * 10_000)
    return df.withColumn("is_test", hash_mod(key, 10_000, seed) < limit)


def _cuts(df: DataFrame, key: Sequence[str], strata: Sequence[str], wanted: Column, seed: str) -> DataFrame:
    """``(strata, _cut)``: the digest of rank ``wanted`` in each stratum.

    Counting digest heads finds the one bucket that holds the cut; only that
    bucket (1/65536 of the rows) is ordered. ``wanted`` may use ``_n``, the
    size of the stratum.
    """
    digest = key_digest(key, seed)
    heads = df.select(*strata, digest.alias("_d")).select(
        *strata, "_d", F.substring("_d", 1, HEAD_DIGITS).alias("_h")
    )
    per_head = heads.groupBy(*strata, "_h").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*strata).orderBy("_h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*strata)
    # at most 65 536 rows per stratum from here on
    placed = (
        per_head.withColumn("_upto", F.sum("_c").over(running))
        .withColumn("_n", F.sum("_c").over(whole))
        .withColumn("_k", wanted.cast("bigint"))
        .filter("_k > 0 and _upto >= _k and _upto - _c < _k")
        .select(*strata, "_h", (F.col("_k") - (F.col("_upto") - F.col("_c"))).alias("_r"))
    )
    renamed = placed.select(*[F.col(s).alias(f"_s{i}") for i, s in enumerate(strata)], F.col("_h").alias("_hh"), "_r")
    # one row per stratum; a single row when there are no strata
    renamed = broadcast_if_small(renamed) if strata else F.broadcast(renamed)
    same = [heads[s].eqNullSafe(renamed[f"_s{i}"]) for i, s in enumerate(strata)]
    condition = heads["_h"] == renamed["_hh"]
    for c in same:
        condition = condition & c
    candidates = heads.join(renamed, condition)
    rank = F.row_number().over(Window.partitionBy(*strata, "_h").orderBy("_d"))
    return (
        candidates.withColumn("_rank", rank)
        .filter("_rank = _r")
        .select(*[F.col(s).alias(f"_s{i}") for i, s in enumerate(strata)], F.col("_d").alias("_cut"))
    )


def stratified_split(
    df: DataFrame, key: Sequence[str], label: str, test_share: float = 0.2, seed: str = ""
) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(n * test_share)`` rows of each label.

    ``key`` has to identify a row. Each row compares its digest with the cut of
    its label; the few cuts are broadcast, so no row is shuffled.
    """
    cuts = _cuts(df, key, [label], F.ceil(F.col("_n") * F.lit(test_share)), seed)
    cuts = broadcast_if_small(cuts)
    return (
        df.join(cuts, df[label].eqNullSafe(cuts["_s0"]), "left")
        .withColumn("is_test", F.coalesce(key_digest(key, seed) <= F.col("_cut"), F.lit(False)))
        .drop("_s0", "_cut")
    )


def sample_n(df: DataFrame, key: Sequence[str], n: int, seed: str = "") -> DataFrame:
    """``n`` rows with the smallest digests (all rows when there are fewer)."""
    cut = _cuts(df, key, [], F.least(F.lit(n), F.col("_n")), seed).select("_cut").scalar()
    return df.filter(key_digest(key, seed) <= cut)


def sample_with_replacement(df: DataFrame, key: Sequence[str], n: int, seed: str = "") -> DataFrame:
    """``n`` draws with replacement; a drawn row appears once per draw.

    ``key`` has to identify a row. Only digests are put into order; the rows
    themselves are joined by digest to the at most ``n`` that are drawn.
    """
    spark = df.sparkSession
    coded = dense_codes(df.select(key_digest(key, seed).alias("_d")), [], "_d")
    rows = df.agg(F.count(F.lit(1))).scalar()
    drawn = digest_number(key_digest([F.concat(F.lit("draw"), F.col("id").cast("string"))], seed), 12)
    draws = spark.range(n).groupBy(F.pmod(drawn, rows).alias("code")).agg(F.count(F.lit(1)).alias("_times"))
    chosen = coded.join(draws, "code").select(F.col("_d").alias("_drawn"), "_times")
    repeated = df.join(chosen, key_digest(key, seed) == F.col("_drawn"))
    return repeated.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).select(*df.columns)


def sample_stratified(df: DataFrame, key: Sequence[str], stratum: str, fractions: dict, seed: str = "") -> DataFrame:
    """Keep about ``fractions[value]`` of each stratum, by digest, no shuffle."""
    limit = F.lit(0)
    for value, fraction in fractions.items():
        limit = F.when(F.col(stratum) == value, F.lit(round(fraction * 10_000))).otherwise(limit)
    return df.filter(hash_mod(key, 10_000, seed) < limit)


def covariate_shift(df: DataFrame, add: dict[str, float] | None = None, replace: dict[str, object] | None = None) -> DataFrame:
    """Shifted copy of a sample, by default older and never flying."""
    add = {"Age": 8} if add is None else add
    replace = {"FrequentFlyer": "No"} if replace is None else replace
    changes = {c: F.col(c) + F.lit(v) for c, v in add.items() if c in df.columns}
    changes |= {c: F.lit(v) for c, v in replace.items() if c in df.columns}
    return df.withColumns(changes) if changes else df


def duplicate_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows, distinct rows, surplus copies and distinct feature combinations."""
    whole = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    combined = (
        whole.groupBy(*features)
        .agg(F.sum("_c").alias("_c"), F.count(F.lit(1)).alias("_rows"))
    )
    return combined.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("distinct_rows"),
        F.coalesce(F.sum("_c") - F.sum("_rows"), F.lit(0)).alias("duplicate_rows"),
        F.count(F.lit(1)).alias("distinct_features"),
    )


def leakage_overlap(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """How many test rows have a feature combination that occurs in training.

    Both sides are reduced to counted combinations first, so a combination held
    by a large part of the rows is a single row in the join.
    """
    seen = train.select(*[F.col(f).alias(f"_t{i}") for i, f in enumerate(features)]).distinct()
    combos = test.groupBy(*features).agg(F.count(F.lit(1)).alias("_c"))
    condition = None
    for i, f in enumerate(features):
        equal = combos[f].eqNullSafe(seen[f"_t{i}"])
        condition = equal if condition is None else condition & equal
    hit = combos.join(seen, condition, "left_semi").agg(F.coalesce(F.sum("_c"), F.lit(0))).scalar()
    return test.agg(F.count(F.lit(1)).alias("n_test")).select(
        "n_test", hit.alias("n_overlap"), F.try_divide(hit.cast("double"), F.col("n_test")).alias("overlap_share")
    )


def group_folds(df: DataFrame, features: Sequence[str], k: int = 5, seed: str = "") -> DataFrame:
    """Add ``fold``; identical feature combinations share a fold."""
    return df.withColumn("fold", hash_mod(features, k, seed))


def stratified_folds(
    df: DataFrame, key: Sequence[str], label: str, k: int = 5, seed: str = "", exact: bool = False
) -> DataFrame:
    """Add ``fold``. Each label is spread evenly: in expectation (no shuffle),
    or with counts that differ by at most one when ``exact``."""
    if not exact:
        return df.withColumn("fold", hash_mod(key, k, seed))
    keyed = df.select("*", key_digest(key, seed).alias("_d"))
    coded = dense_codes(keyed, [label], "_d")
    return coded.select(*df.columns, F.pmod("code", F.lit(k)).cast("int").alias("fold"))


def append_rows(accumulated: DataFrame | None, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stack the listed columns of new rows below the accumulated ones."""
    picked = new.select(*columns)
    return picked if accumulated is None else accumulated.select(*columns).unionByName(picked)
