"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets are words per source; they are apportioned as equal blocks of words to
the sources by highest quotients. A source is cut into shards of about
``SHARD_WORDS`` words by a hash of its documents, and its blocks are apportioned
to its shards the same way, by their words: each shard gets an integer quota.
Within a shard the documents stand in an order given by the seed, the stream of
their words is cut into blocks, and as many blocks as the quota says are taken,
those that a seeded hash puts first (a shard that must be repeated is first
taken whole as often as it fits).

Shards depend on the size of the source and ``shard_words`` alone, not on the
cluster, so reruns agree. The order and the shard of a document come from its id
and its text: one id that many documents share fills no shard.

Defined cases: a null text has size 0; a document of size 0 is taken 0 times; a
source without words gets target 0; a null source is a source of its own, last
in order; repeated rows are separate documents; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import NOT_SPACE
from riskweave.session import materialize

BLOCK_WORDS = 32
SHARD_WORDS = 500_000
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = 42


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients v / (2j - 1); ties go to the earlier entry.

    A divisor found by bisection gives all seats but those at its edge, which
    are awarded one by one.
    """
    votes = np.asarray(votes, dtype=np.float64)
    quota = np.zeros(len(votes), dtype=np.int64)
    if seats <= 0 or votes.sum() <= 0:
        return quota
    low, high = 0.0, 2.0 * votes.max() + 1.0
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        given = np.floor(votes / mid + 0.5)
        if given.sum() > seats:
            low = mid
        else:
            high, quota = mid, given.astype(np.int64)
    queue = [(-v / (2 * q + 1), i) for i, (v, q) in enumerate(zip(votes, quota, strict=True)) if v > 0]
    heapq.heapify(queue)
    for _ in range(seats - int(quota.sum())):
        _, i = heapq.heappop(queue)
        quota[i] += 1
        heapq.heappush(queue, (-votes[i] / (2 * quota[i] + 1), i))
    return quota


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, target: one row per source.

    A source stops at ``most`` times its size when its share of what the sources
    with a lower limit leave is above it.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source: the named parts of a mixture, not documents.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("weight", weight)
    t = t.withColumns(
        {
            "limit": F.lit(float(most)) * F.col("source_size"),
            "total": F.sum("source_size").over(everything).cast("double"),
            "weights": F.sum("weight").over(everything),
        }
    )
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumns({"used": F.coalesce(F.sum("limit").over(before), F.lit(0.0)), "weighed": F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    t = t.withColumn("full", F.col("limit") * (F.col("weights") - F.col("weighed")) <= F.col("weight") * (F.col("total") - F.col("used")))
    t = t.withColumns(
        {
            "used": F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(everything), F.lit(0.0)),
            "weighed": F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(everything), F.lit(0.0)),
        }
    )
    level = (F.col("total") - F.col("used")) * F.col("weight") / (F.col("weights") - F.col("weighed"))
    return t.select("source", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(level).alias("target"))


def _quotas(group: list[str], votes: str, seats: str, schema: str, df: DataFrame, order: str = "source") -> DataFrame:
    """Blocks for the rows of each group (sources, or shards of one source)."""

    def award(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order, na_position="last", kind="stable")
        return part.assign(blocks=sainte_lague(part[votes].to_numpy(), int(part[seats].iloc[0])))[[x.split()[0] for x in schema.split(", ")]]

    return df.groupBy(*group).applyInPandas(award, schema)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), source,
    and the columns ``keep`` of ``docs`` (the text, say) that come along.

    ``docs`` needs doc_id, text and source. Sizes are counted once and written
    to the shared folder; from there on only sizes and keys are shuffled.
    """
    sized = materialize(
        docs.select(
            "doc_id",
            "source",
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(NOT_SPACE)).cast("long").alias("size"),
            F.md5(F.concat_ws("-", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))).alias("key"),
            *[F.col(c).alias(f"kept_{c}") for c in keep],
        ),
        "mix-sizes",
    )
    targets = source_targets(sized, weights, most)
    seats = F.floor(F.sum("target").over(Window.partitionBy()) / block_words + F.lit(0.5))
    quotas = _quotas(
        ["one"],
        "target",
        "seats",
        "source string, source_size long, target double, blocks long",
        targets.withColumns({"seats": seats.cast("long"), "one": F.lit(1)}),
    )
    plan = materialize(
        quotas.select("source", "source_size", "target", "blocks", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long").alias("shards")),
        "mix-sources",
    )
    placed = sized.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # ranges of the key: it is a hash, so they are about equal
    placed = placed.withColumn("shard", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("shards") / F.lit(float(1 << 32))))
    # one row per shard from here to the blocks that are taken
    shards = placed.groupBy("source", "shard", "blocks").agg(F.sum("size").alias("words"))
    shards = _quotas(["source"], "words", "blocks", "source string, shard long, words long, blocks long", shards, "shard")
    words = F.least(F.col("blocks") * block_words, F.col("words") * most)
    repeats = F.when(F.col("words") > 0, F.floor(words / F.col("words"))).otherwise(F.lit(0)).cast("long")
    shards = shards.withColumns({"repeats": repeats, "rest": F.floor((words - repeats * F.col("words")) / block_words + F.lit(0.5)).cast("long")})
    shards = materialize(shards.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "words", "repeats", "rest"), "mix-shards")
    number = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("words") / block_words) - 1, F.lit(0))).cast("array<bigint>"))
    drawn = F.md5(F.concat_ws("-", F.lit(str(seed)), F.coalesce("_source", F.lit("")), F.col("_shard"), F.col("_block")))
    order = Window.partitionBy("_source", "_shard").orderBy(drawn, "_block")  # the blocks of one shard
    # dealt out before they become blocks: a table of one row a shard is read by one task
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = shards.where("rest > 0").repartition(tasks, "_source", "_shard")
    chosen = dealt.select("_source", "_shard", "rest", number.alias("_block"))
    chosen = chosen.withColumn("place", F.row_number().over(order)).where("place <= rest").select("_source", "_shard", "_block")
    before = Window.partitionBy("source", "shard").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    streamed = placed.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    here = F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard"))
    # the words of a document in each block that is taken; with words in it, its start is its own
    cut = streamed.where("size > 0").select(
        "source", "shard", "start", "size", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))).alias("block")
    )
    inside = F.least((F.col("block") + 1) * block_words, F.col("start") + F.col("size")) - F.greatest(F.col("block") * block_words, F.col("start"))
    # the planner takes the blocks for as few as the shards they come from: no broadcast
    given = cut.join(chosen.hint("merge"), here & (F.col("block") == F.col("_block"))).groupBy("source", "shard", "start").agg(F.sum(inside).alias("part"))
    given = given.select(F.col("source").alias("_of"), F.col("shard").alias("_in"), F.col("start").alias("_at"), "part")
    own = F.col("source").eqNullSafe(F.col("_of")) & (F.col("shard") == F.col("_in")) & (F.col("start") == F.col("_at")) & (F.col("size") > 0)
    out = streamed.join(given.hint("merge"), own, "left").join(shards.select("_source", "_shard", "repeats"), here)
    taken = (F.col("repeats") * F.col("size") + F.coalesce("part", F.lit(0))).cast("long").alias("taken")
    return out.select("doc_id", "size", "source_size", "target", taken, "source", *[F.col(f"kept_{c}").alias(c) for c in keep])
