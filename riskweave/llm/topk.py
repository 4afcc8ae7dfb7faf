"""Exact top-k search by distributed histogram selection.

Vectors become integers, floor(256 * x). Every query meets every row in tiles
of a query block and a row block; a tile is scored whole by each pass and its
scores are never stored. Passes 1..n narrow, for each query, the interval that
holds its k-th best score: the tiles count their scores in the bins of the
interval, the counts of a query are summed over all tiles, and the bin in which
the k-th score falls is the next interval, until it is one value wide. A last
pass takes the scores from that value on; ties go to the smaller id.

A tile counts no bin below its own k-th best score: the k-th best of all rows
is at least as high. So a tile sends at most k bins for a query, also where a
vector stands a million times. The last pass sends at most k rows of a tile
for a query, those that come first among equal scores.

Blocks come from a round-robin exchange of the rows, so no id or vector, however
frequent, makes one larger. Their number grows with the table. State (one row a
query) and blocks are tables in the shared folder.

Defined cases: vectors that are null or hold a null or non-finite component
take no part; an empty vector does (its products are 0); a vector whose squared
length in integers is 2**61 or more takes no part, so that every product fits
into a long. A query is compared with the rows of its own length. A query's own
rows are all rows with its id. Rows that stand repeatedly count each; repeated
query rows (equal ids) each get a ranking of their own. A null id is no query
where the condition is null, and comes last among ties. With fewer than k
candidates all are returned; an empty table gives an empty result; other
columns are ignored. Ids are integers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import materialize

SCALE = 256
#: Most rows of a block, and the least that are worth one more block.
BLOCK_ROWS, QUERY_ROWS, LEAST_ROWS = 1 << 16, 1 << 14, 1 << 12
BINS = 1 << 12
#: Scores that are held at a time.
CHUNK = 1 << 21
LARGEST = 1 << 61

PACKED = "block int, ids array<bigint>, lengths array<int>, width int, parts binary"


def quantized(vectors: DataFrame) -> DataFrame:
    """vec_id and the integers of the rows that take part."""
    e = F.col("embedding").cast("array<double>")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e"), "asked").where(~bad)
    scaled = rows.select("vec_id", "asked", F.transform("e", lambda v: F.floor(v.cast("double") * SCALE).cast("double")).alias("e"))
    norm = F.aggregate("e", F.lit(0.0), lambda a, v: a + v * v)
    return scaled.where(norm < float(LARGEST)).select("vec_id", "asked", F.transform("e", lambda v: v.cast("int")).alias("v"))


def _blocks(rows: int, most: int, cores: int) -> int:
    """As many blocks as their size asks for; on small tables enough to use the cores."""
    return max(1, math.ceil(rows / most), min(cores, math.ceil(rows / LEAST_ROWS)))


def _packed(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row per block: the ids in order (null last), the lengths, all components."""

    def pack(batches):
        ids, lengths, parts, block = [], [], [], None
        for batch in batches:
            block = batch.column("block")[0].as_py()
            v = batch.column("v")
            ids.append(batch.column("vec_id"))
            lengths.append(v.value_lengths().to_numpy(zero_copy_only=False))
            parts.append(v.flatten().to_numpy(zero_copy_only=False))
        if block is None:
            return
        ids, lengths, parts = pa.concat_arrays(ids), np.concatenate(lengths), np.concatenate(parts)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        begins = np.cumsum(lengths) - lengths
        parts = np.concatenate([parts[:0], *[parts[begins[i] : begins[i] + lengths[i]] for i in order]])
        narrow = np.int16 if np.abs(parts).max(initial=0) < 1 << 15 else np.int32  # a component fits: its square is below LARGEST
        whole = pa.array([0, len(ids)], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int32()),
                pa.ListArray.from_arrays(whole, ids.take(pa.array(order))),
                pa.ListArray.from_arrays(whole, pa.array(lengths[order], pa.int32())),
                pa.array([narrow().itemsize], pa.int32()),
                pa.array([parts.astype(narrow).tobytes()], pa.binary()),
            ],
            names=["block", "ids", "lengths", "width", "parts"],
        )

    dealt = rows.select("vec_id", "v").repartition(blocks).withColumn("block", F.spark_partition_id())
    return materialize(dealt.mapInArrow(pack, PACKED), name)


class _Block:
    """The vectors of a packed row, by length."""

    def __init__(self, table: pa.Table):
        ids = table["ids"].combine_chunks().flatten()
        self.known = np.array(ids.is_valid())
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.lengths = table["lengths"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.parts = np.frombuffer(table["parts"][0].as_py(), dtype=f"<i{table['width'][0].as_py()}")
        self.begins = np.cumsum(self.lengths) - self.lengths

    def of_length(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and matrix of the vectors of that length."""
        rows = np.flatnonzero(self.lengths == length)
        return rows, self.parts[self.begins[rows][:, None] + np.arange(length)[None, :]]


def _tiles(queries: pa.Table, rows: pa.Table, k: int):
    """Chunks of a tile: query numbers, row numbers, their scores (the lowest
    long for a query's own rows) and each query's k-th best score in the tile."""
    own, all_rows = _Block(queries), _Block(rows)
    none = np.iinfo(np.int64).min
    for length in np.unique(own.lengths):
        q_at, q = own.of_length(int(length))
        r_at, r = all_rows.of_length(int(length))
        if not len(r_at):
            continue
        most = max(1, int(length)) * int(np.abs(q.astype(np.int64)).max(initial=0)) * int(np.abs(r.astype(np.int64)).max(initial=0))
        exact = most < 2**53  # then sums of doubles are exact
        kind = np.float64 if exact else np.int64
        q, r = q.astype(kind), r.astype(kind).T
        ids = all_rows.ids[r_at]
        known = int(all_rows.known[r_at].sum())  # those with an id come first
        step = max(1, CHUNK // len(r_at))
        for a in range(0, len(q_at), step):
            at = q_at[a : a + step]
            score = (q[a : a + step] @ r).astype(np.int64)
            first = np.searchsorted(ids[:known], own.ids[at], side="left")
            last = np.searchsorted(ids[:known], own.ids[at], side="right")
            for i in np.flatnonzero((last > first) & own.known[at]):
                score[i, first[i] : last[i]] = none
            least = np.partition(score, len(r_at) - k, axis=1)[:, len(r_at) - k] if len(r_at) > k else np.full(len(at), none)
            yield at, r_at, score, np.maximum(least, none + 1)


def _histograms(k: int):
    """Counts of a tile's scores in the bins of each query's interval."""

    def count(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(queries) and len(rows):
            low, step = (queries[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("low", "step"))
            bins = queries["bins"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            for at, _, score, least in _tiles(queries, rows, k):
                i, j = np.nonzero(score >= np.maximum(least, low[at])[:, None])
                bin_ = (score[i, j] - low[at[i]]) // step[at[i]]
                inside = bin_ < bins[at[i]]  # what is above was counted before
                key, n = np.unique(at[i[inside]] * np.int64(BINS) + bin_[inside], return_counts=True)
                found.append((key // BINS, key % BINS, n))
        place, bin_, n = (np.concatenate([f[c] for f in found] or [np.zeros(0, np.int64)]) for c in range(3))
        block = queries["block"][0].as_py() if len(queries) else 0
        return pa.table({"block": pa.array(np.full(len(place), block), pa.int32()), "place": place, "bin": bin_, "n": n})

    return count


def _taken(k: int):
    """The first k rows of a tile, for each query, from its k-th best score on."""

    def take(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        ids = rows["ids"].combine_chunks().flatten() if len(rows) else pa.array([], pa.int64())
        if len(queries) and len(rows):
            low = queries["low"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            for at, r_at, score, least in _tiles(queries, rows, k):
                i, j = np.nonzero(score >= np.maximum(least, low[at])[:, None])
                s = score[i, j]
                order = np.lexsort((j, -s, i))  # rows of a block are in the order of their ids
                i, j, s = i[order], j[order], s[order]
                kept = np.arange(len(i)) - np.searchsorted(i, i) < k
                found.append((at[i[kept]], r_at[j[kept]], s[kept]))
        place, row, score = (np.concatenate([f[c] for f in found] or [np.zeros(0, np.int64)]) for c in range(3))
        asked = queries["ids"].combine_chunks().flatten() if len(queries) else ids
        block = queries["block"][0].as_py() if len(queries) else 0
        head = {"block": pa.array(np.full(len(place), block), pa.int32()), "place": pa.array(place)}
        return pa.table({**head, "query_id": asked.take(pa.array(place)), "vec_id": ids.take(pa.array(row)), "score": pa.array(score)})

    return take


def _met(queries: DataFrame, rows: DataFrame, sizes: tuple[int, int], work, schema: str) -> DataFrame:
    """``work`` on every pair of a query block and a row block."""
    n_q, n_r = sizes
    key = ["block", "met"]
    tasks = min(n_q * n_r, 1 << 15)
    left = queries.withColumn("met", F.explode(F.sequence(F.lit(0), F.lit(n_r - 1)))).repartition(tasks, *key)
    right = rows.withColumnRenamed("block", "met").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))).repartition(tasks, *key)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(work, schema)


def search(vectors: DataFrame, is_query: Column, k: int, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, bins: int = BINS) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest product for each query row."""
    bins = max(2, min(bins, BINS))
    spark = vectors.sparkSession
    rows = materialize(quantized(vectors.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asked"))), "integers")
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)
    n, asked, bound = rows.agg(F.count("*"), F.count_if("asked"), F.max(norm)).first()
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cores = spark.sparkContext.defaultParallelism
    sizes = (_blocks(asked, query_rows, 1), _blocks(n, block_rows, cores))
    stored = _packed(rows, sizes[1], "row-blocks")
    queries = _packed(rows.where("asked"), sizes[0], "query-blocks")
    # |q . r| <= bound for every pair: all scores lie in [-bound, bound]
    state = queries.select("block", F.posexplode("lengths").alias("place", "_length")).select(
        "block", F.col("place").cast("long").alias("place"), F.lit(-bound).cast("long").alias("low"),
        F.lit(2 * bound + 1).cast("long").alias("span"), F.lit(k).cast("long").alias("need"),
    )
    span = 2 * bound + 1
    while span > 1:
        step = F.expr(f"greatest(1, (span + {bins - 1}) div {bins})")
        state = state.withColumn("step", step).withColumn("bins", F.expr("(span + step - 1) div step"))
        counts = _met(_with_state(queries, state, "low", "step", "bins"), stored, sizes, _histograms(k), "block int, place long, bin long, n long")
        state = materialize(_narrowed(state, counts), "intervals")
        span = state.agg(F.max("span")).first()[0]
    best = _met(_with_state(queries, state, "low"), stored, sizes, _taken(k), "block int, place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))  # at most k rows of a tile
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _with_state(queries: DataFrame, state: DataFrame, *columns: str) -> DataFrame:
    """Each query block with the state of its queries as arrays in their order."""
    ordered = F.array_sort(F.collect_list(F.struct("place", *columns)))
    lists = state.groupBy("block").agg(ordered.alias("s"))
    return queries.join(lists.select("block", *[F.col(f"s.{c}").alias(c) for c in columns]), "block")


def _narrowed(state: DataFrame, counts: DataFrame) -> DataFrame:
    """The next interval of each query: the bin in which its k-th best score falls.

    With fewer scores than are needed the lowest bin is taken: all of them count.
    """
    total = counts.groupBy("block", "place", "bin").agg(F.sum("n").alias("n"))
    per_query = total.groupBy("block", "place").agg(F.array_sort(F.collect_list(F.struct((-F.col("bin")).alias("b"), "n"))).alias("bins_seen"))
    start = F.struct(F.lit(None).cast("long").alias("bin"), F.lit(0).cast("long").alias("above"), F.col("need").alias("need"))
    walked = F.aggregate(
        "bins_seen",  # at most the number of bins, from the highest on
        start,
        lambda a, x: F.when(a["bin"].isNotNull(), a).otherwise(
            F.struct(
                F.when(a["above"] + x["n"] >= a["need"], -x["b"]).alias("bin"),
                F.when(a["above"] + x["n"] >= a["need"], a["above"]).otherwise(a["above"] + x["n"]).alias("above"),
                a["need"].alias("need"),
            )
        ),
    )
    joined = state.join(per_query, ["block", "place"], "left").withColumn("x", walked)
    found = F.coalesce(F.col("x.bin"), F.lit(0))
    low = (F.col("low") + found * F.col("step")).alias("low")
    return joined.select(
        "block", "place", low,
        F.least("step", F.col("low") + F.col("span") - (F.col("low") + found * F.col("step"))).alias("span"),
        (F.col("need") - F.when(F.col("x.bin").isNotNull(), F.col("x.above")).otherwise(0)).alias("need"),
    )
