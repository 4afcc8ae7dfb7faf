"""Nearest neighbours by learned partitions.

A bounded sample (``SAMPLE`` vectors, those with the least hash of their id) is
turned into a neighbour graph and cut into parts of nearly equal size with few
edges between them. A softmax classifier learns, for each sample vector, in
which parts its neighbours lie. It then puts every row into its most probable
part and sends every query to its most probable parts, as many as reach
``TARGET`` recall on sample queries (for the sample's own neighbours). Those
parts are searched exactly, in double precision.

Parts are cut into blocks of bounded size, so a part that holds a third of the
rows (or one vector many times) is searched by as many tasks as it needs, and
each returns at most ``k`` rows per query.

Defined cases: vectors that are null, empty, zero, of another length than most
of the sample, or that hold a null or non-finite component take no part, nor do
rows with a null id; exact repeats of a row count once; rows that share an id but not the vector are
queries and candidates of their own (a query's own rows are all with its id);
ties go to the smaller
id; with k or fewer candidates all are returned that the searched parts hold,
and all parts are searched when the table is small enough (``EXHAUSTIVE``); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.fitting import fit_in_task
from riskweave.session import materialize

SAMPLE, PARTS, GRAPH_K = 4096, 32, 10
TARGET = 0.98
BLOCK_ROWS = 8192
#: Rows up to which a search visits every part: what a sample of this size would do anyway.
EXHAUSTIVE = 64


def neighbour_graph(x: np.ndarray, k: int = GRAPH_K) -> np.ndarray:
    """The k largest inner products of each row with the others."""
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    k = min(k, len(x) - 1)
    return np.argpartition(-s, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(x), 0), dtype=np.int64)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20, slack: float = 0.1) -> np.ndarray:
    """Parts of nearly equal size with few graph edges between them.

    Begins with median cuts along principal directions, then moves vertices to
    the part where most of their neighbours are while sizes stay within the slack.
    """
    label = np.zeros(len(x), dtype=np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        own = groups.pop()
        if len(own) < 2:
            groups.append(own)
            break
        centred = x[own] - x[own].mean(axis=0)
        direction = np.linalg.svd(centred, full_matrices=False)[2][0]
        order = own[np.argsort(centred @ direction, kind="stable")]
        groups += [order[: len(order) // 2], order[len(order) // 2 :]]
    for i, own in enumerate(groups):
        label[own] = i
    most = int(np.ceil(len(x) / parts * (1 + slack)))
    least = int(len(x) / parts * (1 - slack))
    edges = np.stack([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()], axis=1)
    both = np.concatenate([edges, edges[:, ::-1]])
    size = np.bincount(label, minlength=parts)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (both[:, 0], label[both[:, 1]]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), label]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < most and size[label[i]] > least:
                size[best[i]] += 1
                size[label[i]] -= 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


def learn_router(x: np.ndarray, targets: np.ndarray, steps: int = 300, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression to soft targets by Adam on the whole sample."""
    w, b = np.zeros((x.shape[1], targets.shape[1])), np.zeros(targets.shape[1])
    m, v = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for t in range(1, steps + 1):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - targets) / len(x)
        for i, (param, grad) in enumerate(((w, x.T @ d + decay * w), (b, d.sum(axis=0)))):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad * grad
            param -= 0.1 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-9)
    return w, b


def fit_index(vectors: np.ndarray, parts: int, target: float, k: int = 20) -> dict:
    """Router weights, scale and number of parts to visit."""
    scale = float(np.sqrt((vectors**2).sum(axis=1).mean())) or 1.0
    x = vectors / scale
    parts = max(1, min(parts, len(x) // 8))
    graph = neighbour_graph(x)
    label = balanced_parts(x, graph, parts)
    targets = np.zeros((len(x), parts))
    np.add.at(targets, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph.ravel()]), 1)
    targets[np.arange(len(x)), label] += max(1, graph.shape[1])
    targets /= targets.sum(axis=1, keepdims=True)
    w, b = learn_router(x, targets)
    probes = parts
    if parts > 1:
        order = np.argsort(-(x @ w + b), axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
        asked = np.arange(0, len(x), max(1, len(x) // 512))
        s = x[asked] @ x.T
        s[np.arange(len(asked)), asked] = -np.inf
        near = np.argsort(-s, axis=1)[:, : min(k, len(x) - 1)]
        visits = np.take_along_axis(place[asked], order[near, 0], axis=1)
        recall = [(visits < n).mean() for n in range(1, parts + 1)]
        probes = next((n for n, r in enumerate(recall, 1) if r >= target), parts)
    return {"w": w, "b": b, "scale": scale, "parts": parts, "probes": probes, "dim": vectors.shape[1]}


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part, each once."""
    e = F.col("embedding").cast("array<double>")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select("vec_id", e.alias("embedding")).where(~bad)
    return rows.where(F.exists("embedding", lambda v: v != 0))


def fit(rows: DataFrame, sample: int = SAMPLE, parts: int = PARTS, target: float = TARGET) -> dict | None:
    """An index from a bounded sample; None if there is no vector."""
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)

    def learn(batches):
        found = [v for b in batches for v in b.column("embedding").to_pylist()]
        if not found:
            return None
        lengths = [len(v) for v in found]
        dim = max(sorted(set(lengths)), key=lengths.count)
        return fit_index(np.array([v for v in found if len(v) == dim]), parts, target)

    return fit_in_task(chosen, learn)


def search(vectors: DataFrame, is_query: Column, k: int = 20, block_rows: int = BLOCK_ROWS, index: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k best found for each query row."""
    rows = usable(vectors)
    index = index or fit(rows)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    spark = vectors.sparkSession
    if index is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    dim = index["dim"]
    rows = rows.where(F.size("embedding") == dim)

    def place(most: int):
        def local(batches):
            for batch in batches:
                x = _matrix(batch.column("embedding"), dim) / index["scale"]
                order = np.argsort(-(x @ index["w"] + index["b"]), axis=1, kind="stable")[:, :most]
                at = np.repeat(np.arange(len(x)), order.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(at)), batch.column("embedding").take(pa.array(at)), pa.array(order.ravel(), pa.int32())],
                    names=["vec_id", "embedding", "part"],
                )

        return local

    schema = f"vec_id {kind}, embedding array<double>, part int"
    placed = materialize(rows.mapInArrow(place(1), schema), "placed-vectors")
    counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # one number per part
    blocks = F.create_map(*[F.lit(x) for p in range(index["parts"]) for x in (p, -(-max(1, counts.get(p, 1)) // block_rows))])
    stored = placed.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.element_at(blocks, F.col("part"))).cast("int"))
    probes = index["parts"] if sum(counts.values()) <= EXHAUSTIVE * k else index["probes"]
    asked = rows.where(is_query).mapInArrow(place(probes), schema).withColumn("told", F.xxhash64("embedding"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(blocks, F.col("part")) - 1)))

    def nearest(queries: pa.Table, own: pa.Table) -> pa.Table:
        if not len(queries) or not len(own):
            none = own["vec_id"].slice(0, 0)
            return pa.table({"query_id": none, "told": pa.array([], pa.int64()), "vec_id": none, "score": pa.array([], pa.float64())})
        own = own.sort_by("vec_id")
        b, q = _matrix(own["embedding"], dim), _matrix(queries["embedding"], dim)
        ids, query_ids = own["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        repeat = np.zeros(len(ids), dtype=bool)
        repeat[1:] = (ids[1:] == ids[:-1]) & (b[1:] == b[:-1]).all(axis=1)
        b, ids = b[~repeat], ids[~repeat]
        q_at, b_at, scores = [], [], []
        step = max(1, (1 << 21) // len(ids))
        margin = 1e-9 * float(np.abs(b).max()) * max(1.0, float(np.abs(q).max())) * dim
        for at in range(0, len(q), step):
            s = q[at : at + step] @ b.T
            s[query_ids[at : at + step][:, None] == ids[None, :]] = -np.inf
            least = np.full(len(s), -np.inf) if len(ids) <= k else np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k]
            r, c = np.nonzero((s >= least[:, None] - margin) & (s > -np.inf))
            # products of equal vectors must be equal: summed again, row by row
            exact = np.concatenate([(q[at + r[i : i + 65536]] * b[c[i : i + 65536]]).sum(axis=1) for i in range(0, len(r), 65536)] or [np.zeros(0)])
            order = np.lexsort((c, -exact, r))
            r, c, exact = r[order], c[order], exact[order]
            first = np.searchsorted(r, np.arange(len(s)))
            kept = np.arange(len(r)) - first[r] < k
            q_at.append(at + r[kept])
            b_at.append(c[kept])
            scores.append(exact[kept])
        q_at, b_at = np.concatenate(q_at), np.concatenate(b_at)
        kinds = own["vec_id"].type
        told = queries["told"].combine_chunks().take(pa.array(q_at, pa.int64()))
        return pa.table({"query_id": pa.array(query_ids[q_at], kinds), "told": told, "vec_id": pa.array(ids[b_at], kinds), "score": pa.array(np.concatenate(scores), pa.float64())})

    found = (
        asked.groupBy("part", "block")
        .cogroup(stored.groupBy("part", "block"))
        .applyInArrow(nearest, f"query_id {kind}, told long, vec_id {kind}, score double")
        .dropDuplicates(["query_id", "told", "vec_id", "score"])
    )
    # at most k rows per searched block and query
    order = Window.partitionBy("query_id", "told").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
