"""Exact k nearest neighbours by a two-level tree of cells around centres.

A sample of training vectors serves as centres, one for every ``CELL_ROWS`` rows;
about the root of their number are top centres, and every other centre belongs
to its nearest top centre. A training vector goes to the cell of the nearest
centre under its nearest top centre; cells and top centres have a radius. A
query first searches near cells until they hold ``k`` rows, which bounds its
k-th distance; then only cells whose lower bound (distance to the centre less
the radius) does not exceed it, and whole top centres are passed over by theirs.
The triangle inequality makes that exact wherever a vector was put, and the work
follows the cells that remain instead of queries times rows.

For the near cells, cells are cut into blocks of bounded size, and the queries that
ask a cell into parts of bounded size, for each of which the cell's blocks are sent.
For all others, queries near each other make large parts and cells near each other
large chunks, both bounded in bytes: a part is sent once for a chunk that it needs
and a cell once for a part, whatever the number of cells that a query asks, and a
task keeps the ``k`` best rows of its queries over the whole chunk. No task holds
more than one pair of a part and a block or chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import materialize

#: The centres go to every task, so their number is bounded.
BLOCK_ROWS, CENTRES, CELL_ROWS = 2_048, 16_384, 2_048
#: Queries of a cell that are compared with a block together; queries that a tree
#: is asked for, rows that are sent, and pairs that are measured at once.
QUERY_ROWS, ASKED_AT_ONCE, SENT_AT_ONCE, PAIRS_AT_ONCE = 8_192, 256, 4_096, 65_536
#: Bytes of the vectors, as doubles, of a part of queries; a chunk of cells has twice as many.
PART_BYTES, PART_ROWS = 16 << 20, 4_096


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.float64)


def _nearest_in_block(query: np.ndarray, train: np.ndarray, k: int, same: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and squared distance of every pair that may be among the k
    nearest. The matrix product screens; survivors get exact distances."""
    rough = (query**2).sum(1)[:, None] + (train**2).sum(1)[None, :] - 2.0 * query @ train.T
    if same is not None:
        rough[same] = np.inf
    width = min(k, train.shape[0])
    kth = np.partition(rough, width - 1, axis=1)[:, width - 1]
    scale = np.abs(rough[np.isfinite(rough)]).max(initial=1.0)
    rows, cols = np.nonzero(rough <= (kth + 1e-9 * scale)[:, None])
    keep = np.isfinite(rough[rows, cols])
    rows, cols = rows[keep], cols[keep]
    d2 = np.empty(len(rows))
    for at in range(0, len(rows), PAIRS_AT_ONCE):  # with copies nearly all pairs may be as near
        some = slice(at, at + PAIRS_AT_ONCE)
        diff = query[rows[some]] - train[cols[some]]
        d2[some] = np.einsum("ij,ij->i", diff, diff)
    return rows, cols, d2


def _centre_distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (vectors**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2.0 * vectors @ centres.T
    return np.sqrt(np.maximum(square, 0.0))


class Tree:
    """Centres under top centres; cells have sizes and radii once rows are placed."""

    def __init__(self, centres: np.ndarray):
        """The first of ``centres`` are the top ones: they come in the order of a hash."""
        self.centres = centres
        self.tops = centres[: max(1, round(len(centres) ** 0.5))] if len(centres) else centres
        top = _centre_distances(centres, self.tops).argmin(1) if len(centres) else np.zeros(0, np.int64)
        self.members = [np.flatnonzero(top == t) for t in range(len(self.tops))]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector and its distance from the centre."""
        top = _centre_distances(x, self.tops).argmin(1)
        cell, away = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
        for t in np.unique(top):
            own = np.flatnonzero(top == t)
            d = _centre_distances(x[own], self.centres[self.members[t]])
            near = d.argmin(1)
            cell[own], away[own] = self.members[t][near], d[np.arange(len(own)), near]
        return cell, away

    def measured(self, radius: np.ndarray, size: np.ndarray) -> Tree:
        """Takes the radii and sizes of the cells; empty cells have radius -inf."""
        self.radius, self.size = radius, size
        reach = [_centre_distances(self.tops[t : t + 1], self.centres[m])[0] + radius[m] for t, m in enumerate(self.members)]
        self.reach = np.array([r.max(initial=-np.inf) for r in reach])
        self.held = np.array([size[m].sum() for m in self.members])
        return self

    def first(self, x: np.ndarray, k: int) -> list[np.ndarray]:
        """Per query near cells that hold ``k`` rows together."""
        out = []
        for v, d in zip(x, _centre_distances(x, self.tops), strict=True):
            order = np.argsort(d, kind="stable")
            enough = int(np.searchsorted(np.cumsum(self.held[order]), k)) + 1
            cells = np.concatenate([self.members[t] for t in order[:enough]])
            cells = cells[np.argsort(_centre_distances(v[None], self.centres[cells])[0], kind="stable")]
            out.append(cells[: int(np.searchsorted(np.cumsum(self.size[cells]), k)) + 1])
        return out

    def within(self, x: np.ndarray, bound: np.ndarray) -> list[np.ndarray]:
        """Per query the cells that may hold a row as near as ``bound``."""
        top = _centre_distances(x, self.tops)
        slack = 1e-9 * (1.0 + np.abs(top).max(initial=0.0) + np.abs(self.reach[np.isfinite(self.reach)]).max(initial=0.0))
        found: list[list[np.ndarray]] = [[] for _ in x]
        for t, members in enumerate(self.members):
            asked = np.flatnonzero(top[:, t] - self.reach[t] <= bound + slack)
            if not len(asked) or not self.held[t]:
                continue
            d = _centre_distances(x[asked], self.centres[members])
            near = (d - self.radius[members] <= (bound[asked] + slack)[:, None]) & (self.size[members] > 0)
            for i, row in zip(asked.tolist(), near, strict=True):
                found[i].append(members[row])
        return [np.sort(np.concatenate(f)) if f else np.zeros(0, np.int64) for f in found]


class Cells:
    """The rows of a training table in the cells of a tree."""

    def __init__(self, rows: DataFrame, vector: str, most: int, block_rows: int):
        """``rows`` gets the columns ``cell`` and ``block``."""
        chosen = rows.select(vector, F.xxhash64(vector).alias("_h")).distinct().orderBy("_h").limit(most).collect()
        tree = self.tree = Tree(np.array([r[vector] for r in chosen], dtype=np.float64))

        def assign(batches):
            for b in batches:
                cell, away = tree.place(_stacked(b[vector]))
                yield b.assign(cell=cell.astype(np.int32), away=away)

        schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", cell int, away double"
        self.rows = materialize(rows.mapInPandas(assign, schema), "cells")
        # one row per centre
        found = {r["cell"]: r for r in self.rows.groupBy("cell").agg(F.max("away").alias("r"), F.count(F.lit(1)).alias("n")).collect()}
        cells = range(len(tree.centres))
        tree.measured(np.array([found[c]["r"] if c in found else -np.inf for c in cells]), np.array([found[c]["n"] if c in found else 0 for c in cells]))
        self.blocks = np.maximum(1, -(-tree.size // block_rows)).astype(int)


    def spans(self, rows: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells in the order of their top centres, put together until they hold
        ``limit`` of the ``rows`` counted for each: the first group of each cell, and
        over how many it goes."""
        order = np.concatenate(self.tree.members)
        begin = np.cumsum(rows[order]) - rows[order]
        first, many = np.zeros((2, len(rows)), dtype=np.int64)
        first[order] = begin // limit
        many[order] = np.maximum(1, (begin + rows[order] - 1) // limit - begin // limit + 1)
        return first, many


def best_in_chunk(left: pd.DataFrame, right: pd.DataFrame, tree: Tree, k: int, exclude_same_key: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the query, place of the row and squared distance of the ``k`` best
    rows of a chunk for each query that are not beyond its ``bound`` (squared)."""
    a, a_key, bound = _stacked(left["q_vec"]), left["q_key"].to_numpy(), left["bound"].to_numpy().copy()
    b, b_key, cell = _stacked(right["t_vec"]), right["t_key"].to_numpy(), right["cell"].to_numpy()
    order = pd.factorize(b_key, sort=True)[0]  # of equal distances the smaller key
    by_cell = np.argsort(cell, kind="stable")
    a2, b2 = (a**2).sum(1), (b**2).sum(1)
    slack = 1e-9 * (1.0 + a2.max() + b2.max() + (tree.centres**2).sum(1).max())
    held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for rows in np.split(by_cell, np.flatnonzero(np.diff(cell[by_cell])) + 1):
        centre = tree.centres[cell[rows[:1]]]
        away = _centre_distances(a, centre)[:, 0] - tree.radius[cell[rows[0]]]
        asked = np.flatnonzero(away <= np.sqrt(bound) + np.sqrt(slack))
        for at in range(0, len(rows), BLOCK_ROWS):
            block = rows[at : at + BLOCK_ROWS]
            for begin in range(0, len(asked), BLOCK_ROWS):
                own = asked[begin : begin + BLOCK_ROWS]
                free = np.isinf(bound[own])
                if free.any():  # no bound yet: the nearest of this block
                    some = own[free]
                    same = a_key[some][:, None] == b_key[block][None, :] if exclude_same_key else None
                    r, c, d2 = _nearest_in_block(a[some], b[block], k, same)
                    held = _kept(held, some[r], block[c], d2, order, bound, k)
                    own = own[~free]
                if not len(own):
                    continue
                rough = a2[own][:, None] + b2[block][None, :] - 2.0 * a[own] @ b[block].T
                r, c = np.nonzero(rough <= (bound[own] + slack)[:, None])
                r, c = own[r], block[c]
                if exclude_same_key:
                    other = a_key[r] != b_key[c]
                    r, c = r[other], c[other]
                d2 = np.empty(len(r))
                for i in range(0, len(r), PAIRS_AT_ONCE):
                    diff = a[r[i : i + PAIRS_AT_ONCE]] - b[c[i : i + PAIRS_AT_ONCE]]
                    d2[i : i + PAIRS_AT_ONCE] = np.einsum("ij,ij->i", diff, diff)
                near = d2 <= bound[r]
                held = _kept(held, r[near], c[near], d2[near], order, bound, k)
    return _best(*held, order, k)


def _best(r: np.ndarray, c: np.ndarray, d2: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query, in the order of the queries."""
    at = np.lexsort((order[c], d2, r))
    r, c, d2 = r[at], c[at], d2[at]
    first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]])) if len(r) else np.zeros(0, np.int64)
    rank = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
    return r[rank < k], c[rank < k], d2[rank < k]


def _kept(held: tuple, r: np.ndarray, c: np.ndarray, d2: np.ndarray, order: np.ndarray, bound: np.ndarray, k: int) -> tuple:
    """Adds rows; the k best of a query that are known lower its bound."""
    if not len(r):
        return held
    r, c, d2 = _best(r, c, d2, order, k)
    held = tuple(np.concatenate(x) for x in zip(held, (r, c, d2), strict=True))
    if len(held[0]) > 4 * k * len(bound):
        held = _best(*held, order, k)
        r, d2 = held[0], held[2]
    # the last of k rows of a query
    last = np.flatnonzero(r[k - 1 :] == r[: max(0, len(r) - k + 1)]) + k - 1
    bound[r[last]] = np.minimum(bound[r[last]], d2[last])
    return held


Choose = Callable[[pd.DataFrame, np.ndarray], list[np.ndarray]]


def chosen_cells(batch: pd.DataFrame, choose: Choose) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """A few queries of a batch at a time, and the place and the cell of every request of theirs."""
    for at in range(0, len(batch), ASKED_AT_ONCE):
        own = batch.iloc[at : at + ASKED_AT_ONCE]
        cells = choose(own, _stacked(own["q_vec"]))
        place = np.repeat(np.arange(len(own)), [len(c) for c in cells])
        yield own, place, np.concatenate(cells).astype(np.int32) if len(place) else np.zeros(0, np.int32)


def count_requests(batches: Iterator[pd.DataFrame], choose: Choose, cells: int) -> Iterator[pd.DataFrame]:
    """How many queries ask each cell."""
    n = np.zeros(cells, dtype=np.int64)
    for b in batches:
        for _, _, cell in chosen_cells(b, choose):
            n += np.bincount(cell, minlength=cells)
    asked = np.flatnonzero(n)
    yield pd.DataFrame({"cell": asked.astype(np.int32), "n": n[asked]})


def send_requests(batches: Iterator[pd.DataFrame], choose: Choose, parts: np.ndarray) -> Iterator[pd.DataFrame]:
    """``(q_key, q_vec, cell, part)`` in frames of bounded size; the queries of a
    cell are dealt over its ``parts`` in turn, whatever their keys are."""
    before = 0
    for b in batches:
        for own, place, cell in chosen_cells(b, choose):
            part = ((before + place) % parts[cell]).astype(np.int32)
            before += len(own)
            for at in range(0, len(place), SENT_AT_ONCE):
                some = slice(at, at + SENT_AT_ONCE)
                yield own[["q_key", "q_vec"]].iloc[place[some]].assign(cell=cell[some], part=part[some])


def nearest(
    train: DataFrame,
    query: DataFrame,
    key: str,
    vector: str,
    k: int = 5,
    payload: str | None = None,
    exclude_same_key: bool = False,
    block_rows: int = BLOCK_ROWS,
    centres: int = CENTRES,
    cell_rows: int = CELL_ROWS,
    query_rows: int = QUERY_ROWS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``(query_key, train_key, distance, rank[, payload])`` for the k nearest.

    Squared Euclidean order; equal distances by smaller training key. Rows
    without a vector take no part. There is a centre for every ``cell_rows``
    training rows, and at most ``centres``; the result is the same for any number.
    """
    extra = [payload] if payload else []
    # tasks compute with doubles; floats are sent as floats
    narrow = dict(train.dtypes)[vector] == dict(query.dtypes)[vector] == "array<float>"
    kind_of_vector = "array<float>" if narrow else "array<double>"
    t = train.filter(F.col(vector).isNotNull()).select(
        F.col(key).alias("t_key"), F.col(vector).cast(kind_of_vector).alias("t_vec"), *[F.col(p).alias("t_payload") for p in extra]
    )
    q = query.filter(F.col(vector).isNotNull()).select(F.col(key).alias("q_key"), F.col(vector).cast(kind_of_vector).alias("q_vec"))
    cells = Cells(t, "t_vec", max(1, min(centres, t.count() // cell_rows)), block_rows)
    kind, query_kind = dict(t.dtypes), dict(q.dtypes)["q_key"]
    columns = ["q_key", "t_key", "d2", *(["t_payload"] if extra else [])]
    schema = f"q_key {query_kind}, t_key {kind['t_key']}, d2 double" + (f", t_payload {kind['t_payload']}" if extra else "")
    if not len(cells.blocks):
        return _ranked(q.sparkSession.createDataFrame([], schema), k, extra)
    # cells of more than one block are few: the others need no entry
    split = {c: int(n) for c, n in enumerate(cells.blocks) if n > 1}
    count = F.create_map(*[F.lit(x) for entry in split.items() for x in entry]) if split else None
    blocks = F.coalesce(F.try_element_at(count, F.col("cell")), F.lit(1)) if split else F.lit(1)
    stored = cells.rows.drop("away").withColumn("block", F.pmod(F.xxhash64("t_key"), blocks).cast("int"))
    need = k + int(exclude_same_key)

    def best_of_pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=columns)
        b, b_key = _stacked(right["t_vec"]), right["t_key"].to_numpy()
        parts = []
        for at in range(0, len(left), BLOCK_ROWS):
            own = left.iloc[at : at + BLOCK_ROWS]
            a, a_key = _stacked(own["q_vec"]), own["q_key"].to_numpy()
            same = a_key[:, None] == b_key[None, :] if exclude_same_key else None
            rows, cols, d2 = _nearest_in_block(a, b, k, same)
            out = pd.DataFrame({"q_key": a_key[rows], "t_key": b_key[cols], "d2": d2})
            if extra:
                out["t_payload"] = right["t_payload"].to_numpy()[cols]
            parts.append(out.sort_values(["q_key", "d2", "t_key"]).groupby("q_key", sort=False).head(k)[columns])
        return pd.concat(parts)

    tree = cells.tree

    few = q.limit(query_rows + 1).count() <= query_rows

    def search(asking: DataFrame, choose: Choose) -> DataFrame:
        parts, held = np.ones(len(tree.centres), dtype=np.int64), stored.withColumn("part", F.lit(0))
        if not few:
            # one row per centre
            requests = asking.mapInPandas(lambda batches: count_requests(batches, choose, len(parts)), "cell int, n long")
            for r in requests.groupBy("cell").agg(F.sum("n").alias("n")).collect():
                parts[r["cell"]] = -(-r["n"] // query_rows)
            table = asking.sparkSession.createDataFrame([(c, n) for c, n in enumerate(parts.tolist())], "cell int, parts long")
            last = (F.col("parts") - 1).cast("int")
            held = stored.join(F.broadcast(table), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), last))).drop("parts")
        asked = asking.mapInPandas(lambda batches: send_requests(batches, choose, parts), f"q_key {query_kind}, q_vec {kind_of_vector}, cell int, part int")
        spread = asked.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        by = ["cell", "block", "part"]
        return spread.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(best_of_pair, schema)

    near = search(q, lambda b, x: tree.first(x, need))
    if len(tree.centres) == 1:
        return _ranked(near, k, extra)
    rank = F.row_number().over(Window.partitionBy("q_key").orderBy("d2", "t_key"))
    bound = near.withColumn("rank", rank).filter(F.col("rank") == k).select("q_key", F.col("d2").alias("bound"))
    bounded = q.join(bound, "q_key", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))

    def home(batches):
        for b in batches:
            yield b.assign(cell=tree.place(_stacked(b["q_vec"]))[0].astype(np.int32))

    query_schema = f"q_key {query_kind}, q_vec {kind_of_vector}, bound double"
    homes = materialize(bounded.mapInPandas(home, query_schema + ", cell int"), "queries")
    # one row per centre
    asking = np.zeros(len(tree.centres), dtype=np.int64)
    for r in homes.groupBy("cell").count().collect():
        asking[r["cell"]] = r["count"]
    most = max(1, part_bytes // (8 * tree.centres.shape[1]))
    part_rows = min(most, max(PART_ROWS, -(-int(asking.sum()) // q.sparkSession.sparkContext.defaultParallelism)))
    first, many = cells.spans(asking, part_rows)
    first_chunk, chunks = cells.spans(tree.size, 2 * most)

    def deal(batches):
        before = 0
        for b in batches:
            cell = b["cell"].to_numpy()
            yield b.drop(columns="cell").assign(part=(first[cell] + (before + np.arange(len(b))) % many[cell]).astype(np.int32))
            before += len(b)

    parts = materialize(homes.mapInPandas(deal, query_schema + ", part int"), "parts")

    def wanted(batches):
        for b in batches:
            for own, place, cell in chosen_cells(b, lambda own, x: tree.within(x, np.sqrt(own["bound"].to_numpy()))):
                yield pd.DataFrame({"part": own["part"].to_numpy()[place], "cell": cell}).drop_duplicates()

    wants = materialize(parts.mapInPandas(wanted, "part int, cell int").distinct(), "wanted")
    table = [(c, int(f), int(n)) for c, (f, n) in enumerate(zip(first_chunk, chunks, strict=True))]
    spans = F.broadcast(q.sparkSession.createDataFrame(table, "cell int, first int, many int"))
    whole = wants.join(spans, "cell").select("part", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("many") - 1)).alias("chunk")).distinct()
    left = parts.join(whole, "part")
    right = cells.rows.drop("away").join(spans, "cell").withColumn("chunk", (F.col("first") + F.pmod(F.xxhash64("t_key"), F.col("many"))).cast("int"))
    right = right.drop("first", "many").join(wants, "cell")

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=columns)
        r, c, d2 = best_in_chunk(left, right, tree, k, exclude_same_key)
        out = pd.DataFrame({"q_key": left["q_key"].to_numpy()[r], "t_key": right["t_key"].to_numpy()[c], "d2": d2})
        return out.assign(t_payload=right["t_payload"].to_numpy()[c]) if extra else out

    # the rows of the near cells are among them
    found = left.groupBy("part", "chunk").cogroup(right.groupBy("part", "chunk")).applyInPandas(best, schema)
    return _ranked(found, k, extra)


def _ranked(found: DataFrame, k: int, extra: list[str]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("q_key").orderBy("d2", "t_key"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("q_key").alias("query_key"),
        F.col("t_key").alias("train_key"),
        F.sqrt("d2").alias("distance"),
        "rank",
        *[F.col("t_payload").alias(p) for p in extra],
    )


def classify(neighbours: DataFrame, label: str) -> DataFrame:
    """Majority label per query; the smallest label wins a draw."""
    votes = neighbours.groupBy("query_key", label).agg(F.count(F.lit(1)).alias("_v"))
    return votes.groupBy("query_key").agg(
        F.min_by(label, F.struct(-F.col("_v"), F.col(label))).alias("predicted"), F.max("_v").alias("votes")
    )


def positive_share(neighbours: DataFrame, label: str) -> DataFrame:
    return neighbours.groupBy("query_key").agg(F.avg((F.col(label) == 1).cast("double")).alias("p"))
