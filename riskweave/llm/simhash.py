"""SimHash near-duplicates with BK-trees.

A fingerprint is the bitwise majority of the XXH64 values (seed 42) of a text's
3-word shingles. Equal fingerprints are one class. Classes that differ in at
most ``RADIUS`` bits are linked: the 64 bits are cut into RADIUS + 3 blocks, so
two such fingerprints agree on at least three of them, and every choice of
three blocks deals the classes out to shards that share those bits. Each shard
is a BK-tree (children keyed by their distance to the parent), searched along
the edges within the radius. The trees stay in the task that holds their shard:
broadcast trees of all classes would grow with the corpus.

A shard gives back a star per connected part, never its pairs; the parts are
joined to components by distributed star steps.

Defined cases: null, empty and blank texts have fingerprint zero and are linked
like any other; one or two words are one shingle; repeated rows keep a row
each; a component without any non-null id has a null id; an empty table gives
an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import fresh
from riskweave.llm.components import components
from riskweave.session import materialize

RADIUS, SHINGLE, SEED = 2, 3, 42
#: Query rows times nodes of a shard that are searched at once.
AT_ONCE = 1 << 21


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The majority of the shingles' hash bits; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    if len(words) <= size:
        spans = [joined]
    else:
        starts = [0, *ends[:-size].tolist()]
        spans = [joined[s : e - 1] for s, e in zip(starts, ends[size - 1 :].tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, digest (a hash of the text), fp (the 64 bits as a signed number)."""

    def local(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            fps = np.array([fingerprint(t.as_py() or b"") for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(fps, pa.int64())], names=["doc_id", "digest", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("digest"), text.alias("text")).mapInArrow(local, f"doc_id {kind}, digest long, fp long")


class Forest:
    """One BK-tree per group, built and searched for all groups at once.

    The first fingerprint of a group is its root; the others go to the child of
    their distance to it, and so on down.
    """

    def __init__(self, group: np.ndarray, fps: np.ndarray):
        """``group`` is sorted, 0 .. n-1; fingerprints of a group are distinct."""
        self.pivots, keys, kids = [], [], []
        rows, node = np.arange(len(fps)), group.astype(np.int64)
        first = 0
        while len(rows):
            heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            rank = np.cumsum(np.concatenate([[True], node[1:] != node[:-1]])) - 1
            if first:
                keys.append(node[heads])
                kids.append(first + np.arange(len(heads)))
            pivot = fps[rows[heads]]
            self.pivots.append(pivot)
            away = np.bitwise_count(fps[rows] ^ pivot[rank]).astype(np.int64)
            rest = np.ones(len(rows), dtype=bool)
            rest[heads] = False
            child = ((first + rank) * 65 + away)[rest]
            order = np.argsort(child, kind="stable")
            rows, node, first = rows[rest][order], child[order], first + len(heads)
        self.pivots = np.concatenate(self.pivots)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.kids = np.concatenate(kids) if kids else np.zeros(0, np.int64)

    def search(self, roots: np.ndarray, fps: np.ndarray, radius: int):
        """(query, pivot) pairs within the radius; a query begins at its root."""
        query, node = np.arange(len(fps)), roots
        while len(query):
            away = np.bitwise_count(fps[query] ^ self.pivots[node]).astype(np.int64)
            near = away <= radius
            yield query[near], self.pivots[node[near]]
            queries, nodes = [], []
            for step in range(-radius, radius + 1):
                key = node * 65 + away + step
                at = np.searchsorted(self.keys, key)
                there = (away + step > 0) & (at < len(self.keys))
                there[there] = self.keys[at[there]] == key[there]
                queries.append(query[there])
                nodes.append(self.kids[at[there]])
            query, node = np.concatenate(queries), np.concatenate(nodes)


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        x = up


def stars(group: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) of every connected part of the groups; ``group`` is sorted."""
    rank = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1
    order = np.lexsort((fps, rank))
    fps = fps[order]
    sizes = np.bincount(rank)
    forest = Forest(rank, fps)
    parent = np.arange(len(fps))
    begin = np.cumsum(sizes) - sizes
    work = np.cumsum(sizes[rank])
    at = 0
    while at < len(fps):
        to = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + AT_ONCE, side="right")))
        for query, pivot in forest.search(rank[at:to], fps[at:to], radius):
            query = query + at
            # rows are sorted by (group, fingerprint): the pivot's row is found by its place in the group
            other = _find(fps, begin[rank[query]], begin[rank[query]] + sizes[rank[query]], pivot)
            a, b = query, other
            while len(a):
                a, b = _roots(parent, a), _roots(parent, b)
                apart = a != b
                a, b = a[apart], b[apart]
                np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        at = to
    root = _roots(parent, np.arange(len(fps)))
    tied = root != np.arange(len(fps))
    return fps[tied], fps[root[tied]]


def _find(fps: np.ndarray, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Rows of the values in their own sorted ranges, by bisection."""
    low, high = low.copy(), high.copy()
    while (high - low > 1).any():
        mid = (low + high) // 2
        right = fps[mid] <= value
        low, high = np.where(right, mid, low), np.where(right, high, mid)
    return low


def block_masks(radius: int = RADIUS) -> list[int]:
    """The bits of every choice of three out of radius + 3 blocks."""
    edges = np.linspace(0, 64, radius + 4).round().astype(int)
    blocks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(c) for c in combinations(blocks, 3)]


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """u, v: stars that connect the fingerprints within the radius."""
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius)]
    dealt = classes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "bits"))
    dealt = dealt.repartition("choice", "bits").sortWithinPartitions("choice", "bits")

    def part(choice, bits, fps):
        new = np.concatenate([[True], (choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1])])
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        u, v = stars(group[many], fps[many].view(np.uint64), radius) if many.any() else (np.zeros(0, np.uint64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64), pa.int64()) for x in (u, v)], names=["u", "v"])

    def local(batches):
        held = None
        for batch in batches:
            now = [np.asarray(batch.column(n).to_numpy(zero_copy_only=False)).astype(np.int64) for n in ("choice", "bits", "fp")]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            if not len(now[0]):
                continue
            # the last group may go on in the next batch
            last = (now[0] != now[0][-1]) | (now[1] != now[1][-1])
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            held = [x[cut:] for x in now]
            if cut:
                yield part(*[x[:cut] for x in now])
        if held is not None:
            yield part(*held)

    return dealt.select("choice", "bits", "fp").mapInArrow(local, "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, digest, fingerprint (16 hex digits), component_id, component (a
    fingerprint that stands for it): one row per document."""
    rows = materialize(fingerprints(docs), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    parts = components(links(classes.select("fp"), radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    placed = classes.join(parts, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed, "placed")
    heads = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(placed.join(heads, "root").select("fp", "root", "component_id"), "named")
    return rows.join(named, "fp").select(
        "doc_id", "digest", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.col("root").alias("component")
    )


def without_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: the least id of every component, once."""
    near = near_duplicates(docs, radius)
    stay = near.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("row"))
    doc, own, told = fresh(docs, "_doc", "_own", "_told")
    stay = materialize(stay.select(F.col("row.doc_id").alias(doc), F.col("row.digest").alias(told)), "stay")
    kept = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = kept.join(stay, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(told)), "left_semi")
    return kept.dropDuplicates(["doc_id", own]).drop(own)
