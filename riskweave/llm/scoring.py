"""Language-model scoring by a weighted backoff automaton over word n-grams.

States are the contexts seen in training (the empty one is the root). An arc of
a state is a word seen after it; every state has a failure arc to its context
without the oldest word. With Dirichlet smoothing of strength mu the weights are

    arc:      (c(h w) + mu p(w | shorter h)) / (c(h) + mu)
    failure:  mu / (c(h) + mu)

so following failure arcs until a word is found multiplies to a proper
probability; the root gives (c(w) + 1) / (N + V + 1). One pass from left to
right carries the state and adds the logarithms.

The automaton is not held whole anywhere. A shard of documents asks for the
n-grams it meets: their keys go to buckets by hash, are summed over all
training documents, and the sums come back aligned with the shard's keys. From
them the shard builds the states, arcs and failure arcs that its texts reach
(:class:`Automaton`). The state before a token is the longest known context, so
all tokens of a shard are carried forward together: those that find an arc take
it, the others follow their failure arc, one order at a time.

Words are keyed by 64-bit hashes, longer n-grams by 40 bits beside those of
their bucket (buckets grow with the corpus): two of a million keys may share one.

Defined cases: a null or empty text is one end token; repeated rows are scored
and learned from each; a null id counts as empty text when rows are held out;
without any training row every probability is that of an unseen word; an empty
table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm import tokens as tk

ORDER = 2
STRENGTH = (200.0, 50.0)
END, BEGIN = np.uint64(0x5EED0E4D), np.uint64(0x5EEDBE61)
WIDTHS = (8, 5)
MESSAGE = "bucket long, shard long, keys binary, counts binary"
ANSWER = "shard long, bucket long, counts binary"


def token_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, each row closed by an end token, and the row starts."""
    words, counts = tk.word_hashes(data, offsets)
    ends = np.cumsum(counts + 1) - 1
    tokens = np.full(len(words) + len(counts), END, dtype=np.uint64)
    inner = np.ones(len(tokens), dtype=bool)
    inner[ends] = False
    tokens[inner] = words
    return tokens, np.concatenate([[0], ends + 1])


def gram_keys(tokens: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """The key of the n-gram that ends at each token; rows begin with a mark."""
    key = tokens.copy()
    previous = tokens
    for _ in range(order - 1):
        shifted = np.empty_like(previous)
        shifted[1:] = previous[:-1]
        shifted[starts[:-1]] = BEGIN
        key = tk.mixed(key * tk.GOLDEN + shifted)
        previous = shifted
    return tk.mixed(key) if order == 1 else key


def cut(keys: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Keys as precise as they are sent."""
    return keys if order == 1 else keys & ~((np.uint64(1) << np.uint64(64 - bits - 8 * WIDTHS[1])) - np.uint64(1))


def messages(keys: np.ndarray, trained: np.ndarray, order: int, bits: int, shard: int) -> list[tuple]:
    """Distinct keys of a shard with their training counts, a row per bucket."""
    every, _ = tk.distinct(keys)
    learned, times = tk.distinct(keys[trained])
    counts = np.zeros(len(every), dtype=np.int64)
    counts[np.searchsorted(every, learned)] = times
    width = WIDTHS[min(order, 2) - 1]
    return [
        (bucket * 16 + order, shard, tk.pack_keys(every[a:b], bits, width), tk.pack_numbers(counts[a:b]))
        for bucket, a, b in tk.bucket_ranges(every, bits)
    ]


class Automaton:
    """States, arcs and failure arcs that the tokens of a shard reach.

    ``counts[k]``: training count of the (k + 1)-gram that ends at each token;
    ``contexts[k]``: that of the k words before it (k from 1). An arc leaves a
    state for each n-gram that was seen; the root knows every word.
    """

    def __init__(self, counts: list[np.ndarray], contexts: list[np.ndarray], root: np.ndarray, strength: tuple[float, ...]):
        self.root = np.log10(root)
        self.seen = [c > 0 for c in counts[1:]]
        self.known = [c > 0 for c in contexts]
        self.arcs, self.failures = [], []
        p = root
        for count, context, mu in zip(counts[1:], contexts, strength, strict=False):
            p = (count + mu * p) / (context + mu)
            self.arcs.append(np.log10(p))
            self.failures.append(np.log10(mu / (context + mu)))

    def states(self) -> np.ndarray:
        """The number of words of the state before each token."""
        state = np.zeros(len(self.root), dtype=np.int64)
        for k, known in enumerate(self.known, 1):
            state[known & (state == k - 1)] = k
        return state

    def traverse(self) -> np.ndarray:
        """The log probability of each token: failure arcs, then an arc."""
        state, total = self.states(), np.zeros(len(self.root))
        moving = np.ones(len(state), dtype=bool)
        for k in range(len(self.arcs), 0, -1):
            here = moving & (state == k)
            found = here & self.seen[k - 1]
            total[found] += self.arcs[k - 1][found]
            moving &= ~found
            fails = here & ~found
            total[fails] += self.failures[k - 1][fails]
            state[fails] = k - 1
        total[moving] += self.root[moving]
        return total


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    types = [pa.binary() if n in ("keys", "counts") else pa.int64() for n in names]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))


def _summed(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per message its rows in the bucket's key list, and the list's sums."""
    width = WIDTHS[min(table["bucket"][0].as_py() % 16, 2) - 1]
    keys = [tk.unpack_keys(b.as_py(), width) for b in table["keys"]]
    counts = np.concatenate([tk.unpack_numbers(b.as_py()) for b in table["counts"]])
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(place, weights=counts, minlength=len(every)).astype(np.int64)
    return np.split(place, np.cumsum([len(k) for k in keys])[:-1]), sums, every


def vocabulary(docs: DataFrame, bits: int) -> tuple[int, int]:
    """N and V: all and distinct tokens of the training rows."""

    def local(batches):
        for batch in batches:
            data, offsets = tk.text_bytes(batch.column("text"))
            tokens, starts = token_stream(data, offsets)
            keys = gram_keys(tokens, starts, 1)
            for t in _table(messages(keys, np.ones(len(keys), bool), 1, bits, 0), ("bucket", "shard", "keys", "counts")).to_batches():
                yield t

    def total(table: pa.Table) -> pa.Table:
        _, sums, _ = _summed(table)
        return pa.table({"n": pa.array([int(sums.sum())], pa.int64()), "v": pa.array([len(sums)], pa.int64())})

    learned = docs.where("NOT held_out").select("text")
    found = learned.mapInArrow(local, MESSAGE).groupBy("bucket").applyInArrow(total, "n long, v long")
    row = found.agg(F.sum("n"), F.sum("v")).first()
    return row[0] or 0, row[1] or 0


def score(docs: DataFrame, held_out: Column, order: int = ORDER, strength: tuple[float, ...] = STRENGTH, shard_bytes: int = tk.SHARD_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` marks the rows that are scored but not learned from. The rows
    are shuffled once; the exchange serves asking and scoring.
    """
    marked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    shards = tk.shard_number(marked, shard_bytes)
    bits = tk.bucket_bits(shards)
    n_all, n_words = vocabulary(marked, bits)
    begun = marked.where("NOT held_out").count()
    rows = tk.sharded(marked, shards, "held_out")

    def grams(table: pa.Table):
        data, offsets = tk.text_bytes(table["text"])
        tokens, starts = token_stream(data, offsets)
        learned = np.repeat(~table["held_out"].to_numpy(zero_copy_only=False).astype(bool), np.diff(starts))
        return tokens, starts, learned

    def ask(table: pa.Table) -> pa.Table:
        tokens, starts, learned = grams(table)
        shard, out = table["shard"][0].as_py(), []
        for k in range(1, order + 1):
            out += messages(cut(gram_keys(tokens, starts, k), k, bits), learned, k, bits, shard)
        return _table(out, ("bucket", "shard", "keys", "counts"))

    def answer(table: pa.Table) -> pa.Table:
        places, sums, _ = _summed(table)
        out = [(s.as_py(), b.as_py(), tk.pack_numbers(sums[p])) for s, b, p in zip(table["shard"], table["bucket"], places, strict=True)]
        return _table(out, ("shard", "bucket", "counts"))

    def traverse(table: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, starts, _ = grams(table)
        buckets = answers["bucket"].to_numpy()
        found = []
        for k in range(1, order + 1):
            keys = cut(gram_keys(tokens, starts, k), k, bits)
            every, _ = tk.distinct(keys)
            own = np.flatnonzero(buckets % 16 == k)
            sums = [tk.unpack_numbers(answers["counts"][int(i)].as_py()) for i in own[np.argsort(buckets[own])]]
            found.append((np.concatenate(sums) if sums else np.zeros(0, np.int64))[np.searchsorted(every, keys)])
        base = (found[0] + 1.0) / (n_all + n_words + 1.0)
        contexts = []
        for k in range(1, order):
            # the context of an n-gram is the shorter n-gram that ends one token earlier
            context = np.empty(len(tokens), dtype=np.int64)
            context[1:] = found[k - 1][:-1]
            context[starts[:-1]] = begun
            contexts.append(context)
        weights = Automaton(found, contexts, base, strength).traverse()
        total = lambda x: np.add.reduceat(x, starts[:-1]) if len(x) else np.zeros(0)
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "held_out": table["held_out"],
                "n_tokens": pa.array(np.diff(starts), pa.int64()),
                "n_known": pa.array(total((found[0] > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array(np.full(len(table), n_all), pa.int64()),
                "base_score": pa.array(total(np.log10(base)), pa.float64()),
                "score": pa.array(total(weights), pa.float64()),
            }
        )

    answers = rows.groupBy("shard").applyInArrow(ask, MESSAGE).groupBy("bucket").applyInArrow(answer, ANSWER)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(traverse, schema)
