"""Suffix-array deduplication: bytes that repeat an earlier document go.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in
a document with a smaller id. The work goes in four steps:

1. Shards of documents name the least 20-byte gram of every window of LENGTH
   bytes (equal windows have equal least grams); buckets of grams tell which
   ones occur in two documents or more. Only windows with such a gram can repeat.
2. Each shard builds a suffix array of the text of those windows whose gram
   it has more than once (Larsson-Sadakane refinement) and common prefixes
   (Kasai): suffixes that share LENGTH bytes are one class, represented by its
   earliest document.
3. The representatives of all shards meet in the bucket of their gram and are
   merged: every shard's windows find their place among the sorted distinct
   ones by binary search, where the smallest document id is kept.
4. Shards get the smallest id of each representative back, pass it on to the
   class and remove what is covered.

Nothing is compared pairwise. Copies in a shard send one representative, so a
passage of a third of all documents reaches its bucket once per shard. A gram
with very many different surroundings is dealt out by whole windows instead.
Windows are compared exactly within shards and by 128 bits of hash across them.

Defined cases: a null or empty text has no bytes; a null id counts as larger
than every other; documents with the same id do not remove from each other;
repeats inside one document stay; an empty table gives an empty result; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm import tokens as tk
from riskweave.llm.suffixes import common_prefixes, concatenated, suffix_array

LENGTH, GRAM = 50, 20
SHARD_BYTES = 4 << 20
#: Text of one suffix array; a shard whose repeats fill more has several.
REGION_BYTES = 2 << 20
#: Runs of one gram in the whole corpus from which its windows are dealt out one by one.
HOT_RUNS = 1 << 20
LAST = np.iinfo(np.int64).max
U = np.uint64


def _words(part: np.ndarray) -> np.ndarray:
    return np.ndarray((len(part),), dtype="<u8", buffer=np.concatenate([part, np.zeros(8, np.uint8)]), strides=(1,))


def gram_hashes(part: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` (16 to 24) bytes from each place on."""
    n = max(0, len(part) - gram + 1)
    w = _words(part)
    h = w[:n] * U(0x9E3779B97F4A7C15)
    h ^= h >> U(29)
    h += w[8 : 8 + n]
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(32)
    h += w[gram - 8 : gram - 8 + n]
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def window_keys(part: np.ndarray, at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the ``length`` bytes from each of the places."""
    w = _words(part)
    a, b = np.full(len(at), 7, dtype=U), np.full(len(at), 11, dtype=U)
    for j in [*range(0, length - 8, 8), length - 8]:
        x = w[at + j]
        a = (a ^ x) * U(0x9E3779B97F4A7C15)
        a ^= a >> U(32)
        b = (b + x) * U(0xD6E8FEB86659FD93)
        b ^= b >> U(29)
    return tk.mixed(a), tk.mixed(b)


def runs_of(data: np.ndarray, offsets: np.ndarray, bits: int, length: int = LENGTH, gram: int = GRAM):
    """(start, number of windows, gram key) of the runs of windows with one least gram."""
    span = length - gram + 1
    starts, sizes, keys = [], [], []
    for i, j in tk.slices(offsets):
        part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if len(part) < length:
            continue
        least, s = gram_hashes(part, gram), 1
        while 2 * s <= span:
            least = np.minimum(least[:-s], least[s:])
            s *= 2
        if s < span:
            least = np.minimum(least[: s - span], least[span - s :])
        room = bounds[1:] - length + 1  # windows of row r are bounds[r] .. room[r]-1
        valid = np.zeros(len(least) + 1, dtype=np.int32)
        own = room > bounds[:-1]
        np.add.at(valid, bounds[:-1][own], 1)
        np.add.at(valid, room[own], -1)
        valid = np.cumsum(valid[:-1]) > 0
        new = valid.copy()
        new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
        heads = bounds[:-1][own]
        new[heads] = True
        ends = np.flatnonzero(np.append(new[1:] | ~valid[1:], True) & valid)
        begin = np.flatnonzero(new)
        starts.append(begin + offsets[i])
        sizes.append(ends - begin + 1)
        keys.append(least[begin])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    low = U(64 - bits - 40) if bits < 24 else U(0)
    # least hashes are small: mixed again, they spread evenly over the buckets
    return np.concatenate(starts), np.concatenate(sizes), (tk.mixed(np.concatenate(keys)) >> low) << low


class Shard:
    """The rows of a shard in order of id: bytes, offsets, ids."""

    def __init__(self, table: pa.Table):
        ids = table["doc_id"].to_pylist()
        digests = table["digest"].to_numpy()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, digests[i]))
        table = table.take(pa.array(order, pa.int64()))
        self.table = table
        self.ids = np.array([LAST if ids[i] is None else ids[i] for i in order], dtype=np.int64)
        self.data, self.offsets = tk.text_bytes(table["text"])

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1


def regions(starts: np.ndarray, sizes: np.ndarray, length: int, limit: int):
    """Windows of touching runs as stretches of text, in groups of about ``limit`` bytes."""
    if not len(starts):
        return
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] != starts[:-1] + sizes[:-1]
    heads = np.flatnonzero(new)
    at, windows = starts[heads], np.add.reduceat(sizes, heads)
    many = windows > limit  # a long stretch is cut, with its windows dealt out
    if many.any():
        parts = [(a + k, min(limit, w - k)) for a, w in zip(at.tolist(), windows.tolist(), strict=True) for k in range(0, w, limit)]
        at, windows = (np.array(x, dtype=np.int64) for x in zip(*parts, strict=True))
    total = np.cumsum(windows + length - 1)
    a = 0
    while a < len(at):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + limit, side="right")))
        yield at[a:b], windows[a:b]
        a = b


def classes(data: np.ndarray, at: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Every window of the stretches and the first window of its class (places in ``data``)."""
    x, places, sources = concatenated(at, windows + length - 1, data)
    sa, rank = suffix_array(x, places, length)
    shared = common_prefixes(x, sa, rank, length)
    heads = np.flatnonzero(np.concatenate([[True], shared[1:] < length]))
    origin = np.zeros(len(x), dtype=np.int64)
    origin[places] = sources
    ordered = origin[sa]
    leading = np.zeros(len(x), dtype=np.int64)
    leading[sa] = np.repeat(np.minimum.reduceat(ordered, heads), np.diff(np.append(heads, len(ordered))))
    stretch = windows + length - 1
    window = spread(np.cumsum(stretch) - stretch, windows)
    return sources[window], leading[places[window]]


def spread(at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """at, at + 1, ... for each length, one after the other."""
    return np.repeat(at - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [c.split() for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.table([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(names)], names=[n for n, _ in names])


NAMED = "bucket long, shard long, keys binary, counts binary"
COMMON = "shard long, bucket long, flags binary"
SENT = "bucket long, shard long, ids binary, sizes binary, bytes binary"
BACK = "shard long, bucket long, sizes binary, ids binary, state binary"


def name_grams(table: pa.Table, bits: int, length: int) -> pa.Table:
    """Step 1: a shard's distinct gram keys; twice their runs, plus one if two rows have it."""
    shard = Shard(table)
    starts, _, keys = runs_of(shard.data, shard.offsets, bits, length)
    order = np.argsort(keys)
    row, keys = shard.row_of(starts)[order], keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if not len(heads):
        return _table([], NAMED)
    several = np.minimum.reduceat(row, heads) != np.maximum.reduceat(row, heads)
    counts = 2 * np.diff(np.append(heads, len(keys))) + several
    every, number = keys[heads], table["shard"][0].as_py()
    return _table([(k, number, tk.pack_keys(every[a:b], bits, 5), tk.pack_numbers(counts[a:b])) for k, a, b in tk.bucket_ranges(every, bits)], NAMED)


def common_grams(table: pa.Table, hot_runs: int) -> pa.Table:
    """Step 1 in a bucket: per shard and key 0 (one row only), 1 (common) or 2 (hot)."""
    keys = [tk.unpack_keys(b.as_py(), 5) for b in table["keys"]]
    counts = np.concatenate([tk.unpack_numbers(b.as_py()) for b in table["counts"]])
    _, place, shards = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    runs = np.bincount(place, weights=counts // 2)
    common = (shards > 1) | (np.bincount(place, weights=counts & 1) > 0)
    flags = (common.astype(np.uint8) + (common & (runs >= hot_runs)))[place]
    parts = np.split(flags, np.cumsum([len(k) for k in keys])[:-1])
    return _table([(s.as_py(), b.as_py(), f.tobytes()) for s, b, f in zip(table["shard"], table["bucket"], parts, strict=True)], COMMON)


def send_representatives(table: pa.Table, answers: pa.Table, bits: int, length: int) -> pa.Table:
    """Step 2: classes of the shard; representatives go to their buckets, the
    rest (where they are and what represents them) goes along to the shard itself."""
    if not len(table):
        return _table([], SENT)
    shard, number = Shard(table), table["shard"][0].as_py()
    data = shard.data
    starts, sizes, keys = runs_of(data, shard.offsets, bits, length)
    every, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    flags = np.frombuffer(b"".join(answers["flags"][int(i)].as_py() for i in np.argsort(answers["bucket"].to_numpy())), dtype=np.uint8)
    flag = flags[place] if len(every) else np.zeros(0, np.uint8)
    kept = flag > 0
    starts, sizes, keys, hot, again = starts[kept], sizes[kept], keys[kept], flag[kept] > 1, times[place][kept] > 1
    # a gram with one run here has no second copy here: its windows represent themselves
    alone = ~again & ~hot
    copies, sends = [], [(starts[alone], sizes[alone], keys[alone])]
    starts, sizes, keys, hot = starts[~alone], sizes[~alone], keys[~alone], hot[~alone]
    for at, windows in regions(starts, sizes, length, REGION_BYTES):
        window, first = classes(data, at, windows, length)
        run = np.searchsorted(starts, window, side="right") - 1
        own = window == first
        p, q = window[~own], first[~own]
        if len(p):
            head = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)]))
            copies.append((p[head], np.diff(np.append(head, len(p))), q[head]))
        p, r = window[own], run[own]
        alone = hot[r]
        head = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1] + 1) | (r[1:] != r[:-1]) | alone[1:]]))
        key = keys[r[head]]
        key[alone[head]] = window_keys(data, p[head][alone[head]], length)[0]
        sends.append((p[head], np.diff(np.append(head, len(p))), key))
    at, size, key = (np.concatenate(x) for x in zip(*sends, strict=True)) if sends else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U))
    order = np.lexsort((at, key))
    at, size, key = at[order], size[order], key[order]
    ids = shard.ids[shard.row_of(at)]
    rows = []
    for bucket, a, b in tk.bucket_ranges(key, bits):
        text = data[spread(at[a:b], size[a:b] + length - 1)]
        rows.append((bucket, number, ids[a:b].tobytes(), tk.pack_numbers(size[a:b]), text.tobytes()))
    moved = [np.concatenate(x) for x in zip(*copies, strict=True)] if copies else [np.zeros(0, np.int64)] * 3
    state = [tk.pack_numbers(x) for x in (at, size, *moved)]
    rows.append((-1 - number, number, b"", np.array([len(x) for x in state], "<i8").tobytes(), b"".join(state)))
    return _table(rows, SENT)


def merge(table: pa.Table, length: int) -> pa.Table:
    """Step 3: the least id of every window in a bucket, back to each shard as runs."""
    if table["bucket"][0].as_py() < 0:
        return _table([(s.as_py(), -1, n.as_py(), b"", t.as_py()) for s, n, t in zip(table["shard"], table["sizes"], table["bytes"], strict=True)], BACK)
    parts = []
    for ids, sizes, text in zip(table["ids"], table["sizes"], table["bytes"], strict=True):
        size = tk.unpack_numbers(sizes.as_py())
        stretch = size + length - 1
        at = spread(np.cumsum(stretch) - stretch, size)
        parts.append((np.repeat(np.frombuffer(ids.as_py(), "<i8"), size), *window_keys(np.frombuffer(text.as_py(), np.uint8), at, length)))
    while True:
        merged, _ = tk.distinct(np.concatenate([a for _, a, _ in parts]))
        least, check = np.full(len(merged), LAST), np.zeros(len(merged), U)
        places = [np.searchsorted(merged, a) for _, a, _ in parts]
        for place, (ids, _, b) in zip(places, parts, strict=True):
            np.minimum.at(least, place, ids)
            check[place] = b
        if all((check[place] == b).all() for place, (_, _, b) in zip(places, parts, strict=True)):
            break
        parts = [(ids, tk.mixed(a + b * tk.GOLDEN), b) for ids, a, b in parts]  # two windows had one first hash
    rows = []
    for shard, bucket, place in zip(table["shard"], table["bucket"], places, strict=True):
        value = least[place]
        head = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        rows.append((shard.as_py(), bucket.as_py(), tk.pack_numbers(np.diff(np.append(head, len(value)))), value[head].tobytes(), None))
    return _table(rows, BACK)


def covered_spans(shard: Shard, answers: pa.Table, length: int) -> np.ndarray:
    """Step 4: which bytes of the shard go."""
    covered = np.zeros(len(shard.data) + 1, dtype=np.int32)
    bucket = answers["bucket"].to_numpy()
    if not len(bucket):
        return covered[:-1] > 0
    own = np.repeat(shard.ids, np.diff(shard.offsets))
    least = own.copy()
    state = int(np.flatnonzero(bucket == -1)[0])
    raw, ends = answers["state"][state].as_py(), np.cumsum(np.frombuffer(answers["sizes"][state].as_py(), "<i8"))
    at, size, p, n, q = (tk.unpack_numbers(raw[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True))
    order = [int(i) for i in np.argsort(bucket) if bucket[i] >= 0]
    if order:
        runs = np.concatenate([tk.unpack_numbers(answers["sizes"][i].as_py()) for i in order])
        values = np.concatenate([np.frombuffer(answers["ids"][i].as_py(), "<i8") for i in order])
        least[spread(at, size)] = np.repeat(values, runs)
    if len(p):
        least[spread(p, n)] = least[spread(q, n)]
    gone = np.flatnonzero(least < own)
    np.add.at(covered, gone, 1)
    np.add.at(covered, gone + length, -1)
    return np.cumsum(covered[:-1]) > 0


def remove(table: pa.Table, answers: pa.Table, length: int, keep: tuple[str, ...]) -> pa.Table:
    shard = Shard(table)
    gone = covered_spans(shard, answers, length)
    edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
    first = edge[:-1] == 1
    inner = shard.offsets[:-1][shard.offsets[:-1] < len(gone)]
    first[inner] |= gone[inner]  # a run that goes on in the next row is two
    begin = np.flatnonzero(first)
    last = np.append(gone[:-1] & (~gone[1:] | first[1:]), gone[-1:])
    end = np.flatnonzero(last) + 1
    row = shard.row_of(begin)
    # an empty row shares its offset with the next one: spans belong to the row that has the byte
    spans: list[list[dict]] = [[] for _ in range(len(table))]
    for r, a, b in zip(row.tolist(), begin.tolist(), end.tolist(), strict=True):
        o = int(shard.offsets[r])
        spans[r].append({"begin": a - o, "end": b - o})
    kept = []
    for r, (a, b) in enumerate(zip(shard.offsets[:-1].tolist(), shard.offsets[1:].tolist(), strict=True)):
        text = shard.data[a:b]
        kept.append((text[~gone[a:b]] if spans[r] else text).tobytes())
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    return pa.table(
        {
            **{c: shard.table[c] for c in keep},
            "n_bytes": pa.array(np.diff(shard.offsets), pa.int64()),
            "spans": pa.array(spans, span),
            "kept": pa.array(kept, pa.binary()),
            "kept_text": pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()),
        }
    )


def deduplicate(
    docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, hot_runs: int = HOT_RUNS, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` (not the text), n_bytes, spans (removed bytes: begin,
    end), kept (the other bytes), kept_text (the same as text; what is left of a
    character that was cut goes).

    One row per document. The texts are shuffled once; the exchange serves
    steps 1, 2 and 4.
    """
    others = [c for c in keep if c != "doc_id"]
    body = F.coalesce("text", F.lit(""))
    text = docs.select("doc_id", *others, body.alias("text"), F.xxhash64(body).alias("digest"))
    shards = tk.shard_number(text, shard_bytes)
    bits = tk.bucket_bits(shards)
    rows = tk.sharded(text, shards, *others, "digest")
    named = rows.groupBy("shard").applyInArrow(lambda t: name_grams(t, bits, length), NAMED)
    common = named.groupBy("bucket").applyInArrow(lambda t: common_grams(t, hot_runs), COMMON)
    sent = rows.groupBy("shard").cogroup(common.groupBy("shard")).applyInArrow(lambda t, a: send_representatives(t, a, bits, length), SENT)
    back = sent.groupBy("bucket").applyInArrow(lambda t: merge(t, length), BACK)
    own = T.StructType([docs.schema[c] for c in keep])
    schema = T.StructType([*own.fields, *T.StructType.fromDDL("n_bytes long, spans array<struct<begin:long,end:long>>, kept binary, kept_text string").fields])
    return rows.groupBy("shard").cogroup(back.groupBy("shard")).applyInArrow(lambda t, a: remove(t, a, length, keep), schema)
