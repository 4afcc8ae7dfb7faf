"""Words of Arrow text columns as 64-bit hashes, and packed key counts.

Tasks exchange sorted keys in packed form, one row per (task, bucket): a bucket
is the top bits of a key, so its rows hold each key at most once per task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_random = np.random.default_rng(20)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS = [np.ones(1, dtype=np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit key over all of them."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        size = 1 << max(6, (n - 1).bit_length())
        _POWERS[0] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, GOLDEN)]), dtype=np.uint64)
    return _POWERS[0]


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    array = array.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES):
    """Row ranges of about ``size`` bytes; a longer row is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs without white space, A-Z as a-z) and their number per row."""
    hashes, counts = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for a, b in slices(offsets):
        part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if not len(part):
            continue
        space = _SPACE[part]
        first = np.empty(len(part), dtype=bool)
        first[0] = True
        first[1:] = space[:-1]
        first[bounds[:-1][bounds[:-1] < len(part)]] = True
        first &= ~space
        at = np.flatnonzero(~space)
        starts = np.flatnonzero(first)
        counts[a:b] = np.diff(np.searchsorted(starts, bounds))
        if not len(starts):
            continue
        begins = first[at]
        place = at - starts[np.cumsum(begins) - 1]
        value = _BYTE[part[at]] * powers(int(place.max()) + 1)[place]
        hashes.append(mixed(np.add.reduceat(value, np.flatnonzero(begins))))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    keys = np.sort(keys)
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.diff(np.append(at, len(keys)))


def pack_numbers(x: np.ndarray) -> bytes:
    """Numbers from 0 in the narrowest width that holds them."""
    most = int(x.max()) if len(x) else 0
    width = 1 if most < 2**8 else 2 if most < 2**16 else 4 if most < 2**32 else 8
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def unpack_numbers(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype=f"<u{b[0]}", offset=1).astype(np.int64)


def pack_keys(keys: np.ndarray, bits: int, width: int) -> bytes:
    """Keys of one bucket without its bits, cut to ``width`` bytes from the top."""
    low = (keys << np.uint64(bits)) >> np.uint64(64 - 8 * width)
    return np.ascontiguousarray(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_keys(b: bytes, width: int) -> np.ndarray:
    raw = np.zeros((len(b) // width, 8), dtype=np.uint8)
    raw[:, :width] = np.frombuffer(b, dtype=np.uint8).reshape(-1, width)
    return raw.reshape(-1).view("<u8")


def bucket_ranges(keys: np.ndarray, bits: int):
    """(bucket, from, to) of the buckets that sorted keys fall into."""
    if not len(keys):
        return
    buckets = (keys >> np.uint64(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    for a, b in zip(at, np.append(at[1:], len(keys)), strict=True):
        yield int(buckets[a]), int(a), int(b)


def shard_number(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    """How many shards of about ``shard_bytes`` the texts fill."""
    return max(1, math.ceil((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / shard_bytes))


def bucket_bits(shards: int) -> int:
    """So many top bits that a bucket stays as large as a shard's share."""
    return max(2, (shards - 1).bit_length())


def sharded(docs: DataFrame, shards: int, *columns: str) -> DataFrame:
    """Rows dealt out by a hash of id and text; one key never fills a shard."""
    kept = docs.select("doc_id", *columns, "text")
    return kept.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards))).repartition(shards, "shard")
