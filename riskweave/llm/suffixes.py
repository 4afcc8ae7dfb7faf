"""Suffix arrays of integer strings in numpy, and their common prefixes."""

from __future__ import annotations

import numpy as np

#: Positions after each entry that hold zero; the first key covers so many symbols.
PAD = 7


def concatenated(at: np.ndarray, lengths: np.ndarray, data: np.ndarray, kind: type = np.uint16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries ``data[at : at + length]`` one after the other, each followed by
    PAD zeros: the string (symbols are values plus one), the places of its
    symbols, and where they stand in ``data``."""
    begins = np.cumsum(lengths + PAD) - (lengths + PAD)
    inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    places = np.repeat(begins, lengths) + inner
    sources = np.repeat(at, lengths) + inner
    x = np.zeros(int((lengths + PAD).sum()), dtype=kind)
    x[places] = data[sources].astype(kind) + kind(1)
    return x, places, sources


def suffix_array(x: np.ndarray, places: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the rank of each place of ``x``.

    Larsson-Sadakane: a first sort by PAD symbols, then only groups that are
    still tied are sorted again, by the rank of the suffix as far ahead as the
    order reaches, which doubles every time. Suffixes end with their entry; the
    ends differ, in the order of the entries. ``depth`` stops when so many
    symbols are in order: longer ties keep one rank.
    """
    top = int(x.max()) + 1 if len(x) else 1
    width = PAD if top**PAD < 2**63 else max(1, int(62 / np.log2(top)))
    reading = np.concatenate([x, np.zeros(width, x.dtype)])
    key = np.zeros(len(x), dtype=np.uint64)
    for j in range(width):
        key *= np.uint64(top)
        key += reading[j : j + len(x)]
    key = key[places]
    order = np.argsort(key)
    key = key[order]
    sa = places[order]
    # place of each symbol's end: a suffix that is used up ranks by its entry
    entry_end = np.cumsum(x[::-1] == 0)[::-1].astype(np.int64)
    new = np.ones(len(sa), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    heads = np.flatnonzero(new)
    rank = -entry_end  # negative beyond the entries; later entries rank higher
    slot_rank = heads[np.cumsum(new) - 1] if len(sa) else heads
    rank[sa] = slot_rank
    reach = width
    while depth is None or reach < depth:
        sizes = np.diff(np.append(heads, len(sa)))
        tied = np.repeat(sizes > 1, sizes)
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        own = sa[slots]
        # a suffix that ends within its reach ranks by its entry
        ahead = own + reach
        inside = ahead < len(x)
        second = np.full(len(own), -1, dtype=np.int64)
        second[inside] = rank[ahead[inside]]
        ended = ~inside | (entry_end[own] != entry_end[np.minimum(ahead, len(x) - 1)])
        second[ended] = -entry_end[own[ended]]
        low = np.int64(len(x) + 2)
        joint = (slot_rank[slots] * (2 * low) + second + low).astype(np.uint64)
        again = np.argsort(joint)
        sa[slots] = own[again]
        joint = joint[again]
        fresh = np.ones(len(joint), dtype=bool)
        fresh[1:] = joint[1:] != joint[:-1]
        new[slots] = fresh
        heads = np.flatnonzero(new)
        slot_rank = heads[np.cumsum(new) - 1]
        rank[sa[slots]] = slot_rank[slots]
        reach *= 2
    return sa, rank


def common_prefixes(x: np.ndarray, sa: np.ndarray, rank: np.ndarray, depth: int | None = None) -> np.ndarray:
    """For each suffix in order, how many symbols it shares with the one before it.

    Kasai: from one place to the next the prefix shared with the predecessor
    shrinks by one at most, and by exactly one where the symbols before both are
    the same and were neighbours too. Only the other places are compared, the
    rest count down from them. Symbols are compared eight bytes at a time. With a suffix array of limited ``depth``, a suffix tied with the one
    before it counts as sharing ``depth`` symbols, or all it has left.
    """
    if len(sa) < 2:
        return np.zeros(len(sa), dtype=np.int64)
    before = np.full(len(x), -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    places = np.flatnonzero(x)
    phi = before[places]
    has = phi >= 0
    tied = has & (rank[places] == rank[phi])
    left, far = np.maximum(places - 1, 0), np.maximum(phi - 1, 0)
    chained = has & ~tied & (places > 0) & (phi > 0) & (x[left] == x[far]) & (x[left] != 0) & (before[left] == far)
    chained[1:] &= ~tied[:-1]
    compare = np.flatnonzero(has & ~chained & ~tied)
    # symbols left in the entry from each place on
    zero = np.where(x == 0, np.arange(len(x)), len(x))
    end = np.minimum.accumulate(zero[::-1])[::-1]
    a, b = places[compare], phi[compare]
    room = np.minimum(end[a] - a, end[b] - b)
    words = np.ndarray((len(x),), dtype="<u8", buffer=np.concatenate([x, np.zeros(8, x.dtype)]), strides=(x.itemsize,))
    step, bits = 8 // x.itemsize, 8 * x.itemsize
    found, at, active = np.zeros(len(compare), dtype=np.int64), 0, np.arange(len(compare))
    while len(active):
        apart = words[a[active] + at] ^ words[b[active] + at]
        equal = np.bitwise_count((apart & (~apart + np.uint64(1))) - np.uint64(1)).astype(np.int64) // bits
        found[active] += equal
        at += step
        active = active[(apart == 0) & (room[active] > at)]
    shared = np.zeros(len(places), dtype=np.int64)
    shared[compare] = np.minimum(found, room)
    anchor = np.maximum.accumulate(np.where(chained, 0, np.arange(len(places))))
    shared = np.where(chained, shared[anchor] - (places - places[anchor]), shared)
    shared[tied] = np.minimum(depth or 0, np.minimum(end[places[tied]] - places[tied], end[phi[tied]] - phi[tied]))
    out = np.zeros(len(x), dtype=np.int64)
    out[places] = shared
    return out[sa]
