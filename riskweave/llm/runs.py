"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) and at least ``max(LEAST_WORDS, LEAST_COPIES * q)`` words that no
neighbouring word extends keeping that period.

Each word of a run occurs in it at least ``LEAST_COPIES`` times. So a word that
is rarer than that within its segment is in no run there, and the segment is
split at it; counts fall in the parts, which are split again until nothing
changes. Only surviving segments are scanned by lag: a run of period q covers
three multiples of q in a row at which the word equals the one q further on, so
lag q is tried at every q-th word only. What passes is extended word by word.

Documents are independent, so nothing is shuffled: rows are read in Arrow
batches and worked off in slices of about a megabyte of text.

Defined cases: a null or empty text, or one of white space, has no words, no
runs and an empty collapsed text; a very long text is a slice of its own and
its lags are tried in blocks of bounded size; repeated rows each keep their
result; a null doc_id is kept; columns other than doc_id and text are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tokens import slices, text_bytes

LEAST_WORDS, LEAST_COPIES = 6, 4
#: Samples that a block of lags may hold.
BLOCK = 1 << 18


def surviving_segments(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the segments in which every word occurs often enough.

    ``bounds`` are the borders of the documents; a code is one word of one
    document. All documents are split in the same round; a segment without a
    rare word is set aside and not counted again.
    """
    begins, ends = bounds[:-1], bounds[1:]
    stable = [(begins[:0], ends[:0])]
    while True:
        long = ends - begins >= LEAST_WORDS
        begins, ends = begins[long], ends[long]
        if not len(begins):
            break
        lengths = ends - begins
        first = np.cumsum(lengths) - lengths
        segment = np.repeat(np.arange(len(begins)), lengths)
        at = np.arange(int(lengths.sum())) + np.repeat(begins - first, lengths)
        _, word, counts = np.unique((segment << 32) | codes[at], return_inverse=True, return_counts=True)
        rare = counts[word] < LEAST_COPIES
        broken = np.logical_or.reduceat(rare, first)
        stable.append((begins[~broken], ends[~broken]))
        live = ~rare & broken[segment]
        joined = np.concatenate([[False], live[1:] & live[:-1] & (segment[1:] == segment[:-1])])
        opens = np.flatnonzero(live & ~joined)
        closes = np.flatnonzero(live & ~np.append(joined[1:], False))
        begins, ends = at[opens], at[closes] + 1
    begins, ends = (np.concatenate(x) for x in zip(*stable, strict=True))
    order = np.argsort(begins, kind="stable")
    return begins[order], ends[order]


def _stretch(w: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest range around ``at`` whose words equal those ``lag`` further on."""
    end, step, last = at, 64, len(w) - lag
    while end < last:
        stop = min(end + step, last)
        differs = w[end:stop] != w[end + lag : stop + lag]
        if differs.any():
            end += int(differs.argmax())
            break
        end, step = stop, step * 2
    begin, step = at, 64
    while begin > 0:
        stop = max(begin - step, 0)
        differs = w[stop:begin] != w[stop + lag : begin + lag]
        if differs.any():
            begin -= int(differs[::-1].argmax())
            break
        begin, step = stop, step * 2
    return begin, end


def _lag_blocks(words: int):
    """Ranges of lags, each at most twice its first, of bounded sample number."""
    first, last = 1, words // LEAST_COPIES
    while first <= last:
        stop = min(last + 1, 2 * first, first + max(1, BLOCK // max(1, (words - 1) // first)))
        yield first, stop
        first = stop


def lag_scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a segment, by start, then period.

    Lags are tried from small to large. What lies inside a run of a smaller
    period has a multiple of that period (two periods of a stretch that holds
    their sum are multiples of a common one), so it is passed over.
    """
    runs = []
    reach = np.zeros(len(w) + 1, dtype=np.int64)  # how far a run that covers the word goes
    for first, stop in _lag_blocks(len(w)):
        lags = np.arange(first, stop)
        samples = (len(w) - 1) // lags
        lag = np.repeat(lags, samples)
        at = (np.arange(len(lag)) - np.repeat(np.cumsum(samples) - samples, samples)) * lag
        same = w[at] == w[at + lag]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:] & (lag[:-2] == lag[2:]))
        hits = hits[reach[at[hits]] <= at[hits] + 3 * lag[hits]]
        seen = (0, 0)  # lag and end of the last stretch tried
        for q, i in zip(lag[hits].tolist(), at[hits].tolist(), strict=True):
            if (q == seen[0] and i < seen[1]) or reach[i] > i + 3 * q:
                continue
            begin, end = _stretch(w, i, q)
            seen, end = (q, end), end + q
            if end - begin >= max(LEAST_WORDS, LEAST_COPIES * q) and reach[begin] < end:
                runs.append((begin, end - begin, q))
                np.maximum(reach[begin:end], end, out=reach[begin:end])
    runs.sort(key=lambda r: (r[0], r[2]))
    return runs


def runs_of_texts(texts: list[bytes]) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """The words and the runs of each text."""
    words = [t.split() for t in texts]  # of bytes: at the six ASCII white spaces only
    counts = np.array([len(w) for w in words], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    codes = np.empty(int(bounds[-1]), dtype=np.int64)
    for w, a, b in zip(words, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        codes[a:b] = np.fromiter(map({}.setdefault, w, itertools.count(a)), np.int64, b - a)
    found: list[list] = [[] for _ in texts]
    begins, ends = surviving_segments(codes, bounds)
    owner = np.searchsorted(bounds, begins, side="right") - 1
    for a, b, i in zip(begins.tolist(), ends.tolist(), owner.tolist(), strict=True):
        shift = a - int(bounds[i])
        found[i] += [(s + shift, n, q) for s, n, q in lag_scan(codes[a:b])]
    return words, found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that any run repeats."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join(itertools.compress(words, keep.tolist()))


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period),
    collapsed (the text without repeated periods): one row per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in slices(offsets):
                texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(a, b)]
                words, found = runs_of_texts(texts)
                flat = np.array([r for runs in found for r in runs], dtype=np.int64).reshape(-1, 3)
                ends = np.concatenate([[0], np.cumsum([len(runs) for runs in found])])
                fields = [pa.array(flat[:, c]) for c in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(RUN))),
                        pa.array([collapsed(w, r) for w, r in zip(words, found, strict=True)], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    schema = f"doc_id {kind}, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; the first of equal ones, null if there is none."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)
