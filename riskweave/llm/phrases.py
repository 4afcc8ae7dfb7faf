"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: each word with the three that follow it
in its piece (lead columns), padded at the end of the piece. Counts of shorter
phrases are sums of those of the windows that begin with them, and Spark's
ROLLUP makes them all at once; no phrase length is exploded by itself.

Windows are counted in batches of about two million words and leave a task in
rows of one bucket each: their words once, joined, and windows as indices into
them. All windows that begin with the same two words share a bucket, so totals
of their prefixes are known there. A window whose tail is too rare to be in any
phrase (fewer than ``least`` occurrences of the prefix that holds it) is cut
before it and added to the shorter window. ROLLUP therefore sums few rows, and
no sum changes that is ``least`` or more.

Beginnings that hold a large share of all windows (found in a sample, which
decides nothing else) are spread by their third or fourth word; they are never
cut, so their totals need not meet in one bucket.

Defined cases: a null or empty text has no words; a null language is `und`;
repeated rows count each; a very long text is a batch of its own; an empty
table gives no rows; columns other than lang and text are ignored.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.fitting import fit_in_task
from riskweave.llm.tokens import mixed, slices, text_bytes
from riskweave.session import materialize

LEAST, TOP, CONTAINED = 30, 2000, (80, 100)
ORDER = 4
BATCH_WORDS = 2 << 20
BUCKET_BYTES = 8 << 20
SAMPLE_BYTES = 8 << 20
#: A byte that no text holds marks the end of a piece.
END = b"\xff"
_TABLE = bytearray(bytes(range(256)).lower())
for _separator in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_separator] = END[0]
_TABLE = bytes(_TABLE)

COLUMNS = [f"w{i}" for i in range(1, ORDER + 1)]
#: Windows of one row: they have at most 32 768 different words, so an index is two bytes.
ROW_WINDOWS = 8000
MESSAGE = f"lang string, bucket int, words string, {', '.join(f'{c} array<smallint>' for c in COLUMNS)}, n array<int>"
COUNTED = f"lang string, {', '.join(f'{c} string' for c in COLUMNS)}, n long"


def pieces(texts: list[bytes]) -> list[bytes]:
    """The words of all texts in order, END after each piece."""
    return END.join([*texts, b""]).translate(_TABLE).replace(END, b" " + END + b" ").split()


class _Windows:
    """The words of one language within a batch, as codes."""

    def __init__(self):
        self.seen = {END: 0}
        self.codes: list[np.ndarray] = []
        self.size = 1

    def add(self, texts: list[bytes]) -> int:
        words = pieces(texts)
        self.codes.append(np.fromiter(map(self.seen.setdefault, words, itertools.count(self.size)), np.int64, len(words)))
        self.size += len(words)
        return len(words)

    def counted(self) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
        """Words, the window columns as indices into them (0 pads) and the counts of distinct windows."""
        first = np.fromiter(self.seen.values(), np.int64, len(self.seen))  # rising
        code = np.searchsorted(first, np.concatenate([*self.codes, np.zeros(ORDER - 1, np.int64)]))
        columns = [code[: len(code) - ORDER + 1]]
        for i in range(1, ORDER):  # the lead columns
            columns.append(np.where(columns[-1] == 0, 0, code[i : len(code) - ORDER + 1 + i]))
        begins = columns[0] != 0
        columns = [c[begins] for c in columns]
        size = len(self.seen)
        heads, head = np.unique(columns[0] * size + columns[1], return_inverse=True)
        tails, tail = np.unique(columns[2] * size + columns[3], return_inverse=True)
        windows, n = np.unique(head * max(1, len(tails)) + tail, return_counts=True)
        head, tail = heads[windows // max(1, len(tails))], tails[windows % max(1, len(tails))]
        return list(self.seen), [head // size, head % size, tail // size, tail % size], n


def _hot_codes(hot: set, words: dict, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings of two and of three words whose words all occur, as numbers."""
    known = [tuple(words[w] for w in phrase) for phrase in hot if all(w in words for w in phrase)]
    two = np.array(sorted(p[0] * size + p[1] for p in known if len(p) == 2), dtype=np.int64)
    three = np.array(sorted((p[0] * size + p[1]) * size + p[2] for p in known if len(p) == 3), dtype=np.int64)
    return two, three


def _messages(lang: str, windows: _Windows, buckets: int, hot: set) -> pa.RecordBatch | None:
    """Rows of each bucket with the windows that belong there."""
    words, columns, n = windows.counted()
    if not len(n):
        return None
    size = len(words)
    hashed = mixed(np.array([zlib.crc32(w) for w in words], dtype=np.uint64) + np.uint64(zlib.crc32(lang.encode()) << 32))
    two, three = _hot_codes(hot, dict(zip(words, range(size), strict=True)), size)
    begin = columns[0] * size + columns[1]
    key = hashed[columns[0]] * np.uint64(3) + hashed[columns[1]]
    for codes, column in ((two, 2), (three, 3)):
        spread = np.isin(begin, codes)
        key[spread] = key[spread] * np.uint64(5) + hashed[columns[column][spread]]
        begin = begin * size + columns[2]
    bucket = (mixed(key) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, n, columns = bucket[order], n[order], [c[order] for c in columns]
    place = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
    _, first, sizes = np.unique((bucket << 32) + place // ROW_WINDOWS, return_index=True, return_counts=True)
    present = bucket[first]
    row = np.repeat(np.arange(len(present)), sizes)
    own, index = np.unique(np.concatenate([row * size + c for c in columns]), return_inverse=True)
    starts = np.searchsorted(own, np.arange(len(present) + 1) * size)
    index = index.reshape(ORDER, -1) - starts[row][None, :]
    texts, own, bounds = [b"", *words[1:]], (own % size).tolist(), starts.tolist()
    listed = [b" ".join(map(texts.__getitem__, own[a:b])) for a, b in zip(bounds, bounds[1:])]  # no word holds a space
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    numbers = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int16))) for x in index]
    numbers.append(pa.ListArray.from_arrays(ends, pa.array(n, pa.int32())))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(present)), pa.array(present, pa.int32()), pa.array(listed, pa.binary()).cast(pa.string()), *numbers],
        names=["lang", "bucket", "words", *COLUMNS, "n"],
    )


def _texts_by_lang(batch: pa.RecordBatch):
    """(language, texts) of slices of a batch."""
    data, offsets = text_bytes(batch.column("text"))
    langs = batch.column("lang").to_pylist()
    for a, b in slices(offsets):
        texts: dict[str, list[bytes]] = {}
        for i in range(a, b):
            texts.setdefault(langs[i], []).append(data[offsets[i] : offsets[i + 1]].tobytes())
        yield from texts.items()


def _count_windows(buckets: int, hot: dict[str, set], batch_words: int):
    def run(batches):
        open_, held = {}, 0

        def close():
            made = (_messages(lang, w, buckets, hot.get(lang, set())) for lang, w in open_.items())
            yield from (m for m in made if m is not None)

        for batch in batches:
            for lang, texts in _texts_by_lang(batch):
                held += open_.setdefault(lang, _Windows()).add(texts)
                if held >= batch_words:
                    yield from close()
                    open_, held = {}, 0
        yield from close()

    return run


def _shortened(hot: dict[str, set], least: int):
    """Windows of a bucket, without tails that are too rare."""

    def cut(table: pa.Table) -> pa.Table:
        lang = table["lang"][0].as_py()
        lists = pc.split_pattern(table["words"].combine_chunks(), " ")
        words = pa.concat_arrays([lists.flatten(), pa.array([""])]).dictionary_encode()
        base = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)) - lists.value_lengths().to_numpy(zero_copy_only=False)
        counts = table["n"].combine_chunks()
        shift = np.repeat(base, counts.value_lengths().to_numpy(zero_copy_only=False))
        code, listed = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
        columns = [code[table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) + shift] for c in COLUMNS]
        n, size = counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64), len(listed)
        known = dict(zip((w.encode() for w in listed.to_pylist()), range(size), strict=True))
        pad = known[b""]
        two, three = _hot_codes(hot.get(lang, set()), known, size)
        head, tail = columns[0] * size + columns[1], columns[2] * size + columns[3]
        order = np.lexsort((tail, head))
        head, tail, n = head[order], tail[order], n[order]
        kept = []

        def merged(n: np.ndarray, *keys: np.ndarray) -> tuple:
            """Sums over equal neighbours."""
            if not len(n):
                return (n, *keys)
            new = np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
            at = np.flatnonzero(new)
            return (np.add.reduceat(n, at), *[k[at] for k in keys])

        def keep(rows, n, head, third, fourth):
            kept.append((n[rows], head[rows], third[rows], fourth[rows]))

        # whole windows; then beginnings of three, two and one word with what is left of them
        n, head, tail = merged(n, head, tail)
        third, fourth = tail // size, tail % size
        long = (fourth != pad) & (n >= least)
        keep(long, n, head, third, fourth)
        total, head3, third3 = merged(n, head, third)
        rest = merged(np.where(long, 0, n), head, third)[0]
        often = (third3 != pad) & ((total >= least) | np.isin(head3 * size + third3, three))
        keep(often & (rest > 0), rest, head3, third3, np.full(len(rest), pad))
        total, head2 = merged(total, head3)
        rest = merged(np.where(often, 0, rest), head3)[0]
        often = (head2 % size != pad) & ((total >= least) | np.isin(head2, two))
        keep(often & (rest > 0), rest, head2, np.full(len(rest), pad), np.full(len(rest), pad))
        rest, first = merged(np.where(often, 0, rest), head2 // size)
        blank = np.full(len(rest), pad)
        keep(rest > 0, rest, first * size + blank, blank, blank)
        n, head, third, fourth = (np.concatenate(x) for x in zip(*kept, strict=True))
        taken = [listed.take(pa.array(c)) for c in (head // size, head % size, third, fourth)]
        return pa.table({"lang": pa.array([lang] * len(n), pa.string()), **dict(zip(COLUMNS, taken, strict=True)), "n": n})

    return cut


def _frequent_beginnings(texts: DataFrame, fraction: float, buckets: int, least: int) -> dict[str, set]:
    """Beginnings of two and three words that fill much of a bucket, by language.

    From a sample of bounded size; at most one of ``least`` sample words makes one.
    """

    def count(batches):
        seen, words = Counter(), 0
        for lang, texts_ in itertools.chain.from_iterable(map(_texts_by_lang, batches)):
            w = pieces(texts_)
            words += len(w)
            for k in (2, 3):
                seen.update((lang, p) for p in zip(*(w[i:] for i in range(k)), strict=False) if END not in p)
            if words >= SAMPLE_BYTES // 4:
                break
        hot: dict[str, set] = {}
        for (lang, phrase), n in seen.items():
            if n >= max(least, 2 * words / buckets):
                hot.setdefault(lang, set()).add(phrase)
        return hot

    return fit_in_task(texts.sample(fraction, 7), count)


def phrase_counts(docs: DataFrame, least: int = LEAST, bucket_bytes: int = BUCKET_BYTES, batch_words: int = BATCH_WORDS) -> DataFrame:
    """lang, words, phrase, f: every phrase of 1 to ``ORDER`` words that occurs
    ``least`` times in its language, and one row with no words for all of them."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    hot = _frequent_beginnings(texts, min(1.0, SAMPLE_BYTES / total), buckets, least) if buckets > 1 else {}
    messages = texts.mapInArrow(_count_windows(buckets, hot, batch_words), MESSAGE)
    cut = messages.repartition(buckets, "lang", "bucket").groupBy("lang", "bucket").applyInArrow(_shortened(hot, least), COUNTED)
    windows = cut.groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))
    rolled = windows.rollup("lang", *COLUMNS).agg(F.sum("n").alias("f"), F.grouping_id().alias("away"))
    # grouping_id has one bit for each column that is summed away
    words = sum(((F.col("away") < 2**i).cast("int") for i in range(ORDER)), F.lit(0))
    rolled = rolled.where(F.col("away") < 2 ** (ORDER + 1) - 1).select("lang", *COLUMNS, "f", words.alias("words"))
    last = F.get(F.array(*COLUMNS), F.col("words") - 1)
    wanted = (F.col("words") == 0) | ((last != "") & (F.col("f") >= least))
    return rolled.where(wanted).select("lang", "words", F.concat_ws(" ", *COLUMNS).alias("phrase"), "f")


def _parts(phrase: Column, first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, length), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **sizes) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    Candidates are phrases of 2 to ``ORDER`` words with ``a`` occurrences; the
    score is that of their weakest cut. Those that a longer candidate holds
    nearly as often are left out.
    """
    counts = materialize(phrase_counts(docs, least, **sizes), "phrase-counts")
    known = counts.where("words > 0").select("lang", "phrase", "f")
    candidates = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cut = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(
            k.alias("k"), _parts(F.col("phrase"), F.lit(1), k).alias("head"), _parts(F.col("phrase"), k + 1, F.col("words") - k).alias("tail")
        ),
    )
    cuts = candidates.select("lang", "phrase", "a", F.inline(cut))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    score = F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))
    # stretches of each longer candidate
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: _parts(F.col("phrase"), i, m)),
        )
    )
    longer = candidates.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    share, whole = CONTAINED
    held = F.expr(f"cast(held as decimal(19, 0)) * {whole} >= cast(a as decimal(19, 0)) * {share}")
    free = weakest.join(longer, ["lang", "phrase"], "left").where(F.col("held").isNull() | ~held).select("lang", "phrase", "a", "x.score", "x.l", "x.r")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language is first ranked in parts, so that no task orders all its phrases
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = free.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    all_words = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(all_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
