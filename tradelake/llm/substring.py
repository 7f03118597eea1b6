"""Removal of word sequences that occur more than once, by a compressed FM-index per shard."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import repeats
from tradelake.llm.common import pieces, quoted, stored

#: Words of a sequence that must occur once only.
LENGTH = 35
SHAPE = repeats.Shape(size=LENGTH, gram=4, reach=24, width=8)
#: Words that a shard's index holds, about.
SHARD_WORDS = 300_000
#: Different runs with one core from which on the core is no matter for a single shard.
HOT = 2000


def split(raw: bytes) -> tuple[np.ndarray, bytes]:
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in raw.split()], np.uint64)
    return hashes, hashes.tobytes()


def remove(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    words, kept, at = raw.split(), [], 0
    for a, b in spans:
        kept += words[at:a]
        at = b
    return b" ".join(kept + words[at:]), len(words)


class Bits:
    """A bit vector that counts its ones: 64-bit words and the ones before each of them."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class Index:
    """FM-index of a sequence of symbols: a wavelet tree, levels as bit vectors, over its BWT."""

    def __init__(self, symbols: np.ndarray, longest: int) -> None:
        """``longest``: symbols of the longest pattern; suffixes are sorted by as many."""
        n = len(symbols)
        self.size = n
        rank, have = symbols.astype(np.int64), 1
        while True:
            behind = np.zeros(n, np.int64)
            behind[: max(0, n - have)] = rank[have:] + 1
            key = rank * (n + 2) + behind
            order = np.argsort(key, kind="stable")
            new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
            rank = np.empty(n, np.int64)
            rank[order] = new
            have *= 2
            if have >= longest or new[-1] == n - 1:
                break
        last = symbols[order - 1]
        self.kinds = int(symbols.max()) + 1
        self.depth = max(1, int(self.kinds - 1).bit_length())
        self.start = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=self.kinds))))
        self.levels: list[tuple[Bits, int]] = []
        for level in reversed(range(self.depth)):
            bits = (last >> level) & 1
            self.levels.append((Bits(bits.astype(np.uint8)), int(n - bits.sum())))
            last = np.concatenate((last[bits == 0], last[bits == 1]))
        every = np.arange(self.kinds)
        self.base = self._down(every, np.zeros(self.kinds, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - k)) & 1
            rank = bits.rank(at)
            at = np.where(one == 1, zeros + rank, at - rank)
        return at

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put in front."""
        both = self._down(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        both += np.tile(self.start[symbol] - self.base[symbol], 2)
        return both[: len(symbol)], both[len(symbol) :]


def repeated_windows(index: Index, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """Which windows of each pattern occur twice in the index: one row a pattern, one column a start.

    All patterns search backward side by side.  A search from a window's end that fails shows that
    no window with the failing stretch repeats, so the next window starts behind its first symbol.
    Once a window repeats, the stretch from it to the pattern's end is tried as a whole.
    """
    found = np.zeros((len(starts), int(sizes.max()) - length + 1), bool)
    lanes = np.arange(len(starts))
    last = sizes - length  # last start of interest
    start = np.zeros(len(starts), np.int64)
    whole, tried = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    at = start + length
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), index.size)
    while len(lanes):
        symbol = symbols[starts[lanes] + at[lanes] - 1]
        new_low, new_high = index.step(symbol, low[lanes], high[lanes])
        goes_on = new_high - new_low >= 2
        ok = lanes[goes_on]
        at[ok] -= 1
        low[ok], high[ok] = new_low[goes_on], new_high[goes_on]
        done = ok[at[ok] == start[ok]]
        failed = lanes[~goes_on]
        # reached the start: of one window, or of all from it on
        all_of = done[whole[done]]
        for i in all_of:
            found[i, start[i] : last[i] + 1] = True
        start[all_of] = last[all_of] + 1
        one = done[~whole[done]]
        found[one, start[one]] = True
        jump = one[~tried[one] & (start[one] < last[one])]
        step = one[tried[one] | (start[one] >= last[one])]
        start[step] += 1
        whole[jump] = tried[jump] = True
        # failed: a window's search, or that of the whole rest
        single = failed[~whole[failed]]
        start[single] = at[single]
        rest = failed[whole[failed]]
        for i in rest:
            found[i, at[i] : last[i] + 1] = True
        last[rest] = np.minimum(last[rest] - 1, at[rest] - 1)
        start[rest] += 1
        whole[rest] = False
        fresh = np.concatenate((all_of, jump, step, failed))
        at[fresh] = np.where(whole[fresh], sizes[fresh], start[fresh] + length)
        low[fresh], high[fresh] = 0, index.size
        lanes = lanes[start[lanes] <= last[lanes]]
    return found


def _search_shard(rows: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    """``rows``: (f, g1, g2, c, words); ranges of the windows of each that the shard has twice."""
    names: dict[bytes, int] = {}
    parts, starts, sizes, at = [], [], [], 0
    for *_, c, line in rows:
        own = np.array([names.setdefault(w, len(names) + 1) for w in line.split(b" ")], np.int64)
        starts.append(at)
        sizes.append(len(own))
        for _ in range(min(c, 2)):  # a run that others equal is there twice
            parts += [own, np.zeros(1, np.int64)]
            at += len(own) + 1
    if not rows:
        return
    symbols = np.concatenate(parts)
    index = Index(symbols, max(sizes) + 1)
    found = repeated_windows(index, symbols, np.array(starts, np.int64), np.array(sizes, np.int64), length)
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    lane, first = np.nonzero(edge == 1)
    _, behind = np.nonzero(edge == -1)
    keys = [np.array([r[k] for r in rows], np.int64)[lane] for k in range(3)]
    yield pa.RecordBatch.from_arrays(
        [*map(pa.array, keys), pa.array(first.astype(np.int32)), pa.array((behind - 1).astype(np.int32))],
        names=["f", "g1", "g2", "a", "b"],
    )


def by_index(docs: DataFrame, found: repeats.Repeats, kinds: DataFrame, shards: int) -> DataFrame:
    """Repeated windows ``no, s, t`` of all runs of the kinds, by backward search in their shard.

    Kinds with the same core go to the same shard, so all occurrences of a window meet there.
    """
    size = SHAPE.size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "raw"):
            for raw, rows in zip(batch.column("raw"), batch.column("rows"), strict=True):
                words = raw.as_py().split()
                out = [
                    {**{k: r[k] for k in ("f", "g1", "g2", "c")}, "line": b" ".join(words[r["s"] : r["t"] + size])}
                    for r in rows.as_py()
                ]
                yield pa.RecordBatch.from_pylist(out, schema=SEGMENT)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in SEGMENT.names), strict=True)]
        yield from _search_shard(rows, size)

    texts = repeats.with_text(docs, found.texts, kinds.select("no", "s", "t", "f", "g1", "g2", "c"))
    segments = texts.mapInArrow(run, "f long, g1 long, g2 long, c long, line binary")
    ranges = segments.repartition(shards, "f").mapInArrow(search, "f long, g1 long, g2 long, a int, b int")
    ranges = stored(ranges, "index-ranges")
    return found.runs.join(ranges, ["f", "g1", "g2"]).select(
        "no", (F.col("s") + F.col("a")).alias("s"), (F.col("s") + F.col("b")).alias("t")
    )


SEGMENT = pa.schema(
    [("f", pa.int64()), ("g1", pa.int64()), ("g2", pa.int64()), ("c", pa.int64()), ("line", pa.binary())]
)


def deduplicate(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``kept`` (words joined by blanks, bytes), ``n`` (words before) and
    ``spans`` removed, as [first, end) word numbers.

    Removed is every word inside a sequence of LENGTH words that starts anywhere else too, in the
    same text or another; sequences are judged on the texts as they came.  Words are what blanks
    (space, tab to carriage return) separate, unchanged.

    Runs of windows whose core occurs once are left out by hash (see ``repeats``), equal runs are
    counted once.  The others are dealt to shards by core, about SHARD_WORDS words each.  A shard
    indexes its distinct runs and searches all of them backward; what it reports holds for all runs
    of a kind.  A core with more than HOT different runs would fill a shard by itself; its windows
    are told apart by their rank pairs instead, which Spark counts before the shuffle.

    Null texts have no words.  They and texts under LENGTH words lose nothing but blanks.  Of
    repeated rows all copies lose what they share, which is everything from LENGTH words on.
    Columns ``kept``, ``n`` and ``spans`` of the input give way, others stay.  An empty table gives
    no rows.
    """
    texts = docs.select(quoted(text_col).cast("string").alias("text"))
    found = repeats.find(texts, split, SHAPE)
    cool = F.col("kinds") <= HOT
    words, hot_rows = found.kinds.agg(
        F.sum(F.when(cool, (F.col("t") - F.col("s") + LENGTH) * F.least("c", F.lit(2)))), F.count_if(~cool)
    ).first()
    windows = by_index(texts, found, found.kinds.where(cool), max(1, -(-(words or 0) // SHARD_WORDS)))
    if hot_rows:
        hot = repeats.Repeats(found.texts, found.runs, found.kinds.where(~cool))
        single = repeats.by_ranks(texts, hot, hot.edges(), split, SHAPE)
        windows = windows.union(single.select("no", F.col("i").alias("s"), F.col("i").alias("t"))).union(hot.sure())
    spans = repeats.spans(found, windows, SHAPE)
    return repeats.cut(docs, spans, text_col, remove)
