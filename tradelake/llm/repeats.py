"""Windows of a fixed number of elements that occur more than once in a table of texts.

Shared by the byte and the word operator.  An element is a byte or a word.  Each text is cut into
runs of neighbouring windows that have the same *anchor*, the place of the smallest hash among the
small grams in the first part of the window.  The anchor of a window depends on nothing outside it,
so equal windows have equal anchors at equal distance.  Of each run three things are known: where
its windows start, ``f``, the hash of the elements from its anchor on that are inside all of its
windows, and ``g``, the hash of all its elements.  Then

* a run whose ``f`` occurs once has no repeated window and is dropped at once;
* a run whose ``g`` occurs elsewhere has repeated windows only;
* what is left are the edges of repeats, where runs share ``f`` but not ``g``: of each distinct ``g``
  one run is looked at window by window, or first cut into blocks of windows at equal distances
  from the anchor, which have a longer ``f`` and fall out in the same way.

Texts are identified by two 64-bit hashes; a text that occurs twice has no unique window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import packed, pieces, quoted, stored

#: Bits of the broadcast sieves, in rows of 4 KB: 16 MB, whatever the size of the tables.
SIEVE_BITS = 1 << 27
ROW_BITS = 32768
#: Elements whose hashes are in work at once.
CHUNK = 1 << 18
#: Bytes of text whose runs are looked for at once.
PIECE = 1 << 20
#: Windows of a block.
BLOCK = 8
#: Bits of a composite that hold the place; the rest is hash.
PLACE_BITS = 24


@dataclass(frozen=True)
class Shape:
    """``size``: elements of a window; ``gram``: of a hashed gram; ``reach``: grams an anchor is
    chosen from; ``width``: bytes of an element in the buffer of a text."""

    size: int
    gram: int
    reach: int
    width: int

    @property
    def core(self) -> int:
        """Elements from the anchor on that lie inside every window of its run."""
        return self.size - self.reach + 1


Split = Callable[[bytes], tuple[np.ndarray, bytes]]
"""Gives a text's element hashes, and the buffer whose slices stand for its elements."""


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def anchors(elements: np.ndarray, shape: Shape) -> np.ndarray:
    """For each place a window may start at, the place of its anchor."""
    n = len(elements) - shape.size + 1
    out = np.empty(max(n, 0), np.int64)
    for at in range(0, n, CHUNK):
        part = elements[at : at + CHUNK + shape.size]
        have, hashes = 1, part
        while have < shape.gram:  # doubling: the gram at p and the gram behind it
            step = min(have, shape.gram - have)
            hashes = _mixed(hashes[: len(hashes) - step] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[step:])
            have += step
        place = np.uint64((1 << PLACE_BITS) - 1) - np.arange(len(hashes), dtype=np.uint64)
        low = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | place  # ties: the last
        have = 1
        while have < shape.reach:
            step = min(have, shape.reach - have)
            low = np.minimum(low[: len(low) - step], low[step:])
            have += step
        low = low[: min(CHUNK, n - at)]
        mask = np.uint64((1 << PLACE_BITS) - 1)
        out[at : at + CHUNK] = (mask - (low & mask)).astype(np.int64) + at
    return out


def runs(elements: np.ndarray, sizes: list[int], buffer: bytes, shape: Shape) -> list[np.ndarray]:
    """Runs of several texts, whose elements and buffers stand one behind the other.

    The text's number, first and last window start in it, ``f``, the two halves of ``g`` and how far
    the anchor is from the first window's start.
    """
    starts = np.cumsum([0, *sizes])
    at = anchors(elements, shape)
    step = np.zeros(len(elements) + 1, np.int64)
    for a, n in zip(starts.tolist(), sizes, strict=False):
        if n >= shape.size:
            step[a] += 1
            step[a + n - shape.size + 1] -= 1
    valid = np.flatnonzero(np.cumsum(step))
    if not len(valid):
        return [np.zeros(0, np.int64)] * 7
    anchor = at[valid]
    text = np.searchsorted(starts, valid, "right") - 1
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    where = np.flatnonzero(new)
    first, last = valid[where], valid[np.concatenate((where[1:] - 1, [len(valid) - 1]))]
    w, core, size = shape.width, shape.core * shape.width, shape.size
    view, one, two = memoryview(buffer), xxhash.xxh64_intdigest, xxhash.xxh3_128_digest
    f = [one(view[a : a + core]) for a in (anchor[where] * w).tolist()]
    g = b"".join([two(view[a:b]) for a, b in zip((first * w).tolist(), ((last + size) * w).tolist(), strict=True)])
    halves = np.frombuffer(g, np.int64).reshape(-1, 2)
    text = text[where]
    shown = [first - starts[text], last - starts[text]]
    return [text, *shown, np.array(f, np.uint64).view(np.int64), halves[:, 0], halves[:, 1], anchor[where] - first]


def keys(text: F.Column) -> list[F.Column]:
    """Two hashes that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def scan(docs: DataFrame, split: Split, shape: Shape) -> DataFrame:
    """Per text ``k1, k2, no, n`` (elements) and its runs as arrays; written, so ``no`` is settled."""
    schema = "k1 long, k2 long, n long, s array<int>, t array<int>, f array<long>, g1 array<long>, g2 array<long>, d array<int>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "raw", PIECE):
            parts = [split(x.as_py()) for x in batch.column("raw")]
            sizes = [len(x[0]) for x in parts]
            found = runs(np.concatenate([x[0] for x in parts]), sizes, b"".join(x[1] for x in parts), shape)
            ends = np.concatenate(([0], np.cumsum(np.bincount(found[0], minlength=len(parts)))))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            arrays = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind))
                for x, kind in zip(found[1:], kinds, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), pa.array(sizes, pa.int64()), *arrays],
                names=["k1", "k2", "n", "s", "t", "f", "g1", "g2", "d"],
            )

    texts = docs.where("text IS NOT NULL").select(*keys(F.col("text")), F.col("text").cast("binary").alias("raw"))
    return stored(texts.mapInArrow(run, schema).withColumn("no", F.monotonically_increasing_id()), "runs")


class Sieve:
    """Which values may be in a column: a bit for each hash, in a table of at most 16 MB."""

    def __init__(self, values: DataFrame, *columns: str) -> None:
        place = F.pmod(F.xxhash64(*columns), F.lit(SIEVE_BITS))
        self.rows = stored(
            values.select(place.alias("p"))
            .groupBy(F.floor(F.col("p") / ROW_BITS).cast("int").alias("sieve_row"))
            .agg(F.expr(f"bitmap_construct_agg(p % {ROW_BITS})").alias("sieve_bits")),
            "sieve",
        )

    def marked(self, df: DataFrame, *columns: str) -> DataFrame:
        """``df`` with ``maybe``: false if the values of the columns are surely not held."""
        place = F.pmod(F.xxhash64(*columns), F.lit(SIEVE_BITS))
        rows = df.withColumn("sieve_place", place).withColumn(
            "sieve_row", F.floor(F.col("sieve_place") / ROW_BITS).cast("int")
        )
        byte = F.expr(
            f"cast(conv(hex(substring(sieve_bits, cast(sieve_place % {ROW_BITS} div 8 as int) + 1, 1)), 16, 10) as int)"
        )
        bit = F.expr("shiftright(b, cast(sieve_place % 8 as int)) & 1")
        joined = rows.join(F.broadcast(self.rows), "sieve_row", "left").withColumn("b", F.coalesce(byte, F.lit(0)))
        return joined.withColumn("maybe", bit == 1).drop("sieve_place", "sieve_row", "sieve_bits", "b")


@dataclass
class Repeats:
    """``texts``: ``k1, k2, n, no``; ``runs``: ``no, f, g1, g2, s, t, d``, those whose ``f`` occurs
    again; ``kinds``: ``f, g1, g2, c, kinds, no, s, t, d``, one run of each distinct ``g``, ``c`` runs
    having that ``g`` and ``kinds`` the number of ``g`` of ``f``.  ``d``: from ``s`` to the anchor."""

    texts: DataFrame
    runs: DataFrame
    kinds: DataFrame

    def edges(self) -> DataFrame:
        """Kinds that share ``f`` with another kind."""
        return self.kinds.where("kinds > 1")

    def sure(self) -> DataFrame:
        """``no, s, t`` of the runs that another run equals: all of their windows are repeated."""
        again = self.kinds.where("c > 1").select("f", "g1", "g2")
        return self.runs.join(again, ["f", "g1", "g2"]).select("no", "s", "t")


def find(docs: DataFrame, split: Split, shape: Shape) -> Repeats:
    """Finds the runs of all texts whose core is not unique, and their kinds."""
    table = scan(docs, split, shape)
    twice = table.select(F.explode("f").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    sieve = Sieve(twice, "f")
    zipped = F.inline(F.arrays_zip("f", "g1", "g2", "s", "t", "d"))
    found = sieve.marked(table.select("no", zipped), "f").where("maybe").drop("maybe")
    found = stored(found, "repeated-runs")
    kinds = _kinds(found, F.count(F.lit(1)), "s", "t", "d")
    return Repeats(table.select("k1", "k2", "n", "no"), found, kinds)


def _kinds(runs: DataFrame, count: F.Column, *columns: str) -> DataFrame:
    """One run of each distinct ``g`` whose ``f`` occurs again, with ``c``, the runs that have it, and ``kinds``."""
    kinds = runs.groupBy("f", "g1", "g2").agg(count.alias("c"), F.min(F.struct("no", *columns)).alias("one"))
    kinds = stored(kinds, "run-kinds")
    classes = kinds.groupBy("f").agg(F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("all"))
    kinds = kinds.join(classes.where(F.col("all") > 1), "f")  # the sieve lets some single ones pass
    return stored(kinds.select("f", "g1", "g2", "c", "kinds", "one.no", *(f"one.{x}" for x in columns)), "kinds")


def with_text(docs: DataFrame, texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``raw`` and ``rows`` (a list of structs) for the texts, by ``no``, that have any of ``rows``."""
    columns = [c for c in rows.columns if c != "no"]
    lists = rows.groupBy("no").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    wanted = stored(lists.join(texts.select("no", "k1", "k2"), "no"), "wanted")
    some = docs.where("text IS NOT NULL").select(*keys(F.col("text")), F.col("text").cast("binary").alias("raw"))
    some = Sieve(wanted, "k1", "k2").marked(some, "k1", "k2").where("maybe").drop("maybe")
    return some.dropDuplicates(["k1", "k2"]).join(wanted, ["k1", "k2"]).select("no", "raw", "rows")


def by_blocks(docs: DataFrame, found: Repeats, edges: DataFrame, split: Split, shape: Shape) -> DataFrame:
    """Repeated windows ``no, s, t`` of the edges, next to each other from ``s`` to ``t``.

    A run is cut where the distance to its anchor is a multiple of BLOCK.  Equal windows are in blocks
    of the same distances, so blocks are dropped, or known to be repeated, by the same two hashes as
    runs; what lies inside all windows of a block is longer.  Only blocks that share it with a
    different one are looked at window by window.
    """
    w = shape.width

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = xxhash.xxh64_intdigest, xxhash.xxh3_128_digest
        for batch in pieces(batches, "raw", PIECE):
            no, s, t, f, g, c = [], [], [], [], [], []
            for number, raw, rows in zip(*(batch.column(x) for x in ("no", "raw", "rows")), strict=True):
                _, buffer = split(raw.as_py())
                view = memoryview(buffer)
                for r in rows.as_py():
                    anchor = r["s"] + r["d"]
                    first = r["s"]
                    while first <= r["t"]:
                        # the block's last window, if the run goes on that far
                        end = anchor - (anchor - first) // BLOCK * BLOCK
                        last = min(end, r["t"])
                        core = view[end * w : (end - BLOCK + 1 + shape.size) * w]
                        no.append(number.as_py())
                        s.append(first)
                        t.append(last)
                        f.append(one(core))
                        g.append(two(view[first * w : (last + shape.size) * w]))
                        c.append(min(r["c"], 2))
                        first = last + 1
            halves = np.frombuffer(b"".join(g), np.int64).reshape(-1, 2)
            arrays = [pa.array(no, pa.int64()), pa.array(s, pa.int32()), pa.array(t, pa.int32())]
            arrays += [pa.array(np.array(f, np.uint64).view(np.int64)), *(pa.array(x.copy()) for x in halves.T)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(c, pa.int32())], names=["no", "s", "t", "f", "g1", "g2", "c"]
            )

    texts = with_text(docs, found.texts, edges.select("no", "s", "t", "d", "c"))
    schema = "no long, s int, t int, f long, g1 long, g2 long, c int"
    blocks = stored(texts.mapInArrow(run, schema), "blocks")
    kinds = _kinds(blocks, F.sum("c"), "s", "t")
    again = kinds.where("c > 1").select("f", "g1", "g2")
    # blocks of runs that several texts have need no answer
    sure = blocks.where("c = 1").join(again, ["f", "g1", "g2"]).select("no", "s", "t")
    open_ = by_ranks(docs, found, kinds.where("kinds > 1"), split, shape)
    return stored(sure.union(open_.select("no", F.col("i").alias("s"), F.col("i").alias("t"))), "edge-windows")


def by_ranks(docs: DataFrame, found: Repeats, edges: DataFrame, split: Split, shape: Shape) -> DataFrame:
    """Repeated windows ``no, i`` of the edges by their rank pairs.

    The rank of half a window is the name its content has, a 64-bit hash, so that the rank at
    half a window's distance is at hand without a lookup; Spark groups the pairs of ranks of a
    window's two halves, and pairs that occur once fall out.  Windows of a run that several runs
    equal count twice and need no answer.
    """
    half, w = shape.size // 2, shape.width

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = xxhash.xxh64_intdigest
        for batch in pieces(batches, "raw"):
            for no, raw, rows in zip(*(batch.column(c) for c in ("no", "raw", "rows")), strict=True):
                _, buffer = split(raw.as_py())
                view = memoryview(buffer)
                for r in rows.as_py():
                    s, t = r["s"], r["t"]
                    head = [one(view[i * w : (i + half) * w]) for i in range(s, t + 1)]
                    tail = [one(view[(i + half) * w : (i + shape.size) * w]) for i in range(s, t + 1)]
                    n = t - s + 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(head, np.uint64).view(np.int64)),
                            pa.array(np.array(tail, np.uint64).view(np.int64)),
                            pa.array([no.as_py()] * n, pa.int64()),
                            pa.array(range(s, t + 1), pa.int32()),
                            pa.array([min(r["c"], 2)] * n, pa.int32()),
                        ],
                        names=["h1", "h2", "no", "i", "c"],
                    )

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in run(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= 1 << 16:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    texts = with_text(docs, found.texts, edges.select("no", "s", "t", "c"))
    pairs = stored(texts.mapInArrow(joined, "h1 long, h2 long, no long, i int, c int"), "rank-pairs")
    again = pairs.groupBy("h1", "h2").agg(F.sum("c").alias("n")).where("n > 1").select("h1", "h2")
    again = stored(again, "equal-ranks")
    open_ = Sieve(again, "h1", "h2").marked(pairs.where("c = 1"), "h1", "h2").where("maybe")
    return open_.join(again, ["h1", "h2"]).select("no", "i")


def spans(found: Repeats, windows: DataFrame, shape: Shape) -> DataFrame:
    """Per text with repeats ``k1, k2`` and ``spans``: sorted, apart, [start, end) in elements.

    ``windows`` has ``no, s, t``: first and last start of all repeated windows next to each other.
    """
    schema = "no long, spans array<struct<start:long,end:long>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rows in batch.column("rows"):
                merged: list[list[int]] = []
                for a, b in sorted((r["s"], r["t"] + shape.size) for r in rows.as_py()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                out.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays([batch.column("no"), pa.array(out, kind)], names=["no", "spans"])

    # copies of a text have no unique window; the rest goes by its runs
    texts = found.texts
    copies = (
        texts.groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"))
        .where((F.col("m") > 1) & (F.col("n") >= shape.size))
    )
    copies = stored(copies.select("k1", "k2", "n"), "copies")
    single = texts.join(copies.select("k1", "k2"), ["k1", "k2"], "left_anti").select("no", "k1", "k2")
    merged = windows.groupBy("no").agg(F.collect_list(F.struct("s", "t")).alias("rows")).mapInArrow(run, schema)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))).alias("spans")
    return stored(
        single.join(merged, "no").select("k1", "k2", "spans").union(copies.select("k1", "k2", whole)), "spans"
    )


def cut(
    docs: DataFrame,
    spans: DataFrame,
    text_col: str,
    remove: Callable[[bytes, list[tuple[int, int]]], tuple[bytes, int]],
) -> DataFrame:
    """All rows with ``kept`` (binary), ``n`` (elements) and ``spans`` in place of such columns.

    ``remove`` gives what is left of a text and its elements.  Only texts that may have spans are
    shuffled, to meet them.  A null text is empty.
    """
    text = quoted(text_col)
    rows = docs.select(packed(docs, ["kept", "n", "spans"]), text.alias("text"), *keys(text))
    marked = Sieve(spans, "k1", "k2").marked(rows, "k1", "k2")
    none = F.array().cast("array<struct<start:long,end:long>>")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    clean = marked.where("NOT maybe").select("_row", raw, none.alias("spans"))
    hit = marked.where("maybe").join(spans, ["k1", "k2"], "left")
    hit = hit.select("_row", raw, F.coalesce("spans", none).alias("spans"))
    schema = T.StructType(
        [
            clean.schema["_row"],
            T.StructField("kept", T.BinaryType()),
            T.StructField("n", T.LongType()),
            T.StructField("spans", T.ArrayType(SPAN)),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "raw"):
            out = [
                remove(raw.as_py(), [(x["start"], x["end"]) for x in found.as_py()])
                for raw, found in zip(batch.column("raw"), batch.column("spans"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    pa.array([x[0] for x in out], pa.binary()),
                    pa.array([x[1] for x in out], pa.int64()),
                    batch.column("spans"),
                ],
                names=["_row", "kept", "n", "spans"],
            )

    return clean.union(hit).mapInArrow(run, schema).select("_row.*", "kept", "n", "spans")


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
