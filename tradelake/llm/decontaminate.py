"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import packed, pieces, quoted, stored

WINDOW = 13
#: Share of a text's words from which hits make it contaminated, as 1 / this.
WORDS_PER_HIT = 20
#: Bytes of item text that go into one automaton.
BLOCK_BYTES = 4 << 20

#: A-Z lowered; ASCII other than digits and letters becomes a blank; bytes of other letters stay.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

SPAN_TYPE = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
#: What a scan adds: words, runs of hit words, the same in characters, items.
FOUND = [
    T.StructField("_n_words", T.LongType()),
    T.StructField("_runs", T.ArrayType(SPAN_TYPE)),
    T.StructField("_spans", T.ArrayType(SPAN_TYPE)),
    T.StructField("_items", T.ArrayType(T.StringType())),
]


def words(raw: bytes) -> list[bytes]:
    return raw.translate(NORMAL).split()


def windows(raw: bytes, size: int) -> list[bytes]:
    """The item's windows, each between blanks."""
    w = words(raw)
    return [b" " + b" ".join(w[i : i + size]) + b" " for i in range(max(1, len(w) - size + 1))] if w else []


class Matcher:
    """The automaton over the windows of ``items``, pairs of an id (may be null) and a text."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int) -> None:
        owners: dict[bytes, set[str]] = {}
        for item, raw in items:
            for window in windows(raw, size):
                own = owners.setdefault(window, set())
                if item is not None:
                    own.add(item)
        self.empty = not owners
        self.automaton = ahocorasick.Automaton()
        for window, own in owners.items():
            # Latin-1 keeps one character a byte, so that places in it are byte places
            self.automaton.add_word(window.decode("latin-1"), (window.count(b" ") - 1, own))
        if owners:
            self.automaton.make_automaton()

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, runs of hit words as [first, end) word numbers, and items hit."""
        w = words(raw)
        if self.empty or not w:
            return len(w), [], set()
        line = b" " + b" ".join(w) + b" "
        found = list(self.automaton.iter(line.decode("latin-1")))
        if not found:
            return len(w), [], set()
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        ends = np.searchsorted(blanks, np.array([end for end, _ in found]))
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        for end, (_, (n, own)) in sorted(zip(ends.tolist(), found, strict=True), key=lambda x: x[0] - x[1][1][0]):
            items |= own
            if runs and end - n <= runs[-1][1]:
                runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
            else:
                runs.append((end - n, end))
        return len(w), runs, items


def character_spans(raw: bytes, runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as [start, end) character places in the text as it came."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([0], np.frombuffer(raw.translate(NORMAL), np.uint8) != 32, [0])).astype(np.int8)
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return [(int(before[starts[a]]), int(before[ends[b - 1]])) for a, b in runs]


def _union(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    """The items in lists of at most ``block_bytes`` of text and one item more."""
    held, size = [], 0
    rows = benchmark.select(
        quoted(item_col).cast("string").alias("item"), quoted(text_col).cast("binary").alias("raw")
    ).where("raw IS NOT NULL AND octet_length(raw) > 0")
    for row in rows.toLocalIterator():
        held.append((row.item, bytes(row.raw)))
        size += len(row.raw)
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def _pass(docs: DataFrame, items: list, size: int, first: bool) -> DataFrame:
    """One scan of the texts; what earlier scans found stands in the last four columns."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    names = docs.columns if first else docs.columns[: -len(FOUND)]
    schema = T.StructType([*(docs.schema[c] for c in names), *FOUND])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, size)
        for batch in pieces(batches, "_raw"):
            counts, all_runs, all_spans, all_items = [], [], [], []
            for i, value in enumerate(batch.column("_raw")):
                raw = value.as_py() or b""
                n, runs, own = matcher.scan(raw)
                if not first:
                    own |= set(batch.column("_items")[i].as_py())
                    runs = _union([*runs, *((x["start"], x["end"]) for x in batch.column("_runs")[i].as_py())])
                counts.append(n)
                all_runs.append(_as_spans(runs))
                all_spans.append(_as_spans(character_spans(raw, runs)) if runs else [])
                all_items.append(sorted(own))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array(counts, pa.int64()),
                    pa.array(all_runs, pa.list_(SPAN)),
                    pa.array(all_spans, pa.list_(SPAN)),
                    pa.array(all_items, pa.list_(pa.string())),
                ],
                names=[*names, *(f.name for f in FOUND)],
            )

    return docs.mapInArrow(run, schema)


def _as_spans(pairs: Iterable[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in pairs]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every row of ``docs`` with what it shares with the benchmark.

    New columns: ``n_words``; ``n_hit``, words inside any occurrence of an item's window of
    ``window`` words (a shorter item is one window); ``items``, ids with occurring windows, sorted
    as text; ``spans``, runs of hit words as [start, end) character places in the text as it came;
    ``contaminated``, at least one word in twenty is hit.  Same-named input columns give way.

    Texts are scanned once, whole, without a shuffle.  The benchmark is turned into automata of
    ``block_bytes`` of item text each, so neither the driver nor a worker holds more; with several
    blocks the texts are scanned once for each, and each scan is written to the shared folder.

    Null or empty texts have no words and are clean.  Null or wordless items have no windows; an
    item without an id marks words but is not listed.  Repeated rows, in either table, count each
    for itself; repeated items have one id.  An empty benchmark leaves every document clean, an
    empty ``docs`` gives no rows.
    """
    own = ["n_words", "n_hit", "items", "spans", "contaminated"]
    out = docs.select(packed(docs, own), quoted(text_col).cast("binary").alias("_raw"))
    first = True
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        out = _pass(out if first else stored(out, "decontaminate"), items, window, first)
        first = False
    if first:
        out = _pass(out, [], window, True)
    n_hit = F.aggregate("_runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return out.select(
        "_row.*",
        F.col("_n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.col("_items").alias("items"),
        F.col("_spans").alias("spans"),
        ((n_hit > 0) & (WORDS_PER_HIT * n_hit >= F.col("_n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all the columns they came with."""
    rows = docs.select(packed(docs).alias("kept"), quoted(text_col).alias("text"))
    found = decontaminate(rows, benchmark, **options)
    return found.where("NOT contaminated").select("kept.*")
