"""Removal of byte strings that occur more than once, by rank doubling over sampled positions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import repeats
from tradelake.llm.common import quoted
from tradelake.session import shuffles_released

#: Bytes of a string that must occur once only.
LENGTH = 400
SHAPE = repeats.Shape(size=LENGTH, gram=16, reach=200, width=1)
#: Hash of each byte: the 64-bit mixes of 1 to 256.
BYTES = repeats._mixed(repeats._mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def split(raw: bytes) -> tuple[np.ndarray, bytes]:
    return BYTES[np.frombuffer(raw, np.uint8)], raw


def remove(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]), len(raw)


def deduplicate(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``kept`` (bytes), ``n`` (bytes before) and ``spans`` removed.

    Removed is every byte inside a string of LENGTH bytes that starts anywhere else too, in the
    same text or another; strings are judged on the texts as they came.

    Ranks double over positions: grams of 16 bytes are named by hashing pairs of halves (1, 2, 4, 8,
    16 bytes), the smallest in reach make the positions; Spark groups their 201-byte ranks and drops
    the unique; the rest goes on to ranks of whole runs of windows (400 to 600 bytes), where those are
    unique again to ranks of blocks of 8 windows (393 and 400 to 407 bytes), and at last to pairs of
    the ranks of a window's two halves (200 and 200 bytes).
    Ranks are hashes of content, not counted up, so none has to be looked up at the next offset.

    Null texts are empty; they and texts under LENGTH bytes lose nothing.  Of repeated rows all
    copies lose what they share, which is everything from LENGTH bytes on.  Columns ``kept``, ``n``
    and ``spans`` of the input give way, others stay.  An empty table gives no rows.
    """
    texts = docs.select(quoted(text_col).cast("string").alias("text"))
    with shuffles_released(docs.sparkSession):
        found = repeats.find(texts, split, SHAPE)
        windows = repeats.by_blocks(texts, found, found.edges(), split, SHAPE)
        spans = repeats.spans(found, windows.union(found.sure()), SHAPE)
        return repeats.cut(docs, spans, text_col, remove)
