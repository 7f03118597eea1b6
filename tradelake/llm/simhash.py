"""Near duplicates by SimHash: bit-sliced comparison inside pigeonhole buckets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import components, pieces, quoted, stored

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Rows of a bucket that are compared in one piece; larger buckets are cut into pairs of tiles.
TILE = 2048
#: Buckets of up to so many rows are compared side by side, row by row distance.
SMALL = 24
#: Queries against one tile at a time.
QUERIES = 128


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is set if it is set in over half of the shingles' hashes."""
    words = raw.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(line, SEED)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()
    starts = [0, *(g + 1 for g in gaps[: len(words) - size])]
    ends = [*gaps[size - 1 :], len(line)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``fp``, the fingerprint as a signed long."""
    kept = docs.select(*map(quoted, keep), quoted(text_col).cast("binary").alias("_raw"))
    schema = T.StructType([*(kept.schema[c] for c in keep), T.StructField("fp", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_raw"):
            prints = np.array([fingerprint(x.as_py() or b"") for x in batch.column("_raw")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(prints.view(np.int64))], names=[*keep, "fp"]
            )

    return kept.mapInArrow(run, schema)


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """Bit b of all fingerprints side by side: 64 rows of packed 64-bit words."""
    lanes = -(-len(prints) // 64) * 64
    bits = np.zeros((64, lanes), np.uint8)
    bits[:, : len(prints)] = np.unpackbits(
        prints.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1
    ).T
    return np.packbits(bits, axis=1).view(np.uint64)


def _within(differing: Iterable[np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Lanes in which at most RADIUS (three) of the planes of differences are set.

    A carry-save counter of two bits and an overflow runs over the planes; once all lanes have
    overflowed the rest of the planes is left.
    """
    ones, twos, over = (np.zeros(shape, np.uint64) for _ in range(3))
    for k, d in enumerate(differing):
        carry = ones & d
        ones ^= d
        over |= twos & carry
        twos ^= carry
        if k % 8 == 7 and not np.any(~over):
            break
    return ~over


def _unpack(lanes: np.ndarray) -> np.ndarray:
    return np.unpackbits(lanes.view(np.uint8), axis=-1).astype(bool)


def neighbours(prints: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (lower, higher) of the same small group within the radius; groups are runs."""
    low, high = [], []
    rows = np.arange(len(prints))
    for shift in range(1, SMALL):
        rows = rows[rows + shift < len(prints)]
        rows = rows[group[rows] == group[rows + shift]]
        if not len(rows):
            break
        for at in range(0, len(rows), 1 << 15):
            r = rows[at : at + (1 << 15)]
            a, b = bit_planes(prints[r]), bit_planes(prints[r + shift])
            near = _unpack(_within((a[k] ^ b[k] for k in range(64)), a[0].shape))[: len(r)]
            low.append(r[near])
            high.append(r[near] + shift)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(low), join(high)


def spanning(left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """Links that span what is within the radius: inside ``left``, or between the two tiles.

    Of each set of linked rows only a spanning tree leaves the tile, never all its pairs.
    """
    rows = left if right is None else np.concatenate([left, right])
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    lanes = left if right is None else right
    planes, offset = bit_planes(lanes), 0 if right is None else len(left)
    for at in range(0, len(left), QUERIES):
        q = left[at : at + QUERIES]
        asked = np.unpackbits(q.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).T.astype(np.uint64)
        masks = np.uint64(0) - asked  # all ones where the query's bit is set
        near = _unpack(
            _within((planes[k][None, :] ^ masks[k][:, None] for k in range(64)), (len(q), planes.shape[1]))
        )[:, : len(lanes)]
        for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
            a, b = root(at + i), root(offset + j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield int(rows[at + i]), int(rows[offset + j])


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, left, fp) sorted by the first two: links of each bucket.

    ``left`` is null in a whole bucket; else true and false mark the two tiles to compare.
    """

    def links(bucket: np.ndarray, side: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(bucket)])))
        small = np.repeat(sizes <= SMALL, sizes) & (side == 0) & np.repeat(sizes > 1, sizes)
        if small.any():
            p = prints[small]
            a, b = neighbours(p, bucket[small])
            yield p[a], p[b]
        for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
            if n > 1 and not small[s]:
                p, k = prints[s : s + n], side[s : s + n]
                left, right = (p, None) if k[0] == 0 else (p[k == 1], p[k == 2])
                if pairs := list(spanning(left, right)):
                    yield tuple(np.array(pairs, np.uint64).T)

    held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.uint64)]
    for batch in batches:
        got = [
            batch.column("bucket").to_numpy(),
            batch.column("side").to_numpy().astype(np.int8),
            batch.column("fp").to_numpy().view(np.uint64),
        ]
        held = [np.concatenate(x) for x in zip(held, got, strict=True)]
        changes = np.flatnonzero(held[0][1:] != held[0][:-1])
        if not len(changes):
            continue
        end = changes[-1] + 1  # the last bucket may go on in the next batch
        for a, b in links(*(x[:end] for x in held)):
            yield _link_batch(a, b)
        held = [x[end:] for x in held]
    if len(held[0]):
        for a, b in links(*held):
            yield _link_batch(a, b)


def _link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
    )


def _bucket_keys() -> F.Column:
    """Sixteen keys: one 16-bit quarter, and one of four parts of the other 48 bits.

    Two fingerprints that differ in at most three bits agree in a quarter; the other 48 bits differ
    in at most three too, so they agree in one of their four parts of twelve bits.  Each pair is
    thus compared, over buckets of 28 agreeing bits.
    """
    fp = F.col("fp")
    keys = []
    for q in range(4):
        quarter = F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(0xFFFF))
        rest = _rest(fp, q)
        for part in range(4):
            twelve = F.shiftrightunsigned(rest, 12 * part).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((q * 4 + part) << 28) + quarter * F.lit(1 << 12) + twelve)
    return F.array(*keys)


def _rest(fp: F.Column, quarter: int) -> F.Column:
    """The 48 bits without one quarter, closed up."""
    at = 16 * quarter
    low = fp.bitwiseAND(F.lit((1 << at) - 1)) if at else F.lit(0).cast("long")
    high = F.shiftrightunsigned(fp, at + 16) if at < 48 else F.lit(0).cast("long")
    return low.bitwiseOR(F.shiftleft(high, at))


def links(prints: DataFrame, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` that span all pairs of distinct fingerprints ``fp`` within the radius."""
    keyed = prints.select("fp", F.explode(_bucket_keys()).alias("key"))
    large = (
        keyed.groupBy("key")
        .count()
        .where(F.col("count") > tile)
        .select("key", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    )
    marked = keyed.join(large, "key", "left")
    # a large bucket's rows go to every pair of tiles that holds their own; equal to both: inside one
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    other = F.explode(
        F.when(F.col("tiles").isNull(), F.array(F.lit(-1))).otherwise(
            F.sequence(F.lit(0), F.col("tiles") - 1)
        )
    )
    dealt = marked.select("fp", "key", own.alias("own"), other.alias("other"))
    whole = (F.col("other") < 0) | (F.col("own") == F.col("other"))
    # pairs of tiles have negative numbers; two that share one would only be compared together
    bucket = F.when(F.col("other") < 0, F.col("key")).otherwise(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).bitwiseOR(
            F.lit(-(1 << 63))
        )
    )
    side = F.when(whole, 0).when(F.col("own") < F.col("other"), 1).otherwise(2).cast("byte")
    rows = dealt.select(bucket.alias("bucket"), side.alias("side"), "fp")
    return (
        rows.repartition("bucket")
        .sortWithinPartitions("bucket", "side", "fp")
        .mapInArrow(_compare, "a long, b long")
    )


def _classes(prints: DataFrame, best: F.Column) -> DataFrame:
    """Per distinct ``fp`` its ``component`` and ``best`` of the component's rows."""
    classes = stored(prints.groupBy("fp").agg(best.alias("best")), "classes")
    found = components(links(classes.select("fp")))
    named = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "best", F.coalesce("component", "fp").alias("component")
    )
    return stored(named, "components")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Texts are lower-cased (A-Z) and cut into words at blanks; shingles are three words, repeats
    included.  Fingerprints at a distance of three or less link; ``component_id`` is the smallest
    id reachable.  Equal fingerprints are compared once.

    Null, empty and blank texts have fingerprint zero and link like any other.  Fewer than three
    words are one shingle.  Repeated rows stay repeated.  A null id stays null and does not count
    as smallest; a component without ids has a null id.  Other columns are not read.  Empty
    tables give no rows.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    prints = stored(with_fingerprint(rows, "text", ["id"]), "fingerprints")
    classes = _classes(prints, F.min("id"))
    smallest = classes.groupBy("component").agg(F.min("best").alias("component_id"))
    by_print = classes.join(smallest, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less near copies: of each component, the row with the smallest id.

    Rows without an id come after all others; the hash of the text, then of the row, breaks ties,
    so that one row stays whatever repeats.  All columns stay as they came.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        quoted(id_col).alias("id"),
        quoted(text_col).alias("text"),
        F.xxhash64(quoted(text_col)).alias("hash"),
        F.to_json(F.struct(quoted(id_col).alias("id"))).alias("key"),
    )
    prints = stored(with_fingerprint(rows, "text", ["id", "hash", "key"]), "fingerprints")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "hash", "key"))
    classes = _classes(prints, best)
    winners = classes.groupBy("component").agg(F.min("best").alias("best"))
    winners = winners.select("best.key", "best.hash")
    kept = rows.join(winners.distinct(), ["key", "hash"])
    single = kept.groupBy("key", "hash").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return single.select("row.*")
