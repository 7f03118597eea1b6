"""Texts whose word shingles have a large Jaccard similarity, joined by parity sketches.

A text's shingles are hashed to places in the parts of a sketch, and each flips the bit at its place.
Two sketches then differ in no more bits than the sets differ in shingles, because a shingle that
both have flips the same bit in both.  With as many parts as two linked texts of a size band may
differ in shingles, twice over, at least half of the parts are equal:

* a part's places are kept as one number, the XOR of their mixed values, so parts may be 2^32 bits
  wide and equal parts are equal numbers;
* texts meet in equal parts (pigeonhole), the rarest first: of a text that may differ in D parts
  only its D + 1 rarest are looked at, so parts that a third of all texts share join nobody unless a
  text has hardly any others;
* a sketch of at most 4,096 bits goes with each text; pairs whose sketches differ in too many bits
  are never compared;
* the rest is verified on the sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import components, packed, pieces, quoted, stored
from tradelake.llm.repeats import Sieve, keys

SHINGLE = 3
#: Least similarity of a link, in hundredths.
PERCENT = 90
#: Size bands begin here; smaller sets are linked to equal ones only.
FIRST = PERCENT // (100 - PERCENT)
#: Sizes at the end of a band next to those at its start, in hundredths.
BAND = 150
#: Words of 64 bits in a sketch that travels with a text.
SKETCH = 64
#: Texts that one task compares with as many others.
TILE = 1024
#: Texts of a part up to which its pairs are written down rather than compared in tiles.
FEW = 64

U = np.uint64


def most(size: int) -> int:
    """Shingles in which a set of ``size`` may differ from one linked to it."""
    return size * (100 - PERCENT) // PERCENT


def bands(up_to: int) -> list[tuple[int, int]]:
    """First and last size of each band until one holds ``up_to``."""
    out, low = [], FIRST
    while not out or out[-1][1] < up_to:
        out.append((low, max(low, low * BAND // 100 - 1)))
        low = out[-1][1] + 1
    return out


def parts(band: tuple[int, int]) -> int:
    """Two sets of a band differ in at most ``2 high (100 - PERCENT) / (100 + PERCENT)`` shingles."""
    return 2 * (2 * band[1] * (100 - PERCENT) // (100 + PERCENT) + 1)


def sketch_words(band: tuple[int, int]) -> int:
    return min(SKETCH, 1 << max(1, (band[1] // 4 - 1).bit_length()))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_sets(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of the texts, sorted, one text behind the other, and their numbers."""
    one = xxhash.xxh3_64_intdigest
    words, sizes = [], []
    for raw in raws:
        split = raw.lower().split()
        sizes.append(len(split))
        words += [one(w) for w in split]
    w = np.array(words, U)
    n = np.array(sizes, np.int64)
    starts = np.cumsum(n) - n
    counts = np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)
    text = np.repeat(np.arange(len(n)), counts)
    at = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[text]
    left = np.minimum(n[text] - (at - starts[text]), SHINGLE)
    hashed = _mixed(left.astype(U))
    for k in range(SHINGLE):
        there = left > k
        word = w[np.minimum(at + k, len(w) - 1)] if len(w) else w
        hashed = np.where(there, _mixed(hashed * U(0x9E3779B97F4A7C15) + word), hashed)
    order = np.lexsort((hashed, text))
    text, hashed = text[order], hashed[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashed[1:] != hashed[:-1])
    return hashed[new], np.bincount(text[new], minlength=len(n)).astype(np.int64)


def part_keys(hashed: np.ndarray, sizes: np.ndarray, band: int, n_parts: int) -> np.ndarray:
    """The number of each part of each set: (sets, parts)."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    # the part by the high bits, the place in it by the low ones
    where = (hashed >> U(32)) * U(n_parts) >> U(32)
    cell = text * n_parts + where.astype(np.int64)
    order = np.argsort(cell, kind="stable")
    cell, places = cell[order], _mixed(hashed[order] & U(0xFFFFFFFF))
    out = np.zeros(len(sizes) * n_parts, U)
    if len(cell):
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        out[cell[first]] = np.bitwise_xor.reduceat(places, first)
    out = out.reshape(len(sizes), n_parts)
    names = _mixed(np.arange(n_parts, dtype=U) + U(band << 32))
    return _mixed(out ^ names)


def sketches(hashed: np.ndarray, sizes: np.ndarray, words: int) -> np.ndarray:
    """Parity of the shingles at each of 64 ``words`` places: (sets, words)."""
    bits = 64 * words
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = text * bits + (_mixed(hashed + U(1)) % U(bits)).astype(np.int64)
    odd = (np.bincount(place, minlength=len(sizes) * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sizes), bits), axis=1).view(U)


READ = "n int, h1 long, h2 long"
ENTRY = "array<struct<band:int,keys:array<long>,sketch:binary>>"


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, two hashes of the set, and its entries: one for its band, one for the next if it is near."""
    kind = pa.list_(pa.struct([("band", pa.int32()), ("keys", pa.list_(pa.int64())), ("sketch", pa.binary())]))
    for batch in pieces(batches, "raw", 1 << 20):
        hashed, sizes = shingle_sets([x.as_py() or b"" for x in batch.column("raw")])
        starts = np.concatenate(([0], np.cumsum(sizes)))
        one, two = _set_hashes(hashed, starts)
        entries: list[list[dict]] = [[] for _ in sizes]
        table = bands(int(sizes.max(initial=0)) * 100 // PERCENT + 1)
        for b, (low, high) in enumerate(table):
            near = low * PERCENT // 100 if low > FIRST else low
            chosen = np.flatnonzero((sizes >= near) & (sizes <= high))
            if not len(chosen):
                continue
            own = np.concatenate([hashed[starts[i] : starts[i + 1]] for i in chosen])
            n_parts = parts((low, high))
            found = part_keys(own, sizes[chosen], b, n_parts).view(np.int64)
            drawn = sketches(own, sizes[chosen], sketch_words((low, high)))
            for i, k, s in zip(chosen.tolist(), found, drawn, strict=True):
                entries[i].append({"band": b, "keys": k, "sketch": s.tobytes()})
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("id", "k1", "k2")), pa.array(sizes, pa.int32()), pa.array(one), pa.array(two),
             pa.array(entries, kind)],
            names=["id", "k1", "k2", "n", "h1", "h2", "entries"],
        )


def _set_hashes(hashed: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers that stand for each set: the XOR and the sum of its mixed hashes."""
    one, two = np.zeros(len(starts) - 1, U), np.zeros(len(starts) - 1, U)
    some = np.flatnonzero(starts[1:] > starts[:-1])
    if len(some):
        one[some] = np.bitwise_xor.reduceat(_mixed(hashed), starts[some])
        two[some] = np.add.reduceat(_mixed(hashed + U(7)), starts[some])
    return one.view(np.int64), two.view(np.int64)


def _within(table: pa.Table) -> pa.Table:
    """Pairs ``a, b`` of two tiles of a part that are of different groups and whose sketches are near."""
    tile, i, j = (table.column(c).to_numpy() for c in ("tile", "i", "j"))
    c, g, most_ = (table.column(k).to_numpy() for k in ("c", "g", "most"))
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), U).reshape(len(c), -1)
    left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    found = []
    for at, x in enumerate(left.tolist()):
        y = right[at + 1 :] if i[0] == j[0] else right
        bits = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1)
        y = y[(bits <= np.minimum(most_[x], most_[y])) & (g[x] != g[y])]
        found.append(np.stack((np.maximum(c[x], c[y]), np.minimum(c[x], c[y]))))
    a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "raw", 1 << 20):
        hashed, sizes = shingle_sets([x.as_py() for x in batch.column("raw")])
        held = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(hashed.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("c"), held], names=["c", "shingles"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets reach PERCENT."""
    with_a = pairs.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("x")), "a")
    both = with_a.join(sets.select(F.col("c").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    linked = 100 * common >= PERCENT * (F.size("x") + F.size("y") - common)
    return both.where(linked).select("a", "b")


def _met(entries: DataFrame) -> DataFrame:
    """``key, c, most, sketch, rest``: the rare parts in which a text meets others.

    ``rest`` is the number of its parts that no other has.  Parts are ordered by how many texts have
    them; those of one text need no row, but count among its ``most`` + 1 rarest.
    """
    rows = entries.select("c", "band", "most", F.size("keys").alias("all"), F.explode("keys").alias("key"))
    often = rows.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    often = stored(often, "parity-parts")
    shared = Sieve(often, "key").marked(rows, "key").where("maybe").drop("maybe").join(often, "key")
    listed = shared.groupBy("c", "band", "most", "all").agg(F.sort_array(F.collect_list(F.struct("times", "key"))).alias("k"))
    rest = F.col("all") - F.size("k")
    kept = listed.withColumn("rest", rest).where("rest <= most")
    rarest = F.slice("k", F.lit(1), F.col("most") + 1 - F.col("rest"))
    return stored(kept.select("c", "band", "most", "rest", F.explode(rarest).alias("k")).select("c", "band", "most", "rest", "k.*"), "parity-met")


def _tiles(open_: DataFrame) -> DataFrame:
    """Pairs of different groups whose sketches are near, of parts with many texts: tile by tile.

    Rows ``key, c, g, most, sketch, tiles``.  A part's texts are dealt to tiles by a hash; each pair of tiles
    is one group of the next shuffle, so no task holds more than two tiles.
    """
    tile = F.pmod(F.xxhash64(F.lit(3), "c"), F.col("tiles")).cast("int")
    rows = open_.withColumn("tile", tile)
    to = F.explode(F.sequence(F.lit(0), (F.col("tiles") - 1).cast("int"))).alias("other")
    sent = rows.select("key", "c", "g", "most", "sketch", "tile", to)
    sent = sent.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
    return sent.drop("other").groupBy("key", "i", "j").applyInArrow(_within, "a long, b long").distinct()


def similar(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``n_shingles`` and ``component_id``.

    Words are what stands between white space after A-Z are lower-cased; shingles are SHINGLE words;
    a text with fewer is one shingle.  Two texts are linked if their sets have a Jaccard similarity of
    PERCENT hundredths or more; the component is the smallest id reachable by links.

    Equal sets are one class first, so copies of a text cost as much as one.  Classes meet in parts
    (see above).  In each part, the text with the fewest parts of its own is compared with all others;
    links make groups.  Of parts that are still in several groups, the pairs between groups are
    compared: written down where a part has few texts, else tile by tile on sketches.  No pair that
    shares a looked-at part stays unseen, unless both are in one group already.

    Null, empty and blank texts have no shingles and are their own component.  Rows that repeat an
    id or a text are linked; a row without an id links others but is never the smallest, and its
    component is null where no other has an id.  Input columns with the names of new ones give way.
    An empty table gives no rows.
    """
    own = ["n_shingles", "component_id"]
    text = quoted(text_col).cast("string")
    raw = docs.select(quoted(id_col).cast("long").alias("id"), *keys(text), text.cast("binary").alias("raw"))
    table = stored(raw.mapInArrow(_read, f"id long, k1 long, k2 long, {READ}, entries {ENTRY}").withColumn("c", F.monotonically_increasing_id()), "parity")
    classes = table.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("c").alias("c"), F.min("id").alias("id"))
    classes = stored(classes, "parity-classes")
    # the entries of one text of each class; only it is looked at below
    chosen = table.where(F.size("entries") > 0).select("c", "n", "k1", "k2", "entries")
    chosen = stored(chosen.join(classes.select("c"), "c", "left_semi"), "parity-chosen")
    # no text may differ in more than its own size allows, nor in more than half of the parts less one
    most_ = F.expr(f"cast(least(n * {100 - PERCENT} div {PERCENT}, size(keys) div 2 - 1) as int)")
    entries = chosen.select("c", "n", F.inline("entries")).withColumn("most", most_)
    met = _met(entries.select("c", "band", "most", "keys"))
    links = _linked(docs, text_col, table, chosen, entries, met)
    groups = components(links) if links is not None else None
    return _labelled(docs, own, id_col, text_col, table, classes, groups)


def _linked(docs, text_col, table, chosen, entries, met) -> DataFrame | None:
    """Links ``a, b`` between classes that connect all that belongs together."""
    # a part's pivot: the text with the fewest parts of its own, the likeliest origin of the others
    pivots = met.groupBy("key").agg(F.count(F.lit(1)).alias("here"), F.min(F.struct("rest", "c")).alias("p"))
    pivots = stored(pivots.where("here > 1").select("key", "here", F.col("p.c").alias("pivot")), "parity-pivots")
    pairs = met.join(pivots, "key").where("c <> pivot")
    pairs = stored(pairs.select(F.greatest("c", "pivot").alias("a"), F.least("c", "pivot").alias("b")).distinct(), "parity-pairs")
    some = met.join(pivots.select("key"), "key", "left_semi").select("c").distinct()
    sets = _sets_of(docs, text_col, chosen.join(some, "c", "left_semi"))
    links = stored(_verified(pairs, sets), "parity-links")
    group = components(links).withColumnRenamed("component", "g")
    open_ = met.join(pivots, "key").join(group.withColumnRenamed("node", "c"), "c", "left")
    open_ = open_.select("key", "c", "band", "most", "here", F.coalesce("g", "c").alias("g"))
    mixed = open_.groupBy("key").agg(F.min("g").alias("g1"), F.max("g").alias("g2")).where("g1 < g2").select("key")
    open_ = stored(open_.join(mixed, "key", "left_semi"), "parity-open")
    few = open_.where(F.col("here") <= FEW)
    left, right = few.select("key", F.col("c").alias("a"), F.col("g").alias("ga")), few.select("key", F.col("c").alias("b"), F.col("g").alias("gb"))
    written = left.join(right, "key").where("a > b AND ga <> gb").select("a", "b").distinct()
    many = open_.where(F.col("here") > FEW)
    tiles = F.ceil(F.col("here") / F.lit(TILE)).alias("tiles")
    many = many.join(entries.select("c", "band", "sketch"), ["c", "band"]).select("key", "c", "g", "most", "sketch", tiles)
    more = written.union(_tiles(many)).distinct()
    more = stored(more.join(pairs, ["a", "b"], "left_anti"), "parity-more")
    return links.union(stored(_verified(more, sets), "parity-links"))


def _sets_of(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """``c`` and its shingles, for the classes ``c, k1, k2``; their texts are read again."""
    wanted = stored(wanted.select("c", "k1", "k2"), "parity-wanted")
    text = quoted(text_col).cast("string")
    some = docs.where(text.isNotNull()).select(*keys(text), text.cast("binary").alias("raw"))
    some = Sieve(wanted, "k1", "k2").marked(some, "k1", "k2").where("maybe").drop("maybe")
    some = some.dropDuplicates(["k1", "k2"]).join(wanted, ["k1", "k2"]).select("c", "raw")
    return stored(some.mapInArrow(_sets, "c long, shingles array<long>"), "parity-sets")


def _labelled(docs, own, id_col, text_col, table, classes, groups) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class's component."""
    joined = classes.join(groups.withColumnRenamed("node", "c"), "c", "left")
    joined = joined.select("h1", "h2", "n", F.coalesce("component", "c").alias("g"), "id")
    least = joined.groupBy("g").agg(F.min("id").alias("component_id"))
    known = stored(joined.join(least, "g").select("h1", "h2", "n", "component_id"), "parity-components")
    text = quoted(text_col).cast("string")
    rows = docs.select(packed(docs, own), quoted(id_col).cast("long").alias("id"), *keys(text))
    # a class for each distinct text, small beside the texts
    texts = table.groupBy("k1", "k2").agg(F.min("h1").alias("h1"), F.min("h2").alias("h2"), F.min("n").alias("n"))
    texts = texts.join(known, ["h1", "h2", "n"], "left").select("k1", "k2", "n", "component_id")
    out = rows.join(texts, ["k1", "k2"], "left")
    n = F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles")
    component = F.when(F.coalesce("n", F.lit(0)) == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    return out.select("_row.*", n, component)
