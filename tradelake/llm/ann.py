"""Nearest neighbours by cross-polytope hashing with several probes a table."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.common import quoted, stored

TABLES = 32
#: Hash functions joined in one table's bucket.
AXES = 2
SEED = 20
NEAREST = 5
#: Sample queries that fix the number of probes, and the recall asked of them.
SAMPLE, RECALL = 96, 0.96
#: Queries that are compared together, a power of two; and rows of the index that meet them in one piece.
CHUNK, PIECE = 1 << 12, 1 << 16
#: Rows of one bucket that stay together; larger buckets are dealt over several keys.
BUCKET = 1 << 14
#: Axes of each hash function that probes are drawn from.
PROBE_AXES = 64


def _signs(d: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(SEED)).choice([-1.0, 1.0], (TABLES, AXES, 3, d))


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of sign flips and a fast Hadamard transform; rows are unit vectors."""
    n, d = x.shape
    for s in signs:
        x = x * s
        h = 1
        while h < d:
            x = x.reshape(n, -1, 2, h)
            x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, d)
            h *= 2
        x /= np.sqrt(d)
    return x


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, filled up with zeros to a power of two."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
    d = 1 << max(0, int(vectors.shape[1] - 1).bit_length())
    return np.pad(scaled, ((0, 0), (0, d - vectors.shape[1])))


def _signed_axes(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Nearness to each of the 2d signed axes."""
    r = rotate(x, signs)
    return np.concatenate((r, -r), axis=1)


def bucket_codes(vectors: np.ndarray) -> np.ndarray:
    """The bucket of each vector in each table: (rows, TABLES)."""
    x = _unit(vectors)
    signs = _signs(x.shape[1])
    out = np.zeros((len(x), TABLES), np.int32)
    for t in range(TABLES):
        for k in range(AXES):
            out[:, t] = out[:, t] * (2 * x.shape[1]) + _signed_axes(x, signs[t, k]).argmax(axis=1)
    return out


def probe_codes(vectors: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` likeliest buckets of each vector in each table, nearest first."""
    x = _unit(vectors)
    d2 = 2 * x.shape[1]
    signs = _signs(x.shape[1])
    out = np.full((len(x), TABLES, probes), -1, np.int32)
    for t in range(TABLES):
        loss, code = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for k in range(AXES):
            near = _signed_axes(x, signs[t, k])
            axes = np.argsort(-near, axis=1, kind="stable")[:, : min(PROBE_AXES, d2)]
            near = np.take_along_axis(near, axes, axis=1)
            miss = (near[:, :1] - near) ** 2
            loss = (loss[:, :, None] + miss[:, None, :]).reshape(len(x), -1)
            code = (code[:, :, None] * d2 + axes[:, None, :]).reshape(len(x), -1)
        n = min(probes, loss.shape[1])
        first = np.argpartition(loss, n - 1, axis=1)[:, :n] if n < loss.shape[1] else np.tile(np.arange(n), (len(x), 1))
        first = np.take_along_axis(first, np.argsort(np.take_along_axis(loss, first, axis=1), axis=1), axis=1)
        out[:, t, :n] = np.take_along_axis(code, first, axis=1)
    return out


def _matrix(column: pa.Array, rows: np.ndarray, size: int) -> np.ndarray:
    taken = column.take(pa.array(rows))
    return taken.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), size)


def _by_size(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of each number of components."""
    sizes = pc.list_value_length(column).to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, _matrix(column, rows, int(size))


def build_index(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """One row per distinct vector, written: ``h1, h2`` (its key), ``ids`` (the NEAREST + 1 smallest),
    ``vec``, ``codes`` (its bucket in each table), ``row`` (its number)."""
    rows = usable(vectors, id_col, vector_col)
    first = Window.partitionBy("h1", "h2").orderBy("id")
    least = (
        rows.dropDuplicates(["id", "h1", "h2"])
        .withColumn("r", F.row_number().over(first))
        .where(F.col("r") <= NEAREST + 1)
    )
    classes = least.groupBy("h1", "h2").agg(
        F.sort_array(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                codes = np.zeros((batch.num_rows, TABLES), np.int32)
                for rows, v in _by_size(batch.column("vec")):
                    codes[rows] = bucket_codes(v)
                held = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, codes.size + 1, TABLES), pa.int32()), pa.array(codes.ravel())
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, held], names=[*batch.schema.names, "codes"])

    schema = "h1 long, h2 long, ids array<long>, vec array<double>, codes array<int>"
    coded = classes.select("h1", "h2", "ids", "vec").mapInArrow(run, schema)
    return stored(coded.withColumn("row", F.monotonically_increasing_id()), "ann-index")


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows ``id, vec, h1, h2`` with an id and a finite vector that is not zero."""
    vec = quoted(vector_col).cast("array<double>")
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(
        finite & F.exists("vec", lambda x: x != 0)
    )
    return rows.select("id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))


def _numbered(queries: DataFrame) -> DataFrame:
    """Query vectors, written, with their chunk and their place in it; a chunk holds CHUNK at most.

    They are read by so few tasks that chunks, which lie inside one, are full.
    """
    queries = stored(queries.select("h1", "h2", "vec"), "ann-asked")
    queries = queries.coalesce(max(1, -(-queries.count() // (16 * CHUNK))))
    q = F.monotonically_increasing_id()
    chunk, place = F.shiftright(q, CHUNK.bit_length() - 1), q.bitwiseAND(F.lit(CHUNK - 1)).cast("int")
    return stored(
        queries.select("h1", "h2", "vec", chunk.alias("chunk"), place.alias("place")), "ann-queries"
    )


def _bucket(code: F.Column, table: F.Column) -> F.Column:
    """Bucket of a table as one number, apart for each number of components."""
    d = F.size("vec").cast("long")
    return F.shiftleft(d, 36).bitwiseOR(F.shiftleft(table.cast("long"), 31)).bitwiseOR(code.cast("long"))


def _met(index: DataFrame, asked: DataFrame, probes: int) -> DataFrame:
    """Rows that share a probed bucket with a query: ``row, chunk, places`` (those of the queries).

    Numbers alone are joined, a row with the list of a chunk's queries that probe its bucket, so pairs
    are never rows.  Buckets of over BUCKET rows are dealt over several keys, which the lists of such a
    bucket are repeated for, so that no task gets a bucket whole.
    """
    held = index.select("row", "vec", F.posexplode("codes").alias("t", "code"))
    held = stored(held.select("row", _bucket(F.col("code"), F.col("t")).alias("b")), "ann-buckets")
    probed = asked.select("chunk", "place", "vec").mapInArrow(
        lambda x: _with_probes(x, probes), "chunk long, place int, vec array<double>, probes array<int>"
    )
    probed = probed.select("chunk", "place", "vec", F.posexplode("probes").alias("i", "code")).where("code >= 0")
    table = F.floor(F.col("i") / F.lit(probes))
    probed = probed.select("chunk", "place", _bucket(F.col("code"), table).alias("b"))
    probed = probed.groupBy("b", "chunk").agg(F.collect_set("place").alias("places"))
    large = held.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET)
    large = stored(large.select("b", F.ceil(F.col("n") / BUCKET).cast("int").alias("keys")), "ann-large")
    keys = F.coalesce("keys", F.lit(1))
    held = held.join(large, "b", "left").select("row", "b", F.pmod("row", keys).cast("int").alias("key"))
    probed = probed.join(large, "b", "left").select(
        "chunk", "places", "b", F.explode(F.sequence(F.lit(0), keys - 1)).alias("key")
    )
    met = held.join(probed, ["b", "key"])
    return met.groupBy("row", "chunk").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")
    )


def _compared(index: DataFrame, asked: DataFrame, pieces: int) -> DataFrame:
    """The best rows of each query among all rows, chunk after chunk of queries that are numbered without gaps."""
    chunks = asked.groupBy("chunk").agg(F.max("place").alias("last")).collect()  # one row per CHUNK queries
    every = F.array(*(F.struct(F.lit(r.chunk).cast("long").alias("chunk"), F.lit(r.last).alias("last")) for r in chunks))
    met = index.select("row", F.explode(every).alias("c"))
    met = met.select("row", "c.chunk", F.sequence(F.lit(0), F.col("c.last")).alias("places"))
    return _scored(index, asked, met, pieces)


def _scored(index: DataFrame, asked: DataFrame, met: DataFrame, pieces: int) -> DataFrame:
    """The best rows of each query among those it meets: ``chunk, place, score, id, h1, h2``.

    A chunk's queries go to every piece that any of them meets: CHUNK rows a piece at most, so that
    the lists of a row's queries need not be taken apart.

    The vectors of a chunk's queries and the rows they meet come to the same task, queries first; rows
    pass by in batches, each with its own vector once for all queries of the chunk.
    """
    piece = F.pmod("row", F.lit(pieces).cast("long")).alias("piece")
    met = stored(met.select("row", "chunk", "places", piece), "ann-met")
    none = lambda kind: F.lit(None).cast(kind)
    queries = met.select("chunk", "piece").distinct().join(asked, "chunk").select(
        "chunk", "piece", "place", "vec", none("array<int>").alias("places"), none("array<long>").alias("ids"), "h1", "h2"
    )
    rows = met.join(index, "row").select(
        "chunk", "piece", none("int").alias("place"), "vec", "places", "ids", "h1", "h2"
    )
    both = queries.union(rows).repartition("chunk", "piece")
    both = both.sortWithinPartitions("chunk", "piece", F.col("place").asc_nulls_last())
    found = both.mapInArrow(_score_chunks, "chunk long, place int, score double, id long, h1 long, h2 long")
    order = Window.partitionBy("chunk", "place").orderBy(F.desc("score"), "id")
    found = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= NEAREST + 1).drop("r")
    return stored(found, "ann-found")


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares neither overflow nor vanish; cosines stay the same."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


class _Chunk:
    """Queries of one chunk and the best rows found for them so far."""

    def __init__(self, key: tuple[int, int]) -> None:
        self.key = key
        self.vectors: dict[int, dict[int, np.ndarray]] = {}
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.best = [np.zeros(0, kind) for kind in (np.int64, np.float64, np.int64, np.int64, np.int64)]

    def ask(self, batch: pa.RecordBatch) -> None:
        places = batch.column("place").to_numpy()
        for at, v in _by_size(batch.column("vec")):
            self.vectors.setdefault(v.shape[1], {}).update(zip(places[at].tolist(), v, strict=True))

    def _queries(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each place of the chunk is in the matrix of this size (-1: of another size), matrix, norms."""
        if size not in self.tables:
            held = self.vectors.get(size, {})
            where = np.full(CHUNK, -1)
            where[list(held)] = np.arange(len(held))
            m = _scaled(np.array(list(held.values()))) if held else np.zeros((0, size))
            self.tables[size] = where, m, np.linalg.norm(m, axis=1)
        return self.tables[size]

    def meet(self, batch: pa.RecordBatch) -> None:
        lists = [(batch.column(c), pc.list_value_length(batch.column(c)).to_numpy()) for c in ("places", "ids")]
        (places, n_places), (ids, n_ids) = ((c.flatten().to_numpy(), n) for c, n in lists)
        at_place, at_id = (np.cumsum(n) - n for n in (n_places, n_ids))
        key = [batch.column(k).to_numpy() for k in ("h1", "h2")]
        for rows, v in _by_size(batch.column("vec")):
            where, asked, norms = self._queries(v.shape[1])
            v = _scaled(v)
            own = np.linalg.norm(v, axis=1)
            r, spot = _unfolded(n_places[rows], at_place[rows])
            place = places[spot]
            r, place = (x[where[place] >= 0] for x in (r, place))
            for k in range(0, len(r), 1 << 16):
                of, row = place[k : k + (1 << 16)], r[k : k + (1 << 16)]
                q = where[of]
                score = np.einsum("ij,ij->i", v[row], asked[q]) / (own[row] * norms[q])
                pair, spot = _unfolded(n_ids[rows[row]], at_id[rows[row]])
                new = [of[pair], score[pair], ids[spot], *(x[rows[row[pair]]] for x in key)]
                self.best = _best(*(np.concatenate(x) for x in zip(self.best, new, strict=True)))

    def result(self) -> pa.RecordBatch:
        place, score, ids, h1, h2 = self.best
        columns = [np.full(len(place), self.key[0]), place.astype(np.int32), score, ids, h1, h2]
        names = ["chunk", "place", "score", "id", "h1", "h2"]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)


def _unfolded(counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of lists laid end to end: number of its list, and its place in the flat array."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts - starts, counts)


def _score_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for whole in batches:
        for start in range(0, whole.num_rows, 512):
            batch = whole.slice(start, 512)
            keys = np.stack([batch.column(c).to_numpy() for c in ("chunk", "piece")])
            asks = batch.column("place").is_valid().to_numpy(zero_copy_only=False)
            new = np.any(keys[:, 1:] != keys[:, :-1], axis=0) | (asks[1:] != asks[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                key = (int(keys[0, a]), int(keys[1, a]))
                if held is None or held.key != key:
                    if held is not None:
                        yield held.result()
                    held = _Chunk(key)
                part = batch.slice(a, b - a)
                held.ask(part) if asks[a] else held.meet(part)
    if held is not None:
        yield held.result()


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, *key: np.ndarray) -> list[np.ndarray]:
    """The NEAREST + 1 best of each query: largest score, then smallest id."""
    order = np.lexsort((ids, -score, query))
    query, score, ids, *key = (x[order] for x in (query, score, ids, *key))
    starts = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, int)
    sizes = np.diff(np.concatenate((starts, [len(query)])))
    keep = np.arange(len(query)) - np.repeat(starts, sizes) <= NEAREST
    return [x[keep] for x in (query, score, ids, *key)]


def fit_probes(index: DataFrame, queries: DataFrame, pieces: int) -> tuple[int, float]:
    """The fewest probes a table (a power of two) that find RECALL of the true neighbours.

    Measured on at most SAMPLE query vectors (smallest key hashes), whose neighbours are looked for
    among all rows.  Returns the probes and the recall found on the sample.
    """
    asked = _numbered(queries.orderBy("h1", "h2").limit(SAMPLE))
    sample = {(r.chunk, r.place): r for r in asked.collect()}
    if not sample:
        return 1, 1.0
    true = _compared(index, asked, pieces).join(index.select("h1", "h2", "codes"), ["h1", "h2"])
    most = PROBE_AXES**AXES
    order = {k: probe_codes(np.array([r.vec]), most)[0] for k, r in sample.items()}
    places = []
    for r in true.collect():
        of = sample[r.chunk, r.place]
        if (r.h1, r.h2) != (of.h1, of.h2):
            hits = [np.flatnonzero(order[r.chunk, r.place][t] == r.codes[t]) for t in range(TABLES)]
            places.append(min((int(h[0]) for h in hits if len(h)), default=most))
    probes = 1
    found = lambda n: sum(p < n for p in places) / len(places) if places else 1.0
    while probes < most and found(probes) < RECALL:
        probes = min(2 * probes, most)
    return probes, found(probes)


def nearest(
    vectors: DataFrame,
    is_query: F.Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The five rows of largest cosine found for each query row: ``query_id, rank, vec_id, score``.

    ``is_query`` says of ``id`` which rows ask; all rows but the query's own are candidates.
    Equal vectors are indexed and asked once, with their six smallest ids, which is all that any
    answer can hold; so a vector that a third of the rows share costs as much as one row.  Buckets
    have no cap.  Probed buckets and the rows' buckets are joined as numbers, by a shuffle; each row
    then meets the queries it shares a bucket with, CHUNK of them at a time, and is scored exactly.
    Neither queries nor candidates pass through the driver.

    The number of probes is fitted on SAMPLE query vectors, see ``fit_probes``.  Where even the most
    probes find less than RECALL of the sample's neighbours, all queries are put to all rows in
    blocks; so is any query that meets fewer than six rows.

    Rows without an id, and vectors that are null, empty, zero, or hold nulls or non-finite
    numbers take no part.  Vectors compare with those of the same number of components only.  Rows
    that repeat both id and vector count once; an id with two vectors asks and answers for each.
    Ties go to the smaller id.  Vectors of huge or tiny numbers are scaled by a power of two, which
    leaves cosines as they are.  Other columns are not read.  An empty table gives no rows.
    """
    index = build_index(vectors, id_col, vector_col)
    pieces = max(1, -(-index.count() // PIECE))
    asking = usable(vectors, id_col, vector_col).where(is_query).select("id", "h1", "h2").distinct()
    asked = _numbered(index.join(asking.select("h1", "h2").distinct(), ["h1", "h2"]))
    probes, recall = fit_probes(index, asked, pieces)
    if recall < RECALL:
        answers = _answers(_compared(index, asked, pieces), asked)
    else:
        found = _scored(index, asked, _met(index, asked, probes), pieces)
        full = found.groupBy("chunk", "place").agg(F.count("id").alias("n")).where(F.col("n") > NEAREST)
        answers = _answers(found.join(full.select("chunk", "place"), ["chunk", "place"], "left_semi"), asked)
        short = _numbered(asked.join(full, ["chunk", "place"], "left_anti"))
        if not short.isEmpty():
            answers = answers.union(_answers(_compared(index, short, pieces), short))
    rows = asking.join(answers, ["h1", "h2"]).where(~((F.col("id") == F.col("vec_id")) & F.col("own")))
    order = Window.partitionBy("id", "h1", "h2").orderBy(F.desc("score"), "vec_id")
    return (
        rows.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= NEAREST)
        .select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
    )


def _answers(found: DataFrame, asked: DataFrame) -> DataFrame:
    """What was found by the key of the query's vector: ``h1, h2, vec_id, score, own``."""
    keys = asked.select("chunk", "place", F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    own = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    return found.join(keys, ["chunk", "place"]).select(
        F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("id").alias("vec_id"), "score", own.alias("own")
    )


def _with_probes(batches: Iterable[pa.RecordBatch], probes: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            codes = np.zeros((batch.num_rows, TABLES, probes), np.int32)
            for rows, v in _by_size(batch.column("vec")):
                codes[rows] = probe_codes(v, probes)
            held = pa.ListArray.from_arrays(
                pa.array(np.arange(0, codes.size + 1, TABLES * probes), pa.int32()), pa.array(codes.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, held], names=[*batch.schema.names, "probes"])
