"""Toxicity scores of a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import packed, pieces, quoted, stored

#: Hash space of terms.
BUCKETS = 1 << 22
#: Labelled rows the model is fitted on at most: those of the smallest id hashes.
SAMPLE = 24_000
#: Hashed terms the model keeps at most, and the chi-square of label and term asked of them.
TERMS, LEAST_CHI = 8192, 12.0
FACTORS = 6
EPOCHS, RATE, DECAY, BATCH = 60, 0.05, 2e-3, 1024
SEED = 7
#: Longest stem taken of a word besides the word itself; shorter words have none.
STEMS = (4, 5)
#: Words whose terms a worker remembers before it starts anew.
REMEMBERED = 400_000

WORD = re.compile(r"[^\W\d_]+")


def word_terms(word: str) -> list[int]:
    """Hashes of a word and of its stems; the length keeps word and stem apart."""
    out = [zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS]
    for n in STEMS:
        if len(word) >= n:
            out.append(zlib.crc32(f"{n}:{word[:n]}".encode("utf-8", "replace")) % BUCKETS)
    return out


class Terms:
    """Distinct hashed terms of texts, or of those the kept ones."""

    def __init__(self, kept: dict[int, int] | None = None) -> None:
        self.kept, self.known = kept, {}

    def __call__(self, raw: bytes | None) -> list[int]:
        out: set[int] = set()
        known, kept = self.known, self.kept
        for word in set(WORD.findall((raw or b"").decode("utf-8", "replace").lower())):
            terms = known.get(word)
            if terms is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                terms = word_terms(word)
                if kept is not None:
                    terms = [kept[t] for t in terms if t in kept]
                known[word] = terms
            if terms:
                out.update(terms)
        return sorted(out)


class Machine:
    """Second-order factorization machine with a logistic output over present terms."""

    def __init__(self, size: int) -> None:
        rng = np.random.Generator(np.random.PCG64(SEED))
        self.bias, self.weights = 0.0, np.zeros(size)
        self.factors = rng.normal(0, 0.01, (size, FACTORS))

    def margin(self, terms: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Margins of ``n`` rows and their sums of factors; ``rows`` is sorted."""
        v = self.factors[terms]
        sums, squares = np.zeros((n, FACTORS)), np.zeros((n, FACTORS))
        for f in range(FACTORS):
            sums[:, f] = np.bincount(rows, v[:, f], n)
            squares[:, f] = np.bincount(rows, v[:, f] ** 2, n)
        linear = np.bincount(rows, self.weights[terms], n)
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums

    def scores(self, lists: list[list[int]]) -> np.ndarray:
        sizes = np.array([len(x) for x in lists], np.int64)
        terms = np.concatenate([np.array(x, np.int64) for x in lists]) if len(lists) else np.zeros(0, int)
        rows = np.repeat(np.arange(len(lists)), sizes)
        return _logistic(self.margin(terms.astype(np.int64), rows, len(lists))[0])

    def fit(self, lists: list[list[int]], labels: np.ndarray) -> None:
        """Adam over small batches, weights pulled to zero."""
        share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(share / (1 - share)))
        rng = np.random.Generator(np.random.PCG64(SEED))
        arrays = [np.array(x, np.int64) for x in lists]
        state = [np.zeros((len(self.weights), 1 + FACTORS)) for _ in range(2)]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(arrays))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                sizes = np.array([len(arrays[i]) for i in some])
                terms = np.concatenate([arrays[i] for i in some])
                rows = np.repeat(np.arange(len(some)), sizes)
                margin, sums = self.margin(terms, rows, len(some))
                off = (_logistic(margin) - labels[some]) / len(some)
                grad = np.zeros((len(self.weights), 1 + FACTORS))
                grad[:, 0] = np.bincount(terms, off[rows], len(self.weights))
                pull = off[rows, None] * (sums[rows] - self.factors[terms])
                for f in range(FACTORS):
                    grad[:, 1 + f] = np.bincount(terms, pull[:, f], len(self.weights))
                both = np.concatenate((self.weights[:, None], self.factors), axis=1)
                grad += DECAY / 10 * both
                step += 1
                state[0] = 0.9 * state[0] + 0.1 * grad
                state[1] = 0.99 * state[1] + 0.01 * grad**2
                first, second = state[0] / (1 - 0.9**step), state[1] / (1 - 0.99**step)
                move = RATE * (1 - epoch / EPOCHS) * first / (np.sqrt(second) + 1e-4)
                self.weights -= move[:, 0]
                self.factors -= move[:, 1:] * 0.2
                self.bias -= RATE * off.sum()


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def is_held_out(id_column: F.Column) -> F.Column:
    """Rows never learnt from: crc32 of the id as text divides by five.  A null id is not one."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def _term_arrays(rows: DataFrame, kept: dict[int, int] | None = None) -> DataFrame:
    """``raw`` replaced by the distinct hashed terms."""
    names = [c for c in rows.columns if c != "raw"]
    schema = T.StructType([*(rows.schema[c] for c in names), T.StructField("terms", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(kept)
        for batch in pieces(batches, "raw"):
            lists = [terms(x.as_py()) for x in batch.column("raw")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(lists, pa.list_(pa.int32()))], names=[*names, "terms"]
            )

    return rows.mapInArrow(run, schema)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> tuple[dict[int, int], Machine]:
    """The kept terms and the machine, fitted on at most ``sample`` labelled rows not held out.

    The sample is the labelled ids of the smallest hashes, few enough to send to the texts; of an id
    with several labels the largest counts.  Terms are counted by Spark; the kept ones are those that depend most on the label, so
    the driver sees SAMPLE short lists of kept terms and no text.
    """
    marked = labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("y"))
    marked = marked.where("id IS NOT NULL AND y IS NOT NULL").where(~is_held_out(F.col("id")))
    chosen = marked.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("binary").alias("raw"))
    rows = stored(_term_arrays(texts.join(F.broadcast(chosen), "id")).select("y", "terms"), "toxic-terms")
    n, positive = rows.agg(F.count("y"), F.sum((F.col("y") > 0).cast("long"))).first()
    if not n or not positive or positive == n:
        machine = Machine(0)
        share = min(max((positive or 0) / n, 1e-3), 1 - 1e-3) if n else 1e-3
        machine.bias = float(np.log(share / (1 - share)))
        return {}, machine
    seen = (
        rows.select("y", F.explode("terms").alias("t"))
        .groupBy("t")
        .agg(F.count("y").alias("c"), F.sum((F.col("y") > 0).cast("long")).alias("p"))
    )
    # chi-square of the two-by-two table of label and term
    a, b = F.col("p").cast("double"), (F.col("c") - F.col("p")).cast("double")
    c, d = F.lit(float(positive)) - a, F.lit(float(n - positive)) - b
    chi = F.lit(float(n)) * (a * d - b * c) ** 2 / ((a + b) * (c + d) * float(positive) * float(n - positive))
    best = (
        seen.where("c >= 3")
        .where(c + d > 0)
        .select("t", chi.alias("chi"))
        .where(F.col("chi") >= LEAST_CHI)
        .orderBy(F.desc("chi"), "t")
        .limit(TERMS)
    )
    kept = {r.t: i for i, r in enumerate(best.collect())}
    chosen_terms = best.sparkSession.sparkContext.broadcast(kept)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = chosen_terms.value
        for batch in batches:
            lists = [[index[t] for t in x.as_py() if t in index] for x in batch.column("terms")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(lists, pa.list_(pa.int32()))], names=["y", "terms"])

    lists = rows.mapInArrow(keep, rows.schema).collect()
    machine = Machine(len(kept))
    if kept:
        machine.fit([r.terms for r in lists], np.array([float(r.y > 0) for r in lists]))
    return kept, machine


def score(docs: DataFrame, model: tuple[dict[int, int], Machine], *, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Columns of these two names in the input give way.  Null and empty texts have no terms and get
    the bias's score.  Each row is scored by its whole text alone, without a shuffle.
    """
    kept, machine = model
    rows = docs.select(packed(docs, ["score", "predicted"]), quoted(text_col).cast("binary").alias("raw"))
    shared = docs.sparkSession.sparkContext.broadcast((kept, machine))
    schema = T.StructType(
        [
            rows.schema["_row"],
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, machine = shared.value
        terms = Terms(kept)
        for batch in pieces(batches, "raw"):
            scores = machine.scores([terms(x.as_py()) for x in batch.column("raw")])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["_row", "score", "predicted"],
            )

    return rows.mapInArrow(run, schema).select("_row.*", "score", "predicted")


def accepted(docs: DataFrame, model: tuple[dict[int, int], Machine], *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` not predicted toxic, with all the columns they came with."""
    rows = docs.select(packed(docs).alias("kept"), quoted(text_col).alias("text"))
    return score(rows, model).where("predicted = 0").select("kept.*")
