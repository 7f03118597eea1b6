"""Helpers the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.session import work_folder

#: Bytes of text that one step of a task holds as arrays.
STEP_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path not used before, in the folder that driver and executors share."""
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns whose names an operator's own columns take."""
    taken = {n.lower() for n in names}
    return df.select([quoted(c) for c in df.columns if c.lower() not in taken])


def packed(df: DataFrame, names: Iterable[str] = ()):
    """The columns of ``df``, less those of the names, as one struct ``_row``.

    Operators carry rows as this struct, so that no column's name can meet one of their own.
    """
    return F.struct(*map(quoted, without(df, names).columns)).alias("_row")


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has about ``limit`` bytes in each, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        start = held = 0
        for i, n in enumerate(sizes.to_pylist()):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n + 16
        if start < batch.num_rows:
            yield batch.slice(start)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the undirected links ``(a, b)``: rows ``(node, component)``.

    Component is the smallest node reachable.  Large-star and small-star steps (joins with the
    smallest neighbour) run by turns until the links no longer change; each round is written to
    the shared folder.  A node with a third of all links costs no more than one of few: its
    neighbours are reduced to one smallest per task before the shuffle, and the join back on the
    hot node is left to adaptive skew splitting.
    """
    edges = stored(_pairs(links.select("a", "b")), "links")
    before = None
    for _ in range(rounds):
        # large star: neighbours above a node go to the smallest of its neighbours and itself
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = _pairs(
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        # small star: neighbours below a node, and itself, go to the smallest of them
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
        edges = stored(_pairs(small), "links")
        seen = edges.agg(
            F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")
        ).first()
        if before == seen:
            break
        before = seen
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return roots.union(edges.select(F.col("a").alias("node"), F.col("b").alias("component"))).distinct()


def _pairs(df: DataFrame) -> DataFrame:
    """Distinct links with the larger node first; a node's link to itself goes."""
    return (
        df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
