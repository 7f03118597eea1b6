"""Row numbers in reading order, without a limit on files and without repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.schema import SEQ, reading_order

#: Spark counts rows inside a task in the low bits of its increasing ids.
_IN_TASK = (1 << 33) - 1


def next_number(stored: DataFrame) -> int:
    """The first row number not used in a stored table; only that column is read."""
    if SEQ not in stored.columns:
        return 0
    top = stored.agg(F.max(SEQ)).first()[0]
    return 0 if top is None else top + 1


def number_rows(df: DataFrame, work: str, start: int = 0) -> DataFrame:
    """``df`` with dense row numbers from ``start`` on, by the file and place a row was read at.

    Rows are sorted over ranges of (file, place) and written to ``work``, so numbers stay as they
    are; each range then begins where the ranges before it end.  Only the number of rows in each
    range, one figure a task, is looked at outside the tasks.
    """
    order = reading_order(df)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("_range", F.spark_partition_id()).withColumn(
        "_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK))
    ).write.parquet(work, compression="zstd")
    spark = df.sparkSession
    written = spark.read.parquet(work)
    sizes = written.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
    begins, at = [], start
    for row in sorted(sizes, key=lambda r: r["_range"]):
        begins.append((row["_range"], at))
        at += row["n"]
    offsets = spark.createDataFrame(begins, "_range int, _begin bigint")
    rest = [c for c in df.columns if c != SEQ]
    numbered = written.join(F.broadcast(offsets), "_range")  # one row a task
    return numbered.select(*rest, (F.col("_begin") + F.col("_row")).alias(SEQ))
