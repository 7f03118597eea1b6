"""Saved responses: JSON files holding raw trade records.

Two layouts are read.  *Envelopes* are whole JSON documents, either ``{"data": [...], ...}`` or
a bare list; each record becomes a variant of its own, so only the text of one response has to fit
a row.  *Lines* hold one record per line and can be split at any size, which is the layout for
volume.

Both give ``_src_file`` and ``_src_pos``, the file and the place in it, which together are the
reading order, ``rec``, the record as a variant, which keeps every digit and the kind of each
value, and ``_text``, the text of what is not JSON.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.schema import SOURCE_FILE, SOURCE_POSITION

_ROW_MASK = (1 << 33) - 1


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(_paths(paths), wholetext=True)
        .select(F.col("_metadata.file_path").alias(SOURCE_FILE), "value")
    )


def _opened(text: Column, items: str, *more: str) -> Column:
    """A document as a struct: its list as ``data`` (``items`` each), ``more`` of its fields.

    No or null ``data`` is no records; text that is no JSON, or anything but a list there, is an
    error.
    """
    kind = ", ".join([f"data array<{items}>", *(f"{m} variant" for m in more), "_bad string"])
    options = {"columnNameOfCorruptRecord": "_bad"}
    bare = F.ltrim(text).startswith("[")
    listed = F.from_json(F.when(bare, text), f"array<{items}>")
    wrapped = F.from_json(F.when(~bare, text), kind, options)
    bad = F.when(bare, listed.isNull()).otherwise(wrapped["_bad"].isNotNull() | wrapped.isNull())
    data = F.when(bad, F.raise_error(F.lit("a response needs a list of records"))).when(bare, listed)
    data = data.otherwise(F.coalesce(wrapped["data"], F.array().cast(f"array<{items}>")))
    return F.struct(data.alias("data"), *(wrapped[m].alias(m) for m in more))


def read_responses(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Records of whole-document responses."""
    documents = _documents(spark, paths)
    records = _opened(F.col("value"), "variant")["data"]
    return documents.select(
        SOURCE_FILE, F.posexplode(records).alias(SOURCE_POSITION, "rec")
    ).select(
        SOURCE_FILE,
        F.col(SOURCE_POSITION).cast("bigint").alias(SOURCE_POSITION),
        "rec",
        F.lit(None).cast("string").alias("_text"),
    )


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Records of line-delimited files; a line that is not JSON has a null record and its text.

    The position is the byte offset of the split plus the row index inside the task.  A full
    split has a task to itself, so positions of one file never run into the next split.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(_paths(paths))
    rec = F.try_parse_json("value")
    return (
        lines.select(
            F.col("_metadata.file_path").alias(SOURCE_FILE),
            (
                F.col("_metadata.file_block_start")
                + F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))
            ).alias(SOURCE_POSITION),
            "value",
        )
        .filter(F.trim("value") != "")  # a length would be counted character by character
        .select(SOURCE_FILE, SOURCE_POSITION, rec.alias("rec"), "value")
        .select(SOURCE_FILE, SOURCE_POSITION, "rec", F.when(F.col("rec").isNull(), F.col("value")).alias("_text"))
    )


def read_envelopes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per response: declared count, error text, elapsed seconds, records held."""
    doc = _opened(F.col("value"), "string", "count", "error", "elapsed_seconds").alias("doc")

    def part(name: str, kind: str) -> Column:
        return F.try_variant_get(F.col("doc")[name], "$", kind)

    return _documents(spark, paths).select(SOURCE_FILE, doc).select(
        SOURCE_FILE,
        F.coalesce(part("count", "bigint"), F.lit(0)).alias("declared_count"),
        F.coalesce(part("error", "string"), F.lit("")).alias("error"),
        F.coalesce(part("elapsed_seconds", "double"), F.lit(0.0)).alias("elapsed_seconds"),
        F.size("doc.data").cast("bigint").alias("record_count"),
    )


def records_from_text(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Records already held as JSON text in a column of a frame."""
    return df.select(*keep, F.try_parse_json(F.col(text)).alias("rec"))
