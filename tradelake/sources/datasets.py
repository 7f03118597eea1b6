"""Stored datasets: CSV, JSON and Parquet folders and catalog tables.

Files are laid out by reporter, year and frequency.  Rows are rebalanced on that layout before
writing, so a task does not open every folder, and a folder holding most of the table is split
over several tasks and files instead of going through one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schema import CANONICAL, FILE_ORDER, PARTITION_COLUMNS, SEQ, as_canonical, as_narrow
from tradelake.session import WRITERS, setting, shuffles_released, work_folder
from tradelake.sources import versions
from tradelake.sources.paths import delete_path, file_system, make_folder, path_exists

FORMATS = ("csv", "json", "parquet")
_SUFFIXES = {".csv": "csv", ".json": "json", ".parquet": "parquet", ".pq": "parquet"}
_COMPRESSED = (".gz", ".gzip", ".zst", ".snappy", ".bz2")


class StorageError(ValueError):
    """A dataset that cannot be written, found or read."""


def stored_schema() -> T.StructType:
    """Read schema: canonical columns and the row number."""
    return T.StructType([*CANONICAL.fields, T.StructField(SEQ, T.LongType())])


def file_order():
    """Row order within files: five key parts compared as text, missing as empty text."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FILE_ORDER]


def canonical_order(df: DataFrame) -> DataFrame:
    """The whole table in stored order (text order, so ``"10"`` sorts before ``"9"``)."""
    return df.orderBy(*file_order(), *([SEQ] if SEQ in df.columns else []))


def spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Move rows to where their folder is written, in their canonical columns.

    Rebalancing merges small pieces into files of a good size and splits folders too big for a
    task; without folders it evens out the files.  Rows travel and are sorted as narrow as they came:
    absent columns and wide amounts are made afterwards, and the texts of the order are made once a
    row, not in every comparison.  Columns that name the folder say nothing about the order in it.
    """
    rows = as_narrow(df, [*partition_by, *FILE_ORDER]).hint("rebalance", *partition_by)
    texts = {f"_text_{c}": t for c, t in zip(FILE_ORDER, file_order()) if c not in partition_by}
    return as_canonical(rows.withColumns(texts).sortWithinPartitions(*partition_by, *texts))


def _compression(fmt: str, name: str | None) -> str | None:
    if name is None:
        return None
    if fmt in ("csv", "json") and name not in ("none", "gzip"):
        raise StorageError(f"{fmt} compression must be 'none' or 'gzip'; got {name!r}")
    return name


def write_dataset(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    mode: str = "error",
    compression: str | None = None,
    touched_only: bool = False,
    versioned: bool = False,
    laid_out: bool = False,
) -> None:
    """Write a trade table in its canonical columns.

    ``partition_by=()`` writes without folders.  Overwriting replaces the whole dataset, or with
    ``touched_only`` just the folders that receive rows.  CSV has a header and plain decimal text,
    JSON is one object per line with decimals as text, so no digit is lost in either.

    ``versioned`` begins a dataset whose changes come into force in one step (see
    :mod:`tradelake.sources.versions`); whatever is written to it later becomes a version, too.

    ``laid_out`` is for rows that lie by folder already, as those of a stored dataset do: every task
    writes what it reads, in that order, and nothing is moved or sorted.  Of other rows it would make
    many small files.
    """
    if fmt not in FORMATS:
        raise StorageError(f"format must be one of {FORMATS}; got {fmt!r}")
    spark = df.sparkSession
    going_on = mode in ("append", "overwrite") and versions.is_versioned(spark, path)
    if versioned or going_on:
        if tuple(partition_by) != PARTITION_COLUMNS:
            raise StorageError(f"versions are kept by {PARTITION_COLUMNS}; got {tuple(partition_by)}")
        if not going_on and path_exists(spark, path):
            raise StorageError(f"{path} exists already")
        # from here on the path counts as versioned, so that a first write can be made again
        make_folder(spark, f"{path.rstrip('/')}/{versions.LISTS}")
        base = versions.newest(spark, path)
        kept = "others" if touched_only else "all" if mode == "append" else "none"
        write_version(df, path, fmt, base=base, kept=kept, compression=compression)
        return
    codec = _compression(fmt, compression)
    out = as_canonical(df) if laid_out else spread(df, partition_by)
    if fmt != "parquet":
        out = out.select(
            *[
                F.col(f.name).cast("string").alias(f.name)
                if isinstance(f.dataType, T.DecimalType)
                else F.col(f.name)
                for f in out.schema
            ]
        )
    writer = out.write.mode(mode).partitionBy(*partition_by)
    writer = writer.option("partitionOverwriteMode", "dynamic" if touched_only else "static")
    if codec is not None:
        writer = writer.option("compression", codec)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"', emptyValue="", nullValue="")
    with _writing(spark, laid_out):
        writer.format(fmt).save(path)


#: Folders a task writes side by side when its rows are laid out already; a task of Spark's usual
#: 128 MB reads 32 files at most, as each counts 4 MB at least.
SIDE_BY_SIDE = 64


@contextmanager
def _writing(spark: SparkSession, laid_out: bool) -> Iterator[None]:
    """Settings of a write: what it moves is of no use once the rows are stored, and goes with it."""
    with shuffles_released(spark), setting(spark, WRITERS, str(SIDE_BY_SIDE)) if laid_out else nullcontext():
        yield


def write_version(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    base: int,
    kept: str | DataFrame = "all",
    compression: str | None = None,
) -> int:
    """Write rows as a new set and put the version after ``base`` in force; returns its number.

    ``kept`` says which folders of ``base`` stay: ``all``, ``none``, the ``others`` that receive no
    rows, or those outside a frame of folder keys.
    """
    spark, name = df.sparkSession, versions.new_set()
    where = f"{path.rstrip('/')}/{versions.SET}={name}"
    write_dataset(df, where, fmt, compression=compression)
    old = versions.listed(spark, path, base)
    new = spark.createDataFrame([], versions.LISTED)
    if _holds_folders(spark, where):
        new = versions.counted(read_dataset(spark, where, fmt), name)
    if isinstance(kept, DataFrame):
        old = old.join(kept, list(PARTITION_COLUMNS), "left_anti")
    elif kept == "others":
        old = old.join(new, list(PARTITION_COLUMNS), "left_anti")
    return versions.commit(spark, path, base, new if isinstance(kept, str) and kept == "none" else old.unionByName(new))


def take_over(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Make a dataset stored in the standard layout a versioned one; its files stay where they are."""
    if versions.is_versioned(spark, path):
        raise StorageError(f"{path} has versions already")
    rows = read_dataset(spark, path, fmt)
    return versions.commit(spark, path, 0, versions.counted(rows, ""))


def _holds_folders(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return any(s.isDirectory() for s in _children(fs, hadoop_path))


def stored_numbers(spark: SparkSession, path: str, fmt: str, version: int | None = None) -> DataFrame:
    """Row numbers of a stored dataset, or the largest of each folder where versions list those."""
    if versions.is_versioned(spark, path):
        return versions.listed(spark, path, version).select(F.col("last_row").alias(SEQ))
    return read_dataset(spark, path, fmt)


def stored_count(spark: SparkSession, path: str, fmt: str) -> int:
    """Rows of a stored dataset; versions list them by folder, so their rows are not read."""
    if versions.is_versioned(spark, path):
        return versions.listed(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return read_dataset(spark, path, fmt).count()


def read_dataset(
    spark: SparkSession, path: str, fmt: str = "parquet", version: int | None = None
) -> DataFrame:
    """Read a stored dataset with the canonical types; text that does not fit is an error.

    The stored row number comes back when the dataset has one.  Of a versioned dataset the version
    in force is read, or an older one by its number.
    """
    if fmt not in FORMATS:
        raise StorageError(f"format must be one of {FORMATS}; got {fmt!r}")
    if not versions.is_versioned(spark, path):
        if version is not None:
            raise StorageError(f"{path} has no versions")
        return _read(spark, spark.read, path, fmt)
    parts = [
        _read(spark, spark.read.option("basePath", path), folders, fmt)
        for folders in versions.live_folders(spark, path, version)
        if folders
    ]
    if not parts:
        return spark.createDataFrame([], stored_schema())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read(spark: SparkSession, reader: DataFrameReader, path: str | list[str], fmt: str) -> DataFrame:
    reader = reader.format(fmt)
    if fmt == "csv":
        # Columns are matched by header, not by position.
        names = [n for n in reader.options(header=True).load(path).columns if n != versions.SET]
        kinds = {f.name: f.dataType for f in stored_schema()}
        unknown = [n for n in names if n not in kinds]
        if unknown:
            raise StorageError(f"unknown columns in {path}: {unknown}")
        schema = T.StructType([T.StructField(n, kinds[n]) for n in names])
        df = reader.options(
            header=True, escape='"', emptyValue="", nullValue="", mode="FAILFAST"
        ).load(path, schema=schema)
        has_seq = SEQ in names
    elif fmt == "json":
        df = reader.option("mode", "FAILFAST").load(path, schema=stored_schema())
        has_seq = True
    else:
        df = reader.load(path)
        has_seq = SEQ in df.columns
    picked = [F.col(f.name).cast(f.dataType).alias(f.name) for f in CANONICAL]
    return df.select(*(_present() if fmt == "json" else picked), *([SEQ] if has_seq else []))


def _present() -> list[Column]:
    """The canonical columns; a required one without a value is an error, not a null.

    Columns that name folders stay bare, so that filters on them still choose folders.
    """
    return [
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.nullable or f.name in PARTITION_COLUMNS
        else F.coalesce(
            F.col(f.name).cast(f.dataType), F.raise_error(F.lit(f"no value in required column {f.name}"))
        ).alias(f.name)
        for f in CANONICAL
    ]


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """Rows kept as whole JSON documents: ``{"records": [...], ...}`` or a bare list of rows.

    For taking over existing files; one document is one row until its list is unfolded, so
    volume belongs into the line layout of :func:`write_dataset`.  Files ending in
    ``.meta.json`` describe a dataset and are left out.
    """
    text = (
        spark.read.option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
        .filter(~F.col("_metadata.file_path").endswith(".meta.json"))
    )
    rows = T.ArrayType(CANONICAL)
    options = {"mode": "FAILFAST"}
    bare = F.ltrim("value").startswith("[")
    listed = F.from_json(F.when(bare, F.col("value")), rows, options)
    wrapped = F.from_json(
        F.when(~bare, F.col("value")), T.StructType([T.StructField("records", rows)]), options
    )["records"]
    unfolded = text.select(F.inline(F.coalesce(listed, wrapped)))
    return unfolded.select(*_present())


# -- finding out what is stored ---------------------------------------------------------------


def _visible(name: str) -> bool:
    return not name.startswith(("_", ".")) and not name.endswith(".meta.json")


def _children(fs, hadoop_path) -> Iterator:
    listed = sorted(fs.listStatus(hadoop_path), key=lambda s: s.getPath().getName())
    return (s for s in listed if _visible(s.getPath().getName()))


def _format_of_name(name: str) -> str | None:
    name = name.lower()
    for ending in _COMPRESSED:
        name = name.removesuffix(ending)
    return next((f for suffix, f in _SUFFIXES.items() if name.endswith(suffix)), None)


def detect_format(spark: SparkSession, path: str, version: int | None = None) -> str:
    """Format of a file by its suffix, of a folder by the first data file in it."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        raise StorageError(f"no dataset at {path}")
    if versions.is_versioned(spark, path):
        path = next((p for paths in versions.live_folders(spark, path, version) for p in paths), path)
        fs, hadoop_path = file_system(spark, path)
    waiting = [fs.getFileStatus(hadoop_path)]
    while waiting:
        status = waiting.pop(0)
        if status.isDirectory():
            # Depth first: the first folder decides, later ones are not listed.
            waiting = [*_children(fs, status.getPath()), *waiting]
            continue
        found = _format_of_name(status.getPath().getName())
        if found:
            return found
    raise StorageError(f"no csv, json or parquet data at {path}")


def open_dataset(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Read whatever format is stored at a path; JSON as lines of rows or as whole documents.

    ``version`` picks an older version of a versioned dataset.
    """
    if versions.is_versioned(spark, path):
        if not any(versions.live_folders(spark, path, version)):
            return spark.createDataFrame([], stored_schema())
        return read_dataset(spark, path, detect_format(spark, path, version), version)
    fmt = detect_format(spark, path)
    if fmt == "json" and not _starts_with_a_row(spark, path):
        return read_json_documents(spark, path)
    return read_dataset(spark, path, fmt, version)


def _starts_with_a_row(spark: SparkSession, path: str) -> bool:
    """Whether the first line that is not blank opens an object with a canonical column."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = lines.filter(~F.col("_metadata.file_path").endswith(".meta.json"))
    first = lines.filter("trim(value) <> ''").select(F.substring("value", 1, 200)).first()
    key = re.match(r'\s*\{\s*"([^"]+)"', first[0]) if first else None
    return first is None or (key is not None and key[1] in stored_schema().names)


# -- tables -----------------------------------------------------------------------------------


def write_table(
    df: DataFrame,
    table: str,
    *,
    overwrite: bool = False,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    laid_out: bool = False,
) -> None:
    """Append to a catalog table, or replace it with ``overwrite``; ``laid_out`` as for :func:`write_dataset`.

    A replacement is written whole to the shared work folder first, so the rows may come from the
    table itself, and rows that fail to compute leave it as it was.  Should moving the finished rows
    in break off, they stay in that folder, which the error names.
    """
    spark = df.sparkSession
    out = as_canonical(df) if laid_out else spread(df, partition_by)
    exists = spark.catalog.tableExists(table)
    if exists and not overwrite:
        with _writing(spark, laid_out):
            out.select(*spark.table(table).columns).write.insertInto(table)
        return
    if not exists:
        with _writing(spark, laid_out):
            out.write.format("parquet").partitionBy(*partition_by).saveAsTable(table)
        return
    stage = f"{work_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    out.write.parquet(stage)
    rows = spark.read.schema(out.schema).parquet(stage).select(*spark.table(table).columns)
    try:
        rows.write.option("partitionOverwriteMode", "static").insertInto(table, overwrite=True)
    except Exception as exc:
        raise StorageError(f"{table} may be incomplete; its new rows are kept at {stage}") from exc
    delete_path(spark, stage)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    if not spark.catalog.tableExists(table):
        raise StorageError(f"no table {table!r}")
    df = spark.table(table)
    return df.select(*CANONICAL.names, *([SEQ] if SEQ in df.columns else []))


def load_partition(df: DataFrame, key: tuple[int, int, str], view: str | None = None) -> DataFrame:
    """One (reporter, year, frequency) slice; on a stored dataset only its folder is read."""
    if len(key) != len(PARTITION_COLUMNS):
        raise StorageError(f"a partition key has {len(PARTITION_COLUMNS)} parts; got {key!r}")
    for column, value in zip(PARTITION_COLUMNS, key):
        df = df.filter(F.col(column) == F.lit(value))
    if view:
        df.createOrReplaceTempView(view)
    return df


def sql(df: DataFrame, statement: str, view: str = "trade") -> DataFrame:
    """Run a SQL statement with the dataset under a view name."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(statement)
