"""Bringing a stored trade table up to date with a batch of records.

The batch is first reduced to one row per key.  ``append`` adds it; ``merge`` and ``replace``
both end as *existing rows whose key is not in the batch, plus the batch*.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from tradelake.operators.flow_totals import check_choice
from tradelake.operators.numbering import next_number
from tradelake.operators.quality import first_wins, last_wins
from tradelake.schema import (
    COMPOSITE_KEY,
    PARTITION_COLUMNS,
    SCHEMA_VERSION,
    SEQ,
    as_canonical,
    as_narrow,
    key_columns,
)
from tradelake.session import work_folder
from tradelake.sources import datasets, registry, versions

MODES = ("append", "merge", "replace")
DUPLICATES = ("keep_first", "keep_last")


class SchemaIncompatibleError(datasets.StorageError):
    """The batch does not fit the dataset it is meant for."""


def reduce_batch(
    batch: DataFrame, duplicates: str = "keep_last", *, order: Sequence[str] = (SEQ,)
) -> DataFrame:
    """One row per key of a batch."""
    check_choice("duplicates", duplicates, DUPLICATES)
    pick = first_wins if duplicates == "keep_first" else last_wins
    return pick(batch, order=order)


def _key_parts() -> list[Column]:
    """The key for joins, led by its hash: sorts compare one number instead of codes most rows share."""
    named = [c.alias(f"_key_{n}") for c, n in zip(key_columns(), COMPOSITE_KEY)]
    return [F.xxhash64(*key_columns()).alias("_key_hash"), *named]


def _with_key(df: DataFrame) -> DataFrame:
    return df.select("*", *_key_parts())


def _same_key(left: DataFrame, right: DataFrame) -> list[Column]:
    return [left[n] == right[n] for n in ("_key_hash", *(f"_key_{n}" for n in COMPOSITE_KEY))]


def untouched(existing: DataFrame, reduced: DataFrame) -> DataFrame:
    """Existing rows whose key the batch does not bring (anti join)."""
    keyed, keys = _with_key(existing), reduced.select(*_key_parts())
    return keyed.join(keys, _same_key(keyed, keys), "left_anti").select(*existing.columns)


def combine(existing: DataFrame, reduced: DataFrame, mode: str) -> DataFrame:
    """Table after the update, from an already reduced batch."""
    check_choice("mode", mode, MODES)
    kept = existing if mode == "append" else untouched(existing, reduced)
    return kept.unionByName(reduced)


def update_counts(existing: DataFrame, batch: DataFrame, reduced: DataFrame) -> DataFrame:
    """One row: batch rows added, keys present on both sides, duplicate rows in the batch.

    Rows of the three frames are tagged and grouped by key once.
    """
    sides = [
        df.select(*[c.alias(f"_key_{n}") for c, n in zip(key_columns(), COMPOSITE_KEY)], F.lit(k).alias("_side"))
        for k, df in enumerate((existing, batch, reduced))
    ]
    tagged = sides[0].unionByName(sides[1]).unionByName(sides[2])
    rows = [F.count_if(F.col("_side") == k).alias(n) for k, n in enumerate(("_old", "_given", "_new"))]
    by_key = tagged.groupBy(*[f"_key_{n}" for n in COMPOSITE_KEY]).agg(*rows)
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    return by_key.agg(
        total("_new").alias("records_added"),
        F.count_if((F.col("_old") > 0) & (F.col("_new") > 0)).alias("records_merged"),
        (total("_given") - total("_new")).alias("duplicates_in_input"),
    )


def check_compatible(
    latest: DataFrame | None, *, schema_version: str, parser_name: str
) -> tuple[bool, str]:
    """Whether a batch may go into a dataset, given the newest metadata row (if any)."""
    row = latest.first() if latest is not None else None
    if row is None:
        return True, ""
    given = {"schema_version": schema_version, "parser_name": parser_name}
    for name, value in given.items():
        if row[name] != value:
            return False, f"{name} mismatch: existing={row[name]!r}, new={value!r}"
    return True, ""


@dataclass(frozen=True)
class UpdateResult:
    mode: str
    records_added: int
    records_merged: int
    duplicates_in_input: int
    destination: str


def _partitions(df: DataFrame) -> DataFrame:
    return df.select(*PARTITION_COLUMNS).distinct()


def update_dataset(
    batch: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    mode: str = "merge",
    duplicates: str = "keep_last",
    latest_metadata: DataFrame | None = None,
    schema_version: str = SCHEMA_VERSION,
    parser_name: str = "parse_records",
    compression: str | None = None,
    registry_path: str | None = None,
    name: str = "trade",
    order: Sequence[str] | None = None,
) -> UpdateResult:
    """Update a stored, partitioned dataset.

    Only folders that hold a colliding row or receive a new one are read whole and rewritten.  A
    key may sit under another year or frequency than the batch row replacing it, so those folders
    are found by the key columns of the batch's reporters, in one pass that also counts the keys
    on both sides.  Rows of the batch are numbered on from the last stored number.  With
    ``registry_path`` a provenance row tells the new record count, and a batch of another schema or
    parser than the newest row's is refused (``latest_metadata`` stands in for that row).  ``order`` says which of the
    batch's rows of one key is the last, by default the reading order.

    A dataset that begins with an update is versioned, as is one that ``datasets.take_over`` was
    called for: the new content of those folders becomes a set of files of its own, and one rename
    puts it in force, so that readers see the state before or the state after, and an update that
    breaks off changes nothing.  An update that another one has overtaken raises
    ``versions.ConflictError`` and is simply made again.

    Datasets without versions are changed in place by a dynamic partition overwrite, which writes the
    new content aside and moves it in after its last row has been read.  A folder whose rows all moved elsewhere is deleted last; until then its rows are
    stale duplicates, so a failed update is repeated with ``merge``, which ends in the same state.
    """
    check_choice("mode", mode, MODES)
    spark = batch.sparkSession
    if latest_metadata is None and registry_path is not None:
        latest_metadata = registry.latest(spark, registry_path, name)
    fits, why = check_compatible(
        latest_metadata, schema_version=schema_version, parser_name=parser_name
    )
    if not fits:
        raise SchemaIncompatibleError(why)

    stage = f"{work_folder(spark).rstrip('/')}/update-{uuid.uuid4().hex}"
    columns = as_canonical(batch).columns
    order = order or ((SEQ,) if SEQ in columns else tuple(columns))
    given = as_narrow(batch, [*COMPOSITE_KEY, *order])
    # The reduced batch is used several times below; a written table is its single version.
    seen = Observation(f"update-{uuid.uuid4().hex}")
    watched = given.observe(seen, F.count(F.lit(1)).alias("n"))
    as_canonical(reduce_batch(watched, duplicates, order=order)).write.parquet(f"{stage}/batch")
    reduced, total = spark.read.parquet(f"{stage}/batch"), seen.get["n"]
    try:
        if not datasets.path_exists(spark, path):
            datasets.write_dataset(reduced, path, fmt, compression=compression, versioned=True)
            n = reduced.count()
            if registry_path is not None:
                registry.register(
                    spark,
                    registry_path,
                    dataset_name=name,
                    record_count=n,
                    destination=path,
                    backend=fmt,
                    parser_name=parser_name,
                    duplicates_removed=total - n,
                    source_count=total,
                )
            return UpdateResult(mode, n, 0, total - n, path)
        base = versions.newest(spark, path) if versions.is_versioned(spark, path) else None
        existing = datasets.read_dataset(spark, path, fmt, base)
        if SEQ in reduced.columns and SEQ in existing.columns:
            reduced = reduced.withColumn(SEQ, F.col(SEQ) + F.lit(next_number(datasets.stored_numbers(spark, path, fmt, base))))
        elif SEQ in reduced.columns:
            existing = existing.withColumn(SEQ, F.lit(None).cast("bigint"))
        elif SEQ in existing.columns:
            reduced = reduced.withColumn(SEQ, F.lit(None).cast("bigint"))
        # the stored rows with a key of the batch, by reporter folders and key columns only
        keys = reduced.select(*_key_parts())
        mine = _in_folders(existing, _partitions(reduced).select("reporter_code").distinct())
        here = _with_key(mine.select(*dict.fromkeys([*PARTITION_COLUMNS, *COMPOSITE_KEY])))
        here.join(keys, _same_key(here, keys), "left_semi").select(
            *PARTITION_COLUMNS, *[f"_key_{n}" for n in COMPOSITE_KEY]
        ).distinct().write.parquet(f"{stage}/colliding")
        colliding = spark.read.parquet(f"{stage}/colliding")
        merged = colliding.select(*[f"_key_{n}" for n in COMPOSITE_KEY]).distinct().count()
        added = reduced.count()
        if mode == "append" and base is None:
            datasets.write_dataset(reduced, path, fmt, mode="append", compression=compression)
        elif mode == "append":
            datasets.write_version(reduced, path, fmt, base=base, compression=compression)
        else:
            _rewrite(existing, colliding, reduced, path, fmt, stage, compression, base)
        if registry_path is not None:
            registry.register(
                spark,
                registry_path,
                dataset_name=name,
                record_count=datasets.stored_count(spark, path, fmt),
                destination=path,
                backend=fmt,
                parser_name=parser_name,
                duplicates_removed=total - added,
                source_count=total,
            )
    finally:
        datasets.delete_path(spark, stage)
    return UpdateResult(mode, added, merged, total - added, path)


#: Longest list of values a scan is pruned by; more of them touch most folders anyway, and the
#: join behind the filter is exact either way.
PRUNED_BY = 1000


def _in_folders(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` in wanted folders; as far as the lists are short, only those are read."""
    for column in wanted.columns:
        values = [r[0] for r in wanted.select(column).distinct().limit(PRUNED_BY + 1).collect()]
        if len(values) <= PRUNED_BY:
            df = df.filter(F.col(column).isin(values))
    names = df.columns
    return df.join(wanted, wanted.columns, "left_semi").select(*names)


def _left_empty(existing: DataFrame, colliding: DataFrame, reduced: DataFrame) -> list[Row]:
    """Folders all of whose rows move elsewhere.  At most one row per touched folder reaches the driver."""
    leaving = _partitions(colliding).join(_partitions(reduced), list(PARTITION_COLUMNS), "left_anti")
    if leaving.isEmpty():
        return []
    staying = _partitions(untouched(_in_folders(existing, leaving), reduced))
    return leaving.join(staying, list(PARTITION_COLUMNS), "left_anti").collect()


def _rewrite(
    existing: DataFrame,
    colliding: DataFrame,
    reduced: DataFrame,
    path: str,
    fmt: str,
    stage: str,
    compression: str | None,
    base: int | None,
) -> None:
    spark = existing.sparkSession
    _partitions(_partitions(colliding).unionByName(_partitions(reduced))).write.parquet(
        f"{stage}/folders"
    )
    folders = spark.read.parquet(f"{stage}/folders")

    rows = combine(_in_folders(existing, folders), reduced, "merge")
    if base is not None:
        datasets.write_version(rows, path, fmt, base=base, kept=folders, compression=compression)
        return
    left_empty = _left_empty(existing, colliding, reduced)
    datasets.write_dataset(
        rows, path, fmt, mode="overwrite", compression=compression, touched_only=True
    )
    for row in left_empty:
        parts = "/".join(f"{c}={row[c]}" for c in PARTITION_COLUMNS)
        datasets.delete_path(spark, f"{path.rstrip('/')}/{parts}")


def update_table(
    batch: DataFrame, table: str, *, mode: str = "merge", duplicates: str = "keep_last"
) -> UpdateResult:
    """The same update on a catalog table partitioned in the standard layout."""
    spark = batch.sparkSession
    if not spark.catalog.tableExists(table):
        given = as_canonical(batch)
        reduced = reduce_batch(given, duplicates)
        datasets.write_table(reduced, table)
        n = spark.table(table).count()
        return UpdateResult(mode, n, 0, given.count() - n, table)
    location = (
        spark.sql(f"describe formatted {table}")
        .filter("col_name = 'Location'")
        .first()["data_type"]
    )
    result = update_dataset(batch, location, mode=mode, duplicates=duplicates)
    spark.sql(f"msck repair table {table} sync partitions")
    spark.catalog.refreshTable(table)
    return UpdateResult(
        mode, result.records_added, result.records_merged, result.duplicates_in_input, table
    )
