"""The ``datasets`` table: one provenance row per write."""

from __future__ import annotations

import json
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schema import PARTITION_COLUMNS, SCHEMA_VERSION
from tradelake.sources.datasets import path_exists

REGISTRY = T.StructType(
    [
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("schema_version", T.StringType(), False),
        T.StructField("parser_name", T.StringType(), False),
        T.StructField("record_count", T.LongType(), False),
        T.StructField("skipped", T.LongType(), False),
        T.StructField("duplicates_removed", T.LongType(), False),
        T.StructField("source_count", T.LongType(), False),
        T.StructField("extracted_at", T.TimestampType()),
        T.StructField("stored_at", T.TimestampType(), False),
        T.StructField("partition_keys", T.StringType(), False),
        T.StructField("backend", T.StringType(), False),
        T.StructField("destination", T.StringType(), False),
        T.StructField("extra", T.StringType()),
    ]
)


def partition_keys(df: DataFrame) -> DataFrame:
    """Distinct (reporter, year, frequency) keys of a dataset, in order."""
    return df.select(*PARTITION_COLUMNS).distinct().orderBy(*PARTITION_COLUMNS)


def register(
    spark: SparkSession,
    registry_path: str,
    *,
    dataset_name: str,
    record_count: int,
    destination: str,
    backend: str,
    parser_name: str = "parse_records",
    skipped: int = 0,
    duplicates_removed: int = 0,
    source_count: int | None = None,
    extracted_at: datetime | None = None,
    keys: str = "",
    extra: dict[str, Any] | None = None,
) -> None:
    """Append one provenance row.  ``keys`` describes the partitions (their number may be large,
    so the list itself is read from the dataset with :func:`partition_keys`)."""
    now = datetime.now(UTC)
    row = (
        dataset_name,
        SCHEMA_VERSION,
        parser_name,
        record_count,
        skipped,
        duplicates_removed,
        record_count if source_count is None else source_count,
        extracted_at or now,
        now,
        keys or ",".join(PARTITION_COLUMNS),
        backend,
        destination,
        json.dumps(extra or {}, sort_keys=True),
    )
    spark.createDataFrame([row], REGISTRY).coalesce(1).write.mode("append").parquet(registry_path)


def history(spark: SparkSession, registry_path: str, dataset_name: str | None = None) -> DataFrame:
    """All provenance rows, newest first."""
    df = spark.read.schema(REGISTRY).parquet(registry_path)
    if dataset_name is not None:
        df = df.filter(F.col("dataset_name") == dataset_name)
    return df.orderBy(F.col("stored_at").desc())


def latest(spark: SparkSession, registry_path: str, dataset_name: str) -> DataFrame | None:
    """The newest provenance row of a dataset, None before the first write."""
    if not path_exists(spark, registry_path):
        return None
    return history(spark, registry_path, dataset_name).limit(1)


def dataset_summary(df: DataFrame, **provenance: Any) -> DataFrame:
    """One row about a dataset as it is: record count and the given provenance values."""
    shown = [F.lit(value).alias(name) for name, value in provenance.items()]
    return df.agg(F.count(F.lit(1)).alias("record_count")).select("record_count", *shown)
