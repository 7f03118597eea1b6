"""Small constant tables made of literals, so that plans see their true (tiny) size."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(
    spark: SparkSession, columns: dict[str, str], rows: Iterable[Sequence]
) -> DataFrame:
    """A table with the given ``name: type`` columns; one generated row set, no data shipping."""
    body = ", ".join(
        "struct("
        + ", ".join(f"{_sql(v)} as {name}" for name, v in zip(columns, row))
        + ")"
        for row in rows
    )
    made = spark.range(1).select(F.expr(f"inline(array({body}))"))
    return made.select(*[F.col(name).cast(kind) for name, kind in columns.items()])


def _sql(value) -> str:
    """A Python number, text or None as a SQL literal."""
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)
