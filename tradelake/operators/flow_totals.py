"""The aggregation every trade report is built on.

Exports are ``X`` rows and imports ``M`` rows; re-exports and re-imports are counted as
records but never enter a total.

Two grouping steps.  The first groups the facts by (key, label, flow) and keeps only
fixed-width buffers (an exact sum, two counts, the lowest row number), so it hash-aggregates
map-side and a hot key leaves each task as a handful of rows.  The second folds those few
rows into one row per key and picks the label that was read first.  Carrying a text label as
an aggregate over the facts instead would force a sort of the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.schema import SEQ, VALUE, sequence_or_zero

EXPORT, IMPORT = "X", "M"

#: Columns of the first step.
AMOUNT, ROWS, VALUED, FIRST = "_amount", "_rows", "_valued", "_first"


def by_flow(df: DataFrame, keys: Sequence[str], labels: Sequence[str] = ()) -> DataFrame:
    """First step: one row per (keys, labels, flow) with amount, counts and lowest row number."""
    group = list(dict.fromkeys([*keys, *labels, "flow_code"]))
    return df.groupBy(*group).agg(
        F.sum(VALUE).alias(AMOUNT),
        F.count(F.lit(1)).alias(ROWS),
        F.count(VALUE).alias(VALUED),
        F.min(sequence_or_zero(df)).alias(FIRST),
    )


def total(amount: Column, when: Column | None = None) -> Column:
    """Exact sum of ``amount`` where ``when`` holds; 0 when nothing matches."""
    picked = amount if when is None else F.when(when, amount)
    return F.coalesce(F.sum(picked), F.lit(0))


def count_where(count: Column, when: Column | None = None) -> Column:
    picked = count if when is None else F.when(when, count)
    return F.coalesce(F.sum(picked), F.lit(0)).cast("bigint")


def first_seen(labels: Sequence[str], when: Column | None = None) -> Column:
    """The labels of the earliest row as a struct; equal row numbers fall back to label order."""
    packed = F.struct(FIRST, *labels)
    return F.min(packed if when is None else F.when(when, packed))


def flow_columns(
    names: tuple[str, str, str, str],
    *,
    side: str | None = None,
    when: Column | None = None,
) -> list[Column]:
    """Exports, imports, total and balance over a :func:`by_flow` frame.

    ``side`` limits the totals to one flow (the other side reads 0).  The total and the balance
    are sums of their own rather than ``x + m``: decimal addition would drop a digit of scale.
    """
    flow, amount = F.col("flow_code"), F.col(AMOUNT)
    is_x, is_m = flow == EXPORT, flow == IMPORT
    if side == EXPORT:
        is_m = F.lit(False)
    elif side == IMPORT:
        is_x = F.lit(False)
    if when is not None:
        is_x, is_m = is_x & when, is_m & when
    x, m, both, net = names
    return [
        total(amount, is_x).alias(x),
        total(amount, is_m).alias(m),
        total(amount, is_x | is_m).alias(both),
        F.coalesce(F.sum(F.when(is_x, amount).when(is_m, -amount)), F.lit(0)).alias(net),
    ]


def totals_by(
    df: DataFrame,
    keys: Sequence[str],
    labels: Sequence[str] = (),
    *,
    total_name: str = "total_trade",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per key: labels, exports, imports, total, balance and record count."""
    names = ("total_exports", "total_imports", total_name, "trade_balance")
    picked = [first_seen(labels).alias("_label")] if labels else []
    out = (
        by_flow(df, keys, labels)
        .groupBy(*keys)
        .agg(
            *picked,
            *flow_columns(names),
            count_where(F.col(ROWS)).alias("record_count"),
            *extra,
        )
    )
    return unpack(out, keys, labels)


def unpack(df: DataFrame, keys: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Spread ``_label`` into its columns, right after the keys."""
    if not labels:
        return df
    rest = [c for c in df.columns if c not in (*keys, "_label")]
    return df.select(*keys, *[F.col(f"_label.{c}").alias(c) for c in labels], *rest)


def label_frame(df: DataFrame, code: str, labels: Sequence[str]) -> DataFrame:
    """First-seen labels per code over a whole table: one row per code, small."""
    narrow = df.groupBy(code, *labels).agg(F.min(sequence_or_zero(df)).alias(FIRST))
    return unpack(
        narrow.groupBy(code).agg(first_seen(labels).alias("_label")), (code,), labels
    )


def top(
    df: DataFrame,
    by: Column | str,
    tie: Sequence[str],
    *,
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Order by a measure, equal measures by ascending code, optionally the first ``limit``."""
    if limit is not None and limit < 0:
        raise ValueError("limit must be non-negative")
    measure = F.col(by) if isinstance(by, str) else by
    ordered = df.orderBy(measure.desc() if descending else measure.asc(), *tie)
    return ordered if limit is None else ordered.limit(limit)


def check_choice(name: str, value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {sorted(allowed)}; got {value!r}")


def ranking_measure(by: str) -> Column:
    """Sort expression for a ranking field name."""
    if by == "abs_trade_balance":
        return F.abs(F.col("trade_balance"))
    return F.col({"exports": "total_exports", "imports": "total_imports"}.get(by, by))


# Fixed values.
RANKING_FIELDS = (
    "total_trade",
    "exports",
    "imports",
    "trade_balance",
    "abs_trade_balance",
    "record_count",
)

__all__ = [
    "AMOUNT",
    "EXPORT",
    "FIRST",
    "IMPORT",
    "RANKING_FIELDS",
    "ROWS",
    "SEQ",
    "VALUED",
    "by_flow",
    "check_choice",
    "count_where",
    "first_seen",
    "flow_columns",
    "label_frame",
    "ranking_measure",
    "top",
    "total",
    "totals_by",
    "unpack",
]
