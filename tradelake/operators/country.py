"""Reports on reporting countries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.operators import flow_totals as ft
from tradelake.operators.selection import narrow
from tradelake.schema import VALUE

LABELS = ("reporter_iso3", "reporter_name")


def _total(df, flow, name, reporter_code, year, years):
    picked = narrow(df, reporter_code=reporter_code, flow=flow, year=year, years=years)
    return picked.agg(ft.total(F.col(VALUE)).alias(name))


def total_imports(
    df: DataFrame,
    *,
    reporter_code: int | None = None,
    year: int | None = None,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Sum of imports, 0 when nothing matches."""
    return _total(df, ft.IMPORT, "total_imports", reporter_code, year, years)


def total_exports(
    df: DataFrame,
    *,
    reporter_code: int | None = None,
    year: int | None = None,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Sum of exports, 0 when nothing matches."""
    return _total(df, ft.EXPORT, "total_exports", reporter_code, year, years)


# Fixed values.
RANKING_FIELDS = ("total_trade_value", "exports", "imports", "trade_balance", "record_count")


def country_ranking(
    df: DataFrame,
    *,
    flow: str | None = None,
    by: str = "total_trade_value",
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Reporters ranked by a measure.

    With ``flow`` only countries having such rows appear and the other side reads 0.  Labels
    come from the first row of the whole table, so the flow is a condition inside the one
    aggregation pass rather than a filter in front of it.  ``record_count`` counts rows that
    carry a value.
    """
    ft.check_choice("by", by, RANKING_FIELDS)
    wanted = F.lit(True) if flow is None else F.col("flow_code") == F.lit(flow)
    names = ("total_exports", "total_imports", "total_trade_value", "trade_balance")
    rows = (
        ft.by_flow(df, ("reporter_code",), LABELS)
        .groupBy("reporter_code")
        .agg(
            ft.first_seen(LABELS).alias("_label"),
            *ft.flow_columns(names, when=wanted),
            ft.count_where(F.col(ft.VALUED), wanted).alias("record_count"),
            ft.count_where(F.col(ft.ROWS), wanted).alias("_matching"),
        )
        .filter(F.col("_matching") > 0)
        .drop("_matching")
    )
    rows = ft.unpack(rows, ("reporter_code",), LABELS)
    return ft.top(
        rows, ft.ranking_measure(by), ("reporter_code",), descending=descending, limit=limit
    )


def country_summary(df: DataFrame, reporter_code: int) -> DataFrame:
    """One row for one reporter, no row when it has no records.

    World (partner 0) counts as a partner.
    """
    names = ("total_exports", "total_imports", "total_trade", "trade_balance")
    rows = (
        ft.by_flow(
            narrow(df, reporter_code=reporter_code),
            ("reporter_code", "partner_code", "ref_year"),
            LABELS,
        )
        .groupBy("reporter_code")
        .agg(
            ft.first_seen(LABELS).alias("_label"),
            *ft.flow_columns(names),
            F.count_distinct("partner_code").alias("partner_count"),
            ft.count_where(F.col(ft.ROWS)).alias("record_count"),
            F.min("ref_year").alias("first_year"),
            F.max("ref_year").alias("last_year"),
        )
    )
    return ft.unpack(rows, ("reporter_code",), LABELS)


def country_trend(
    df: DataFrame, reporter_code: int, *, granularity: str = "year"
) -> DataFrame:
    """Exports and imports of one reporter per year or per period, in time order.

    A yearly point carries the period text of the year's first row; a period point carries the
    year of the period's first row.
    """
    ft.check_choice("granularity", granularity, ("year", "period"))
    key, label = ("ref_year", "period") if granularity == "year" else ("period", "ref_year")
    names = ("exports", "imports", "total_trade", "trade_balance")
    rows = (
        ft.by_flow(narrow(df, reporter_code=reporter_code), (key,), (label,))
        .groupBy(key)
        .agg(
            ft.first_seen((label,)).alias("_label"),
            *ft.flow_columns(names),
            ft.count_where(F.col(ft.ROWS)).alias("record_count"),
        )
    )
    return (
        ft.unpack(rows, (key,), (label,))
        .select(F.col("ref_year").alias("year"), "period", *names, "record_count")
        .orderBy("year", "period")
    )


def trend_totals(trend: DataFrame) -> DataFrame:
    """Totals and the covered years of a trend."""
    return trend.agg(
        F.array_sort(F.collect_set("year")).alias("years"),
        ft.total(F.col("exports")).alias("total_exports"),
        ft.total(F.col("imports")).alias("total_imports"),
        ft.total(F.col("total_trade")).alias("total_trade"),
    )
