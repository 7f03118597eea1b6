"""Reports on commodities and nomenclature sections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.codes import hs_chapter, hs_digits, section_of, section_table
from tradelake.functions.ratios import ratio
from tradelake.operators import flow_totals as ft
from tradelake.operators.partner import period_points
from tradelake.operators.selection import narrow
from tradelake.schema import VALUE

HS_LEVELS = (2, 4, 6)


def top_hs_codes(
    df: DataFrame,
    *,
    reporter_code: int | None = None,
    flow: str | None = None,
    by: str = "total_trade",
    descending: bool = True,
    limit: int | None = None,
    hs_level: int | None = None,
) -> DataFrame:
    """Commodity codes ranked by a measure.

    ``hs_level`` keeps codes with exactly that many leading digits, which drops the ``TOTAL``
    rows; without it they stay.
    """
    ft.check_choice("by", by, ft.RANKING_FIELDS)
    if hs_level is not None and hs_level not in HS_LEVELS:
        raise ValueError(f"hs_level must be one of {HS_LEVELS}; got {hs_level!r}")
    picked = narrow(df, reporter_code=reporter_code, flow=flow)
    if hs_level is not None:
        picked = picked.filter(hs_digits(F.col("commodity_code")) == hs_level)
    rows = ft.totals_by(picked, ("commodity_code",), ("commodity_name",))
    return ft.top(
        rows,
        ft.ranking_measure(by),
        ("commodity_code",),
        descending=descending,
        limit=limit,
    )


def commodity_ranking(
    df: DataFrame, *, include_share: bool = False, reporter_code: int | None = None, **ranking
) -> DataFrame:
    """:func:`top_hs_codes` with each code's share of all trade of the reporter.

    The denominator takes every flow and code, whatever the ranking is limited to.
    """
    rows = top_hs_codes(df, reporter_code=reporter_code, **ranking)
    if not include_share:
        return rows.withColumn("share", F.lit(None).cast("double"))
    everything = narrow(df, reporter_code=reporter_code).agg(F.sum(VALUE))
    return rows.withColumn("share", ratio(F.col("total_trade"), everything.scalar()))


def ranked_commodities(
    df: DataFrame, *, reporter_code: int, flow: str = "X", hs_level: int = 2, limit: int = 10
) -> DataFrame:
    """The first ``limit`` codes with their position.  Numbering runs on the kept rows only."""
    rows = top_hs_codes(
        df, reporter_code=reporter_code, flow=flow, hs_level=hs_level, limit=limit
    )
    return number_rows(rows, F.col("total_trade").desc(), F.col("commodity_code")).select(
        "rank",
        "commodity_code",
        "commodity_name",
        F.col("total_exports").alias("export_value"),
        F.col("total_imports").alias("import_value"),
        "total_trade",
        "trade_balance",
        "record_count",
    )


def number_rows(df: DataFrame, *order) -> DataFrame:
    """1-based position over an aggregated report (one row per code, never raw facts)."""
    from pyspark.sql import Window

    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def commodity_trend(
    df: DataFrame,
    *,
    commodity_code: str,
    reporter_code: int | None = None,
    granularity: str = "year",
) -> DataFrame:
    """Trade in one code per (year, period); both granularities give the same points."""
    if not commodity_code:
        raise ValueError("commodity_code must not be empty")
    ft.check_choice("granularity", granularity, ("year", "period"))
    return period_points(
        narrow(df, commodity_code=commodity_code, reporter_code=reporter_code)
    )


def sector_summaries(
    df: DataFrame, *, reporter_code: int | None = None, flow: str | None = None
) -> DataFrame:
    """Always 22 rows: the 21 sections in order and one for codes outside them.

    Facts are first reduced to one row per (code, flow); sections are looked up on that.
    """
    names = ("total_exports", "total_imports", "total_trade", "trade_balance")
    chapter = hs_chapter(F.col("commodity_code"))
    found = (
        ft.by_flow(narrow(df, reporter_code=reporter_code, flow=flow), ("commodity_code",))
        .withColumn("sector_id", section_of(chapter))
        .groupBy("sector_id")
        .agg(
            *ft.flow_columns(names),
            ft.count_where(F.col(ft.ROWS)).alias("record_count"),
            F.array_sort(F.collect_set(F.coalesce(chapter, F.lit(0)))).alias("chapter_codes"),
            F.count_distinct("commodity_code").alias("hs_code_count"),
        )
    )
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in (*names, "record_count")]
    return (
        section_table(df.sparkSession)
        .join(found, "sector_id", "left")
        .orderBy("section_no")
        .select(
            "sector_id",
            "sector_name",
            *zero,
            F.coalesce("chapter_codes", F.array().cast("array<int>")).alias("chapter_codes"),
            F.coalesce(F.col("hs_code_count"), F.lit(0)).alias("hs_code_count"),
        )
    )


def commodity_partner_matrix(
    df: DataFrame, *, partner_codes: list[int], commodity_codes: DataFrame | None = None
) -> DataFrame:
    """Value per commodity (rows) and partner (columns); null where the pair has no value."""
    picked = df.filter(F.col("partner_code").isin(partner_codes))
    if commodity_codes is not None:
        picked = in_code_set(picked, commodity_codes)
    wide = (
        picked.filter(F.col(VALUE).isNotNull())
        .groupBy("commodity_code")
        .pivot("partner_code", partner_codes)
        .agg(F.sum(VALUE))
    )
    renamed = [F.col(f"`{p}`").alias(f"partner_{p}") for p in partner_codes]
    return wide.select("commodity_code", *renamed).orderBy("commodity_code")


def in_code_set(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows whose commodity code is in a code list frame (semi join)."""
    return df.join(codes.select("commodity_code").distinct(), "commodity_code", "left_semi")
