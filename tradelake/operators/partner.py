"""Reports on the trading partners of one reporter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.ratios import compound_growth, minus, ratio
from tradelake.operators import flow_totals as ft
from tradelake.operators.selection import narrow

LABELS = ("partner_iso3", "partner_name")


def top_partners(
    df: DataFrame,
    *,
    reporter_code: int,
    flow: str | None = None,
    by: str = "total_trade",
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Partners of a reporter ranked by a measure.

    ``flow`` decides which partners appear, what ``record_count`` counts and where the label
    comes from.  The sums run over all the reporter's rows; ``X`` and ``M`` blank the opposite
    side, re-flows blank neither.
    """
    ft.check_choice("by", by, ft.RANKING_FIELDS)
    matching = F.lit(True) if flow is None else F.col("flow_code") == F.lit(flow)
    names = ("total_exports", "total_imports", "total_trade", "trade_balance")
    rows = (
        ft.by_flow(narrow(df, reporter_code=reporter_code), ("partner_code",), LABELS)
        .groupBy("partner_code")
        .agg(
            ft.first_seen(LABELS, matching).alias("_label"),
            *ft.flow_columns(names, side=flow),
            ft.count_where(F.col(ft.ROWS), matching).alias("record_count"),
        )
        .filter(F.col("record_count") > 0)
    )
    rows = ft.unpack(rows, ("partner_code",), LABELS)
    return ft.top(
        rows, ft.ranking_measure(by), ("partner_code",), descending=descending, limit=limit
    )


def partner_balance(
    df: DataFrame,
    *,
    reporter_code: int,
    by: str = "trade_balance",
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """All partners of a reporter in balance layout."""
    return top_partners(
        df, reporter_code=reporter_code, by=by, descending=descending, limit=limit
    ).select(
        "partner_code",
        *LABELS,
        "total_exports",
        "total_imports",
        "trade_balance",
        "total_trade",
        "record_count",
    )


def partner_growth_points(
    df: DataFrame, *, reporter_code: int, partner_code: int
) -> DataFrame:
    """The pair's trade per (year, period), in time order."""
    return period_points(narrow(df, reporter_code=reporter_code, partner_code=partner_code))


def period_points(df: DataFrame) -> DataFrame:
    """Trade per (year, period) of whatever rows are given, in time order."""
    names = ("exports", "imports", "total_trade", "_net")
    return (
        ft.by_flow(df, ("ref_year", "period"))
        .groupBy("ref_year", "period")
        .agg(*ft.flow_columns(names), ft.count_where(F.col(ft.ROWS)).alias("record_count"))
        .select(
            F.col("ref_year").alias("year"),
            "period",
            "total_trade",
            "exports",
            "imports",
            "record_count",
        )
        .orderBy("year", "period")
    )


def partner_growth(
    df: DataFrame, *, reporter_code: int, partner_code: int, granularity: str = "year"
) -> DataFrame:
    """Change between the pair's first and last point, as one row (none without records).

    The compound rate is given for yearly granularity only, when the points span years.
    """
    ft.check_choice("granularity", granularity, ("year", "period"))
    points = partner_growth_points(df, reporter_code=reporter_code, partner_code=partner_code)
    when = F.struct("year", "period")
    ends = points.agg(
        F.min_by("total_trade", when).alias("first_trade"),
        F.max_by("total_trade", when).alias("last_trade"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count(F.lit(1)).alias("point_count"),
    ).filter(F.col("point_count") > 0)
    change = minus(F.col("last_trade"), F.col("first_trade"))
    rate = F.lit(None).cast("double")
    if granularity == "year":
        rate = F.when(
            F.col("point_count") >= 2,
            compound_growth(
                F.col("first_trade"), F.col("last_trade"), F.col("last_year") - F.col("first_year")
            ),
        )
    return ends.select(
        F.lit(reporter_code).alias("reporter_code"),
        F.lit(partner_code).alias("partner_code"),
        "point_count",
        "first_year",
        "last_year",
        change.alias("absolute_change"),
        ratio(change, F.col("first_trade")).alias("relative_change"),
        rate.alias("cagr"),
    )


def bilateral_summary(df: DataFrame, *, reporter_code: int, partner_code: int) -> DataFrame:
    """What a pair of countries report about each other, as one row (none without records).

    Both directions are added up as reported: each side's exports to the other count as
    exports, so mirror flows are summed, not reconciled.  The label is the partner as named by
    the reporter, or as named on the mirror side when the reporter has no rows.
    """
    ours = (F.col("reporter_code") == reporter_code) & (F.col("partner_code") == partner_code)
    mirror = (F.col("reporter_code") == partner_code) & (F.col("partner_code") == reporter_code)
    grouped = ft.by_flow(
        df.filter(ours | mirror), ("reporter_code", "partner_code", "ref_year"), LABELS
    )
    # A country paired with itself is on both sides, so it is given a row for each.
    sides = F.array_compact(
        F.array(F.when(ours, F.lit("ours")), F.when(mirror, F.lit("mirror")))
    )
    sided = grouped.withColumn("side", F.explode(sides))
    on_ours, on_mirror = F.col("side") == "ours", F.col("side") == "mirror"
    amount, flow = F.col(ft.AMOUNT), F.col("flow_code")
    is_x, is_m = flow == ft.EXPORT, flow == ft.IMPORT
    rows = sided.agg(
        F.coalesce(ft.first_seen(LABELS, on_ours), ft.first_seen(LABELS, on_mirror)).alias(
            "_label"
        ),
        ft.total(amount, on_ours & is_x).alias("reporter_to_partner_exports"),
        ft.total(amount, on_ours & is_m).alias("reporter_to_partner_imports"),
        ft.total(amount, on_mirror & is_x).alias("partner_to_reporter_exports"),
        ft.total(amount, on_mirror & is_m).alias("partner_to_reporter_imports"),
        ft.total(amount, is_x).alias("total_exports"),
        ft.total(amount, is_m).alias("total_imports"),
        ft.total(amount, is_x | is_m).alias("total_trade"),
        ft.count_where(F.col(ft.ROWS)).alias("record_count"),
        F.min("ref_year").alias("first_year"),
        F.max("ref_year").alias("last_year"),
    ).filter(F.col("record_count") > 0)
    return rows.select(
        F.lit(reporter_code).alias("reporter_code"),
        F.lit(partner_code).alias("partner_code"),
        *[F.col(f"_label.{c}").alias(c) for c in LABELS],
        "reporter_to_partner_exports",
        "reporter_to_partner_imports",
        "partner_to_reporter_exports",
        "partner_to_reporter_imports",
        "total_exports",
        "total_imports",
        "total_trade",
        "record_count",
        "first_year",
        "last_year",
    )
