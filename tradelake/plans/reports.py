"""Composed reports: several operators put together into one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake.functions.ratios import compound_growth, percent
from tradelake.operators.commodity import number_rows
from tradelake.operators.country import country_summary
from tradelake.operators.partner import partner_growth, partner_growth_points, top_partners
from tradelake.operators.timeseries import annual_trend, growth_rates
from tradelake.sources.datasets import open_dataset


def partner_share_report(
    df: DataFrame, *, reporter_code: int, limit: int | None = None
) -> DataFrame:
    """Partners in rank order with their trade as a percentage of the reporter's exports.

    The exports are added up over the ranked rows (one per partner), so the facts are read once.
    """
    partners = top_partners(df, reporter_code=reporter_code)
    exports = F.sum("total_exports").over(Window.partitionBy())
    ranked = number_rows(
        partners.withColumn("_exports", exports),
        F.col("total_trade").desc(),
        F.col("partner_code"),
    )
    if limit is not None:
        ranked = ranked.filter(F.col("rank") <= limit)
    share = F.when(F.col("_exports") > 0, percent(F.col("total_trade"), F.col("_exports")))
    return ranked.select(
        "rank",
        "partner_code",
        "partner_iso3",
        "partner_name",
        "total_trade",
        "trade_balance",
        F.coalesce(share, F.lit(0.0)).alias("share_pct"),
    )


def trend_report(df: DataFrame, *, reporter_code: int, flow: str = "X") -> DataFrame:
    """Yearly values with growth against the year before and the rate over the whole span."""
    points = annual_trend(df, reporter_code=reporter_code, flow=flow)
    # One row per year: a window over the whole series is a handful of rows.
    series = Window.orderBy("year").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rate = compound_growth(
        F.first("value").over(series),
        F.last("value").over(series),
        F.last("year").over(series) - F.first("year").over(series),
    )
    return growth_rates(points).select(
        "year", "value", "growth", "record_count", rate.alias("cagr")
    )


def partner_analysis(
    df: DataFrame,
    *,
    reporter_code: int,
    flow: str = "X",
    top_n: int = 10,
    focus_partner: int | None = None,
) -> dict[str, DataFrame]:
    """A partner ranking and, for one partner, its growth points and summary."""
    rows = top_partners(df, reporter_code=reporter_code, flow=flow, limit=top_n)
    out = {
        "top_partners": number_rows(rows, F.col("total_trade").desc(), F.col("partner_code"))
    }
    if focus_partner is not None:
        pair = {"reporter_code": reporter_code, "partner_code": focus_partner}
        out["growth"] = partner_growth(df, **pair)
        out["growth_points"] = partner_growth_points(df, **pair)
    return out


def stored_analysis(
    spark: SparkSession, path: str, *, reporter_code: int, limit: int = 10
) -> dict[str, DataFrame]:
    """Summary and partner ranking of one reporter, read from a stored dataset."""
    df = open_dataset(spark, path)
    return {
        "summary": country_summary(df, reporter_code),
        "top_partners": top_partners(df, reporter_code=reporter_code, limit=limit),
    }

