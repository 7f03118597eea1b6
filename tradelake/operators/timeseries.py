"""Trends over time and the computations on a trend.

A trend has ``year, period, value, record_count, month``.  The follow-up computations take an
optional ``by`` list, so a table holding one series per reporter (or any key) is processed as a
whole, partitioned by that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.functions.codes import HAS_MONTH, HAS_YEAR
from tradelake.functions.ratios import compound_growth, ratio
from tradelake.operators.metrics import Metric
from tradelake.operators.selection import narrow


def annual_trend(
    df: DataFrame,
    *,
    reporter_code: int | None = None,
    flow: str | None = None,
    partner_code: int | None = None,
    commodity_code: str | None = None,
    metric: Metric | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """A metric per year of the period text; annual and monthly rows both count."""
    picked = narrow(
        df,
        reporter_code=reporter_code,
        flow=flow,
        partner_code=partner_code,
        commodity_code=commodity_code,
    )
    measure = metric or Metric.sum_primary_value()
    # Grouping by text leaves the conversion to numbers for the few finished rows.
    return (
        picked.filter(F.col("period").rlike(HAS_YEAR))
        .groupBy(*by, F.substring("period", 1, 4).alias("period"))
        .agg(measure.build().alias("value"), F.count(F.lit(1)).alias("record_count"))
        .select(
            *by,
            F.col("period").cast("int").alias("year"),
            "period",
            "value",
            "record_count",
            F.lit(None).cast("int").alias("month"),
        )
        .orderBy(*by, "year")
    )


def monthly_trend(
    df: DataFrame,
    *,
    reporter_code: int | None = None,
    flow: str | None = None,
    partner_code: int | None = None,
    commodity_code: str | None = None,
    metric: Metric | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """A metric per month; rows with an annual period are left out."""
    picked = narrow(
        df,
        reporter_code=reporter_code,
        flow=flow,
        partner_code=partner_code,
        commodity_code=commodity_code,
    )
    measure = metric or Metric.sum_primary_value()
    return (
        picked.filter(F.col("period").rlike(HAS_MONTH))
        .groupBy(*by, F.substring("period", 1, 6).alias("period"))
        .agg(measure.build().alias("value"), F.count(F.lit(1)).alias("record_count"))
        .select(
            *by,
            F.substring("period", 1, 4).cast("int").alias("year"),
            "period",
            "value",
            "record_count",
            F.substring("period", 5, 2).cast("int").alias("month"),
        )
        .orderBy(*by, "year", "month")
    )


def _in_time(by: Sequence[str]):
    order = [F.col("year"), F.coalesce(F.col("month"), F.lit(0))]
    return Window.partitionBy(*by).orderBy(*order)


def rolling_average(
    points: DataFrame, *, window: int = 3, field: str = "value", by: Sequence[str] = ()
) -> DataFrame:
    """Trailing mean over ``window`` points by position; the first points average what is there."""
    if window < 1:
        raise ValueError("window must be at least 1")
    frame = _in_time(by).rowsBetween(-(window - 1), Window.currentRow)
    mean = ratio(F.sum(field).over(frame), F.count(field).over(frame))
    return points.withColumn(field, mean)


def growth_rates(
    points: DataFrame, *, field: str = "value", by: Sequence[str] = ()
) -> DataFrame:
    """Change against the previous point; null for the first one and after a zero."""
    previous = F.lag(field).over(_in_time(by))
    return (
        points.withColumn("previous", previous)
        .withColumn("growth", ratio(F.col(field) - F.col("previous"), F.col("previous")))
        .select(
            *by,
            "year",
            "period",
            F.col(field).alias("value"),
            "previous",
            "growth",
            "record_count",
            "month",
        )
    )


def cagr_column(field: str = "value", years: int | None = None) -> Column:
    """Compound yearly growth between the first and last point, as an aggregate."""
    when = F.struct(F.col("year"), F.coalesce(F.col("month"), F.lit(0)))
    span = F.lit(years) if years is not None else F.max("year") - F.min("year")
    rate = compound_growth(F.min_by(field, when), F.max_by(field, when), span)
    return F.when(F.count(F.lit(1)) >= 2, rate)


def cagr(
    points: DataFrame,
    *,
    field: str = "value",
    years: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per series with its compound yearly growth, null where it is undefined."""
    return points.groupBy(*by).agg(cagr_column(field, years).alias("cagr"))
