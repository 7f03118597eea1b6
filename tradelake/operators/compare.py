"""Side-by-side comparisons of countries, periods, commodities or partners.

All sides differ in one column only, so one ``IN`` filter and one aggregation serve any number
of sides; the per-side columns are conditional sums over the reduced rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions.literals import literal_table
from tradelake.functions.ratios import percent
from tradelake.operators import flow_totals as ft
from tradelake.operators.selection import narrow
from tradelake.schema import VALUE

BREAKDOWNS = {"commodity": "commodity_code", "partner": "partner_code", "period": "period"}
_LABELS = {"commodity": ("commodity_name",), "partner": ("partner_iso3", "partner_name")}


@dataclass(frozen=True)
class Comparison:
    """``rows`` per breakdown key, ``summary`` per side (before any limit), ``sides`` as named.

    Columns of ``rows`` are numbered by side: ``value_0`` is the baseline, ``delta_i`` and
    ``pct_change_i`` compare side *i* with it.
    """

    rows: DataFrame
    summary: DataFrame
    sides: DataFrame | None


def _key_label(breakdown_by: str) -> Column:
    """Readable label of a breakdown key from its first-seen code and name."""
    if breakdown_by == "commodity":
        return F.col("commodity_name")
    code, name = F.nullif(F.col("partner_iso3"), F.lit("")), F.nullif(
        F.col("partner_name"), F.lit("")
    )
    return F.coalesce(F.concat(code, F.lit(" — "), name), name, code, F.col("dimension_key"))


def compare_sides(
    df: DataFrame,
    *,
    axis: str,
    values: Sequence[int] | Sequence[str],
    breakdown_by: str,
    descending: bool = True,
    limit: int | None = None,
    labels: DataFrame | None = None,
    **shared,
) -> tuple[DataFrame, DataFrame]:
    """Rows and summary for the given axis values; the first value is the baseline.

    Labels are those first seen anywhere in ``df``.  That needs a second, three-column pass
    over the table; pass ``labels`` (a code list frame) to spare it.
    """
    ft.check_choice("breakdown_by", breakdown_by, tuple(BREAKDOWNS))
    values = list(values)
    if len(values) < 2:
        raise ValueError(f"at least 2 values to compare are needed; got {len(values)}")
    if len(set(values)) != len(values):
        raise ValueError(f"values to compare must differ; got {values}")
    if limit is not None and limit < 0:
        raise ValueError("limit must be non-negative")
    flow = shared.get("flow")
    if flow is not None:
        ft.check_choice("flow", flow, (ft.EXPORT, ft.IMPORT))

    dimension = BREAKDOWNS[breakdown_by]
    cells = (
        narrow(df, **shared)
        .filter(F.col(axis).isin(values))
        .groupBy(F.col(axis).alias("_side"), F.col(dimension).cast("string").alias("dimension_key"))
        .agg(F.sum(VALUE).alias(ft.AMOUNT), F.count(VALUE).alias(ft.VALUED))
    )
    amount, counted = F.col(ft.AMOUNT), F.col(ft.VALUED)
    sides = [F.col("_side") == F.lit(v) for v in values]
    measures = []
    for i, side in enumerate(sides):
        measures.append(ft.total(amount, side).alias(f"value_{i}"))
        measures.append(ft.count_where(counted, side).alias(f"record_count_{i}"))
        if i:
            signed = F.when(side, amount).when(sides[0], -amount)
            measures.append(F.coalesce(F.sum(signed), F.lit(0)).alias(f"delta_{i}"))
    rows = cells.groupBy("dimension_key").agg(*measures)
    last = f"delta_{len(values) - 1}"
    rows = ft.top(rows, last, ("dimension_key",), descending=descending, limit=limit)

    base = F.col("value_0")
    shape = [F.col("value_0"), F.col("record_count_0")]
    for i in range(1, len(values)):
        shape += [
            F.col(f"value_{i}"),
            F.col(f"record_count_{i}"),
            F.col(f"delta_{i}"),
            percent(F.col(f"delta_{i}"), base).alias(f"pct_change_{i}"),
        ]
    if breakdown_by == "period":
        named = rows.withColumn("dimension_label", F.col("dimension_key"))
    else:
        if labels is None:
            labels = ft.label_frame(df, dimension, _LABELS[breakdown_by])
        texts = labels.select(
            F.col(dimension).cast("string").alias("dimension_key"), *_LABELS[breakdown_by]
        )
        named = rows.join(texts, "dimension_key", "left").withColumn(
            "dimension_label", _key_label(breakdown_by)
        )
    order = F.col(last).desc() if descending else F.col(last).asc()
    named = named.select("dimension_key", "dimension_label", *shape).orderBy(
        order, "dimension_key"
    )
    return named, _summary(cells, values)


def _summary(cells: DataFrame, values: list) -> DataFrame:
    """One row per side in the given order, zero for a side without rows."""
    kind = "int" if isinstance(values[0], int) else "string"
    listed = literal_table(
        cells.sparkSession, {"side_no": "int", "_side": kind}, enumerate(values)
    )
    found = cells.groupBy("_side").agg(
        F.sum(ft.AMOUNT).alias("total_value"), F.sum(ft.VALUED).alias("total_records")
    )
    return (
        listed.join(found, "_side", "left")
        .select(
            "side_no",
            F.col("_side").cast("string").alias("label"),
            F.coalesce(F.col("total_value"), F.lit(0)).alias("total_value"),
            F.coalesce(F.col("total_records"), F.lit(0)).alias("total_records"),
        )
        .orderBy("side_no")
    )


def _named_sides(df: DataFrame, code: str, labels: tuple[str, ...], values: list) -> DataFrame:
    """First-seen labels of the compared codes."""
    return ft.label_frame(df.filter(F.col(code).isin(values)), code, labels)


def country_vs_country(
    df: DataFrame,
    *,
    reporter_codes: Sequence[int],
    breakdown_by: str = "commodity",
    flow: str | None = None,
    period: str | None = None,
    descending: bool = True,
    limit: int | None = None,
    labels: DataFrame | None = None,
) -> Comparison:
    """Compare reporters; without ``flow`` all four flows are summed."""
    codes = list(reporter_codes)
    rows, summary = compare_sides(
        df,
        axis="reporter_code",
        values=codes,
        breakdown_by=breakdown_by,
        descending=descending,
        limit=limit,
        labels=labels,
        flow=flow,
        period=period,
    )
    sides = _named_sides(df, "reporter_code", ("reporter_iso3", "reporter_name"), codes)
    return Comparison(rows, summary, sides)


def year_vs_year(
    df: DataFrame,
    *,
    reporter_code: int,
    period_a: str,
    period_b: str,
    breakdown_by: str = "commodity",
    flow: str | None = None,
    descending: bool = True,
    limit: int | None = None,
    labels: DataFrame | None = None,
) -> Comparison:
    """Compare two periods of one reporter; ``period_a`` is the baseline."""
    rows, summary = compare_sides(
        df,
        axis="period",
        values=[period_a, period_b],
        breakdown_by=breakdown_by,
        descending=descending,
        limit=limit,
        labels=labels,
        reporter_code=reporter_code,
        flow=flow,
    )
    sides = _named_sides(
        df, "reporter_code", ("reporter_iso3", "reporter_name"), [reporter_code]
    )
    return Comparison(rows, summary, sides)


def commodity_vs_commodity(
    df: DataFrame,
    *,
    commodity_codes: Sequence[str],
    reporter_code: int | None = None,
    breakdown_by: str = "partner",
    flow: str | None = None,
    period: str | None = None,
    descending: bool = True,
    limit: int | None = None,
    labels: DataFrame | None = None,
) -> Comparison:
    """Compare commodity codes, optionally for one reporter."""
    codes = list(commodity_codes)
    rows, summary = compare_sides(
        df,
        axis="commodity_code",
        values=codes,
        breakdown_by=breakdown_by,
        descending=descending,
        limit=limit,
        labels=labels,
        reporter_code=reporter_code,
        flow=flow,
        period=period,
    )
    return Comparison(
        rows, summary, _named_sides(df, "commodity_code", ("commodity_name",), codes)
    )


def partner_vs_partner(
    df: DataFrame,
    *,
    partner_codes: Sequence[int],
    reporter_code: int,
    breakdown_by: str = "commodity",
    flow: str | None = None,
    period: str | None = None,
    descending: bool = True,
    limit: int | None = None,
    labels: DataFrame | None = None,
) -> Comparison:
    """Compare partners of one reporter."""
    codes = list(partner_codes)
    rows, summary = compare_sides(
        df,
        axis="partner_code",
        values=codes,
        breakdown_by=breakdown_by,
        descending=descending,
        limit=limit,
        labels=labels,
        reporter_code=reporter_code,
        flow=flow,
        period=period,
    )
    sides = _named_sides(df, "partner_code", ("partner_iso3", "partner_name"), codes)
    return Comparison(rows, summary, sides)
