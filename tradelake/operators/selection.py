"""Equality slices shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def narrow(
    df: DataFrame,
    *,
    reporter_code: int | None = None,
    partner_code: int | None = None,
    flow: str | None = None,
    commodity_code: str | None = None,
    period: str | None = None,
    year: int | None = None,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Rows matching every given value; the filters reach the scan."""
    if year is not None and years is not None:
        raise ValueError("give year or years, not both")
    wanted = {
        "reporter_code": reporter_code,
        "partner_code": partner_code,
        "flow_code": flow,
        "commodity_code": commodity_code,
        "period": period,
        "ref_year": year,
    }
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    if years is not None:
        df = df.filter(F.col("ref_year").isin([int(y) for y in years]))
    return df
