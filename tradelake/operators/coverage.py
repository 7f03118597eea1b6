"""Request-shaped slices of a stored table, and what a grid of requests would find in it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.codes import period_list
from tradelake.operators.quality import first_wins
from tradelake.schema import FLOW_CODES, SEQ, TOTAL_COMMODITY, WORLD_CODE

MAX_RECORDS = 250_000
PERIODS_PER_PAGE = 12


@dataclass(frozen=True)
class Slice:
    """A checked request: reporter and periods are required, everything else narrows further.

    Without a partner all partners match; the commodity defaults to the ``TOTAL`` rows.
    """

    reporter_code: int
    period: str | Sequence[str]
    commodity_code: str = TOTAL_COMMODITY
    flow_code: str | None = None
    partner_code: int | None = None
    partner2_code: int | None = None
    classification_code: str | None = None
    edition: str | None = None
    customs_code: str | None = None
    mot_code: int | None = None
    mos_code: str | int | None = None
    frequency_code: str | None = None
    max_records: int | None = None

    def __post_init__(self) -> None:
        whole = ("reporter_code", "partner_code", "partner2_code", "mot_code", "max_records")
        for name in whole:
            value = getattr(self, name)
            if value is None and name != "reporter_code":
                continue
            if isinstance(value, bool) or not isinstance(value, int):
                raise TypeError(f"{name} must be an integer; got {value!r}")
            if value < 0:
                raise ValueError(f"{name} must not be negative; got {value}")
        for name in ("commodity_code", "classification_code", "edition", "customs_code"):
            value = getattr(self, name)
            if value is not None and not str(value).strip():
                raise ValueError(f"{name} must not be empty")
        if self.flow_code is not None and self.flow_code not in FLOW_CODES:
            raise ValueError(f"flow_code must be one of {FLOW_CODES}; got {self.flow_code!r}")
        if self.max_records is not None and not 1 <= self.max_records <= MAX_RECORDS:
            raise ValueError(f"max_records must be in 1..{MAX_RECORDS}; got {self.max_records}")
        period_list(self.period)

    def apply(
        self, df: DataFrame, *, reporter_codes: Sequence[int] | None = None
    ) -> DataFrame:
        """Matching rows, the first ``max_records`` of them in reading order.

        ``reporter_codes`` asks for several reporters in place of the one.
        """
        df = df.filter(F.col("reporter_code").isin(reporter_codes or [self.reporter_code]))
        df = df.filter(F.col("period").isin(period_list(self.period)))
        for item in fields(self):
            value = getattr(self, item.name)
            if item.name in ("reporter_code", "period", "max_records") or value is None:
                continue
            wanted = str(value) if item.name == "mos_code" else value
            df = df.filter(F.col(item.name) == F.lit(wanted))
        if self.max_records is not None:
            df = df.orderBy(SEQ) if SEQ in df.columns else df
            df = df.limit(self.max_records)
        return df


def _annual(reporter_code: int, period, **rest) -> Slice:
    return Slice(reporter_code, period, frequency_code="A", **rest)


def _monthly(reporter_code: int, period, **rest) -> Slice:
    return Slice(reporter_code, period, frequency_code="M", **rest)


def exports(df: DataFrame, reporter_code: int, period, **rest) -> DataFrame:
    """Annual exports."""
    return _annual(reporter_code, period, flow_code="X", **rest).apply(df)


def imports(df: DataFrame, reporter_code: int, period, **rest) -> DataFrame:
    """Annual imports."""
    return _annual(reporter_code, period, flow_code="M", **rest).apply(df)


def trade(df: DataFrame, reporter_code: int, flow_code: str, period, **rest) -> DataFrame:
    """Annual trade of one flow."""
    return _annual(reporter_code, period, flow_code=flow_code, **rest).apply(df)


def by_hs(
    df: DataFrame, commodity_code: str, reporter_code: int, flow_code: str, period, **rest
) -> DataFrame:
    """Annual trade in one commodity code."""
    return trade(df, reporter_code, flow_code, period, commodity_code=commodity_code, **rest)


def world(df: DataFrame, reporter_code: int, flow_code: str, period, **rest) -> DataFrame:
    """Annual trade with the World aggregate."""
    return trade(df, reporter_code, flow_code, period, partner_code=WORLD_CODE, **rest)


def all_flows(df: DataFrame, reporter_code: int, period, **rest) -> DataFrame:
    """Annual rows of every flow, the input of a balance."""
    return _annual(reporter_code, period, **rest).apply(df)


def bilateral(
    df: DataFrame, reporter_code: int, partner_code: int, period, **rest
) -> DataFrame:
    """Annual rows of every flow with one partner."""
    return _annual(reporter_code, period, partner_code=partner_code, **rest).apply(df)


def matrix(df: DataFrame, reporter_codes: Sequence[int], period, **rest) -> DataFrame:
    """Annual rows of several reporters with all partners."""
    codes = list(reporter_codes)
    if not codes:
        raise ValueError("at least one reporter is needed")
    shared = [Slice(c, period, frequency_code="A", **rest) for c in codes][0]
    return shared.apply(df, reporter_codes=codes)


def monthly_exports(df: DataFrame, reporter_code: int, period, **rest) -> DataFrame:
    return _monthly(reporter_code, period, flow_code="X", **rest).apply(df)


def monthly_imports(df: DataFrame, reporter_code: int, period, **rest) -> DataFrame:
    return _monthly(reporter_code, period, flow_code="M", **rest).apply(df)


def monthly_trade(
    df: DataFrame, reporter_code: int, flow_code: str, period, **rest
) -> DataFrame:
    return _monthly(reporter_code, period, flow_code=flow_code, **rest).apply(df)


def line_level(
    df: DataFrame,
    reporter_code: int,
    flow_code: str,
    period,
    *,
    commodity_code: str | None = None,
    **rest,
) -> DataFrame:
    """Annual rows of one national tariff code, or the ``TOTAL`` rows without one."""
    code = TOTAL_COMMODITY if commodity_code is None else commodity_code
    return trade(df, reporter_code, flow_code, period, commodity_code=code, **rest)


def request_grid(
    spark: SparkSession,
    reporter_codes: Sequence[int],
    years: Sequence[int],
    partner_codes: Sequence[int],
) -> DataFrame:
    """Every (reporter, year, partner) request in download order, unfolded from literal lists."""

    def listed(values: Sequence[int]):
        return F.array(*[F.lit(int(v)) for v in values])

    return (
        spark.range(1)
        .select(F.posexplode(listed(reporter_codes)).alias("_r", "reporter_code"))
        .select("*", F.posexplode(listed(years)).alias("_y", "ref_year"))
        .select("*", F.posexplode(listed(partner_codes)).alias("_p", "partner_code"))
        .select(
            (
                F.col("_r") * len(years) * len(partner_codes)
                + F.col("_y") * len(partner_codes)
                + F.col("_p")
            ).alias("request_no"),
            "reporter_code",
            "ref_year",
            "partner_code",
        )
    )


def grid_coverage(
    df: DataFrame,
    reporter_codes: Sequence[int],
    years: Sequence[int],
    partner_codes: Sequence[int],
) -> DataFrame:
    """Records per request cell; a cell without records is not covered."""
    cell = ("reporter_code", "ref_year", "partner_code")
    held = (
        df.filter(
            F.col("reporter_code").isin(list(reporter_codes))
            & F.col("ref_year").isin(list(years))
            & F.col("partner_code").isin(list(partner_codes))
        )
        .groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
    grid = request_grid(df.sparkSession, reporter_codes, years, partner_codes)
    return (
        grid.join(held, list(cell), "left")
        .select(
            "request_no",
            *cell,
            F.coalesce(F.col("record_count"), F.lit(0)).alias("record_count"),
            F.col("record_count").isNotNull().alias("covered"),
        )
        .orderBy("request_no")
    )


def coverage_totals(coverage: DataFrame) -> DataFrame:
    """One row: cells, covered cells, empty cells, records."""
    return coverage.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("covered").alias("successful"),
        F.count_if(~F.col("covered")).alias("failed"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"),
    )


def pages(periods: str | Sequence[str], per_page: int = PERIODS_PER_PAGE) -> list[list[str]]:
    """Split a period list into pages of at most 12."""
    if not 1 <= per_page <= PERIODS_PER_PAGE:
        raise ValueError(f"a page holds 1..{PERIODS_PER_PAGE} periods; got {per_page}")
    tokens = period_list(periods)
    return [tokens[i : i + per_page] for i in range(0, len(tokens), per_page)]


def merge_pages(page_frames: Sequence[DataFrame], *, order: Sequence[str] = (SEQ,)) -> DataFrame:
    """Union of pages; a key on several pages is kept from the first page that has it."""
    return first_wins(combine(page_frames, "_page"), order=("_page", *order)).drop("_page")


def combine(frames: Sequence[DataFrame], number: str | None = None) -> DataFrame:
    """All rows of several datasets one after the other, duplicates included."""
    if not frames:
        raise ValueError("nothing to combine")
    out = None
    for i, df in enumerate(frames):
        df = df.withColumn(number, F.lit(i)) if number else df
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
