"""Trade balances: exports minus imports per country, partner or commodity, and overall."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.ratios import minus
from tradelake.operators.flow_totals import top, totals_by
from tradelake.operators.selection import narrow
from tradelake.schema import VALUE, sequence_or_zero


def _balances(df, key, labels, descending, limit):
    rows = totals_by(df, (key,), labels)
    return top(rows, "trade_balance", (key,), descending=descending, limit=limit)


def country_balance(
    df: DataFrame,
    *,
    reporter_code: int | None = None,
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Balance per reporting country, largest first."""
    picked = narrow(df, reporter_code=reporter_code)
    return _balances(
        picked, "reporter_code", ("reporter_iso3", "reporter_name"), descending, limit
    )


def partner_trade_balance(
    df: DataFrame, *, reporter_code: int, descending: bool = True, limit: int | None = None
) -> DataFrame:
    """Balance of one reporter with each of its partners."""
    picked = narrow(df, reporter_code=reporter_code)
    return _balances(
        picked, "partner_code", ("partner_iso3", "partner_name"), descending, limit
    )


def commodity_balance(
    df: DataFrame,
    *,
    reporter_code: int | None = None,
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Balance per commodity code."""
    picked = narrow(df, reporter_code=reporter_code)
    return _balances(picked, "commodity_code", ("commodity_name",), descending, limit)


def global_balance(df: DataFrame) -> DataFrame:
    """One row over everything; all zero for an empty table."""
    return totals_by(df, ())


def largest_net(df: DataFrame, by: str, limit: int = 5) -> DataFrame:
    """The same question asked in SQL over a view of stored balances."""
    spark = df.sparkSession
    name = f"balances_{uuid.uuid4().hex}"
    totals_by(df, (by,)).createTempView(name)
    try:
        return spark.sql(
            f"select {by}, total_exports, total_imports, trade_balance as net from {name} "
            f"order by abs(trade_balance) desc, {by} limit {int(limit)}"
        )
    finally:
        spark.catalog.dropTempView(name)


def composed_balance(df: DataFrame, *, reporter_code: int, **slice_of) -> DataFrame:
    """Exports and imports aggregated apart per partner, then matched by a full outer join.

    Partners seen on one side only read 0 on the other; the country code is taken from the
    export side and empty where there is none.
    """
    picked = narrow(df, reporter_code=reporter_code, **slice_of)
    iso, met = F.col("partner_iso3"), F.col("_met")
    cells = (
        narrow(picked, flow="X")
        .groupBy("partner_code", "partner_iso3")
        .agg(F.sum(VALUE).alias("_sum"), F.min(sequence_or_zero(df)).alias("_met"))
    )
    named = F.when(F.length(iso) > 0, F.struct(met, iso))
    exports = cells.groupBy("partner_code").agg(
        F.coalesce(F.sum("_sum"), F.lit(0)).alias("export_value"),
        F.min(named)["partner_iso3"].alias("partner_iso3"),
    )
    imports = narrow(picked, flow="M").groupBy("partner_code").agg(
        F.coalesce(F.sum(VALUE), F.lit(0)).alias("import_value")
    )
    net = minus(
        F.coalesce(F.col("export_value"), F.lit(0)), F.coalesce(F.col("import_value"), F.lit(0))
    )
    return (
        exports.join(imports, "partner_code", "full_outer")
        .select(
            "partner_code",
            F.coalesce(F.col("partner_iso3"), F.lit("")).alias("partner_iso3"),
            F.coalesce(F.col("export_value"), F.lit(0)).alias("export_value"),
            F.coalesce(F.col("import_value"), F.lit(0)).alias("import_value"),
            net.alias("net_trade"),
        )
        .orderBy("partner_code")
    )
