"""

``queries()`` only wires library calls to the test tables.  Results go through ``plain``:
amounts become doubles after the exact sums are done, lists become text, compound rates are
rounded to nine places, so that both engines print the same values.
"""

from __future__ import annotations

import importlib
import os
import sys
import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradelake.operators import (  # noqa: E402
    balance,
    commodity,
    compare,
    country,
    coverage,
    ingest,
    partner,
    quality,
    timeseries,
    update,
)
from tradelake.operators.metrics import (  # noqa: E402
    Aggregation,
    Filter,
    Metric,
    standard_metrics,
)
from tradelake.operators.predicates import FieldTest  # noqa: E402
from tradelake.operators.query import Query as TradeQuery  # noqa: E402
from tradelake.plans import pipeline, reports  # noqa: E402
from tradelake.plans.analysis import Analysis, metric_row  # noqa: E402
from tradelake.schema import COMPOSITE_KEY, SEQ, VALUE, as_canonical, flat_record, nested_record  # noqa: E402
from tradelake.session import HASHED_LISTS, setting, shuffles_released, work_folder  # noqa: E402
from tradelake.sources import codelists, datasets, fixtures, registry, responses, versions  # noqa: E402
from tradelake.sources.fixtures import table, trade_table  # noqa: E402
from tradelake.sources.responses import records_from_text  # noqa: E402


def _optional(name: str):
    """The module, or None where the training-data package is not installed."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name and name.startswith(missing.name):
            return None
        raise


llm = _optional("tradelake.llm.queries")
corpus = _optional("corpus_pipeline") if llm else None

Query = Callable[[SparkSession, str], DataFrame]

#: Codes the registered queries ask about.
REPORTER, PARTNER = 15, 7


def plain(df: DataFrame) -> DataFrame:
    """Amounts as doubles, lists as comma-joined text, compound rates to nine places."""
    shown = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        elif field.name == "cagr":
            column = F.round(column, 9)
        shown.append(column.alias(field.name))
    return df.select(*shown)


def _on_trade(make: Callable[[DataFrame], DataFrame], **parts: bool) -> Query:
    """A query over the trade table, reading only the dimensions it needs."""
    return lambda spark, sf_dir: plain(make(trade_table(spark, sf_dir, **parts)))


BY_REPORTER = {"partner": False, "commodity": False}
BY_PARTNER = {"commodity": False}
BY_COMMODITY = {"partner": False}
FLOWS_ONLY = {"reporter": False, "partner": False, "commodity": False}


def _reports() -> dict[str, Query]:
    annual = timeseries.annual_trend
    return {
        "country_balance": _on_trade(balance.country_balance, **BY_REPORTER),
        "partner_trade_balance": _on_trade(
            lambda t: balance.partner_trade_balance(t, reporter_code=REPORTER), **BY_PARTNER
        ),
        "commodity_balance": _on_trade(
            balance.commodity_balance, reporter=False, partner=False
        ),
        "global_balance": _on_trade(balance.global_balance, **FLOWS_ONLY),
        "total_imports": _on_trade(
            lambda t: country.total_imports(t, reporter_code=REPORTER, years=[1996, 1998]),
            **BY_REPORTER,
        ),
        "total_exports": _on_trade(
            lambda t: country.total_exports(t, reporter_code=REPORTER, year=1997), **BY_REPORTER
        ),
        "country_ranking": _on_trade(
            lambda t: country.country_ranking(t, limit=10), **BY_REPORTER
        ),
        "country_ranking_exports": _on_trade(
            lambda t: country.country_ranking(t, flow="X", by="exports"), **BY_REPORTER
        ),
        "country_ranking_reexports": _on_trade(
            lambda t: country.country_ranking(t, flow="RX", by="record_count"), **BY_REPORTER
        ),
        "country_summary": _on_trade(
            lambda t: country.country_summary(t, REPORTER), **BY_PARTNER
        ),
        "country_trend": _on_trade(lambda t: country.country_trend(t, REPORTER), **BY_REPORTER),
        "country_trend_by_period": _on_trade(
            lambda t: country.country_trend(t, REPORTER, granularity="period"), **BY_REPORTER
        ),
        "top_partners": _on_trade(
            lambda t: partner.top_partners(t, reporter_code=REPORTER, flow="X", limit=10),
            **BY_PARTNER,
        ),
        "top_partners_reimports": _on_trade(
            lambda t: partner.top_partners(t, reporter_code=REPORTER, flow="RM"), **BY_PARTNER
        ),
        "partner_balance": _on_trade(
            lambda t: partner.partner_balance(
                t, reporter_code=REPORTER, by="abs_trade_balance", limit=12
            ),
            **BY_PARTNER,
        ),
        "partner_growth": _on_trade(
            lambda t: partner.partner_growth(t, reporter_code=REPORTER, partner_code=PARTNER),
            **BY_PARTNER,
        ),
        "partner_growth_points": _on_trade(
            lambda t: partner.partner_growth_points(
                t, reporter_code=REPORTER, partner_code=PARTNER
            ),
            **BY_PARTNER,
        ),
        "bilateral_summary": _on_trade(
            lambda t: partner.bilateral_summary(t, reporter_code=REPORTER, partner_code=3),
            **BY_PARTNER,
        ),
        "top_hs_codes": _on_trade(
            lambda t: commodity.top_hs_codes(
                t,
                reporter_code=REPORTER,
                by="trade_balance",
                descending=False,
                hs_level=4,
                limit=25,
            ),
            **BY_COMMODITY,
        ),
        "commodity_ranking_share": _on_trade(
            lambda t: commodity.commodity_ranking(
                t, reporter_code=REPORTER, include_share=True, limit=20
            ),
            **BY_COMMODITY,
        ),
        "ranked_commodities": _on_trade(
            lambda t: commodity.ranked_commodities(t, reporter_code=REPORTER), **BY_COMMODITY
        ),
        "commodity_trend": _on_trade(
            lambda t: commodity.commodity_trend(t, commodity_code="TOTAL"),
            reporter=False,
            partner=False,
        ),
        "sector_summaries": _on_trade(
            commodity.sector_summaries, reporter=False, partner=False
        ),
        "sector_summaries_imports": _on_trade(
            lambda t: commodity.sector_summaries(t, reporter_code=REPORTER, flow="M"),
            **BY_COMMODITY,
        ),
        "commodity_partner_matrix": _on_trade(
            lambda t: commodity.commodity_partner_matrix(t, partner_codes=[3, 7, 12, 18]),
            reporter=False,
        ),
        "balance_full_outer": _on_trade(
            lambda t: balance.composed_balance(t, reporter_code=REPORTER, period="1997"),
            **BY_PARTNER,
        ),
        "sql_top_net": _on_trade(
            lambda t: balance.largest_net(t, "partner_code"), reporter=False, commodity=False
        ),
        "partner_share_report": _on_trade(
            lambda t: reports.partner_share_report(t, reporter_code=REPORTER), **BY_PARTNER
        ),
        "annual_trend": _on_trade(annual, **FLOWS_ONLY),
        "annual_trend_metric": _on_trade(
            lambda t: annual(
                t,
                reporter_code=REPORTER,
                flow="X",
                metric=Metric.sum_primary_value() / Metric.count(),
            ),
            **BY_REPORTER,
        ),
        "monthly_trend": _on_trade(
            lambda t: timeseries.monthly_trend(t, reporter_code=REPORTER), **BY_REPORTER
        ),
        "rolling_average": _on_trade(
            lambda t: timeseries.rolling_average(
                timeseries.monthly_trend(t, reporter_code=REPORTER), window=4
            ),
            **BY_REPORTER,
        ),
        "growth_rates": _on_trade(
            lambda t: timeseries.growth_rates(annual(t, flow="X")), **FLOWS_ONLY
        ),
        "growth_by_reporter": _on_trade(
            lambda t: timeseries.growth_rates(
                annual(t, by=["reporter_code"]), by=["reporter_code"]
            ),
            **BY_REPORTER,
        ),
        "cagr": _on_trade(
            lambda t: timeseries.cagr(annual(t, reporter_code=REPORTER, flow="M")),
            **BY_REPORTER,
        ),
        "cagr_by_reporter": _on_trade(
            lambda t: timeseries.cagr(annual(t, by=["reporter_code"]), by=["reporter_code"]),
            **BY_REPORTER,
        ),
        "trend_report": _on_trade(
            lambda t: reports.trend_report(t, reporter_code=REPORTER), **BY_REPORTER
        ),
        "country_vs_country": _on_trade(
            lambda t: compare.country_vs_country(
                t, reporter_codes=[REPORTER, 3, 8, 12, 20], breakdown_by="partner"
            ).rows,
            **BY_PARTNER,
        ),
        "country_vs_country_summary": _on_trade(
            lambda t: compare.country_vs_country(
                t, reporter_codes=[REPORTER, 3, 8], breakdown_by="period", flow="X"
            ).summary,
            **BY_REPORTER,
        ),
        "year_vs_year": _on_trade(
            lambda t: compare.year_vs_year(
                t, reporter_code=REPORTER, period_a="1997", period_b="1998"
            ).rows,
            **BY_COMMODITY,
        ),
        "commodity_vs_commodity": _on_trade(
            lambda t: compare.commodity_vs_commodity(
                t, commodity_codes=["TOTAL", "01", "26"], flow="X"
            ).rows,
            reporter=False,
        ),
        "partner_vs_partner": _on_trade(
            lambda t: compare.partner_vs_partner(
                t,
                partner_codes=[PARTNER, 12],
                reporter_code=REPORTER,
                breakdown_by="period",
                flow="M",
                descending=False,
                limit=20,
            ).rows,
            **BY_PARTNER,
        ),
    }


# -- queries, filters, metrics ---------------------------------------------------------------


def _counts(df: DataFrame, conditions: dict) -> DataFrame:
    """How many rows each condition keeps, all in one pass."""
    return df.agg(*[F.count_if(c.column(df)).alias(name) for name, c in conditions.items()])


def filter_ops(t: DataFrame) -> DataFrame:
    """Every comparison, with absent values and values of another kind."""
    return _counts(
        t,
        {
            "eq": FieldTest("reporter_code", "eq", 15),
            "ne": FieldTest("flow.flow_code", "ne", "X"),
            "lt": FieldTest("primary_value", "lt", 50000),
            "le_float": FieldTest("primary_value", "le", 20000.5),
            "gt": FieldTest("period", "gt", "1998"),
            "ge": FieldTest("ref_year", "ge", 1999),
            "is_in": FieldTest("partner_code", "in", [1, 2, 3, None, "4"]),
            "not_in": FieldTest("commodity_code", "not_in", {"TOTAL", "01", 27}),
            "null_eq_null": FieldTest("fob_value", "eq", None),
            "null_ne_value": FieldTest("fob_value", "ne", 5),
            "null_has_no_order": FieldTest("fob_value", "lt", 10**9),
            "null_not_in": FieldTest("partner2.partner_code", "not_in", [1, 2]),
            "text_is_not_number": FieldTest("reporter_code", "eq", "15"),
            "text_differs_from_number": FieldTest("reporter_code", "ne", "15"),
            "is_world": FieldTest("partner.is_world", "eq", True),
        },
    )


def _by_flow(q: TradeQuery) -> DataFrame:
    return q.group_by("flow_code").aggregate(n=("count", None), value=("sum", "primary_value"))


def filter_boolean(t: DataFrame) -> DataFrame:
    """And, or and not over conditions that meet absent values."""
    cheap = FieldTest("fob_value", "lt", 30000)
    near = FieldTest("partner_code", "in", [1, 2, 3])
    late = FieldTest("ref_year", "ge", 1998)
    return _by_flow(TradeQuery(t).filter((cheap & near) | ~(late | cheap)))


def exclude(t: DataFrame) -> DataFrame:
    """Drop rows that match all of two pairs, and rows of a condition."""
    return _by_flow(
        TradeQuery(t)
        .exclude(reporter_code=REPORTER, frequency_code="A")
        .exclude(FieldTest("fob_value", "gt", 40000))
    )


def named_filters(t: DataFrame) -> DataFrame:
    picked = {
        "reporter": Filter.reporter(REPORTER),
        "partner": Filter.partner(PARTNER),
        "exports": Filter.flow_export(),
        "imports": Filter.flow_import(),
        "reexports": Filter.flow("RX"),
        "one_year": Filter.year(1997),
        "years": Filter.year_in(1996, 1998),
        "one_period": Filter.period("199703"),
        "total_rows": Filter.commodity("TOTAL"),
        "classification": Filter.classification("H6"),
        "both": Filter.reporter(REPORTER) & Filter.flow_export(),
        "either_not": Filter.year(1997) | ~Filter.partner(PARTNER),
        "custom": Filter.custom("large", F.col("trade_value_fob_value") > 60000),
        "not_custom": ~Filter.custom("large", F.col("trade_value_fob_value") > 60000),
    }
    return _counts(t, picked)


def filter_hs_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade in the codes of a code list."""
    codes = codelists.search_hs(_commodity_codes(spark, sf_dir), "bolt")
    t = trade_table(spark, sf_dir, reporter=False, partner=False)
    kept = commodity.in_code_set(t, codes)
    return plain(balance.commodity_balance(kept).drop("commodity_name"))


def _ranked_rows(q: TradeQuery) -> DataFrame:
    return q.frame().select("ref_year", "reporter_code", F.col(VALUE).alias("value"))


def sort_multi(t: DataFrame) -> DataFrame:
    return _ranked_rows(
        TradeQuery(t).sort("ref_year", "primary_value", "reporter_code", descending=True).limit(80)
    )


def sort_mixed(t: DataFrame) -> DataFrame:
    keys = (("ref_year", False), ("primary_value", True), ("reporter_code", False))
    return _ranked_rows(TradeQuery(t).sort(*keys).limit(60))


def reverse(t: DataFrame) -> DataFrame:
    return _ranked_rows(
        TradeQuery(t).sort("primary_value", "reporter_code", "ref_year").reverse().limit(50)
    )


def offset_limit(t: DataFrame) -> DataFrame:
    return _ranked_rows(
        TradeQuery(t)
        .filter(flow_code="X")
        .sort("primary_value", "reporter_code", "ref_year")
        .offset(100)
        .limit(70)
    )


def offset_only(t: DataFrame) -> DataFrame:
    few = t.select("ref_year", "reporter_code", VALUE)
    return _ranked_rows(TradeQuery(few).sort("primary_value", "reporter_code").offset(250))


def group_members(t: DataFrame) -> DataFrame:
    q = TradeQuery(t).filter(reporter_code=REPORTER).group_by("flow_code", "ref_year")
    return q.members().select("flow_code", "ref_year", SEQ, F.col(VALUE).alias("value"))


def engine_run(t: DataFrame) -> DataFrame:
    """A filter chain, metrics (one of them undefined) and aggregations (one of them failing)."""
    large = Filter.custom("priced", F.col("trade_value_fob_value").isNotNull())
    nothing = Metric.sum_primary_value() - Metric.sum_primary_value()
    run = (
        Analysis("yearly")
        .with_filter(Filter.year_in(1996, 1997, 1998), large)
        .with_metric(
            Metric.count(),
            Metric.sum_fob_value(),
            Metric.avg_primary_value(),
            (Metric.count() / nothing).named("undefined"),
        )
        .with_aggregation(
            Aggregation("by_flow", ("flow_code",), Metric.sum_quantity()),
            Aggregation("by_year", ("ref_year",), Metric.avg_primary_value()),
            Aggregation(
                "failing", ("ref_year",), Metric.count() / (Metric.count() - Metric.count())
            ),
        )
        .run(t)
    )
    metrics = run.metrics.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
                    for c in run.metrics.columns
                ]
            )
        ).alias("m")
    ).select(F.lit("metric").alias("kind"), "m.name", F.lit("").alias("key"), "m.value")
    groups = [
        run.aggregation(name).select(
            F.lit("aggregation").alias("kind"),
            F.lit(name).alias("name"),
            F.col(key).cast("string").alias("key"),
            F.col("metric_value").cast("double").alias("value"),
        )
        for name, key in (("by_flow", "flow_code"), ("by_year", "ref_year"), ("failing", "ref_year"))
    ]
    counts = run.counts.select(
        F.lit("count").alias("kind"),
        F.lit("filtered").alias("name"),
        F.col("record_count").cast("string").alias("key"),
        F.col("filtered_count").cast("double").alias("value"),
    )
    problems = run.problems.select(
        F.col("level").alias("kind"), "name", F.col("kind").alias("key"), F.lit(0.0).alias("value")
    )
    out = metrics
    for part in (*groups, counts, problems):
        out = out.unionByName(part)
    return out


def _query_surface() -> dict[str, Query]:
    by_code = {"partner": False}
    return {
        "filter_ops": _on_trade(filter_ops),
        "filter_boolean": _on_trade(filter_boolean, reporter=False, commodity=False),
        "exclude": _on_trade(exclude, **BY_REPORTER),
        "named_filters": _on_trade(named_filters),
        "filter_hs_set": filter_hs_set,
        "sort_multi": _on_trade(sort_multi, **BY_REPORTER),
        "sort_mixed": _on_trade(sort_mixed, **BY_REPORTER),
        "reverse": _on_trade(reverse, **BY_REPORTER),
        "offset_limit": _on_trade(offset_limit, **BY_REPORTER),
        "offset_only": _on_trade(offset_only, **BY_REPORTER),
        "group_keys": _on_trade(
            lambda t: TradeQuery(t).group_by("reporter.reporter_code", "period").groups(),
            **BY_REPORTER,
        ),
        "group_members": _on_trade(group_members, **BY_REPORTER),
        "summarize_by_reporter": _on_trade(
            lambda t: TradeQuery(t).group_by("reporter_code").summarize("fob_value"),
            **BY_REPORTER,
        ),
        "summarize_nothing": _on_trade(
            lambda t: TradeQuery(t).filter(reporter_code=-1).summarize("primary_value"),
            **BY_REPORTER,
        ),
        "metrics_all": _on_trade(lambda t: metric_row(t, standard_metrics())),
        "metric_ratio": _on_trade(
            lambda t: Aggregation(
                "value_per_quantity",
                ("commodity_code", "flow_code"),
                Metric.sum_primary_value() / Metric.sum_quantity(),
            ).apply(t),
            reporter=False,
            **by_code,
        ),
        "aggregate_by_flow_year": _on_trade(
            lambda t: Aggregation(
                "flow_year", ("flow_code", "ref_year"), Metric.sum_cif_value()
            ).apply(t),
            **FLOWS_ONLY,
        ),
        "engine_run": _on_trade(engine_run, **FLOWS_ONLY),
        "engine_isolated": _on_trade(engine_isolated, **FLOWS_ONLY),
    }


# -- duplicates, updates, slices -------------------------------------------------------------

#: Test rows may share a row number; the value and the quantity then decide the order.
ORDER = (SEQ, VALUE, "quantity_qty")
KEY_SHOWN = [c for c in COMPOSITE_KEY if c not in ("classification_code", "edition")]


def _keyed(df: DataFrame) -> DataFrame:
    return df.select(*KEY_SHOWN, SEQ, F.col(VALUE).alias("value"))


def _revised(t: DataFrame) -> DataFrame:
    """The table together with a later revision of its rows, some without a revision number."""
    missing = F.col("quantity_qty") % 7 == 0
    again = t.withColumn(
        "ref_period_id",
        F.when(~missing, F.col("ref_period_id") + F.col("quantity_qty").cast("bigint") % 3),
    ).withColumn(VALUE, (F.col(VALUE) + 1).cast("decimal(18,2)"))
    return coverage.combine([t, again.withColumn(SEQ, F.col(SEQ) + (1 << 40))])


def _batch(t: DataFrame) -> DataFrame:
    """An update: rows from 1999 on with a changed value, every tenth one repeated later."""
    late = t.filter(F.col("ref_year") >= 1999)

    def changed(df, by, later):
        return df.withColumn(VALUE, (F.col(VALUE) + by).cast("decimal(18,2)")).withColumn(
            SEQ, F.col(SEQ) + (later << 40)
        )

    repeated = late.filter(F.col(SEQ) % 10 == 0)
    return changed(late, 1, 1).unionByName(changed(repeated, 2, 2))


def _existing(t: DataFrame) -> DataFrame:
    return t.filter(F.col("ref_year") <= 1999)


def merge_update(t: DataFrame, mode: str) -> DataFrame:
    reduced = update.reduce_batch(_batch(t), order=ORDER)
    return _keyed(update.combine(_existing(t), reduced, mode))


def update_counts(t: DataFrame) -> DataFrame:
    batch = _batch(t)
    return update.update_counts(_existing(t), batch, update.reduce_batch(batch, order=ORDER))


def merge_pages(t: DataFrame) -> DataFrame:
    """Three overlapping pages of periods."""
    spans = [(1995, 1997), (1997, 1999), (1999, 2001)]
    frames = [
        t.filter(F.col("ref_year").between(a, b)).withColumn(
            VALUE, (F.col(VALUE) + i).cast("decimal(18,2)")
        )
        for i, (a, b) in enumerate(spans)
    ]
    return _keyed(coverage.merge_pages(frames, order=ORDER))


def combine_datasets(t: DataFrame) -> DataFrame:
    """Yearly downloads put together, duplicates included."""
    years = [t.filter(F.col("ref_year") == y) for y in (1996, 1997, 1997)]
    return balance.country_balance(coverage.combine(years))


SLICE_SHOWN = ("period", "partner_code", "flow_code", "commodity_code", SEQ)


def _slice(make: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_trade(
        lambda t: make(t).select(*SLICE_SHOWN, F.col(VALUE).alias("value"))
    )


def metadata_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as code-list entries: the type is the code, absent for one brand."""
    parts = table(spark, sf_dir, "part").select(
        F.when(F.col("p_brand") != "Brand#7", F.col("p_type")).alias("id"),
        F.col("p_brand").alias("code"),
        "p_partkey",
    )
    return plain(quality.first_per_code(parts, "R04", order=("p_partkey",)))


def _record_keeping() -> dict[str, Query]:
    def first_names(t):
        return coverage.line_level(t, REPORTER, "X", "1997,1998")

    return {
        "dedup_first": _on_trade(lambda t: _keyed(quality.first_wins(t, order=ORDER))),
        "dedup_last": _on_trade(lambda t: _keyed(quality.last_wins(t, order=ORDER))),
        "dedup_custom_key": _on_trade(
            lambda t: quality.first_wins(
                t, ("reporter_code", "flow_code", "ref_year"), order=ORDER
            ).select("reporter_code", "flow_code", "ref_year", SEQ, F.col(VALUE).alias("value")),
            **BY_REPORTER,
        ),
        "latest_wins": _on_trade(
            lambda t: _keyed(quality.latest_wins(_revised(t), order=ORDER))
        ),
        "find_duplicates": _on_trade(
            lambda t: quality.duplicate_keys(t).select(*KEY_SHOWN, "member_count")
        ),
        "duplicate_members": _on_trade(
            lambda t: quality.duplicate_members(
                t, ("reporter_code", "partner_code", "commodity_code", "flow_code")
            ).select(
                "reporter_code", "partner_code", "commodity_code", "flow_code", SEQ,
                F.col(VALUE).alias("value"), "member_count",
            )
        ),
        "merge_update": _on_trade(lambda t: merge_update(t, "merge")),
        "append_update": _on_trade(lambda t: merge_update(t, "append")),
        "update_counts": _on_trade(update_counts),
        "merge_pages": _on_trade(merge_pages),
        "combine_datasets": _on_trade(combine_datasets, **BY_REPORTER),
        "dataset_warnings": _on_trade(quality.dataset_warnings, **BY_REPORTER),
        "metadata_dedupe": metadata_dedupe,
        "slice_exports": _slice(
            lambda t: coverage.exports(t, REPORTER, "1996,1997", commodity_code="TOTAL")
        ),
        "slice_world": _slice(lambda t: coverage.world(t, REPORTER, "X", ["1996", "1998"])),
        "slice_monthly": _slice(
            lambda t: coverage.monthly_imports(
                t, 9, [f"1997{m:02d}" for m in range(1, 13)], commodity_code="TOTAL"
            )
        ),
        "slice_line_level": _slice(first_names),
        "slice_matrix": _slice(lambda t: coverage.matrix(t, [REPORTER, 3, 8], "1997")),
        "slice_limited": _on_trade(
            lambda t: coverage.all_flows(t, REPORTER, "1997", max_records=5).select(SEQ)
        ),
        "grid_coverage": _on_trade(
            lambda t: coverage.grid_coverage(
                t, [REPORTER, 3, 99], [1996, 1997, 2050], [0, PARTNER, 12]
            ),
            **BY_PARTNER,
        ),
        "grid_totals": _on_trade(
            lambda t: coverage.coverage_totals(
                coverage.grid_coverage(t, list(range(25)), [1996, 1997], list(range(0, 30)))
            ),
            **BY_PARTNER,
        ),
        "load_partition": _on_trade(
            lambda t: datasets.load_partition(t, (REPORTER, 1997, "A")).select(
                "partner_code", "commodity_code", SEQ, F.col(VALUE).alias("value")
            )
        ),
        "canonical_order": _on_trade(
            lambda t: datasets.canonical_order(t).select(
                "ref_period_id", "reporter_code", "partner_code", "flow_code", "commodity_code"
            )
        ),
    }


# -- ingest, code lists, pipeline ------------------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_trade(spark, sf_dir)
    return ingest.parse_records(records_from_text(raw, "json", SEQ))


def parse_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON records with planted defects: the rows that survive, typed."""
    return ingest.accepted(_parsed(spark, sf_dir)).select(
        SEQ,
        "ref_period_id",
        "ref_year",
        "ref_month",
        "period",
        "reporter_code",
        "reporter_iso3",
        "partner_code",
        "partner2_code",
        "partner2_iso3",
        "flow_code",
        "commodity_code",
        "mot_code",
        "is_reported",
        "provenance",
        F.col(VALUE).cast("decimal(38,12)").cast("string").alias("value_text"),
        F.col("trade_value_fob_value").cast("decimal(38,4)").cast("string").alias("fob_text"),
    )


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.reject_counts(_parsed(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = records_from_text(fixtures.raw_trade(spark, sf_dir), "json", SEQ)
    return pipeline.to_dataset(raw, order=ORDER)


def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records through every stage to a balance."""
    run = pipeline.Pipeline(
        "balance",
        [
            pipeline.Stage("extract", lambda df: records_from_text(df, "json", SEQ)),
            pipeline.Stage("validate", lambda df: ingest.accepted(ingest.parse_records(df))),
            pipeline.Stage("transform", lambda df: quality.first_wins(df, order=ORDER)),
            pipeline.Stage("export", balance.country_balance),
        ],
    )
    return plain(run.plan(fixtures.raw_trade(spark, sf_dir)))


def _listed(raw: DataFrame) -> DataFrame:
    return records_from_text(raw, "json", "entry_no")


def _commodity_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _listed(fixtures.commodity_list(spark, sf_dir))
    return codelists.code_list("hs").parse(raw, order=("entry_no",))


def ref_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _listed(fixtures.raw_reporters(spark, sf_dir))
    rows = codelists.code_list("reporters").parse(raw, order=("entry_no",))
    dates = ("entry_effective_date", "entry_expired_date")
    return rows.select(
        "country_code", "iso_alpha3", "display_name",
        *[F.col(d).cast("string").alias(d) for d in dates],
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("country_code"), F.col("n_name").alias("display_name")
    )


def lookup_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exact name in any case, and a part of a name in its own case."""
    nations = _nations(spark, sf_dir)
    exact = codelists.by_name(nations, "nation_7").withColumn("how", F.lit("exact"))
    part = codelists.by_name(nations, "ION_1", case_sensitive=True, exact=False)
    none = codelists.by_name(nations, "nation_7", case_sensitive=True)
    return exact.unionByName(part.withColumn("how", F.lit("part"))).unionByName(
        none.withColumn("how", F.lit("never"))
    )


def search_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return codelists.search(parts, "SMALL")


def enrich_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances by commodity with descriptions from a code list."""
    t = trade_table(spark, sf_dir, reporter=False, partner=False)
    rows = balance.commodity_balance(t).drop("commodity_name")
    codes = _commodity_codes(spark, sf_dir)
    return plain(
        codelists.enrich(
            rows, codes, "commodity_code", code="commodity_code", columns=["display_name"]
        )
    )


def _sources() -> dict[str, Query]:
    return {
        "parse_trade": parse_trade,
        "quarantine_counts": quarantine_counts,
        "pipeline_end_to_end": pipeline_end_to_end,
        "ref_tables": ref_tables,
        "lookup_name": lookup_name,
        "lookup_code": lambda spark, sf_dir: codelists.by_code(_nations(spark, sf_dir), 7),
        "search_ref": search_ref,
        "search_hs": lambda spark, sf_dir: codelists.search_hs(
            _commodity_codes(spark, sf_dir), "Blue"
        ).select("commodity_code", "display_name"),
        "enrich_labels": enrich_labels,
    }


# -- storage ---------------------------------------------------------------------------------


def _aside(spark: SparkSession, name: str) -> str:
    """A new path in the shared work folder."""
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _as_text(column) -> F.Column:
    return F.col(column).cast("decimal(38,2)").cast("string")


def store_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table written in every format, opened by path or name, and summed up.

    Parquet is written from the table, the others from the stored rows, which lie by folder already.
    """
    path = _stored(spark, fixtures.full_table(spark, sf_dir), compression="snappy")
    stored = datasets.open_dataset(spark, path)
    found = [("parquet", stored)]
    for fmt in ("csv", "json"):
        path = _aside(spark, fmt)
        datasets.write_dataset(stored, path, fmt, compression="gzip", laid_out=True)
        found.append((fmt, datasets.open_dataset(spark, path)))
    name = f"trade_{uuid.uuid4().hex}"
    datasets.write_table(stored, name, laid_out=True)
    found.append(("table", datasets.read_table(spark, name)))
    sums = [
        df.groupBy("reporter_code", "ref_year", "frequency_code")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.sum(VALUE).alias("value"),
            F.sum("trade_value_fob_value").cast("decimal(38,4)").cast("string").alias("fob"),
            F.sum(SEQ).cast("decimal(38,0)").cast("string").alias("numbers"),
        )
        .withColumn("value", _as_text("value"))
        .withColumn("format", F.lit(fmt))
        for fmt, df in found
    ]
    return reduce(DataFrame.unionByName, sums)


def _stored(spark: SparkSession, t: DataFrame, **how: str) -> str:
    path = _aside(spark, "stored")
    datasets.write_dataset(t, path, **how)
    return path


def stored_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, fixtures.full_table(spark, sf_dir))
    part = datasets.load_partition(datasets.open_dataset(spark, path), (REPORTER, 1997, "A"))
    return part.select("partner_code", "commodity_code", SEQ, F.col(VALUE).cast("double").alias("value"))


def stored_update(spark: SparkSession, sf_dir: str, mode: str) -> tuple[update.UpdateResult, DataFrame]:
    t = fixtures.full_table(spark, sf_dir)
    path = _stored(spark, _existing(t))
    done = update.update_dataset(_batch(t), path, mode=mode, order=ORDER)
    return done, datasets.open_dataset(spark, path)


def stored_rows(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, rows = stored_update(spark, sf_dir, mode)
        return rows.select(*KEY_SHOWN, SEQ, _as_text(VALUE).alias("value"))

    return run


def versioned_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored dataset taken over as version 1, and what a merge made of it."""
    t = fixtures.full_table(spark, sf_dir)
    path = _stored(spark, _existing(t))
    datasets.take_over(spark, path)
    update.update_dataset(_batch(t), path, mode="merge", order=ORDER)
    return datasets.open_dataset(spark, path).select(*KEY_SHOWN, SEQ, _as_text(VALUE).alias("value"))


def versioned_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each version of a dataset that is written, merged into and appended to: listed and read."""
    t = fixtures.full_table(spark, sf_dir)
    path = _aside(spark, "versions")
    datasets.write_dataset(_existing(t), path, versioned=True)
    for mode in ("merge", "append"):
        update.update_dataset(_batch(t), path, mode=mode, order=ORDER)
    found = [
        datasets.open_dataset(spark, path, n)
        .agg(F.count(F.lit(1)).alias("read_rows"), F.count_distinct(SEQ).alias("row_numbers"))
        .withColumns(
            {
                "version": F.lit(n),
                "listed_rows": versions.listed(spark, path, n).agg(F.sum("rows")).scalar(),
            }
        )
        for n in versions.numbers(spark, path)
    ]
    return reduce(DataFrame.unionByName, found)


def stored_update_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, _ = stored_update(spark, sf_dir, "merge")
    counts = (done.records_added, done.records_merged, done.duplicates_in_input)
    return spark.createDataFrame(
        [counts], "records_added bigint, records_merged bigint, duplicates_in_input bigint"
    )


def stored_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances and the summary row of a dataset opened by its path."""
    df = datasets.open_dataset(spark, _stored(spark, fixtures.full_table(spark, sf_dir)))
    total = registry.dataset_summary(df, parser_name="parse_records", schema_version="1.0.0")
    (row,) = total.collect()
    return plain(balance.country_balance(df)).withColumns(
        {
            "dataset_rows": F.lit(row["record_count"]),
            "parser_name": F.lit(row["parser_name"]),
            "schema_version": F.lit(row["schema_version"]),
        }
    )


def _raw_lines(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """Raw records as text; ``again`` as a later revision of themselves."""
    raw = fixtures.raw_trade(spark, sf_dir)
    if again:
        later = F.regexp_replace("json", '"refPeriodId":([0-9]+)', '"refPeriodId":$19')
        raw = raw.withColumn("json", later)
    return raw.select("json")


def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines taken in twice: numbers go on, so first and last per key are settled."""
    source, target = _aside(spark, "lines"), _aside(spark, "twice")
    _raw_lines(spark, sf_dir).write.text(source, compression="gzip")
    for _ in range(2):
        done = pipeline.ingest(spark, source, target, layout="lines", mode="append", conflict="first")
        if done.cause:
            raise done.cause
    df = datasets.open_dataset(spark, target)
    number, half = F.col(SEQ), done.records_out
    first = quality.first_wins(df).agg(F.count_if(number < half))
    last = quality.last_wins(df).agg(F.count_if(number >= half))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(SEQ).alias("number_count"),
        F.min(SEQ).alias("first_number"),
        (F.max(SEQ) + 1).alias("next_number"),
    ).withColumns({"first_of_first": first.scalar(), "last_of_second": last.scalar()})


def ingest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and a later revision of them in one ingest: the revision stays."""
    source, target = _aside(spark, "revisions"), _aside(spark, "latest")
    for n, again in enumerate((True, False)):
        _raw_lines(spark, sf_dir, again).write.text(f"{source}/{n}", compression="gzip")
    done = pipeline.ingest(spark, source, target, layout="lines")
    if done.cause:
        raise done.cause
    df = datasets.open_dataset(spark, target)
    revised = F.count_if(F.col("ref_period_id") > 100_000_000).alias("revised")
    return df.groupBy("reporter_code").agg(F.count(F.lit(1)).alias("record_count"), revised)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of up to 500 orders each, as envelopes or lists, and one without records.

    They are saved compressed, one after the other as their records come, so no text is moved or sorted.
    """
    path = _aside(spark, "responses")
    rows = fixtures.raw_trade(spark, sf_dir, F.floor(F.col(SEQ) / 4000))
    texts = rows.groupBy("doc").agg(
        F.array_join(F.collect_list("json"), ",").alias("rows"), F.count(F.lit(1)).alias("n")
    )
    envelope = F.format_string('{"count":%d,"error":"","data":[%s]}', "n", "rows")
    bare = F.concat(F.lit("["), "rows", F.lit("]"))
    texts = texts.select("doc", F.when(F.col("doc") % 2 == 0, envelope).otherwise(bare).alias("value"))
    with shuffles_released(spark), setting(spark, HASHED_LISTS, "false"):
        texts.write.partitionBy("doc").text(path, compression="gzip")
    spark.createDataFrame([('{"count":0,"data":null}',)], "value string").write.text(f"{path}/doc=none")
    records = responses.read_responses(spark, path)
    heads = responses.read_envelopes(spark, path)
    parsed = ingest.accepted(ingest.parse_records(records)).groupBy("reporter_code")
    off = F.when(F.col("declared_count") > 0, F.col("declared_count") - F.col("record_count"))
    return parsed.agg(F.count(F.lit(1)).alias("record_count")).withColumns(
        {
            "held": heads.agg(F.sum("record_count")).scalar(),
            "off": heads.agg(F.sum(F.coalesce(off, F.lit(0)))).scalar(),
        }
    )


def exact_text(t: DataFrame) -> DataFrame:
    """Differences of amounts with all their decimals, as text."""
    tiny = F.lit("0.000000000000000001").cast("decimal(18,18)")
    fine = t.withColumn(VALUE, (F.col(VALUE) + F.when(F.col("flow_code") == "X", tiny).otherwise(0)).cast("decimal(38,18)"))
    rows = balance.composed_balance(fine, reporter_code=REPORTER)
    return rows.select("partner_code", F.col("net_trade").cast("string").alias("net_trade"))


def registry_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance rows of a first write and a merge, and what the gate says to another parser's batch."""
    t = fixtures.full_table(spark, sf_dir)
    path, rows = _aside(spark, "gated"), _aside(spark, "registry")
    kept = {"registry_path": rows, "name": "gated", "order": ORDER}
    update.update_dataset(_existing(t), path, **kept)
    update.update_dataset(_batch(t), path, **kept)
    try:
        update.update_dataset(_batch(t), path, parser_name="other", **kept)
        said = "taken"
    except update.SchemaIncompatibleError as refused:
        said = str(refused)
    columns = ("dataset_name", "record_count", "duplicates_removed", "source_count", "backend", "parser_name")
    stored = datasets.open_dataset(spark, path).agg(F.count(F.lit(1)).alias("stored_rows")).first()[0]
    shown = registry.history(spark, rows, "gated").select(*columns)
    return shown.withColumns({"stored_rows": F.lit(stored), "refused": F.lit(said)})


def nested_and_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the nested view, and the same columns after it is flattened again."""
    nested = as_canonical(fixtures.full_table(spark, sf_dir)).select(*nested_record())
    flat = nested.select(
        F.col("reporter.reporter_code").alias("nested_reporter"),
        F.col("flow.flow_code").alias("nested_flow"),
        F.col("partner2.partner2_code").alias("nested_partner2"),
        *flat_record(),
    )
    return flat.groupBy("nested_reporter", "reporter_code", "nested_flow", "flow_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(VALUE).cast("double").alias("value"),
        F.count_if(F.col("nested_partner2").eqNullSafe(F.col("partner2_code"))).alias("same_partner2"),
    )


def partner_report(t: DataFrame) -> DataFrame:
    """Ranking of a reporter's partners, and how trade with one of them grew."""
    made = reports.partner_analysis(t, reporter_code=REPORTER, flow="X", top_n=10, focus_partner=PARTNER)
    value = F.col("total_trade").cast("double").alias("value")
    rank, code = F.col("rank").cast("string").alias("key"), F.col("partner_code").cast("long").alias("code")
    top = made["top_partners"].select(F.lit("rank").alias("kind"), rank, code, value)
    points = made["growth_points"].select(F.lit("point"), "period", F.col("year").cast("long"), value)
    nothing = F.lit(None).cast("double")
    count = made["growth"].select(F.lit("growth"), F.lit(""), F.col("point_count").cast("long"), nothing)
    return top.union(points).union(count)


def stored_recipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary and partner ranking of one reporter, from a dataset opened by its path."""
    path = _stored(spark, fixtures.full_table(spark, sf_dir))
    made = reports.stored_analysis(spark, path, reporter_code=REPORTER, limit=10)
    shown = (F.col("record_count").cast("long").alias("records"), F.col("total_trade").cast("double").alias("value"))
    summary = made["summary"].select(F.lit("summary").alias("kind"), F.col("partner_count").cast("long").alias("code"), *shown)
    return summary.union(made["top_partners"].select(F.lit("partner"), F.col("partner_code").cast("long"), *shown))


#: Raw code lists out of the test tables: the name a list is asked by, the table and its row number, an entry.
RAW_LISTS = {
    "References": (
        "region",
        "r_regionkey",
        "'category', r_name, 'variable', 'v', 'description', if(r_regionkey = 3, ' ', 'd'), 'fileuri', concat('f/', r_regionkey)",
    ),
    "R03": (
        "nation",
        "n_nationkey",
        "'PartnerCode', n_nationkey, 'PartnerDesc', n_name, 'PartnerCodeIsoAlpha2', if(n_nationkey % 5 = 0, 'xyz', 'ab')",
    ),
    "HSEdition": ("part", "p_partkey", "'id', if(p_partkey % 9 = 0, '123', lpad(p_partkey % 10000, 4, '0')), 'text', p_name"),
    "Frequency": ("supplier", "s_suppkey", "'id', element_at(array('A', 'M', 'Z'), cast(s_suppkey % 3 as int) + 1), 'text', s_name"),
    "R10": ("supplier", "s_suppkey", "'id', element_at(array('X', 'RM', 'x'), cast(s_suppkey % 3 as int) + 1), 'text', s_name"),
    "TransportModes": ("nation", "n_nationkey", "'id', n_nationkey * 100 - 300, 'text', n_name"),
    "R14": ("nation", "n_nationkey", "'qtyCode', n_nationkey, 'qtyAbbr', if(n_nationkey % 4 = 0, '', 'u'), 'qtyDescription', n_name"),
    "DataItems": ("customer", "c_custkey", "'dataItem', concat('i', c_custkey % 40), 'description', c_name"),
}


def code_lists_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight lists, asked for by table name or number: valid entries, the first of each key."""
    out = None
    for name, (source, place, fields) in RAW_LISTS.items():
        raw = table(spark, sf_dir, source).selectExpr(f"{place} as entry_no", f"to_json(named_struct({fields})) as json")
        one = codelists.code_list(name, edition="HS2017" if name == "HSEdition" else None)
        rows = one.parse(_listed(raw), order=("entry_no",))
        label = next(c for c in ("display_name", "qty_description", "description") if c in rows.columns)
        code = F.col(rows.columns[0]).cast("string").alias("code")
        rows = rows.select(F.lit(name).alias("list"), code, F.col(label).alias("label"))
        out = rows if out is None else out.union(rows)
    return out


def engine_isolated(t: DataFrame) -> DataFrame:
    """Metrics that overflow, divide by zero or raise, next to good ones and a median by histogram."""
    huge = Metric.total("huge", F.lit(Decimal("9" * 38)))
    middle = Metric.mergeable(
        "median_year", {"n": F.count(F.lit(1))}, F.percentile("ref_year", 0.5, F.col("_median_year_n")), keys=("ref_year",)
    )
    raising = {"n": F.max(F.assert_true(F.col("quantity_qty") < 0))}
    run = (
        Analysis("isolated")
        .with_metric(
            Metric.count(),
            huge,
            (huge + Metric.sum_fob_value()).named("huge_too"),
            (Metric.count() / (Metric.count() - Metric.count())).named("by_zero"),
            Metric.mergeable("raising", raising, F.max("_raising_n").cast("double")),
            Metric.custom("raising_alone", F.sum(F.when(F.col("quantity_qty") < 0, 1).otherwise(F.raise_error(F.lit("no")).cast("int")))),
            Metric.custom("largest_year", F.max("ref_year")),
            middle,
        )
        .with_aggregation(
            Aggregation("median_by_flow", ("flow_code",), middle),
            Aggregation("huge_by_flow", ("flow_code",), huge),
        )
        .run(t)
    )
    names = run.metrics.columns
    each = F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in names))
    metrics = run.metrics.select(F.explode(each).alias("m")).select("m.name", F.lit("").alias("key"), "m.value")
    groups = run.aggregation("median_by_flow").select(
        F.lit("median_by_flow").alias("name"), F.col("flow_code").alias("key"), F.col("metric_value").alias("value")
    )
    none = run.aggregation("huge_by_flow").select(F.lit("huge_by_flow").alias("name"), "flow_code", F.lit(1.0).alias("value"))
    # of raised errors only the fact is shown, not Spark's wording
    why = F.when(F.col("reason").isin("a sum does not fit", "no value", "a group has no value"), F.col("reason")).otherwise("raised")
    problems = run.problems.select(F.concat_ws(" ", "level", "kind", "name").alias("name"), why.alias("key"), F.lit(0.0).alias("value"))
    return metrics.union(groups).union(none).union(problems)


def custom_metric(t: DataFrame) -> DataFrame:
    """Any aggregate as a metric: the width of the values, and a sum combined with another."""
    spread = Metric.custom("spread", F.max(VALUE) - F.min(VALUE))
    margin = (Metric.sum_cif_value() - Metric.sum_fob_value()).named("margin")
    return metric_row(t, [spread, margin, (Metric.count() + Metric.count()).named("twice")])


def _storage() -> dict[str, Query]:
    return {
        "store_formats": store_formats,
        "stored_partition": stored_partition,
        "stored_merge": stored_rows("merge"),
        "stored_append": stored_rows("append"),
        "versioned_merge": versioned_merge,
        "versioned_history": versioned_history,
        "stored_update_counts": stored_update_counts,
        "stored_reports": stored_reports,
        "stored_recipe": stored_recipe,
        "registry_history": registry_history,
        "nested_and_back": nested_and_back,
        "partner_report": _on_trade(partner_report, **BY_PARTNER),
        "code_lists_by_name": code_lists_by_name,
        "ingest_twice": ingest_twice,
        "ingest_latest": ingest_latest,
        "read_documents": read_documents,
        "exact_text": lambda spark, sf_dir: exact_text(trade_table(spark, sf_dir, commodity=False)),
        "custom_metric": _on_trade(custom_metric, **FLOWS_ONLY),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: trade balance of every reporting country."""
    return queries()["country_balance"](spark, "/root/testdata/sf0.001")


def trade_queries() -> dict[str, Query]:
    """The queries on trade data."""
    return {**_reports(), **_query_surface(), **_record_keeping(), **_sources(), **_storage()}


def queries() -> dict[str, Query]:
    return {
        **trade_queries(),
        **(llm.queries() if llm else {}),
        **({"pipeline": corpus.run} if corpus else {}),
    }


def oracle_sql() -> dict[str, str]:
    """The same questions as SQL over the same tables."""
    import oracle_sql as sql

    return {
        **sql.all_sql(),
        **(llm.oracle_sql() if llm else {}),
        **({"pipeline": corpus.ORACLE_SQL} if corpus and corpus.ORACLE_SQL else {}),
    }
