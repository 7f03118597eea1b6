"""Report rules on small tables with known answers."""

from decimal import Decimal as D

import pytest

from tests.rows import frame, records, row
from tradelake.functions import codes
from tradelake.operators import balance, commodity, compare, country, partner, timeseries
from tradelake.operators.metrics import Aggregation, Filter, Metric
from tradelake.plans import reports
from pyspark.sql import functions as F

from tradelake.plans.analysis import Analysis


@pytest.fixture(scope="module")
def t(spark):
    return frame(
        spark,
        [
            row(1, 2, "2020", "X", "0101", "10.5"),
            row(1, 2, "2020", "M", "0101", 4),
            row(1, 3, "2021", "X", "27", 20, partner_name="Sealand"),
            row(1, 3, "2021", "RX", "27", 100, partner_name="Cland"),
            row(2, 1, "2020", "X", "TOTAL", 7),
            row(2, 1, "202103", "M", "8517", 9),
            row(3, 0, "2021", "RM", "999999", 50, reporter_name="First"),
            row(3, 0, "2021", "RM", "999999", None, reporter_name="Second"),
        ],
    ).cache()


@pytest.fixture(scope="module")
def nothing(t):
    return t.limit(0)


def test_balances(t):
    rows = {r["reporter_code"]: r for r in records(balance.country_balance(t))}
    assert rows[1]["trade_balance"] == D("26.5") and rows[1]["total_trade"] == D("34.5")
    assert rows[2]["trade_balance"] == -2
    # Re-flows count as records but not in totals.
    assert rows[3]["total_trade"] == 0 and rows[3]["record_count"] == 2
    assert rows[3]["reporter_name"] == "First"
    order = [r["reporter_code"] for r in records(balance.country_balance(t))]
    assert order == [1, 3, 2]
    up = [r["reporter_code"] for r in records(balance.country_balance(t, descending=False))]
    assert up == [2, 3, 1]


def test_ties_go_by_code_in_both_directions(spark):
    same = frame(spark, [row(c, 0, "2020", "X", "TOTAL", 5) for c in (3, 1, 2)])
    for down in (True, False):
        rows = records(balance.country_balance(same, descending=down))
        assert [r["reporter_code"] for r in rows] == [1, 2, 3]


def test_sums_are_exact(spark):
    tiny = frame(
        spark,
        [row(1, 0, "2020", "X", "TOTAL", "0.000000000000000001")] * 3
        + [row(1, 0, "2020", "M", "TOTAL", "99999999999999.123456789012345678")],
    )
    (only,) = records(balance.global_balance(tiny))
    assert only["total_exports"] == D("0.000000000000000003")
    assert only["total_trade"] == D("99999999999999.123456789012345681")
    assert only["trade_balance"] == D("-99999999999999.123456789012345675")


def test_empty_tables(nothing):
    assert records(balance.country_balance(nothing)) == []
    assert records(country.country_summary(nothing, 1)) == []
    assert records(partner.bilateral_summary(nothing, reporter_code=1, partner_code=2)) == []
    assert records(partner.partner_growth(nothing, reporter_code=1, partner_code=2)) == []
    assert records(country.total_exports(nothing)) == [{"total_exports": 0}]
    (world,) = records(balance.global_balance(nothing))
    assert world["record_count"] == 0 and world["total_trade"] == 0
    sectors = records(commodity.sector_summaries(nothing))
    assert len(sectors) == 22 and all(s["record_count"] == 0 for s in sectors)
    assert records(timeseries.annual_trend(nothing)) == []
    assert records(timeseries.cagr(timeseries.annual_trend(nothing))) == [{"cagr": None}]


def test_country_ranking_flow_rules(t):
    only_x = {r["reporter_code"]: r for r in records(country.country_ranking(t, flow="X"))}
    assert set(only_x) == {1, 2}
    assert only_x[1]["total_imports"] == 0 and only_x[1]["total_exports"] == D("30.5")
    re = records(country.country_ranking(t, flow="RM"))
    assert [(r["reporter_code"], r["total_trade_value"]) for r in re] == [(3, 0)]
    # The count takes rows with a value only.
    assert re[0]["record_count"] == 1
    with pytest.raises(ValueError):
        country.country_ranking(t, by="weight")
    with pytest.raises(ValueError):
        country.country_ranking(t, limit=-1)


def test_country_totals_and_summary(t):
    assert records(country.total_exports(t, reporter_code=1, years=[2020])) == [
        {"total_exports": D("10.5")}
    ]
    with pytest.raises(ValueError):
        country.total_imports(t, year=2020, years=[2021])
    (one,) = records(country.country_summary(t, 1))
    assert one["partner_count"] == 2 and one["record_count"] == 4
    assert (one["first_year"], one["last_year"]) == (2020, 2021)


def test_country_trend(t):
    by_year = records(country.country_trend(t, 2))
    assert [(p["year"], p["period"], p["exports"]) for p in by_year] == [
        (2020, "2020", 7),
        (2021, "202103", 0),
    ]
    (totals,) = records(country.trend_totals(country.country_trend(t, 2)))
    assert totals["years"] == [2020, 2021] and totals["total_trade"] == 16
    with pytest.raises(ValueError):
        country.country_trend(t, 2, granularity="week")


def test_top_partners_flow_rules(t):
    x = {r["partner_code"]: r for r in records(partner.top_partners(t, reporter_code=1, flow="X"))}
    assert x[2]["total_imports"] == 0 and x[2]["record_count"] == 1
    re = records(partner.top_partners(t, reporter_code=1, flow="RX"))
    # Only partners with such rows, but their sums take all the reporter's rows.
    assert [(r["partner_code"], r["total_exports"], r["partner_name"]) for r in re] == [
        (3, 20, "Cland")
    ]
    by_size = records(partner.partner_balance(t, reporter_code=1, by="abs_trade_balance"))
    assert [r["partner_code"] for r in by_size] == [3, 2]


def test_bilateral_adds_mirror_flows(t):
    (both,) = records(partner.bilateral_summary(t, reporter_code=1, partner_code=2))
    assert both["reporter_to_partner_exports"] == D("10.5")
    assert both["partner_to_reporter_imports"] == 9
    assert both["total_exports"] == D("17.5") and both["record_count"] == 4
    assert both["partner_iso3"] == "BBB"
    (mirror,) = records(
        partner.bilateral_summary(
            t.filter("reporter_code = 2"), reporter_code=1, partner_code=2
        )
    )
    assert mirror["partner_iso3"] == "AAA"


def test_bilateral_with_itself_counts_twice(spark):
    own = frame(spark, [row(1, 1, "2020", "X", "TOTAL", 5)])
    (only,) = records(partner.bilateral_summary(own, reporter_code=1, partner_code=1))
    assert only["total_exports"] == 10 and only["record_count"] == 2


def test_partner_growth(spark):
    up = frame(
        spark,
        [row(1, 2, "2020", "X", "TOTAL", 100), row(1, 2, "2022", "M", "TOTAL", 121)],
    )
    (g,) = records(partner.partner_growth(up, reporter_code=1, partner_code=2))
    assert g["absolute_change"] == 21 and g["relative_change"] == pytest.approx(0.21)
    assert g["cagr"] == pytest.approx(0.1)
    (p,) = records(
        partner.partner_growth(up, reporter_code=1, partner_code=2, granularity="period")
    )
    assert p["cagr"] is None


def test_commodities(t):
    two = records(commodity.top_hs_codes(t, hs_level=2))
    assert [r["commodity_code"] for r in two] == ["27"]
    assert "TOTAL" in {r["commodity_code"] for r in records(commodity.top_hs_codes(t))}
    with pytest.raises(ValueError):
        commodity.top_hs_codes(t, hs_level=3)
    shares = {
        r["commodity_code"]: r["share"]
        for r in records(commodity.commodity_ranking(t, reporter_code=1, include_share=True))
    }
    # The denominator holds re-exports too: 10.5 + 4 + 20 + 100.
    assert shares["0101"] == 14.5 / 134.5
    assert commodity.commodity_ranking(t).first()["share"] is None


def test_sectors(t):
    rows = {r["sector_id"]: r for r in records(commodity.sector_summaries(t))}
    assert rows["I"]["chapter_codes"] == [1] and rows["I"]["total_exports"] == D("10.5")
    # TOTAL has no chapter (0); chapter 99 has no section.
    assert rows["??"]["chapter_codes"] == [0, 99] and rows["??"]["hs_code_count"] == 2
    assert codes.section_for_chapter(85)[0] == "XVI"
    assert codes.section_for_chapter(99) == ("??", "Unknown")


def test_time_series(t):
    # Years come from the period text.
    points = timeseries.annual_trend(t, flow="X")
    assert [(p["year"], p["value"]) for p in records(points)] == [(2020, D("17.5")), (2021, 20)]
    months = records(timeseries.monthly_trend(t))
    assert [(m["period"], m["month"], m["value"]) for m in months] == [("202103", 3, 9)]
    smooth = records(timeseries.rolling_average(points, window=2))
    assert [p["value"] for p in smooth] == [17.5, 18.75]
    rates = records(timeseries.growth_rates(points))
    assert rates[0]["growth"] is None and rates[1]["growth"] == 2.5 / 17.5
    with pytest.raises(ValueError):
        timeseries.rolling_average(points, window=0)


def test_growth_after_zero_and_cagr_edges(spark):
    zero = frame(spark, [row(1, 0, "2020", "X", "27", 0), row(1, 0, "2021", "X", "27", 5)])
    points = timeseries.annual_trend(zero)
    assert [p["growth"] for p in records(timeseries.growth_rates(points))] == [None, None]
    assert records(timeseries.cagr(points)) == [{"cagr": None}]
    flat = points.withColumn("value", points["value"] * 0)
    assert records(timeseries.cagr(flat)) == [{"cagr": 0.0}]
    assert records(timeseries.cagr(points, years=0)) == [{"cagr": None}]


def test_comparisons(t):
    made = compare.country_vs_country(t, reporter_codes=[1, 2], breakdown_by="partner")
    rows = {r["dimension_key"]: r for r in records(made.rows)}
    assert rows["2"]["value_0"] == D("14.5") and rows["2"]["delta_1"] == D("-14.5")
    assert rows["1"]["pct_change_1"] is None and rows["1"]["delta_1"] == 16
    # Labels are the first seen in the table, and all four flows are summed.
    assert rows["3"]["dimension_label"] == "CCC — Sealand" and rows["3"]["value_0"] == 120
    assert [r["dimension_key"] for r in records(made.rows)] == ["1", "2", "3"]
    assert [r["total_value"] for r in records(made.summary)] == [D("134.5"), 16]
    assert {r["reporter_code"] for r in records(made.sides)} == {1, 2}
    for bad in ([1], [1, 1]):
        with pytest.raises(ValueError):
            compare.country_vs_country(t, reporter_codes=bad)
    with pytest.raises(ValueError):
        compare.year_vs_year(t, reporter_code=1, period_a="2020", period_b="2020")
    with pytest.raises(ValueError):
        compare.country_vs_country(t, reporter_codes=[1, 2], flow="RX")


def test_comparison_equals_one_side_at_a_time(t):
    fused = {
        r["dimension_key"]: r
        for r in records(compare.country_vs_country(t, reporter_codes=[1, 2]).rows)
    }
    for i, code in enumerate((1, 2)):
        alone = t.filter(f"reporter_code = {code}").groupBy("commodity_code")
        for r in alone.sum("trade_value_primary_value").collect():
            assert fused[r[0]][f"value_{i}"] == r[1]


def test_partner_sums_make_the_country_total(t):
    whole = country.total_exports(t, reporter_code=1).first()[0]
    parts = partner.top_partners(t, reporter_code=1).agg({"total_exports": "sum"}).first()[0]
    assert whole == parts


def test_share_report_and_matrix(t):
    rows = records(reports.partner_share_report(t, reporter_code=1))
    assert [r["rank"] for r in rows] == [1, 2]
    assert rows[0]["share_pct"] == pytest.approx(20 / 30.5 * 100)
    no_exports = records(reports.partner_share_report(t, reporter_code=3))
    assert [r["share_pct"] for r in no_exports] == [0.0]
    cells = records(commodity.commodity_partner_matrix(t, partner_codes=[2, 3]))
    assert cells[0] == {"commodity_code": "0101", "partner_2": D("14.5"), "partner_3": None}


def test_partner_analysis(t):
    made = reports.partner_analysis(t, reporter_code=1, top_n=1, focus_partner=3)
    assert [r["partner_code"] for r in records(made["top_partners"])] == [3]
    assert records(made["growth"])[0]["point_count"] == 1


def test_composed_balance_without_codes(spark):
    rows = frame(
        spark,
        [
            row(1, 2, "2020", "M", "TOTAL", 3),
            row(1, 3, "2020", "X", "TOTAL", 8, partner_iso3=None),
            row(1, 3, "2020", "X", "TOTAL", 1),
        ],
    )
    got = records(balance.composed_balance(rows, reporter_code=1))
    assert [(r["partner_iso3"], r["net_trade"]) for r in got] == [("", -3), ("CCC", 9)]


def test_metrics_and_analysis(t, nothing):
    ratio = Metric.sum_primary_value() / Metric.count()
    run = (
        Analysis("a")
        .with_filter(Filter.reporter(1))
        .with_metric(Metric.count(), ratio, Metric.min_year())
        .with_aggregation(Aggregation("f", ("flow_code",), Metric.sum_primary_value()))
        .run(t)
    )
    assert run.metric("count") == 4 and run.metric(ratio.name) == 134.5 / 4
    assert records(run.counts) == [{"record_count": 8, "filtered_count": 4}]
    assert records(run.problems) == []
    assert {r["flow_code"]: r["metric_value"] for r in records(run.aggregation("f"))} == {
        "X": D("30.5"),
        "M": 4,
        "RX": 100,
    }
    empty = Analysis(metrics=(Metric.sum_primary_value(), Metric.avg_primary_value())).run(nothing)
    assert empty.metric("sum_primary_value") == 0
    assert [(p["name"], p["reason"]) for p in records(empty.problems)] == [("avg_primary_value", "no value")]
    with pytest.raises(ValueError):
        Aggregation("x", ("weight",), Metric.count())
    with pytest.raises(KeyError):
        run.metric("other")


def test_failed_metrics_leave_the_others(t):
    huge = Metric.total("huge", F.lit(D("9" * 38)))
    run = Analysis(
        metrics=(
            huge,
            Metric.custom("bad", F.sum(F.raise_error(F.lit("broken")).cast("int"))),
            Metric.mergeable("worse", {"n": F.max(F.assert_true(F.lit(False)))}, F.max("_worse_n").cast("int")),
            Metric.custom("none", F.col("no_such_column")),
            Metric.sum_primary_value(),
            Metric.distinct_partners(),
            Metric.distinct_reporters(),
        ),
        aggregations=(
            Aggregation("by_flow", ("flow_code",), Metric.distinct_partners()),
            Aggregation("all", (), Metric.count()),
            Aggregation("bad", ("flow_code",), Metric.custom("bad", F.sum(F.raise_error(F.lit("x")).cast("int")))),
            Aggregation("huge", ("flow_code",), huge),
        ),
    ).run(t)
    row = records(run.metrics)[0]
    assert list(row) == ["huge", "bad", "worse", "none", "sum_primary_value", "distinct_partners", "distinct_reporters"]
    plain = t.agg(F.sum("trade_value_primary_value"), F.count_distinct("partner_code"), F.count_distinct("reporter_code")).first()
    assert tuple(row.values()) == (None, None, None, None, *plain)
    told = {(p["kind"], p["name"]): p["reason"] for p in records(run.problems)}
    assert set(told) == {("metric", n) for n in ("huge", "bad", "worse", "none")} | {("aggregation", n) for n in ("bad", "huge")}
    assert told["metric", "huge"] == "a sum does not fit" and "broken" in told["metric", "bad"]
    flows = {r["flow_code"]: (r["metric_value"], r["record_count"]) for r in records(run.aggregation("by_flow"))}
    want = t.groupBy("flow_code").agg(F.count_distinct("partner_code").alias("n"), F.count(F.lit(1)).alias("c"))
    assert flows == {r.flow_code: (r.n, r.c) for r in want.collect()}
    assert [r["metric_value"] for r in records(run.aggregation("all"))] == [t.count()]
    assert records(run.aggregation("bad")) == records(run.aggregation("huge")) == []


def test_an_error_that_is_no_metric_s_own_stops_the_run(t):
    broken = t.withColumn("trade_value_primary_value", F.raise_error(F.lit("disk")).cast("decimal(38,18)"))
    with pytest.raises(Exception, match="disk"):
        Analysis(metrics=(Metric.sum_primary_value(),)).run(broken)


def test_last_of_two_metrics_with_one_name_is_used(t):
    run = Analysis(metrics=(Metric.count(), Metric.max_year().named("count"))).run(t)
    assert run.metric("count") == 2021
    assert (Filter.year(2020) & ~Filter.flow("X")).name == "(year=2020) AND (NOT (flow=X))"
