"""Plans that have to hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.rows import frame, row
from tradelake.operators import balance, commodity, compare, country, ingest, quality, update
from tradelake.operators.metrics import Filter
from tradelake.operators.predicates import FieldTest
from tradelake.operators.query import Query
from tradelake.schema import SEQ, VALUE, as_narrow
from tradelake.sources import datasets
from tradelake.sources.fixtures import trade_table
from tradelake.sources.responses import records_from_text


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "d")
    rows = [row(1 + i % 4, i % 3, 2018 + i % 3, "XM"[i % 2], "27", i) for i in range(60)]
    datasets.write_dataset(frame(spark, rows), path)
    return datasets.open_dataset(spark, path)


@pytest.fixture(scope="module")
def hot(spark):
    """100,000 rows, a third of them with one key."""
    base = frame(spark, [row(1, 2, 2020, "X", "27", 1)]).drop(SEQ, VALUE, "partner_code")
    numbers = spark.range(0, 100_000, numPartitions=8).select(
        F.col("id").alias(SEQ),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).cast("int")
        .alias("partner_code"),
        F.col("id").cast("decimal(38,18)").alias(VALUE),
    )
    return numbers.select("*", *[F.lit(base.first()[c]).cast(base.schema[c].dataType).alias(c)
                                 for c in base.columns])


@pytest.mark.parametrize("name", sorted(set(entry.trade_queries()) - set(entry._storage())))
def test_no_pair_joins_and_no_row_python(spark, name):
    text = plan(entry.trade_queries()[name](spark, SF_SMALL))
    for never in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert never not in text


def test_reports_reduce_facts_in_hash_maps(stored):
    """Below the first exchange only a hash aggregate runs: no sort of the facts."""
    for df in (
        balance.country_balance(stored),
        country.country_ranking(stored, flow="X", limit=3),
        commodity.sector_summaries(stored),
        compare.country_vs_country(stored, reporter_codes=[1, 2]).rows,
    ):
        for scan in plan(df).split("FileScan")[:-1]:
            below = scan.rsplit("Exchange", 1)[-1]
            assert "HashAggregate" in below and "Sort" not in below


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(balance.partner_trade_balance(stored, reporter_code=1))
    assert "PartitionFilters: [isnotnull(reporter_code" in text
    assert "ReadSchema: struct<partner_code:int,partner_iso3:string,partner_name:string," in text
    late = FieldTest("partner_code", "ge", 2)
    text = plan(Query(stored).filter(late).filter(flow_code="X").frame())
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(partner_code,2\)", text)
    assert "EqualNullSafe(flow_code,X)" in text or "EqualTo(flow_code,X)" in text
    text = plan(Filter.year_in(2018, 2019).apply(stored))
    assert "PartitionFilters: [isnotnull(ref_year" in text


def test_comparison_is_one_in_filter(stored):
    made = compare.country_vs_country(stored, reporter_codes=[1, 2, 3], breakdown_by="period")
    text = plan(made.rows)
    assert text.count("FileScan") == 1 and "reporter_code#" in text and "IN (1,2,3)" in text


def test_duplicate_rules_cut_before_the_shuffle(hot):
    for df in (quality.first_wins(hot), quality.last_wins(hot), quality.latest_wins(hot)):
        assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", plan(df))


def test_results_are_whole_with_a_hot_key(hot):
    kept = quality.first_wins(hot)
    assert kept.count() == 5000
    assert kept.filter("partner_code = 0").first()[SEQ] == 0
    assert quality.duplicate_members(hot).count() == 100_000
    last = quality.last_wins(hot).filter("partner_code = 0").first()[SEQ]
    assert last == 99_999
    merged = update.combine(hot, quality.last_wins(hot.filter(f"{SEQ} < 10")), "merge")
    # Ten rows bring the keys 0, 1, 2, 4, 5, 7 and 8; all older rows of these keys go.
    gone = hot.filter("partner_code in (0, 1, 2, 4, 5, 7, 8)").count()
    assert merged.count() == 100_000 - gone + 7


def test_order_scan_steps_are_hash_exchanges(hot):
    text = plan(quality.count_decreases(hot, "ref_period_id"))
    assert text.count("hashpartitioning(run") == 4
    (single,) = re.findall(r"SinglePartition.*\n *\+- (\w+)", text)
    assert single == "HashAggregate"


def test_offset_without_limit_stays_distributed(hot):
    text = plan(Query(hot).sort("primary_value").offset(10).frame())
    assert "SinglePartition" not in text and "TakeOrderedAndProject" in text


def test_records_are_parsed_once(spark):
    raw = spark.createDataFrame([(1, "{}")], "_seq bigint, json string")
    for df in (
        ingest.accepted(ingest.parse_records(records_from_text(raw, "json", "_seq"))),
        ingest.reject_counts(ingest.parse_records(records_from_text(raw, "json", "_seq"))),
    ):
        text = plan(df)
        assert text.count("parseJson") == 1
        assert len(re.findall(r"try_variant_get\([^,]*, \$, StructField\(typeCode", text)) == 1


def test_unused_dimensions_are_not_joined(spark):
    text = plan(balance.country_balance(
        trade_table(spark, SF_SMALL, partner=False, commodity=False)))
    assert "supplier.parquet" in text and "nation.parquet" in text
    assert "orders.parquet" not in text and "part.parquet" not in text


def scans(df):
    """Reads of the facts in the plan that runs, whatever parts are reused."""
    return df._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")


@pytest.mark.parametrize(
    ("name", "most"), [("balance_full_outer", 2), ("update_counts", 5), ("country_balance", 1), ("engine_run", 1)]
)
def test_number_of_fact_scans(spark, name, most):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    df = entry.trade_queries()[name](spark, SF_SMALL)
    assert 0 < scans(df) <= most


def test_numbering_has_no_single_task(spark, tmp_path):
    from tradelake.operators.numbering import number_rows

    rows = spark.range(1000).selectExpr(
        "concat('f', id % 7) as _src_file", "id as _src_pos", "id as n"
    )
    numbered = number_rows(rows, str(tmp_path / "n"), 5)
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()
    got = numbered.orderBy("_seq").collect()
    assert [r["_seq"] for r in got] == list(range(5, 1005))
    assert [(r["_src_file"], r["_src_pos"]) for r in got] == sorted((r["_src_file"], r["_src_pos"]) for r in got)


def test_distinct_counts_do_not_copy_facts(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    text = plan(entry.trade_queries()["metrics_all"](spark, SF_SMALL))
    below = text.split("Expand", 1)[1]
    assert "HashAggregate" in below and "Expand" not in below and scans_of(text) == 1


def scans_of(text):
    return text.count("lineitem.parquet")


def largest_methods(spark, df):
    """Bytes of the largest method in each piece of whole-stage code of a plan."""
    package = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    pieces = getattr(package, "MODULE$").codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [pieces.apply(i)._3().maxMethodCodeSize() for i in range(pieces.size())]


def test_methods_of_the_parse_are_small_enough_to_be_compiled(spark, tmp_path):
    spark.createDataFrame([(1, "{}")], "_seq bigint, json string").write.parquet(str(tmp_path / "raw"))
    raw = records_from_text(spark.read.parquet(str(tmp_path / "raw")), "json", "_seq")
    for df in (ingest.accepted(ingest.parse_records(raw)), ingest.reject_counts(ingest.parse_records(raw)).select("reason")):
        if "AdaptiveSparkPlan" in plan(df):
            df.collect()
        sizes = largest_methods(spark, df)
        assert sizes and max(sizes) <= 8000, sizes


def test_shortcuts_of_the_checks_agree_with_their_patterns(spark):
    texts = ["", " ", "\t\n", " ", "　 ", " a", " a", "a", "!", "~", "\x7f", "é", "0", "\x1f"]
    blanks = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.expr(ingest._blank("t")).alias("short"), F.col("t").rlike(ingest.BLANK).alias("whole")
    )
    assert all(r["short"] == r["whole"] for r in blanks.collect())
    tokens = {
        "1.0000000000000000001": True, "0.000000000000000001": False, "1e-19": True, "1E-18": False,
        '"1.0000000000000000001"': True, '"1.5e-18"': True, "1.50e-18": True, "10e-19": False, "12": False,
        "1.000000000000000000000": False,
    }
    fine = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", F.expr(ingest._too_fine("t")).alias("f"))
    assert {r["t"]: r["f"] for r in fine.collect()} == tokens


def test_windows_and_key_joins_sort_by_a_hash_first(hot):
    for df in (quality.first_wins(hot), quality.last_wins(hot), quality.latest_wins(hot)):
        assert "xxhash64(" in plan(df)
    assert "_key_hash" in plan(update.untouched(hot, quality.last_wins(hot)))


def test_rows_are_moved_narrow_and_their_order_is_made_once(stored):
    given = stored.drop("provenance").withColumn("quantity_qty", F.col("ref_year") + 1)
    narrow = as_narrow(given, datasets.PARTITION_COLUMNS)
    assert narrow.schema["quantity_qty"].dataType.simpleString() == "int" and "provenance" not in narrow.columns
    (order,) = re.findall(r"Sort \[(.*?)\]", plan(datasets.spread(given, datasets.PARTITION_COLUMNS)))
    assert "cast(" not in order and "_text_commodity_code" in order


def test_documents_are_made_where_their_rows_lie_and_saved_compressed(spark, tmp_path):
    """Rows of a document are moved as line items: no text of a record is in an exchange or a sort."""
    from pathlib import Path

    from tradelake.session import HASHED_LISTS
    from tradelake.sources import fixtures
    from tradelake.sources.responses import read_envelopes, read_responses

    rows = fixtures.raw_trade(spark, SF_SMALL, F.floor(F.col(SEQ) / 4000))
    lists = rows.groupBy("doc").agg(F.collect_list("json").alias("texts"))
    text = plan(lists)
    made = text.index("AS json#")
    assert "Exchange" not in text[:made] and "Sort " not in text[:made] and "Exchange" in text[made:]
    plain = fixtures.raw_trade(spark, SF_SMALL)
    assert rows.select(SEQ, "json").exceptAll(plain).count() == 0 and rows.count() == plain.count()

    hashed = spark.conf.get(HASHED_LISTS)
    entry.read_documents(spark, SF_SMALL)
    assert spark.conf.get(HASHED_LISTS) == hashed
    folder = max(Path(entry.work_folder(spark).removeprefix("file:")).glob("responses-*"), key=lambda p: p.stat().st_mtime)
    saved = [f for f in folder.rglob("part-*") if "doc=none" not in str(f)]
    assert saved and all(f.name.endswith(".txt.gz") for f in saved)
    assert len(saved) == rows.select("doc").distinct().count()
    assert read_responses(spark, str(folder)).count() == plain.count()
    assert read_envelopes(spark, str(folder)).agg(F.sum("record_count")).first()[0] == plain.count()
