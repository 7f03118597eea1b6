"""Adapter: the star-schema test tables read as one trade table.

Line items are the facts; supplier nation is the reporter, customer nation the partner and the
part gives the commodity.  Every line item has exactly one match in each dimension (a property
of the tables, checked by the tests), so a dimension nobody asks for is not joined at all.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradelake.schema import ANNUAL_MONTH, SEQ

@lru_cache(maxsize=256)
def _file_schema(path: str) -> StructType:
    """Schema of a test table.  The files never change, so each footer is read once."""
    return SparkSession.getActiveSession().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_file_schema(path)).parquet(path)


def _nation_iso3(side: str) -> str:
    code = f"{side}_code"
    return (
        f"concat('N', char(65 + cast(floor({code} / 5) as int)), char(65 + {code} % 5))"
        f" as {side}_iso3"
    )


# The trade columns a line item gives by itself.
FACT_COLUMNS = (
    f"l_orderkey * 8 + l_linenumber as {SEQ}",
    "'C' as type_code",
    "case when l_linenumber % 3 = 0 then 'M' else 'A' end as frequency_code",
    "'H6' as classification_code",
    "'H6' as edition",
    """cast(case when l_linenumber % 3 = 0
      then year(l_shipdate) * 10000 + month(l_shipdate) * 100 + 1
      else year(l_shipdate) * 10000 + 101 end as bigint) as ref_period_id""",
    "year(l_shipdate) as ref_year",
    f"case when l_linenumber % 3 = 0 then month(l_shipdate) else {ANNUAL_MONTH} end as ref_month",
    """cast(case when l_linenumber % 3 = 0 then year(l_shipdate) * 100 + month(l_shipdate)
      else year(l_shipdate) end as string) as period""",
    """case when l_returnflag = 'A' then 'X' when l_returnflag = 'R' then 'M'
      when l_linestatus = 'F' then 'RX' else 'RM' end as flow_code""",
    "'C00' as customs_code",
    "'0' as mos_code",
    "(l_linenumber % 4) * 1000 as mot_code",
    "cast(l_quantity as decimal(18,2)) as quantity_qty",
    "cast(l_extendedprice as decimal(18,2)) as trade_value_primary_value",
    """case when l_returnflag <> 'R' then cast(cast(l_extendedprice as decimal(18,2))
      * (1 - cast(l_discount as decimal(4,2))) as decimal(24,4)) end as trade_value_fob_value""",
    """case when l_returnflag <> 'A' then cast(cast(l_extendedprice as decimal(18,2))
      * (1 + cast(l_tax as decimal(4,2))) as decimal(24,4)) end as trade_value_cif_value""",
)

COMMODITY = """
case when p_partkey % 50 = 0 then 'TOTAL'
  when p_size % 5 = 0 then lpad(cast(p_partkey % 99 + 1 as string), 2, '0')
  when p_size % 5 = 1 then concat(lpad(cast(p_partkey % 99 + 1 as string), 2, '0'),
    lpad(cast(p_partkey % 7 as string), 2, '0'))
  else concat(lpad(cast(p_partkey % 99 + 1 as string), 2, '0'),
    lpad(cast(p_partkey % 7 as string), 2, '0'), '10') end as commodity_code"""


def trade_table(
    spark: SparkSession,
    sf_dir: str,
    *,
    reporter: bool = True,
    partner: bool = True,
    commodity: bool = True,
    extra: tuple[str, ...] = (),
    doc: Column | None = None,
) -> DataFrame:
    """The trade table, optionally without the reporter, partner or commodity columns.

    ``extra`` names line item columns to carry along.  ``doc``, made of the row number, becomes a
    column; rows of one ``doc`` lie together and in its order.
    """
    facts = table(spark, sf_dir, "lineitem")
    picked = [*FACT_COLUMNS, *extra]
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    if commodity:
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.expr(COMMODITY),
            F.col("p_type").alias("commodity_name"),
        )
        facts = facts.join(part, "l_partkey")
        picked += ["commodity_code", "commodity_name"]
    if reporter:
        supplier = table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("reporter_code")
        )
        # Names come last: a nation row is wide and need not travel through the big join.
        names = nations.select(
            F.col("n_nationkey").alias("reporter_code"), F.col("n_name").alias("reporter_name")
        )
        facts = facts.join(supplier, "l_suppkey").join(names, "reporter_code")
        picked += ["reporter_code", _nation_iso3("reporter"), "reporter_name"]
    if partner:
        customer = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("partner_code")
        )
        names = nations.select(
            F.col("n_nationkey").alias("partner_code"), F.col("n_name").alias("partner_name")
        )
        # Orders meet customers first, so the line items are moved once, by order key.
        orders = (
            table(spark, sf_dir, "orders")
            .select("o_orderkey", "o_custkey")
            .join(customer, "o_custkey")
            .select(F.col("o_orderkey").alias("l_orderkey"), "partner_code")
        )
        facts = facts.join(orders, "l_orderkey").join(names, "partner_code")
        picked += [
            "partner_code",
            _nation_iso3("partner"),
            "partner_name",
            "cast(null as int) as partner2_code",
        ]
    if doc is not None:
        # Line items are moved as they are read, their trade columns made afterwards.
        facts = facts.withColumn(SEQ, F.expr(FACT_COLUMNS[0])).withColumn("doc", doc).drop(SEQ)
        facts = facts.repartition("doc").sortWithinPartitions("doc")
        picked += ["doc"]
    return facts.selectExpr(*picked)


# Raw JSON of a trade row.  What is wrong or unusual about a record goes by its part number.
_DEFECT = "l_partkey % 23"
_RAW_PIECES = (
    """'"typeCode":"C"'""",
    f"""concat('"freqCode":"', if({_DEFECT} = 1, 'Q', frequency_code), '"')""",
    "concat('\"refPeriodId\":', ref_period_id)",
    f"""concat('"refYear":', case {_DEFECT} when 4 then '1899'
      when 12 then concat('" ', ref_year, ' "') else string(ref_year) end)""",
    f"""concat('"refMonth":', if({_DEFECT} = 3, 13, ref_month))""",
    """concat('"period":"', period, '"')""",
    "concat('\"reporterCode\":', reporter_code)",
    f"""concat('"reporterISO":"', if({_DEFECT} = 5, 'in1', reporter_iso3), '"')""",
    f"""concat('"reporterDesc":"', if({_DEFECT} = 14, '  ', reporter_name), '"')""",
    f"""concat('"flowCode":"', if({_DEFECT} = 0, 'DX', flow_code), '"')""",
    f"""concat('"partnerCode":', if({_DEFECT} = 15, 'true', string(partner_code)))""",
    """concat('"partnerISO":"', partner_iso3, '","partnerDesc":"', partner_name, '"')""",
    f"""case {_DEFECT} when 9 then '"partner2Code":0,"partner2ISO":"W00","partner2Desc":"World"'
      when 16 then '"partner2Code":7,"partner2ISO":"NBC"' end""",
    """'"classificationCode":"H6","classificationSearchCode":"","isOriginalClassification":true'""",
    f"""concat('"cmdCode":"', if({_DEFECT} = 2, '123', commodity_code), '"')""",
    """'"customsCode":"C00","mosCode":"0"'""",
    f"""concat('"motCode":', if({_DEFECT} = 13, concat(mot_code, '.7'), string(mot_code)))""",
    """concat('"qtyUnitCode":-1,"qty":', quantity_qty)""",
    f"""case {_DEFECT} when 7 then null
      when 6 then concat('"primaryValue":-', trade_value_primary_value)
      when 11 then concat('"primaryValue":"', trade_value_primary_value, '3456789012"')
      else concat('"primaryValue":', trade_value_primary_value) end""",
    """concat('"fobvalue":', trade_value_fob_value)""",
    """concat('"cifvalue":', trade_value_cif_value)""",
    f"""concat('"isReported":', case {_DEFECT} when 8 then '1' when 17 then '" True "'
      else 'false' end)""",
    f"""if({_DEFECT} = 10, '"isLeaf":true,"dataset":"d7","revision":2', '"aggrLevel":6')""",
)


def full_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade table with every required column filled, as a store wants it."""
    flags = (
        "quantity_is_estimated",
        "quantity_is_alt_qty_estimated",
        "is_net_weight_estimated",
        "is_gross_weight_estimated",
        "is_reported",
        "is_aggregate",
    )
    return trade_table(spark, sf_dir).withColumns(
        {
            "quantity_qty_unit_code": F.lit(-1),
            "legacy_estimation_flag": F.lit(0),
            **{name: F.lit(False) for name in flags},
        }
    )


def raw_trade(spark: SparkSession, sf_dir: str, doc: Column | None = None) -> DataFrame:
    """The trade table as raw JSON records with planted defects: ``_seq`` and ``json``.

    With ``doc`` they come with that number, those of one number together and in its order.  Rows are
    moved and sorted for it before they are made into text, which is many times as long.
    """
    pieces = ",\n".join(_RAW_PIECES)
    kept = [SEQ] if doc is None else [SEQ, "doc"]
    rows = trade_table(spark, sf_dir, extra=("l_partkey",), doc=doc)
    return rows.selectExpr(*kept, f"concat('{{', concat_ws(',', {pieces}), '}}') as json")


def raw_reporters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a raw reporter list, listed twice, with entries that break the rules."""
    nation = table(spark, sf_dir, "nation")
    return nation.selectExpr(
        "inline(array(struct(0 as copy), struct(1 as copy)))", "n_nationkey", "n_name"
    ).selectExpr(
        "n_nationkey + 1000 * copy as entry_no",
        """concat('{', concat_ws(',',
          case when n_nationkey % 7 = 1 then concat('"id":"', n_nationkey, '"')
            else concat('"reporterCode":', n_nationkey) end,
          concat('"reporterCodeIsoAlpha3":"', case when n_nationkey % 7 = 4 then 'ABCD'
            when n_nationkey % 7 = 2 then 'abc' when n_nationkey % 7 = 3 then '' else 'XYZ' end, '"'),
          case when n_nationkey % 7 = 6 and copy = 0 then '"reporterDesc":" "'
            else concat('"text":"', n_name, if(copy = 0, '', ' again'), '"') end,
          '"entryEffectiveDate":"1990-01-01T00:00:00"',
          case when n_nationkey % 7 = 5 then '"entryExpiredDate":"1980-12-31"'
            when n_nationkey % 7 = 0 then '"entryExpiredDate":"2001-05-06 07:08"'
            else '"entryExpiredDate":"soon"' end), '}') as json""",
    )


def commodity_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a raw commodity list: a code, a description, a number for the order."""
    part = table(spark, sf_dir, "part")
    return part.selectExpr(COMMODITY, "p_partkey", "p_name").selectExpr(
        "p_partkey as entry_no",
        """concat('{"id":"', if(p_partkey % 11 = 0, '123', commodity_code), '"',
          if(p_partkey % 13 = 0, '', concat(',"text":"', commodity_code, ' - ', p_name, '"')), '}')
          as json""",
    )
