"""The canonical trade table: column types, composite key and value domains.

One row is one trade observation.  The layout is flat (47 columns); ``SEQ`` is an
engine column that numbers rows in the order they were read, which is what every
"first seen" and "first wins" rule is defined on.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_VERSION = "1.0.0"

AMOUNT = T.DecimalType(38, 18)

#: Row number in reading order; a later ingest or update goes on where the stored numbers end.
SEQ = "_seq"

#: Where a record was read: its file, and its place in it.  Files follow path order.
SOURCE_FILE, SOURCE_POSITION = "_src_file", "_src_pos"

VALUE = "trade_value_primary_value"


def _field(name: str, kind: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, kind, nullable=not required)


# Names, order and types of the canonical columns.
CANONICAL = T.StructType(
    [
        _field("type_code", T.StringType(), True),
        _field("frequency_code", T.StringType(), True),
        _field("classification_code", T.StringType(), True),
        _field("classification_search_code", T.StringType()),
        _field("edition", T.StringType(), True),
        _field("is_original_classification", T.BooleanType()),
        _field("ref_period_id", T.LongType()),
        _field("ref_year", T.IntegerType(), True),
        _field("ref_month", T.IntegerType(), True),
        _field("period", T.StringType(), True),
        _field("reporter_code", T.IntegerType(), True),
        _field("reporter_iso3", T.StringType()),
        _field("reporter_name", T.StringType()),
        _field("partner_code", T.IntegerType(), True),
        _field("partner_iso3", T.StringType()),
        _field("partner_name", T.StringType()),
        _field("partner2_code", T.IntegerType()),
        _field("partner2_iso3", T.StringType()),
        _field("partner2_name", T.StringType()),
        _field("flow_code", T.StringType(), True),
        _field("flow_name", T.StringType()),
        _field("commodity_code", T.StringType(), True),
        _field("commodity_name", T.StringType()),
        _field("customs_code", T.StringType(), True),
        _field("customs_name", T.StringType()),
        _field("mos_code", T.StringType(), True),
        _field("mot_code", T.IntegerType(), True),
        _field("mot_name", T.StringType()),
        _field("quantity_qty", AMOUNT),
        _field("quantity_qty_unit_code", T.IntegerType(), True),
        _field("quantity_qty_unit_abbr", T.StringType()),
        _field("quantity_is_estimated", T.BooleanType(), True),
        _field("quantity_alt_qty", AMOUNT),
        _field("quantity_alt_qty_unit_code", T.IntegerType()),
        _field("quantity_alt_qty_unit_abbr", T.StringType()),
        _field("quantity_is_alt_qty_estimated", T.BooleanType(), True),
        _field("net_weight_kg", AMOUNT),
        _field("is_net_weight_estimated", T.BooleanType(), True),
        _field("gross_weight_kg", AMOUNT),
        _field("is_gross_weight_estimated", T.BooleanType(), True),
        _field("trade_value_primary_value", AMOUNT, True),
        _field("trade_value_fob_value", AMOUNT),
        _field("trade_value_cif_value", AMOUNT),
        _field("legacy_estimation_flag", T.IntegerType(), True),
        _field("is_reported", T.BooleanType(), True),
        _field("is_aggregate", T.BooleanType(), True),
        _field("provenance", T.StringType()),
    ]
)

COLUMNS = tuple(CANONICAL.names)

#: The ten parts that identify an observation; an absent second partner counts as 0.
COMPOSITE_KEY = (
    "reporter_code",
    "partner_code",
    "period",
    "flow_code",
    "commodity_code",
    "classification_code",
    "edition",
    "customs_code",
    "mot_code",
    "partner2_code",
)

#: Storage layout: one directory per reporter, year and frequency.
PARTITION_COLUMNS = ("reporter_code", "ref_year", "frequency_code")

#: Row order inside stored files, compared as text.
FILE_ORDER = ("ref_period_id", "reporter_code", "partner_code", "flow_code", "commodity_code")

# Domains accepted on ingest.
FLOW_CODES = ("M", "X", "RX", "RM")
TYPE_CODES = ("C", "S")
FREQUENCY_CODES = ("A", "M")
TOTAL_COMMODITY = "TOTAL"
WORLD_CODE = 0
WORLD_ISO3 = "W00"
ANNUAL_MONTH = 52
MIN_YEAR, MAX_YEAR = 1900, 2100
PERIOD_PATTERN = r"^[0-9]{4}([0-9]{2})?$"
COMMODITY_PATTERN = r"^([0-9]{2}|[0-9]{4}|[0-9]{6}|[0-9]{8}|[0-9]{10})$"


def key_columns(key: tuple[str, ...] = COMPOSITE_KEY) -> list[Column]:
    """Key expressions under their own names, with a missing ``partner2_code`` read as 0."""
    return [
        F.coalesce(F.col(c), F.lit(0)).alias(c) if c == "partner2_code" else F.col(c) for c in key
    ]


def reading_order(df: DataFrame) -> tuple[str, ...]:
    """The columns that order rows as they were read: the row number, or file and place."""
    if SEQ not in df.columns and SOURCE_POSITION in df.columns:
        return (SOURCE_FILE, SOURCE_POSITION)
    return (SEQ,)


def sequence_or_zero(df: DataFrame) -> Column:
    """The reading-order column, or a constant for frames that do not carry one."""
    return F.col(SEQ) if SEQ in df.columns else F.lit(0).cast("bigint")


def as_canonical(df: DataFrame) -> DataFrame:
    """Cast to the stored types in stored order, adding absent optional columns as null.

    ``SEQ`` is kept when present.  Missing required columns are an error.
    """
    present = set(df.columns)
    missing = [f.name for f in CANONICAL if f.name not in present and not f.nullable]
    if missing:
        raise ValueError(f"frame lacks required canonical columns: {missing}")
    picked = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in CANONICAL
    ]
    return df.select(*picked, *([SEQ] if SEQ in present else []))


def as_narrow(df: DataFrame, early: Iterable[str]) -> DataFrame:
    """The canonical columns ``df`` has, those in ``early`` always there and in their stored types.

    For rows still to be moved or sorted: ``as_canonical`` afterwards adds absent columns and widens
    amounts.  Missing required columns are an error here, too.
    """
    names, early = as_canonical(df).columns, {*early}
    picked = [
        (F.col(n) if n in df.columns else F.lit(None)).cast(CANONICAL[n].dataType).alias(n)
        if n in early and n != SEQ
        else F.col(n)
        for n in names
        if n in early or n in df.columns
    ]
    return df.select(*picked)


def nested_record() -> list[Column]:
    """Select list for the nested view of a flat row (reporter, partner, quantity, ...)."""
    groups = {
        "reporter": ("reporter_code", "reporter_iso3", "reporter_name"),
        "partner": ("partner_code", "partner_iso3", "partner_name"),
        "partner2": ("partner2_code", "partner2_iso3", "partner2_name"),
        "flow": ("flow_code", "flow_name"),
        "commodity": ("commodity_code", "commodity_name"),
        "quantity": tuple(c for c in COLUMNS if c.startswith("quantity_")),
        "trade_value": tuple(c for c in COLUMNS if c.startswith("trade_value_")),
    }
    grouped = {c for members in groups.values() for c in members}
    flat = [F.col(c) for c in COLUMNS if c not in grouped]
    packed = []
    for name, members in groups.items():
        body = F.struct(*members)
        if name == "partner2":
            body = F.when(F.col("partner2_code").isNotNull(), body)
        packed.append(body.alias(name))
    return flat + packed


def flat_record() -> list[Column]:
    """Select list that undoes :func:`nested_record`."""
    owner = {
        "reporter_": "reporter",
        "partner_": "partner",
        "partner2_": "partner2",
        "flow_": "flow",
        "commodity_": "commodity",
        "quantity_": "quantity",
        "trade_value_": "trade_value",
    }
    picked = []
    for name in COLUMNS:
        group = next((g for prefix, g in owner.items() if name.startswith(prefix)), None)
        picked.append(F.col(f"{group}.{name}").alias(name) if group else F.col(name))
    return picked
