"""Code lists: countries, commodities, flows, units and other reference tables.

A list is a JSON document (bare list or ``{"data": [...]}``).  An entry that breaks its table's
rules is dropped; of the valid entries with the same key the first is kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.literals import literal_table
from tradelake.operators.ingest import blank
from tradelake.operators.quality import pick_one
from tradelake.schema import (
    COMMODITY_PATTERN,
    FLOW_CODES,
    FREQUENCY_CODES,
    TOTAL_COMMODITY,
    reading_order,
)
from tradelake.sources.responses import read_responses


def _raw(key: str) -> Column:
    """A value as text; absent, null and empty are all null."""
    return F.nullif(F.try_variant_get(F.col("rec"), f"$.{key}", "string"), F.lit(""))


def text(*keys: str) -> Column:
    """The first key that has a value, empty text when none has."""
    return F.coalesce(*[_raw(k) for k in keys], F.lit(""))


def number(*keys: str) -> Column:
    """Whole number of the first key the entry has; fractions and booleans are not numbers."""
    first = F.coalesce(
        *[F.try_variant_get(F.col("rec"), f"$.{k}", "variant") for k in keys]
    )
    digits = F.try_variant_get(first, "$", "string").try_cast("int")
    return F.when(F.schema_of_variant(first) != "BOOLEAN", digits)


def alpha(key: str) -> Column:
    """Upper-case country letters, empty is null."""
    return F.upper(_raw(key))


def day(key: str) -> Column:
    """Date part of an ISO date or timestamp; anything else is null."""
    head = F.regexp_extract(_raw(key), "^([^T ]*)", 1)
    iso = F.when(head.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), head)
    return F.to_date(iso.try_cast("date"))


def _filled(column: str) -> Column:
    return F.col(column).isNotNull() & ~blank(F.col(column))


def _letters(column: str, count: int) -> Column:
    return F.col(column).isNull() | F.col(column).rlike(f"^[A-Z]{{{count}}}$")


def _country(code_key: str, prefix: str) -> dict[str, Column]:
    return {
        "country_code": number(code_key, "id"),
        "iso_alpha2": alpha(f"{prefix}CodeIsoAlpha2"),
        "iso_alpha3": alpha(f"{prefix}CodeIsoAlpha3"),
        "display_name": text(f"{prefix}Desc", "text"),
        "entry_effective_date": day("entryEffectiveDate"),
        "entry_expired_date": day("entryExpiredDate"),
    }


def _country_rule() -> Column:
    ordered = F.col("entry_expired_date") > F.col("entry_effective_date")
    return (
        (F.col("country_code") >= 0)
        & _letters("iso_alpha2", 2)
        & _letters("iso_alpha3", 3)
        & _filled("display_name")
        & F.coalesce(ordered, F.lit(True))
    )


@dataclass(frozen=True)
class CodeList:
    """How one list is read: its columns, its key and what a valid entry is."""

    name: str
    columns: dict[str, Column]
    key: tuple[str, ...]
    valid: Column

    def parse(self, records: DataFrame, *, order: Sequence[str] | None = None) -> DataFrame:
        """Valid entries, first per key, from a frame with ``rec``."""
        order = order or reading_order(records)
        shaped = records.select(*order, *[c.alias(n) for n, c in self.columns.items()])
        good = shaped.filter(F.coalesce(self.valid, F.lit(False)))
        kept = pick_one(good, list(self.key), [F.col(c).asc() for c in order])
        return kept.select(*self.columns)


def _coded(name: str, code: str, rule: Column, code_column: Column | None = None) -> CodeList:
    columns = {
        code: code_column if code_column is not None else text("id"),
        "display_name": text("text"),
    }
    return CodeList(name, columns, (code,), rule & _filled("display_name"))


def hs_list(edition: str) -> CodeList:
    """Commodity codes of one edition; ``combined`` covers all of them."""
    code = F.col("commodity_code")
    named = F.col("display_name").isNull() | _filled("display_name")
    return CodeList(
        "hs_codes",
        {
            "commodity_code": text("id"),
            "classification_code": F.lit("HS"),
            "edition": F.lit(edition),
            "display_name": _raw("text"),
        },
        ("commodity_code",),
        ((code == TOTAL_COMMODITY) | code.rlike(COMMODITY_PATTERN)) & named,
    )


def code_lists() -> dict[str, CodeList]:
    """The lists by name."""
    reference = ("category", "variable", "description", "fileuri")
    filled = _filled("category")
    for column in reference[1:]:
        filled = filled & _filled(column)
    lists = [
        CodeList("references", {c: text(c) for c in reference}, ("category", "variable"), filled),
        CodeList(
            "reporters", _country("reporterCode", "reporter"), ("country_code",), _country_rule()
        ),
        CodeList(
            "partners", _country("PartnerCode", "Partner"), ("country_code",), _country_rule()
        ),
        hs_list("combined"),
        _coded(
            "frequencies", "frequency_code", F.col("frequency_code").isin(list(FREQUENCY_CODES))
        ),
        _coded("trade_flows", "flow_code", F.col("flow_code").isin(list(FLOW_CODES))),
        _coded("transport_modes", "mot_code", F.col("mot_code") >= 0, number("id")),
        CodeList(
            "quantity_units",
            {
                "qty_unit_code": number("qtyCode", "id"),
                "qty_abbr": text("qtyAbbr", "text"),
                "qty_description": text("qtyDescription"),
            },
            ("qty_unit_code",),
            F.col("qty_unit_code").isNotNull() & _filled("qty_abbr") & _filled("qty_description"),
        ),
        CodeList(
            "data_items",
            {"data_item": text("dataItem"), "description": text("description")},
            ("data_item",),
            _filled("data_item") & _filled("description"),
        ),
    ]
    return {one.name: one for one in lists}


#: Other names a list can be asked for.
ALIASES = {
    "countries": "reporters",
    "reporter": "reporters",
    "partner": "partners",
    "hs": "hs_codes",
    "hs_combined": "hs_codes",
    "frequency": "frequencies",
    "flows": "trade_flows",
    "modes_of_transport": "transport_modes",
    "units": "quantity_units",
    "reference": "references",
}


# The table names and numbers that lists are known by elsewhere.
TABLE_NAMES = {
    "References": "references",
    "R01": "references",
    "Reporters": "reporters",
    "R02": "reporters",
    "Partners": "partners",
    "R03": "partners",
    "HSCombined": "hs_codes",
    "R04": "hs_codes",
    "HSEdition": "hs_codes",
    "R05": "hs_codes",
    "Frequency": "frequencies",
    "R09": "frequencies",
    "TradeFlows": "trade_flows",
    "R10": "trade_flows",
    "TransportModes": "transport_modes",
    "R12": "transport_modes",
    "QuantityUnits": "quantity_units",
    "R14": "quantity_units",
    "DataItems": "data_items",
    "R15": "data_items",
}
#: Names of the commodity list of one edition, which must be given.
OF_AN_EDITION = ("HSEdition", "R05")


def code_list(name: str, *, edition: str | None = None) -> CodeList:
    """A list by its name, another name or a table name; commodity lists may name an edition."""
    if name in OF_AN_EDITION and edition is None:
        raise ValueError(f"{name} needs an edition; known: {list(HS_EDITIONS)}")
    known = TABLE_NAMES.get(name) or ALIASES.get(name, name)
    if known == "hs_codes" and edition is not None:
        return hs_list(edition)
    lists = code_lists()
    if known not in lists:
        raise KeyError(f"no code list {name!r}; known: {sorted(lists)}")
    return lists[known]


def read_code_list(
    spark: SparkSession, name: str, path: str | Sequence[str], *, edition: str | None = None
) -> DataFrame:
    """Read one list from its JSON document."""
    return code_list(name, edition=edition).parse(read_responses(spark, path))


# Classification systems and the editions of the Harmonized System.
CLASSIFICATIONS = (
    ("HS", "Harmonized System"),
    ("SITC", "Standard International Trade Classification"),
    ("BEC", "Broad Economic Categories"),
    ("EBOPS", "Extended Balance of Payments Services"),
)
HS_EDITIONS = ("HS2022", "HS2017", "HS2012", "HS2007", "HS2002", "HS1996", "HS1992")


def classifications(spark: SparkSession) -> DataFrame:
    columns = {"classification_code": "string", "display_name": "string"}
    return literal_table(spark, columns, CLASSIFICATIONS)


def classification_editions(spark: SparkSession, classification_code: str = "HS") -> DataFrame:
    """Editions of a classification, newest first; only those of HS are known."""
    rows = [("HS", i, e) for i, e in enumerate(HS_EDITIONS, start=1)]
    columns = {"classification_code": "string", "edition_no": "int", "edition": "string"}
    table = literal_table(spark, columns, rows)
    return table.filter(F.col("classification_code") == classification_code)


# -- lookups ----------------------------------------------------------------------------------


def by_code(df: DataFrame, code, *, column: str = "country_code") -> DataFrame:
    """The entry with a code: one row or none."""
    return df.filter(F.col(column) == F.lit(code)).limit(1)


def by_name(
    df: DataFrame,
    name: str,
    *,
    column: str = "display_name",
    case_sensitive: bool = False,
    exact: bool = True,
) -> DataFrame:
    """Entries whose name equals or contains a text."""
    value, wanted = F.col(column), name
    if not case_sensitive:
        value, wanted = F.lower(value), name.lower()
    return df.filter(value == F.lit(wanted) if exact else F.contains(value, F.lit(wanted)))


def search(
    df: DataFrame,
    query: str,
    *,
    columns: Sequence[str] | None = None,
    case_sensitive: bool = False,
) -> DataFrame:
    """Entries with the text in any text column, or in the given ones; empty text finds nothing."""
    if not query:
        return df.limit(0)
    wanted = F.lit(query if case_sensitive else query.lower())
    found = F.lit(False)
    for field in df.schema:
        asked = columns is None or field.name in columns
        if asked and isinstance(field.dataType, T.StringType):
            value = F.col(field.name) if case_sensitive else F.lower(F.col(field.name))
            found = found | F.coalesce(F.contains(value, wanted), F.lit(False))
    return df.filter(found)


def search_hs(df: DataFrame, query: str) -> DataFrame:
    """Commodity codes by a part of their description, whatever the case; unnamed codes never."""
    return df.filter(F.contains(F.lower("display_name"), F.lit(query.lower())))


def enrich(
    df: DataFrame, codes: DataFrame, on: str, *, code: str, columns: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Add columns of a code list to the rows whose ``on`` code is listed; others get null.

    A code list has one row per code, so the row count never changes.  Whether it is small
    enough to broadcast is left to its measured size.
    """
    added = codes.select(
        F.col(code).alias("_code"), *[F.col(c).alias(f"{prefix}{c}") for c in columns]
    )
    return df.join(added, F.col(on) == F.col("_code"), "left").drop("_code")
