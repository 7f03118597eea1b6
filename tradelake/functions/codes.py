"""Commodity-code and period-text functions, all plain column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.literals import literal_table
from tradelake.schema import PERIOD_PATTERN

# Sections of the Harmonized System nomenclature with their chapter ranges.
HS_SECTIONS = (
    ("I", "Live animals; animal products", 1, 5),
    ("II", "Vegetable products", 6, 14),
    ("III", "Animal or vegetable fats and oils", 15, 15),
    ("IV", "Prepared foodstuffs; beverages, spirits, vinegar; tobacco", 16, 24),
    ("V", "Mineral products", 25, 27),
    ("VI", "Products of the chemical or allied industries", 28, 38),
    ("VII", "Plastics and articles thereof; rubber and articles thereof", 39, 40),
    ("VIII", "Raw hides and skins, leather, furskins; saddlery", 41, 43),
    ("IX", "Wood; charcoal; cork; manufactures of straw", 44, 46),
    ("X", "Pulp; paper; paperboard", 47, 49),
    ("XI", "Textiles and textile articles", 50, 63),
    ("XII", "Footwear, headgear; umbrellas; feathers", 64, 67),
    ("XIII", "Articles of stone, plaster, cement; ceramic; glass", 68, 70),
    ("XIV", "Natural or cultured pearls; precious stones; metals", 71, 71),
    ("XV", "Base metals; articles of base metal", 72, 83),
    ("XVI", "Machinery and mechanical appliances; electrical equipment", 84, 85),
    ("XVII", "Vehicles, aircraft, vessels", 86, 89),
    ("XVIII", "Optical, photographic, cinematographic, measuring, medical instruments", 90, 92),
    ("XIX", "Arms and ammunition", 93, 93),
    ("XX", "Miscellaneous manufactured articles", 94, 96),
    ("XXI", "Works of art, collectors' pieces, antiques", 97, 98),
)
UNKNOWN_SECTION = ("??", "Unknown")


def leading_digits(code: Column) -> Column:
    """The run of digits a code starts with (possibly empty)."""
    return F.regexp_extract(code, r"^([0-9]*)", 1)


def hs_digits(code: Column) -> Column:
    """How many digits a code starts with; this is its level in the nomenclature."""
    return F.length(leading_digits(code))


def hs_chapter(code: Column) -> Column:
    """First two digits as a number, null when the code starts with fewer."""
    head = F.regexp_extract(code, r"^([0-9]{2})", 1)
    return F.when(F.length(head) == 2, head.cast("int"))


#: Periods that name a year, and those that name a month of one.
HAS_YEAR = "^[0-9]{4}"
HAS_MONTH = "^[0-9]{4}(0[1-9]|1[0-2])"


def section_of(chapter: Column) -> Column:
    """Section id of a chapter; chapters outside the nomenclature (or null) are unknown."""
    out = F
    for section_id, _, low, high in HS_SECTIONS:
        out = out.when((chapter >= low) & (chapter <= high), F.lit(section_id))
    return out.otherwise(F.lit(UNKNOWN_SECTION[0]))


def section_for_chapter(chapter: int) -> tuple[str, str]:
    """Section id and name of one chapter number."""
    for section_id, name, low, high in HS_SECTIONS:
        if low <= chapter <= high:
            return section_id, name
    return UNKNOWN_SECTION


def section_table(spark: SparkSession) -> DataFrame:
    """The 22 section rows (21 plus unknown) in nomenclature order."""
    rows = [(i, s[0], s[1]) for i, s in enumerate((*HS_SECTIONS, UNKNOWN_SECTION), start=1)]
    columns = {"section_no": "int", "sector_id": "string", "sector_name": "string"}
    return literal_table(spark, columns, rows)


def period_list(periods: str | Sequence[str]) -> list[str]:
    """Split and check a period argument such as ``"2020,2021"``."""
    parts = periods.split(",") if isinstance(periods, str) else list(periods)
    tokens = [str(p).strip() for p in parts]
    if not tokens or any(not re.fullmatch(PERIOD_PATTERN, t) for t in tokens):
        raise ValueError(f"periods must be YYYY or YYYYMM tokens; got {periods!r}")
    return tokens
