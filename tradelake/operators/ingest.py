"""Raw records to typed rows, with a reason for every row that is turned away.

Each field is taken from the variant once, then converted and checked by column expressions.
Text fields come as text.  All others come as their JSON token (``12.7``, ``"12"``, ``true``),
which keeps every digit and still tells a number from a text.  A row is never an error: it either
has all its typed values or a reject reason.

The conversions and the checks of 45 fields are too much code for one method: the JVM leaves methods
of over 8,000 bytes uncompiled.  :func:`_split` keeps them out of Spark's whole-stage code, so that
Spark deals them over methods of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake import schema as S

REASON = "_reject_reason"
MALFORMED = "malformed"


@dataclass(frozen=True)
class RawField:
    """Where a column comes from and how its value is read."""

    column: str
    key: str
    kind: str
    required: bool = False
    default: int | bool | None = None


def _f(column: str, key: str, kind: str, required: bool = False, default=None) -> RawField:
    return RawField(column, key, kind, required, default)


# Raw keys of the canonical columns.  Kinds: text, iso, int, long, amount, flag.
RAW_FIELDS = (
    _f("type_code", "typeCode", "text", True),
    _f("frequency_code", "freqCode", "text", True),
    _f("classification_code", "classificationCode", "text", True),
    _f("classification_search_code", "classificationSearchCode", "text"),
    _f("is_original_classification", "isOriginalClassification", "flag"),
    _f("ref_period_id", "refPeriodId", "long"),
    _f("ref_year", "refYear", "int", True),
    _f("ref_month", "refMonth", "int", True),
    _f("period", "period", "text", True),
    _f("reporter_code", "reporterCode", "int", True),
    _f("reporter_iso3", "reporterISO", "iso"),
    _f("reporter_name", "reporterDesc", "text"),
    _f("partner_code", "partnerCode", "int", True),
    _f("partner_iso3", "partnerISO", "iso"),
    _f("partner_name", "partnerDesc", "text"),
    _f("partner2_code", "partner2Code", "int"),
    _f("partner2_iso3", "partner2ISO", "iso"),
    _f("partner2_name", "partner2Desc", "text"),
    _f("flow_code", "flowCode", "text", True),
    _f("flow_name", "flowDesc", "text"),
    _f("commodity_code", "cmdCode", "text", True),
    _f("commodity_name", "cmdDesc", "text"),
    _f("customs_code", "customsCode", "text", True),
    _f("customs_name", "customsDesc", "text"),
    _f("mos_code", "mosCode", "text", True),
    _f("mot_code", "motCode", "int", True),
    _f("mot_name", "motDesc", "text"),
    _f("quantity_qty", "qty", "amount"),
    _f("quantity_qty_unit_code", "qtyUnitCode", "int", True),
    _f("quantity_qty_unit_abbr", "qtyUnitAbbr", "text"),
    _f("quantity_is_estimated", "isQtyEstimated", "flag", default=False),
    _f("quantity_alt_qty", "altQty", "amount"),
    _f("quantity_alt_qty_unit_code", "altQtyUnitCode", "int"),
    _f("quantity_alt_qty_unit_abbr", "altQtyUnitAbbr", "text"),
    _f("quantity_is_alt_qty_estimated", "isAltQtyEstimated", "flag", default=False),
    _f("net_weight_kg", "netWgt", "amount"),
    _f("is_net_weight_estimated", "isNetWgtEstimated", "flag", default=False),
    _f("gross_weight_kg", "grossWgt", "amount"),
    _f("is_gross_weight_estimated", "isGrossWgtEstimated", "flag", default=False),
    _f("trade_value_primary_value", "primaryValue", "amount", True),
    _f("trade_value_fob_value", "fobvalue", "amount"),
    _f("trade_value_cif_value", "cifvalue", "amount"),
    _f("legacy_estimation_flag", "legacyEstimationFlag", "int", default=0),
    _f("is_reported", "isReported", "flag", default=False),
    _f("is_aggregate", "isAggregate", "flag", default=False),
)

#: Raw keys that are understood; every other key of a record goes to ``provenance``.
KNOWN_KEYS = (*[f.key for f in RAW_FIELDS], "aggrLevel", "isLeaf")

#: Integer columns that may not be negative.  (A unit code of -1 means "no unit".)
_NOT_NEGATIVE = (
    "reporter_code",
    "partner_code",
    "partner2_code",
    "mot_code",
    "ref_period_id",
    "legacy_estimation_flag",
)

def blank(text: Column) -> Column:
    """Present but without a visible character."""
    return text.rlike(BLANK)


#: Text without a visible character.
BLANK = r"(?U)^\s*$"

#: Bounds of texts that begin with a visible ASCII character, by bytes.
_VISIBLE = ("!", "\x7f")

# The rules below are SQL text over the columns ``_t_...``: texts, or JSON tokens.


def _split(condition: str) -> str:
    """The same condition by way of a lambda, which Spark does not take into whole-stage code."""
    return f"exists(array({condition}), found -> found)"


def _blank(text: str) -> str:
    """``blank`` as SQL; the pattern is only tried on texts without a visible first character."""
    low, high = (_quoted(c) for c in _VISIBLE)
    return f"(({text} < {low} or {text} >= {high}) and {text} rlike {_quoted(BLANK)})"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(values) -> str:
    return ", ".join(_quoted(v) if isinstance(v, str) else str(v) for v in values)


def _is_text(token: str) -> str:
    return f"startswith({token}, '\"')"


def _bare(token: str) -> str:
    """A token without its quotation marks."""
    return f"if({_is_text(token)}, substring({token}, 2, length({token}) - 2), {token})"


def as_integer(token: str, kind: str) -> str:
    """Whole number: digits as text or number; a fractional number is cut, fractional text is not.

    Null for anything else, booleans included, and for numbers beyond the column type.
    """
    cut = f"if({_is_text(token)}, null, try_cast(try_cast({token} as double) as bigint))"
    return f"try_cast(coalesce(try_cast({_bare(token)} as bigint), {cut}) as {kind})"


def as_amount(token: str) -> str:
    """Exact decimal from the digits of a number or of numeric text; null for other text."""
    return f"try_cast({_bare(token)} as {S.AMOUNT.simpleString()})"


def _too_fine(token: str) -> str:
    """An amount with a digit behind the last decimal of the column."""
    # a point and 19 digits at least; a power needs its letter: few tokens meet the patterns
    plain = f"(length({token}) > 19 and {_bare(token)} rlike '^[^eE]*[.][0-9]{{18}}0*[1-9]')"
    powered = f"(contains({token}, 'e') or contains({token}, 'E'))"
    behind = f"length(regexp_extract({token}, '[.]([0-9]*?)0*[eE]', 1))"
    digits = f"if(contains({token}, '.'), {behind}, -length(regexp_extract({token}, '(0*)[eE]', 1)))"
    power = f"try_cast(regexp_extract({token}, '[eE]([+-]?[0-9]+)', 1) as int)"
    return f"({plain} or ({powered} and coalesce({digits} - {power} > 18, false)))"


def as_flag(token: str) -> str:
    """True or false, as a JSON value or spelled out; null for anything else (0 and 1 too)."""
    word = f"lower(trim({_bare(token)}))"
    return f"case {word} when 'true' then true when 'false' then false end"


def _settled(df: DataFrame, column: str) -> DataFrame:
    """The same frame with one column in a form that later filters do not recompute.

    A filter on a plain projected column is pushed below the projection by repeating its
    expression, which for a reject reason means judging, and so parsing, every record twice.
    A column that comes out of a generator stays where it is.
    """
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(F.array(column)).alias(column))


def _tokens(df: DataFrame, rec: str) -> DataFrame:
    """Every field of the record (one pass over the variant), and the unknown keys."""
    textual = {f.key for f in RAW_FIELDS if f.kind in ("text", "iso")}
    kind = ",".join(f"{f.key}:{'string' if f.key in textual else 'variant'}" for f in RAW_FIELDS)
    record = F.col(rec)
    opened = df.select(
        "*",
        F.try_variant_get(record, "$", f"struct<{kind}>").alias("_t"),
        provenance(record).alias("provenance"),
    )
    found = [
        f"_t.{f.key} as _t_{f.column}"
        if f.key in textual
        else f"nullif(to_json(_t.{f.key}), 'null') as _t_{f.column}"
        for f in RAW_FIELDS
    ]
    return opened.selectExpr(*df.columns, "provenance", *found)


def _second_partner_absent() -> str:
    """A second partner is not given, or is the numeric 0 without a country of its own."""
    code, iso = "_t_partner2_code", "_t_partner2_iso3"
    zero = f"""case when {_is_text(code)} then false when {code} = 'false' then true
      else abs(try_cast({code} as double)) < 1 end"""
    no_country = f"({iso} is null or {iso} in ('', {_quoted(S.WORLD_ISO3)}))"
    return f"({code} is null or (coalesce({zero}, false) and {no_country}))"


def _converted(field: RawField) -> str:
    found = f"_t_{field.column}"
    if field.kind in ("text", "iso"):
        return f"nullif({found}, '')"
    if field.kind in ("int", "long"):
        return as_integer(found, "int" if field.kind == "int" else "bigint")
    return as_amount(found) if field.kind == "amount" else as_flag(found)


def _domain(column: str) -> str | None:
    """Condition of a value outside what a column may hold."""
    listed = {
        "type_code": S.TYPE_CODES,
        "frequency_code": S.FREQUENCY_CODES,
        "flow_code": S.FLOW_CODES,
        "ref_month": (*range(1, 13), S.ANNUAL_MONTH),
    }
    if column in listed:
        return f"{column} not in ({_listed(listed[column])})"
    if column == "ref_year":
        return f"{column} not between {S.MIN_YEAR} and {S.MAX_YEAR}"
    if column == "period":
        return f"not {column} rlike {_quoted(S.PERIOD_PATTERN)}"
    if column == "commodity_code":
        total, pattern = _quoted(S.TOTAL_COMMODITY), _quoted(S.COMMODITY_PATTERN)
        return f"{column} <> {total} and not {column} rlike {pattern}"
    return f"{column} < 0" if column in _NOT_NEGATIVE else None


def _problems(field: RawField) -> list[tuple[str, str]]:
    """What can be wrong with a field, in the order it is looked at."""
    value, text = field.column, f"_t_{field.column}"
    out = []
    if field.kind in ("text", "iso"):
        if field.required:
            out.append((f"{text} is null or {_blank(text)}", "missing"))
        elif field.kind == "text":
            out.append((_blank(value), "blank"))
        else:
            world = _quoted(S.WORLD_ISO3)
            wrong = f"{value} <> {world} and not {value} rlike '^[A-Z]{{3}}$'"
            out.append((wrong, "not a country code"))
    else:
        if field.required:
            out.append((f"{text} is null", "missing"))
        out.append((f"{text} is not null and {value} is null", f"not a valid {field.kind}"))
        if field.kind == "amount":
            out.append((f"{value} < 0", "negative"))
            out.append((_too_fine(text), "more than 18 decimals"))
    outside = _domain(field.column)
    if outside is not None:
        out.append((outside, "out of domain"))
    return out


def _reason() -> str:
    """The first problem of a record, null when there is none."""
    branches = [f"when {_split('_t_malformed')} then {_quoted(MALFORMED)}"]
    for field in RAW_FIELDS:
        for wrong, label in _problems(field):
            branches.append(f"when {wrong} then {_quoted(f'{field.key}: {label}')}")
    return "case " + "\n".join(branches) + " end"


def provenance(rec: Column) -> Column:
    """The keys of a record that no column holds, as a JSON object; null when there are none."""
    everything = F.try_variant_get(rec, "$", "map<string,variant>")
    rest = F.map_filter(everything, lambda key, _: ~key.isin(list(KNOWN_KEYS)))
    return F.when(F.cardinality(rest) > 0, F.to_json(rest))


def parse_records(raw: DataFrame, rec: str = "rec") -> DataFrame:
    """Typed canonical columns plus ``_reject_reason`` (null for a good row).

    All other columns of ``raw`` (row number, file) are carried along, ``rec`` included, so a
    rejected row can be looked at.
    """
    carried = raw.columns
    second = [f.column for f in RAW_FIELDS if f.column.startswith("partner2_")]
    tokens = _tokens(raw, rec)
    absent = _second_partner_absent()
    tokens = tokens.selectExpr(
        *[c for c in tokens.columns if c.removeprefix("_t_") not in second],
        *[f"if({absent}, null, _t_{c}) as _t_{c}" for c in second],
    )
    malformed = f"{_split(f'{rec} is null')} as _t_malformed"
    typed = tokens.selectExpr("*", malformed, *[f"{_converted(f)} as {f.column}" for f in RAW_FIELDS])
    shown = {f.column: f.column for f in RAW_FIELDS}
    shown |= {
        f.column: f"coalesce({f.column}, {str(f.default).lower()})"
        for f in RAW_FIELDS
        if f.default is not None
    }
    shown |= {"edition": "classification_code", "provenance": "provenance"}
    values = [f"{shown[c]} as {c}" for c in S.COLUMNS]
    judged = typed.selectExpr(*carried, *values, f"{_reason()} as {REASON}")
    return _settled(judged, REASON)


def accepted(parsed: DataFrame, rec: str = "rec") -> DataFrame:
    """Good rows: canonical columns and the row number."""
    kept = [c for c in (S.SEQ, S.SOURCE_FILE, S.SOURCE_POSITION) if c in parsed.columns]
    return parsed.filter(F.col(REASON).isNull()).select(*S.COLUMNS, *kept)


def quarantined(parsed: DataFrame, rec: str = "rec") -> DataFrame:
    """Rejected rows: where they came from, the record as JSON text, and the reason.

    What is not JSON at all is kept as the text it was.
    """
    kept = [c for c in (S.SEQ, S.SOURCE_FILE, S.SOURCE_POSITION) if c in parsed.columns]
    texts = [F.col(c) for c in ("_text",) if c in parsed.columns]
    record = F.col(rec) if dict(parsed.dtypes)[rec] == "string" else F.to_json(F.col(rec))
    return parsed.filter(F.col(REASON).isNotNull()).select(
        *kept, F.coalesce(record, *texts).alias("record"), F.col(REASON).alias("reason")
    )


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Number of rejected rows per reason."""
    return (
        parsed.filter(F.col(REASON).isNotNull())
        .groupBy(F.col(REASON).alias("reason"))
        .agg(F.count(F.lit(1)).alias("skipped"))
    )
