"""Row conditions on named fields, with two-valued logic.

Fields are named the way records are: short (``reporter_code``), dotted
(``reporter.reporter_code``) or by stored column.  A comparison never yields "unknown": an
absent value equals nothing but an absent value, differs from everything else, and has no
order.  Values of different kinds (text and number) are never equal and have no order either,
which is decided when the condition is built, from the column type.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import ROUND_FLOOR, Decimal, localcontext
from numbers import Number
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schema import COLUMNS, WORLD_CODE

# Record paths whose last part is not the stored column name.
RECORD_PATHS = {
    "reporter.reporter_code": "reporter_code",
    "reporter.iso3": "reporter_iso3",
    "reporter.name": "reporter_name",
    "partner.partner_code": "partner_code",
    "partner.iso3": "partner_iso3",
    "partner.name": "partner_name",
    "partner2.partner_code": "partner2_code",
    "partner2.iso3": "partner2_iso3",
    "partner2.name": "partner2_name",
    "flow.flow_code": "flow_code",
    "flow.flow_name": "flow_name",
    "commodity.commodity_code": "commodity_code",
    "commodity.name": "commodity_name",
    "trade_value.primary_value": "trade_value_primary_value",
    "trade_value.fob_value": "trade_value_fob_value",
    "trade_value.cif_value": "trade_value_cif_value",
    "quantity.qty": "quantity_qty",
    "quantity.qty_unit_code": "quantity_qty_unit_code",
    "quantity.qty_unit_abbr": "quantity_qty_unit_abbr",
    "quantity.is_estimated": "quantity_is_estimated",
    "quantity.alt_qty": "quantity_alt_qty",
    "quantity.alt_qty_unit_code": "quantity_alt_qty_unit_code",
    "quantity.alt_qty_unit_abbr": "quantity_alt_qty_unit_abbr",
    "quantity.is_alt_qty_estimated": "quantity_is_alt_qty_estimated",
    "primary_value": "trade_value_primary_value",
    "fob_value": "trade_value_fob_value",
    "cif_value": "trade_value_cif_value",
}

OPERATORS = ("eq", "ne", "lt", "le", "gt", "ge", "in", "not_in")


class QueryError(ValueError):
    """A query that cannot be built: unknown field, operator or value shape."""


def resolve_field(name: str) -> str:
    """Stored column of a field name or record path."""
    if not isinstance(name, str) or not name:
        raise QueryError("a field needs a non-empty name")
    if name in ("partner.is_world", "partner2.is_world"):
        return name
    column = RECORD_PATHS.get(name, name)
    if column not in COLUMNS:
        raise QueryError(f"unknown field {name!r}")
    return column


def field_column(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """Column and type of a field in this frame."""
    column = resolve_field(name)
    if column.endswith(".is_world"):
        code = column.split(".")[0] + "_code"
        return F.col(code) == WORLD_CODE, T.BooleanType()
    if column not in df.columns:
        raise QueryError(f"field {name!r} is not in this frame")
    return F.col(column), df.schema[column].dataType


def _is_number(value: Any) -> bool:
    return isinstance(value, Number) and not isinstance(value, complex)


def _exact(value: Any) -> Decimal | None:
    """The value as an exact decimal, None for infinities and not-a-number."""
    if isinstance(value, bool):
        return Decimal(int(value))
    if isinstance(value, float):
        return Decimal(value) if math.isfinite(value) else None
    number = Decimal(value)
    return number if number.is_finite() else None


def _grid(value: Decimal, scale: int) -> Decimal:
    """Largest multiple of 10**-scale that is not above the value."""
    with localcontext() as ctx:
        ctx.prec = 400
        return value.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_FLOOR)


def _known(column: Column, made: Column) -> Column:
    """False instead of unknown for an absent value, in a form the scan can still push down."""
    return column.isNotNull() & made


def _compare_number(column: Column, kind: T.DataType, operator: str, value: Any) -> Column:
    """Exact comparison of an integer, decimal or boolean column with any Python number."""
    if isinstance(kind, T.BooleanType):
        column, scale, digits = column.cast("int"), 0, 10
    elif isinstance(kind, T.DecimalType):
        scale, digits = kind.scale, kind.precision - kind.scale
    else:
        scale, digits = 0, 19
    number = _exact(value)
    if number is None:
        above = isinstance(value, float) and value == math.inf
        below = isinstance(value, float) and value == -math.inf
        if isinstance(value, Decimal) and value.is_infinite():
            above, below = value > 0, value < 0
        if operator == "ne":
            return F.lit(True)
        known = (above and operator in ("lt", "le")) or (below and operator in ("gt", "ge"))
        return column.isNotNull() if known else F.lit(False)
    floor = _grid(number, scale)
    if abs(floor) >= Decimal(10) ** digits:
        # Beyond anything the column can hold: the order is known, equality impossible.
        if operator == "ne":
            return F.lit(True)
        fits = operator in (("lt", "le") if floor > 0 else ("gt", "ge"))
        return column.isNotNull() if fits else F.lit(False)
    on_grid = floor == number
    if isinstance(kind, T.DecimalType):
        wide = F.lit(floor).cast(kind)
    else:
        wide = F.lit(int(floor))
    if operator == "eq":
        return column.eqNullSafe(wide) if on_grid else F.lit(False)
    if operator == "ne":
        return ~column.eqNullSafe(wide) if on_grid else F.lit(True)
    if on_grid:
        made = {
            "lt": column < wide,
            "le": column <= wide,
            "gt": column > wide,
            "ge": column >= wide,
        }[operator]
    else:
        # The column only takes grid values, so the bound can be moved down to the grid.
        made = column <= wide if operator in ("lt", "le") else column > wide
    return _known(column, made)


def _compare(column: Column, kind: T.DataType, operator: str, value: Any) -> Column:
    if value is None:
        if operator == "eq":
            return column.isNull()
        return column.isNotNull() if operator == "ne" else F.lit(False)
    textual = isinstance(kind, T.StringType)
    if textual and isinstance(value, str):
        text = F.lit(value)
        if operator in ("eq", "ne"):
            same = column.eqNullSafe(text)
            return same if operator == "eq" else ~same
        made = {
            "lt": column < text,
            "le": column <= text,
            "gt": column > text,
            "ge": column >= text,
        }[operator]
        return _known(column, made)
    if not textual and _is_number(value):
        return _compare_number(column, kind, operator, value)
    return F.lit(operator == "ne")


def _member(column: Column, kind: T.DataType, values: Any) -> Column:
    """Whether the column is among the values: one ``IN`` list, plus null if listed."""
    values = list(values)
    textual = isinstance(kind, T.StringType)
    if textual:
        plain = [v for v in values if isinstance(v, str)]
    elif isinstance(kind, (T.IntegerType, T.LongType)):
        plain = []
        for v in values:
            if _is_number(v) and (number := _exact(v)) is not None and number == int(number):
                if abs(number) < 2**63:
                    plain.append(int(number))
    else:
        out = F.lit(False)
        for v in values:
            out = out | _compare(column, kind, "eq", v)
        return out
    out = _known(column, column.isin(plain)) if plain else F.lit(False)
    return out | column.isNull() if any(v is None for v in values) else out


class Condition:
    """Base of all conditions: combine with ``&``, ``|`` and ``~``."""

    def column(self, df: DataFrame) -> Column:
        raise NotImplementedError

    def __and__(self, other: Condition) -> Condition:
        return Both(self, _checked(other))

    def __or__(self, other: Condition) -> Condition:
        return Either(self, _checked(other))

    def __invert__(self) -> Condition:
        return Negated(self)


def _checked(other: Any) -> Condition:
    if not isinstance(other, Condition):
        raise QueryError(f"cannot combine a condition with {type(other).__name__}")
    return other


@dataclass(frozen=True)
class FieldTest(Condition):
    """``field operator value``; ``in`` and ``not_in`` take a list, tuple or set."""

    field: str
    operator: str
    value: Any

    def __post_init__(self) -> None:
        if not isinstance(self.field, str) or not self.field:
            raise QueryError("a field needs a non-empty name")
        if self.operator not in OPERATORS:
            raise QueryError(f"operator must be one of {OPERATORS}; got {self.operator!r}")
        if self.operator in ("in", "not_in") and not isinstance(
            self.value, (list, tuple, set, frozenset, range)
        ):
            raise QueryError(f"{self.operator!r} needs a list, tuple or set of values")

    def column(self, df: DataFrame) -> Column:
        column, kind = field_column(df, self.field)
        if self.operator == "in":
            return _member(column, kind, self.value)
        if self.operator == "not_in":
            return ~_member(column, kind, self.value)
        return _compare(column, kind, self.operator, self.value)


@dataclass(frozen=True)
class Both(Condition):
    left: Condition
    right: Condition

    def column(self, df: DataFrame) -> Column:
        return self.left.column(df) & self.right.column(df)


@dataclass(frozen=True)
class Either(Condition):
    left: Condition
    right: Condition

    def column(self, df: DataFrame) -> Column:
        return self.left.column(df) | self.right.column(df)


@dataclass(frozen=True)
class Negated(Condition):
    operand: Condition

    def column(self, df: DataFrame) -> Column:
        return ~self.operand.column(df)


@dataclass(frozen=True)
class Expression(Condition):
    """Any boolean column as a condition, with "unknown" read as false."""

    made: Column

    def column(self, df: DataFrame) -> Column:
        return F.coalesce(self.made, F.lit(False))
