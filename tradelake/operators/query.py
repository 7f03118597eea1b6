"""Fluent queries over the trade table.

``Query(df).filter(...).sort(...).limit(...)`` builds one lazy frame.  The steps apply in a
fixed order whatever the call order: conditions, sort, reverse, offset, limit, and grouping of
the rows that are left.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.ratios import ratio
from tradelake.operators.predicates import (
    Condition,
    Expression,
    FieldTest,
    QueryError,
    field_column,
    resolve_field,
)
from tradelake.schema import SEQ


def _as_condition(condition: Condition | Column | None, fields: dict[str, Any]) -> Condition:
    """One condition from a positional argument or from ``field=value`` pairs, all to hold."""
    if isinstance(condition, Column):
        condition = Expression(condition)
    if condition is not None:
        if not isinstance(condition, Condition):
            raise QueryError(f"not a condition: {type(condition).__name__}")
        return condition
    tests = [FieldTest(name, "eq", value) for name, value in fields.items()]
    if not tests:
        raise QueryError("give a condition or field=value pairs")
    made = tests[0]
    for test in tests[1:]:
        made = made & test
    return made


def _amount(value: Any, name: str) -> int | None:
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, int) or value < 0:
        raise QueryError(f"{name} needs a non-negative integer or None; got {value!r}")
    return value


@dataclass(frozen=True)
class Query:
    """An immutable query; every method returns a new one."""

    source: DataFrame
    conditions: tuple[Condition, ...] = ()
    group_fields: tuple[str, ...] = ()
    sort_keys: tuple[tuple[str, bool], ...] = ()
    skip: int | None = None
    take: int | None = None
    reversed: bool = False

    def filter(
        self, condition: Condition | Column | None = None, /, **fields: Any
    ) -> Query:
        """Keep matching rows; repeated calls must all hold."""
        if condition is not None and fields:
            raise QueryError("give a condition or field=value pairs, not both")
        made = _as_condition(condition, fields)
        return replace(self, conditions=(*self.conditions, made))

    def exclude(
        self, condition: Condition | Column | None = None, /, **fields: Any
    ) -> Query:
        """Drop rows matching the whole condition.  Pairs next to a condition are ignored."""
        made = _as_condition(condition, fields)
        return replace(self, conditions=(*self.conditions, ~made))

    def group_by(self, *fields: str) -> Query:
        for name in fields:
            resolve_field(name)
        return replace(self, group_fields=tuple(fields))

    def sort(self, *fields: str | tuple[str, bool], descending: bool = False) -> Query:
        """Order by fields; a ``(field, descending)`` pair sets its own direction.

        Equal rows keep reading order.  A later call replaces the keys.
        """
        if not fields:
            raise QueryError("sort needs at least one field")
        keys = tuple(f if isinstance(f, tuple) else (f, descending) for f in fields)
        for name, _ in keys:
            resolve_field(name)
        return replace(self, sort_keys=keys)

    def reverse(self) -> Query:
        """Hand rows out last to first; applied once however often it is called."""
        return replace(self, reversed=True)

    def offset(self, n: int | None) -> Query:
        return replace(self, skip=_amount(n, "offset"))

    def limit(self, n: int | None) -> Query:
        return replace(self, take=_amount(n, "limit"))

    # -- results ---------------------------------------------------------------------------

    def _order(self, df: DataFrame) -> list[Column]:
        """Sort expressions ending in reading order, all flipped when reversed; nulls last."""
        keys = [(field_column(df, name)[0], down) for name, down in self.sort_keys]
        ordered = bool(keys) or self.reversed or self.take is not None or bool(self.skip)
        if SEQ in df.columns and ordered:
            keys.append((F.col(SEQ), False))
        return [
            c.desc_nulls_last() if down != self.reversed else c.asc_nulls_last()
            for c, down in keys
        ]

    def frame(self) -> DataFrame:
        """The selected rows, sorted and cut."""
        df = self.source
        for condition in self.conditions:
            df = df.filter(condition.column(df))
        order = self._order(df)
        if self.skip and self.take is None:
            # An offset alone would pull every row into one task.  The skipped rows are a
            # bounded top-n, and taking them off as a multiset keeps the rest distributed.
            everything = [*order, *[F.col(c) for c in df.columns]]
            df = df.exceptAll(df.orderBy(*everything).limit(self.skip))
            return df.orderBy(*order) if order else df
        if order:
            df = df.orderBy(*order)
        if self.skip:
            df = df.offset(self.skip)
        if self.take is not None:
            df = df.limit(self.take)
        return df

    def count(self) -> int:
        return self.frame().count()

    def _grouped(self, df: DataFrame):
        named = [field_column(df, f)[0].alias(resolve_field(f)) for f in self.group_fields]
        return df.groupBy(*named), [resolve_field(f) for f in self.group_fields]

    def groups(self) -> DataFrame:
        """One row per group in key order, with its record count; no rows without grouping."""
        df = self.frame()
        if not self.group_fields:
            return df.limit(0).select(F.lit(0).cast("bigint").alias("record_count"))
        grouped, names = self._grouped(df)
        return grouped.agg(F.count(F.lit(1)).alias("record_count")).orderBy(*names)

    def members(self) -> DataFrame:
        """The rows of all groups, group after group, each in the query's own order.

        Groups are neighbouring rows of one sorted frame, never a list in a single row, so a
        group may be as large as the table.
        """
        df = self.frame()
        keys = [field_column(df, f)[0].asc_nulls_last() for f in self.group_fields]
        order = self._order(df) or ([F.col(SEQ)] if SEQ in df.columns else [])
        return df.orderBy(*keys, *order) if keys or order else df

    def summarize(self, field: str) -> DataFrame:
        """Sum, count, mean, minimum and maximum of a decimal field, per group if grouped."""
        df = self.frame()
        column = decimal_field(df, field)
        five = [
            F.sum(column).alias("sum"),
            F.count(column).alias("count"),
            ratio(F.sum(column), F.count(column)).alias("average"),
            F.min(column).alias("minimum"),
            F.max(column).alias("maximum"),
        ]
        if not self.group_fields:
            return df.agg(*five)
        grouped, names = self._grouped(df)
        return grouped.agg(*five).orderBy(*names)

    def aggregate(self, **measures: tuple[str, str] | Column) -> DataFrame:
        """Chosen aggregates, ``name=(kind, field)`` or ``name=column``, per group if grouped."""
        df = self.frame()
        made = [
            (m if isinstance(m, Column) else aggregate_column(df, *m)).alias(name)
            for name, m in measures.items()
        ]
        if not self.group_fields:
            return df.agg(*made)
        grouped, names = self._grouped(df)
        return grouped.agg(*made).orderBy(*names)


def decimal_field(df: DataFrame, name: str) -> Column:
    """The column of a field that sums and means may be taken of."""
    column, kind = field_column(df, name)
    if not isinstance(kind, T.DecimalType):
        raise QueryError(f"field {name!r} is {kind.simpleString()}, not a decimal amount")
    return column


def aggregate_column(df: DataFrame, kind: str, field: str | None = None) -> Column:
    """One aggregate by kind.  All but counts are null over no values."""
    if kind == "count":
        if field is None:
            return F.count(F.lit(1))
        return F.count(field_column(df, field)[0])
    column = decimal_field(df, field)
    makers = {
        "sum": F.sum,
        "average": lambda c: ratio(F.sum(c), F.count(c)),
        "minimum": F.min,
        "maximum": F.max,
    }
    if kind not in makers:
        raise QueryError(f"unknown aggregate {kind!r}")
    return makers[kind](column)
