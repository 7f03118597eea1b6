"""Named metrics and filters.

A metric is an aggregate expression, so any number of them run in one ``agg`` and inside any
``groupBy``.  A metric that has no value (average of nothing, division by zero) is null; the
analysis run reports such metrics as failed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions.ratios import ratio
from tradelake.schema import VALUE


#: One digit less before the point, so that a sum of two amounts keeps all 18 decimals.
_TERM = "decimal(37,18)"


def _plus(a: Column, b: Column) -> Column:
    return a.try_cast(_TERM) + b.try_cast(_TERM)


def _minus(a: Column, b: Column) -> Column:
    return a.try_cast(_TERM) - b.try_cast(_TERM)


def _overflown(column: Column) -> Column:
    """Whether values are there, but their sum doesn't fit."""
    return (F.count(column) > 0) & F.try_sum(column).isNull()


@dataclass(frozen=True)
class Metric:
    """A named aggregate.  ``may_fail`` marks metrics that can be null on a non-empty group.

    No built-in metric stops the job: a sum that doesn't fit, like a division by zero, is null.
    """

    name: str
    build: Callable[[], Column]
    description: str = ""
    unit: str | None = None
    may_fail: bool = False
    #: What the value is: a ``whole`` number, an exact ``amount``, or ``real``.
    kind: str = "real"
    #: How to get the value in two steps, if it can be: buffers over facts grouped by ``keys``,
    #: and the value over those few rows.
    buffers: tuple[tuple[str, Callable[[], Column]], ...] = ()
    keys: tuple[str, ...] = ()
    merge: Callable[[], Column] | None = None
    #: Whether the value is missing because a sum didn't fit, over those rows.
    overflow: Callable[[], Column] | None = None
    #: Given by the caller, so that its expressions may stop a job.
    given: bool = False

    def merged(self) -> Column:
        return self.merge().alias(self.name)

    def column(self) -> Column:
        return self.build().alias(self.name)

    def __add__(self, other: Metric) -> Metric:
        return self._with(other, "+", lambda a, b: F.try_add(a, b), _plus)

    def __sub__(self, other: Metric) -> Metric:
        return self._with(other, "-", lambda a, b: F.try_subtract(a, b), _minus)

    def __mul__(self, other: Metric) -> Metric:
        """The product; of amounts a double, as twice the decimals fit no column."""
        return self._with(
            other, "×", lambda a, b: F.try_multiply(a, b), lambda a, b: a.cast("double") * b.cast("double")
        )

    def __truediv__(self, other: Metric) -> Metric:
        return replace(self._with(other, "÷", ratio), may_fail=True, kind="real")

    def _with(self, other: Metric, sign: str, combine, of_amounts=None) -> Metric:
        """``of_amounts`` combines when an amount is among two exact values."""
        if not isinstance(other, Metric):
            raise TypeError(f"cannot combine a metric with {type(other).__name__}")
        kinds = {self.kind, other.kind}
        exact = "real" not in kinds
        if exact and "amount" in kinds and of_amounts is not None:
            combine = of_amounts
        kind = "whole" if kinds == {"whole"} else "amount" if exact and sign in "+-" else "real"
        return Metric(
            name=f"({self.name} {sign} {other.name})",
            kind=kind,
            buffers=(*self.buffers, *other.buffers),
            keys=(*self.keys, *other.keys),
            merge=(lambda: combine(self.merge(), other.merge())) if self.merge and other.merge else None,
            overflow=lambda: self.overflown() | other.overflown(),
            given=self.given or other.given,
            build=lambda: combine(self.build(), other.build()),
            description=f"{self.description} {sign} {other.description}",
            may_fail=self.may_fail or other.may_fail,
        )

    def overflown(self) -> Column:
        return self.overflow() if self.overflow else F.lit(False)

    def _in_steps(self, buffers: dict[str, Callable[[], Column]], merge, overflow=None) -> Metric:
        return replace(self, buffers=tuple(buffers.items()), merge=merge, overflow=overflow)

    def named(self, name: str) -> Metric:
        """The same metric under another column name."""
        return replace(self, name=name)

    @classmethod
    def count(cls) -> Metric:
        return cls("count", lambda: F.count(F.lit(1)), "Number of records", "records", kind="whole")._in_steps(
            {"_rows": lambda: F.count(F.lit(1))}, lambda: F.coalesce(F.sum("_rows"), F.lit(0))
        )

    @classmethod
    def total(cls, name: str, column: Column, *, unit: str | None = None, description: str = "") -> Metric:
        """Sum of any column, 0 without values, null where it doesn't fit."""
        return cls._total(name, lambda: column, name, description or name, unit)

    @classmethod
    def _total(cls, name: str, column: Callable[[], Column], key: str, description: str, unit: str | None) -> Metric:
        held, over = f"_sum_{key}", f"_over_{key}"
        overflow = lambda: F.coalesce(F.bool_or(over), F.lit(False)) | _overflown(F.col(held))
        none = lambda total, bad: F.when(~bad, F.coalesce(total, F.lit(0)))
        return cls(
            name,
            lambda: none(F.try_sum(column()), _overflown(column())),
            description,
            unit,
            kind="amount",
            may_fail=True,
        )._in_steps(
            {held: lambda: F.try_sum(column()), over: lambda: _overflown(column())},
            lambda: none(F.try_sum(held), overflow()),
            overflow,
        )

    @classmethod
    def _sum(cls, name: str, column: str, unit: str | None) -> Metric:
        return cls._total(name, lambda: F.col(column), column, f"Sum of {column}", unit)

    @classmethod
    def sum_primary_value(cls) -> Metric:
        return cls._sum("sum_primary_value", VALUE, "USD")

    @classmethod
    def sum_fob_value(cls) -> Metric:
        return cls._sum("sum_fob_value", "trade_value_fob_value", "USD")

    @classmethod
    def sum_cif_value(cls) -> Metric:
        return cls._sum("sum_cif_value", "trade_value_cif_value", "USD")

    @classmethod
    def sum_quantity(cls) -> Metric:
        return cls._sum("sum_quantity", "quantity_qty", None)

    @classmethod
    def avg_primary_value(cls) -> Metric:
        total = cls.sum_primary_value()
        return cls(
            "avg_primary_value",
            lambda: ratio(total.build(), F.count(VALUE)),
            f"Mean of {VALUE}",
            "USD",
            may_fail=True,
        )._in_steps(
            {**dict(total.buffers), "_valued": lambda: F.count(VALUE)},
            lambda: ratio(total.merge(), F.sum("_valued")),
            total.overflow,
        )

    @classmethod
    def _distinct(cls, name: str, column: str) -> Metric:
        return cls(
            name,
            lambda: F.count_distinct(F.col(column)),
            f"Distinct {column}",
            name.removeprefix("distinct_"),
            kind="whole",
            keys=(column,),
            merge=lambda: F.count_distinct(F.col(column)),
        )

    @classmethod
    def distinct_reporters(cls) -> Metric:
        return cls._distinct("distinct_reporters", "reporter_code")

    @classmethod
    def distinct_partners(cls) -> Metric:
        return cls._distinct("distinct_partners", "partner_code")

    @classmethod
    def distinct_commodities(cls) -> Metric:
        return cls._distinct("distinct_commodities", "commodity_code")

    @classmethod
    def min_year(cls) -> Metric:
        return cls("min_year", lambda: F.min("ref_year"), "First reference year", kind="whole")._in_steps(
            {"_first": lambda: F.min("ref_year")}, lambda: F.min("_first")
        )

    @classmethod
    def max_year(cls) -> Metric:
        return cls("max_year", lambda: F.max("ref_year"), "Last reference year", kind="whole")._in_steps(
            {"_last": lambda: F.max("ref_year")}, lambda: F.max("_last")
        )

    @classmethod
    def custom(
        cls, name: str, expression: Column, *, description: str = "", unit: str | None = None
    ) -> Metric:
        """Any aggregate column, including a grouped-aggregate pandas UDF call.  It reads the facts
        by itself; see ``mergeable`` for one that shares the pass of the others."""
        return cls(name, lambda: expression, description or name, unit, may_fail=True, given=True)

    @classmethod
    def mergeable(
        cls,
        name: str,
        buffers: dict[str, Column],
        value: Column,
        *,
        keys: Sequence[str] = (),
        whole: Column | None = None,
        description: str = "",
        unit: str | None = None,
    ) -> Metric:
        """A metric in two steps: ``buffers`` are aggregates over the facts of each combination of
        ``keys``, and of whatever else a run groups by; ``value`` is an aggregate over those few rows.

        The facts are thus aggregated before the shuffle, and a histogram (keys and a count) makes
        medians and the like out of one row a key.  ``whole`` is the same over the facts at once, for
        use outside a run.  Names of buffers begin with the metric's own name.
        """
        own = {f"_{name}_{n}": (lambda c=c: c) for n, c in buffers.items()}
        direct = whole if whole is not None else F.lit(None)
        return cls(name, lambda: direct, description or name, unit, may_fail=True, keys=tuple(keys), given=True)._in_steps(
            own, lambda: value
        )


def standard_metrics() -> list[Metric]:
    """All built-in metrics."""
    return [
        Metric.count(),
        Metric.sum_primary_value(),
        Metric.sum_fob_value(),
        Metric.sum_cif_value(),
        Metric.sum_quantity(),
        Metric.avg_primary_value(),
        Metric.distinct_reporters(),
        Metric.distinct_partners(),
        Metric.distinct_commodities(),
        Metric.min_year(),
        Metric.max_year(),
    ]


# The fields that rows can be grouped by.
GROUP_FIELDS = (
    "reporter_code",
    "reporter_iso3",
    "partner_code",
    "partner_iso3",
    "flow_code",
    "commodity_code",
    "classification_code",
    "ref_year",
    "period",
    "frequency_code",
    "type_code",
    "mot_code",
    "customs_code",
    "edition",
)


@dataclass(frozen=True)
class Aggregation:
    """One metric per group of one or more fields."""

    name: str
    group_by: tuple[str, ...]
    metric: Metric

    def __post_init__(self) -> None:
        unknown = [f for f in self.group_by if f not in GROUP_FIELDS]
        if unknown:
            raise ValueError(f"cannot group by {unknown}; known fields: {list(GROUP_FIELDS)}")
        if not isinstance(self.metric, Metric):
            raise TypeError("metric must be a Metric")

    def apply(self, df: DataFrame) -> DataFrame:
        """Group columns, ``metric_name``, ``metric_value`` and ``record_count`` (all rows)."""
        rows = df.groupBy(*self.group_by).agg(
            self.metric.build().alias("metric_value"), F.count(F.lit(1)).alias("record_count")
        )
        if not self.group_by:
            # No records make no group, even where the group is "everything".
            rows = rows.filter(F.col("record_count") > 0)
        return rows.select(
            *self.group_by,
            F.lit(self.metric.name).alias("metric_name"),
            "metric_value",
            "record_count",
        )


@dataclass(frozen=True)
class Filter:
    """A named row condition; ``&``, ``|`` and ``~`` combine names along with conditions.

    Conditions are never "unknown", so a negation keeps every other row.  The built-in ones use
    null-safe equality, which the scan can push down.
    """

    name: str
    condition: Callable[[DataFrame], Column]
    description: str = ""

    def column(self, df: DataFrame) -> Column:
        return self.condition(df)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(self.column(df))

    def __and__(self, other: Filter) -> Filter:
        return Filter(
            f"({self.name}) AND ({other.name})",
            lambda df: self.column(df) & other.column(df),
            f"both of: {self.description} / {other.description}",
        )

    def __or__(self, other: Filter) -> Filter:
        return Filter(
            f"({self.name}) OR ({other.name})",
            lambda df: self.column(df) | other.column(df),
            f"one of: {self.description} / {other.description}",
        )

    def __invert__(self) -> Filter:
        return Filter(
            f"NOT ({self.name})", lambda df: ~self.column(df), f"all but: {self.description}"
        )

    @classmethod
    def _equals(cls, label: str, column: str, value) -> Filter:
        return cls(
            f"{label}={value}",
            lambda df: F.col(column).eqNullSafe(F.lit(value)),
            f"rows whose {column} is {value!r}",
        )

    @classmethod
    def reporter(cls, code: int) -> Filter:
        return cls._equals("reporter", "reporter_code", code)

    @classmethod
    def partner(cls, code: int) -> Filter:
        return cls._equals("partner", "partner_code", code)

    @classmethod
    def flow(cls, code: str) -> Filter:
        return cls._equals("flow", "flow_code", code)

    @classmethod
    def flow_export(cls) -> Filter:
        return cls.flow("X")

    @classmethod
    def flow_import(cls) -> Filter:
        return cls.flow("M")

    @classmethod
    def year(cls, year: int) -> Filter:
        return cls._equals("year", "ref_year", year)

    @classmethod
    def year_in(cls, *years: int) -> Filter:
        wanted = sorted(set(years))
        text = ", ".join(str(y) for y in wanted)
        return cls(
            f"year IN {{{text}}}",
            lambda df: F.col("ref_year").isNotNull() & F.col("ref_year").isin(wanted),
            f"rows of the years {text}",
        )

    @classmethod
    def period(cls, period: str) -> Filter:
        return cls._equals("period", "period", period)

    @classmethod
    def commodity(cls, code: str) -> Filter:
        return cls._equals("commodity", "commodity_code", code)

    @classmethod
    def classification(cls, code: str) -> Filter:
        return cls._equals("classification", "classification_code", code)

    @classmethod
    def custom(
        cls, name: str, condition: Callable[[DataFrame], Column] | Column, description: str = ""
    ) -> Filter:
        """Any boolean column, or a function of the frame that makes one (a pandas UDF call too)."""

        def made(df: DataFrame) -> Column:
            given = condition if isinstance(condition, Column) else condition(df)
            return F.coalesce(given, F.lit(False))

        return cls(name, made, description or name)


def apply_all(df: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    for one in filters:
        df = one.apply(df)
    return df
