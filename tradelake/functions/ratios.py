"""Ratios of exact amounts.

Sums stay exact decimals; a ratio converts both exact operands to double and divides once,
so the result does not depend on how the sums were partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double, null when the denominator is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * F.lit(100.0)


def compound_growth(first: Column, last: Column, years: Column) -> Column:
    """Yearly rate that turns ``first`` into ``last`` over ``years``.

    Null without a positive span, from a negative base, from zero to non-zero, or when the
    quotient is not positive.  From zero to zero is 0.
    """
    quotient = ratio(last, first)
    rate = F.pow(quotient, F.lit(1.0) / years.cast("double")) - F.lit(1.0)
    return (
        F.when(years <= 0, F.lit(None).cast("double"))
        .when((first == 0) & (last == 0), F.lit(0.0))
        .when((first > 0) & (quotient > 0), rate)
    )


#: One digit less before the point, so that a sum of two keeps all 18 decimals.
_TERM = "decimal(37,18)"


def plus(left: Column, right: Column) -> Column:
    """Exact sum of two amounts; decimal addition by itself would drop the last decimal."""
    return left.cast(_TERM) + right.cast(_TERM)


def minus(left: Column, right: Column) -> Column:
    """Exact difference of two amounts."""
    return left.cast(_TERM) - right.cast(_TERM)
