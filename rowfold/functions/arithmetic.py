"""Guarded ratios, integer arithmetic, bands and cascades, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(numerator: Column, denominator: Column, digits: int = 2, scale: int = 1) -> Column:
    """``numerator / max(1, denominator)``, scaled and rounded; never divides by zero."""
    return F.round(numerator / F.greatest(F.lit(1), denominator) * F.lit(scale), digits)


def capped_percentage(part: Column, whole: Column, cap: float = 100, digits: int = 2) -> Column:
    """``part`` in percent of ``whole``, at most ``cap``; null when ``whole`` is zero."""
    share = F.try_divide(part, whole) * F.lit(100)
    # least() skips nulls, which would turn an undefined share into the cap
    return F.when(share.isNotNull(), F.round(F.least(share, F.lit(cap).cast("double")), digits))


def truncated(column: Column, to: str = "int") -> Column:
    """Cast towards zero."""
    return column.cast(to)


def floor_div(dividend: Column, divisor: Column) -> Column:
    """Exact integer division rounding down, also for negative operands."""
    quotient = F.call_function("div", dividend, divisor)
    inexact = (dividend % divisor) != 0
    opposite = (dividend < 0) != (divisor < 0)
    return quotient - F.when(inexact & opposite, F.lit(1)).otherwise(F.lit(0))


def clamp(column: Column, low: Column, high: Column) -> Column:
    """Lower bound wins when the bounds cross."""
    return F.greatest(low, F.least(high, column))


def weighted_sum(terms: Sequence[tuple[Column, float]]) -> Column:
    total = None
    for column, weight in terms:
        term = column * F.lit(weight)
        total = term if total is None else total + term
    if total is None:
        raise ValueError("weighted_sum needs at least one term")
    return total


def per_event(total: Column, opportunities: Column, exempt: Column) -> Column:
    """``total // max(1, opportunities - exempt)``."""
    return floor_div(total, F.greatest(F.lit(1), opportunities - exempt))


def zero_unless(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.lit(0))


def band(column: Column, bands: Sequence[tuple[float | None, float | None, str]], default: str) -> Column:
    """Label of the first closed band holding the value; ``None`` leaves a side open.

    An open lower or upper side is exclusive of nothing; values in gaps and nulls get ``default``.
    """
    label = None
    for low, high, name in bands:
        if low is None and high is None:
            raise ValueError("a band needs at least one bound")
        if low is None:
            inside = column <= F.lit(high)
        elif high is None:
            inside = column >= F.lit(low)
        else:
            inside = column.between(F.lit(low), F.lit(high))
        label = F.when(inside, F.lit(name)) if label is None else label.when(inside, F.lit(name))
    if label is None:
        return F.lit(default)
    return label.otherwise(F.lit(default))


def first_positive(choices: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """Value paired with the first counter above zero."""
    result = None
    for counter, value in choices:
        result = F.when(counter > 0, value) if result is None else result.when(counter > 0, value)
    return default if result is None else result.otherwise(default)


def cascading_limit(column: Column, limits: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """``column``, held to the limit that goes with the first counter above zero."""
    return F.least(column, first_positive(limits, default))
