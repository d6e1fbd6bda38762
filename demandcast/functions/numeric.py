"""Numeric column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(a: Column, b: Column, default: float | None = 0.0) -> Column:
    """``a / b``, or ``default`` where ``b`` is null or zero."""
    ratio = F.try_divide(a, b)
    return ratio if default is None else F.coalesce(ratio, F.lit(float(default)))


def clip(x: Column, low: float | Column | None = None, high: float | Column | None = None) -> Column:
    """Clip to the bounds given; null stays null."""
    out = x
    if low is not None:
        low = low if isinstance(low, Column) else F.lit(float(low))
        out = F.when(out < low, low).otherwise(out)
    if high is not None:
        high = high if isinstance(high, Column) else F.lit(float(high))
        out = F.when(out > high, high).otherwise(out)
    return out


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def clip_or_default(x: Column, low: float = 0.0, high: float | None = None, default: float = 1.0) -> Column:
    """Clip finite values, replace null, NaN and infinities by ``default``."""
    return F.when(is_finite(x), clip(x, low, high)).otherwise(F.lit(float(default)))


def shrink_and_clip(x: Column, shrink: float, low: float, high: float) -> Column:
    """Pull an index towards 1 and clip it; a missing or non-positive index is neutral."""
    pulled = F.lit(1.0) + F.lit(shrink) * (x - F.lit(1.0))
    return F.when(is_finite(x) & (x > 0), clip(pulled, low, high)).otherwise(F.lit(1.0))


def first_positive(*columns: Column) -> Column:
    """First column above zero, else 0."""
    return F.coalesce(*[F.when(c > 0, c) for c in columns], F.lit(0.0))


def ladder(x: Column, steps: list[tuple[float, Column]], otherwise: Column) -> Column:
    """Value of the first step whose exclusive upper limit lies above ``x``."""
    return reduce(lambda rest, step: F.when(x < F.lit(step[0]), step[1]).otherwise(rest), reversed(steps), otherwise)


def try_double(x: Column) -> Column:
    return x.try_cast("double")


def clean_quantity(x: Column) -> Column:
    """Coerce to a number, missing to 0, negative to 0."""
    value = try_double(x)
    return F.greatest(F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0)), F.lit(0.0))


def round_half_even(x: Column) -> Column:
    """Half-even rounding to a non-negative whole number, missing to 0."""
    return F.greatest(F.bround(F.coalesce(x, F.lit(0.0)), 0).cast("long"), F.lit(0).cast("long"))
