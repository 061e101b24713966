"""Guarded ratios. All arithmetic is decimal, so results do not depend on the order of summation.

``avg`` over decimals keeps six digits, and rounding that to two can round twice (x.xx4999999 -> x.xx5
-> up). Ratios and means are therefore one wide division followed by one rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Two shapes of division; each keeps at least 12 digits of the quotient after the point. The first has room for
# 20 digits before the point over cents, the second for operands with many digits after it.
_SHAPES = (
    (T.DecimalType(24, 4), T.DecimalType(22, 2)),
    (T.DecimalType(36, 20), T.DecimalType(30, 8)),
)


def _quotient(num: Column, den: Column, top: T.DecimalType, bottom: T.DecimalType, pct: bool) -> Column:
    above = num.try_cast(top)
    if pct:
        above = (above * F.lit(100)).cast(T.DecimalType(top.precision + 2, top.scale))
    return (above / F.nullif(den.try_cast(bottom), F.lit(0).cast(bottom))).cast(T.DecimalType(38, 14 if pct else 16))


def ratio(num: Column, den: Column, scale: int = 2, *, pct: bool = False) -> Column:
    """``num / den`` (x 100 with ``pct``), rounded half up; NULL if either is NULL or ``den`` is 0.

    Neither operand is rounded: each division is done in the first shape that holds both operands exactly.
    Operands that fit none raise an error.
    """
    fits = [num.eqNullSafe(num.try_cast(top)) & den.eqNullSafe(den.try_cast(bottom)) for top, bottom in _SHAPES]
    first, second = (_quotient(num, den, *shape, pct) for shape in _SHAPES)
    too_long = F.raise_error(F.lit("an operand of a ratio has too many digits")).cast(T.DecimalType(38, 14 if pct else 16))
    return F.round(F.when(fits[0], first).when(fits[1], second).otherwise(too_long), scale)


def growth_pct(cur: Column, prev: Column) -> Column:
    return ratio(cur - prev, prev, 2, pct=True)


def one_minus_ratio(a: Column, b: Column, scale: int, *, pct: bool = False) -> Column:
    return ratio(b - a, b, scale, pct=pct)


def retention_pct(retained: Column, prev: Column) -> Column:
    return ratio(retained, prev, 2, pct=True)


def mean(c: Column | str, scale: int = 2) -> Column:
    """Aggregate: mean of the non-NULL values, rounded once."""
    c = F.col(c) if isinstance(c, str) else c
    return ratio(F.sum(c), F.count(c), scale)
