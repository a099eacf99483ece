"""Exact means of values that already carry two decimal places.

``round(avg(x), 2)`` over doubles depends on summation order and can land on
either side of a rounding tie. The readings are rounded to two places before
any aggregate, so they are exact multiples of 0.01: summing them as integer
hundredths and rounding the exact decimal quotient half away from zero gives
the true rounded mean, independent of partitioning. The sum and the count are also additive,
so partial results can be combined (pre-aggregation) without losing exactness.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hundredths(c: str | Column) -> Column:
    """The value in integer hundredths (long) — exact for a value rounded to 2 places.

    ``x * 100`` of such a double lies within a rounding error of an integer,
    so ``rint`` recovers it exactly. Summing longs keeps the per-row work in
    fixed-width arithmetic inside generated code. NaN, the infinities and
    values beyond a long are null, in ANSI mode too.
    """
    return F.rint(_col(c) * 100).try_cast("long")


def mean_of_hundredths(total: str | Column, count: str | Column, scale: int = 2) -> Column:
    """Mean from a total in hundredths and a count, rounded half away from zero.

    One exact decimal division per group; null when the count is 0 or null.
    """
    q = F.try_divide(_col(total).cast("decimal(20,0)"), (_col(count) * 100).cast("decimal(20,0)"))
    return F.round(q, scale).cast("double")


def exact_mean(c: str | Column, scale: int = 2) -> Column:
    """Aggregate: mean of a 2-decimal column rounded to ``scale`` places, exactly."""
    return mean_of_hundredths(F.sum(hundredths(c)), F.count(hundredths(c)), scale)


def unrounded_mean(c: str | Column) -> Column:
    """Aggregate: mean of a 2-decimal column as a double, the same for any order of the rows.

    An exact long sum, an exact count and one division.
    """
    return F.try_divide(F.sum(hundredths(c)).cast("double"), (F.count(hundredths(c)) * 100).cast("double"))


def mean_of_doubles(c: str | Column) -> Column:
    """Aggregate: mean of doubles at 12 decimals, the same for any order of the rows (decimal sums are exact)."""
    return F.avg(_col(c).try_cast("decimal(28,12)"))
