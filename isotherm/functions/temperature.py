"""Temperature predicates and unit conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isotherm.schemas import FAHRENHEIT_ABOVE, TAVG_MAX, TAVG_MIN


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_valid_range(t: str | Column, low: float = TAVG_MIN, high: float = TAVG_MAX) -> Column:
    """``low <= t <= high``; null for a null t, false for NaN (NaN sorts above all numbers)."""
    c = _col(t)
    return (c >= F.lit(low)) & (c <= F.lit(high))


def outlier_reason(t: str | Column, low: float = TAVG_MIN, high: float = TAVG_MAX) -> Column:
    """'low' / 'high' for a non-null value outside the range, null otherwise."""
    c = _col(t)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c < F.lit(low), F.lit("low"))
        .when(~in_valid_range(c, low, high), F.lit("high"))
    )


def celsius_if_fahrenheit(t: str | Column, above: float = FAHRENHEIT_ABOVE) -> Column:
    """Values strictly above ``above`` are taken as Fahrenheit and converted."""
    c = _col(t)
    return F.when(c > F.lit(above), (c - 32) * 5 / 9).otherwise(c)
