"""Year, month and season of a ``yyyy-MM`` date string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isotherm.schemas import DEFAULT_SEASON, SEASON_MONTHS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_of(date: str | Column) -> Column:
    """Characters 1-4 of the date as int; text that is not a number gives null."""
    return F.substring(_col(date), 1, 4).try_cast("int")


def month_of(date: str | Column) -> Column:
    """Characters 6-7 of the date as int; text that is not a number gives null."""
    return F.substring(_col(date), 6, 2).try_cast("int")


def season_of(month: str | Column) -> Column:
    """Northern-hemisphere season of a month number; anything else is Winter."""
    m = _col(month)
    expr = None
    for name, first, last in SEASON_MONTHS:
        cond = m.between(first, last)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(DEFAULT_SEASON))
