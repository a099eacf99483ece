"""Helpers for expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where ``value`` is computed once.

    Without it, the optimizer may put the whole expression in place of a column that a
    lambda refers to, and work it out anew for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def median_of_sorted(values: Column) -> Column:
    """The median of a sorted array: the mean of the two middle values of an even number; null for an empty one."""
    n = F.size(values)
    return (F.get(values, F.floor((n - 1) / 2).cast("int")) + F.get(values, F.floor(n / 2).cast("int"))) / 2
