"""Year-over-year change of the global yearly means, and its matrices."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def year_change(global_year: DataFrame) -> DataFrame:
    """Add the previous present year's values and the differences.

    The input is the yearly table of ``global_year_means``: one row per year
    (a few hundred rows at most, whatever the size of the readings), so the
    unpartitioned window that orders it by YEAR runs in a single small task by
    design. Never apply this to raw readings.
    """
    w = Window.orderBy("YEAR")
    prev_t = F.lag("rounded_global_avg_temp").over(w)
    prev_p = F.lag("global_avg_precip").over(w)
    return (
        global_year.withColumn("prev_rounded_global_avg_temp", prev_t)
        .withColumn("prev_global_avg_precip", prev_p)
        .withColumn("temp_change", F.col("rounded_global_avg_temp") - F.col("prev_rounded_global_avg_temp"))
        .withColumn("precip_change", F.col("global_avg_precip") - F.col("prev_global_avg_precip"))
    )


def temp_column_name(value: float) -> str:
    """Matrix column name of a rounded temperature: 21 -> t21, -3 -> t_minus3."""
    v = int(round(value))
    return f"t{v}" if v >= 0 else f"t_minus{-v}"


def change_matrix(change: DataFrame, value: str = "temp_change",
                  temperatures: Iterable[float] | None = None) -> DataFrame:
    """Rows = YEAR, one column per rounded global temperature, cell = ``value``.

    Each year has exactly one rounded temperature, so each row has one
    non-null cell. Passing ``temperatures`` fixes the columns (and skips the
    distinct-values job of ``pivot``); otherwise the observed temperatures
    of the small yearly table are used.
    """
    values = None if temperatures is None else [float(t) for t in temperatures]
    grouped = change.groupBy("YEAR").pivot("rounded_global_avg_temp", values)
    out = grouped.agg(F.first(F.col(value), ignorenulls=True))
    renames = {c: temp_column_name(float(c)) for c in out.columns if c != "YEAR"}
    return out.withColumnsRenamed(renames)


def change_long(change: DataFrame, value: str = "temp_change") -> DataFrame:
    """Long form of the matrix: (YEAR, rounded_global_avg_temp, value)."""
    return change.select("YEAR", "rounded_global_avg_temp", F.col(value))
