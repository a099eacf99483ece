"""Significant outliers: readings far from what their site usually has in that month.

Beside the fixed range of ``clean.outlier_report``, a reading is judged by its robust score
``0.6745 * (x - median) / MAD`` among the readings of its site and calendar month; MAD is
the median of the distances from the median. One pass builds a mergeable quantile sketch (KLL)
per site and month, whatever the number of readings; the median and the MAD are
both taken from the sketch, through its quantiles on a fixed grid.

Groups of fewer than ``GRID`` values are exact: the sketch (``SKETCH_K``) still holds every
value and the grid names each one. In larger groups, the ranks of the median and the MAD are off
by ``RANK_ERROR`` of the group at most (with 99 % confidence, as the sketch states it,
and half a step of the grid).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.functions.arrays import bound, median_of_sorted
from isotherm.functions.calendar import month_of

SKETCH_K = 800
GRID = 512
RANK_ERROR = 0.01
# Turns the MAD of normal values into their standard deviation.
NORMAL = 0.6745
THRESHOLD = 3.5
LEAST_VALUES = 8


def robust_stats(readings: DataFrame, keys: list[str], column: str = "TAVG") -> DataFrame:
    """Per ``keys``: ``n_values``, ``median``, ``mad`` of the values that are neither null nor NaN."""
    value = F.when(~F.isnan(column), F.col(column).cast("double"))
    ranks = F.expr("array(" + ", ".join(f"{(i + 0.5) / GRID!r}D" for i in range(GRID)) + ")")
    sketched = readings.filter(value.isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n_values"), F.kll_sketch_agg_double(value, SKETCH_K).alias("_sketch"))
    n = F.col("n_values")
    # Value j of n lies at the ranks from (j - 1) / n to j / n, where the grid has a place if it is finer.
    every = lambda grid: F.transform(F.sequence(F.lit(1).cast("long"), n), lambda j: F.get(
        grid, F.floor((j - 0.5) * GRID / n).cast("int")))
    values = bound(F.kll_sketch_get_quantile_double("_sketch", ranks), lambda grid: F.when(n < GRID, every(grid)).otherwise(grid))

    def measures(v: Column) -> Column:
        return bound(median_of_sorted(v), lambda m: F.struct(m.alias("median"), median_of_sorted(
            F.array_sort(F.transform(v, lambda x: F.abs(x - m)))).alias("mad")))

    return sketched.select(*keys, "n_values", bound(values, measures).alias("_m")).select(*keys, "n_values", "_m.median", "_m.mad")


def significant_outliers(readings: DataFrame, threshold: float = THRESHOLD, least_values: int = LEAST_VALUES,
                         column: str = "TAVG", site: str = "STATION", date: str = "DATE") -> DataFrame:
    """The readings whose robust score is beyond ``threshold`` either way, with MONTH, n_values, median, mad and score.

    Months of a site with fewer than ``least_values`` values are not judged, nor
    those whose MAD is 0 (half of the values are equal: any other would be
    infinitely far). Readings without a month are judged among themselves.
    """
    dated = readings.withColumn("MONTH", month_of(date))
    keys = [site, "MONTH"]
    stats = robust_stats(dated, keys, column).filter((F.col("n_values") >= least_values) & (F.col("mad") > 0))
    named = stats.select(F.col(site).alias("_site"), F.col("MONTH").alias("_month"), "n_values", "median", "mad")
    judged = dated.filter(F.col(column).isNotNull() & ~F.isnan(column)).join(
        named, F.col(site).eqNullSafe(F.col("_site")) & F.col("MONTH").eqNullSafe(F.col("_month")))
    score = NORMAL * (F.col(column) - F.col("median")) / F.col("mad")
    return judged.drop("_site", "_month").withColumn("score", score).filter(F.abs("score") > threshold)
