"""Trend of each site over its years: Theil-Sen slope and the Mann-Kendall test.

Both compare the site's years pair by pair, which is bounded by the calendar and not by
the readings: the input is one row per site and year, as ``metrics.station_year_means`` gives it. A
site's years are gathered into one short sorted array (at most a few hundred entries), and the
pairs are formed inside it, so there is one shuffle by site and no join.
Gaps stay gaps: slopes are taken over the years that lie between, and missing
years or means take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.functions.arrays import bound, median_of_sorted

LEAST_YEARS = 3


def _pairs(n: Column, use) -> Column:
    """``use(i, j)`` for all 0 <= i < j < n."""
    return F.flatten(F.transform(F.when(n > 1, F.sequence(F.lit(0), n - 2)), lambda i: F.transform(
        F.sequence(i + 1, n - 1), lambda j: use(i, j))))


def station_trends(station_year: DataFrame, value: str = "avg_temp", least_years: int = LEAST_YEARS, site: str = "STATION",
                   year: str = "YEAR") -> DataFrame:
    """Per site with ``least_years`` years or more: ``n_years``, ``first_year``, ``last_year``,
    ``slope`` (median of the changes per year over all pairs of years), ``mk_s`` (rises less falls over all pairs)
    and ``mk_z`` (its standard score, with the correction for ties and continuity; 0 when all years are equal).

    One row per site and year is expected; of repeated ones the smallest value counts.
    """
    present = station_year.filter(F.col(year).isNotNull() & F.col(value).isNotNull() & ~F.isnan(value))
    single = present.groupBy(site, year).agg(F.min(value).alias("_v"))
    lists = single.groupBy(site).agg(F.collect_list(F.struct(F.col(year).alias("y"), F.col("_v").alias("v"))).alias("_list"))

    def measures(s: Column) -> Column:
        n, at = F.size(s), lambda k: F.get(s, k)
        slopes = F.array_sort(_pairs(n, lambda i, j: (at(j)["v"] - at(i)["v"]) / (at(j)["y"] - at(i)["y"])))
        rises = _pairs(n, lambda i, j: F.signum(at(j)["v"] - at(i)["v"]).cast("long"))
        # Years of equal value, once per value.
        ties = F.transform(F.array_distinct(F.transform(s, lambda x: x["v"])), lambda v: F.size(
            F.filter(s, lambda x: x["v"] == v)).cast("long"))
        total = lambda values, of: F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + of(x))
        return F.struct(
            n.cast("long").alias("n_years"), at(F.lit(0))["y"].alias("first_year"), at(n - 1)["y"].alias("last_year"),
            bound(slopes, median_of_sorted).alias("slope"), total(rises, lambda x: x).alias("mk_s"),
            total(ties, lambda t: t * (t - 1) * (2 * t + 5)).alias("_tied"))

    enough = lists.filter(F.size("_list") >= least_years)
    measured = enough.select(F.col(site), bound(F.array_sort("_list"), measures).alias("_m")).select(F.col(site), "_m.*")
    years = F.col("n_years")
    spread = F.sqrt((years * (years - 1) * (2 * years + 5) - F.col("_tied")) / 18.0)
    return measured.select(
        F.col(site), "n_years", "first_year", "last_year", "slope", "mk_s",
        F.when(F.col("mk_s") == 0, 0.0).otherwise((F.col("mk_s") - F.signum("mk_s")) / spread).alias("mk_z"))
