"""Stored sums and counts from which the seasonal, station and yearly means follow without the readings.

Sums are in integer hundredths, so they add up, and are taken away again,
exactly: the sums of all rows equal those of any parts, and a part that is replaced can be
subtracted. At the grain (STATION, YEAR, SEASON) one row serves every mean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.means import hundredths, mean_of_hundredths
from isotherm.schemas import READING_SCALE

GROUP = ["STATION", "YEAR", "SEASON"]
SUMS = ["n_rows", "temp_sum", "temp_count", "prcp_sum", "prcp_count"]


def partial_sums(clean: DataFrame, *keys: str) -> DataFrame:
    """Sums and counts per ``keys`` (default GROUP), with a map-side partial step."""
    temp, prcp = hundredths("TAVG"), hundredths("PRCP")
    return clean.groupBy(*(keys or GROUP)).agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum(temp), F.lit(0)).alias("temp_sum"), F.count(temp).alias("temp_count"),
        F.coalesce(F.sum(prcp), F.lit(0)).alias("prcp_sum"), F.count(prcp).alias("prcp_count"))


def negated(parts: DataFrame) -> DataFrame:
    """The same sums with the other sign, to take them out of a total."""
    return parts.withColumns({c: -F.col(c) for c in SUMS})


def merged_sums(parts: DataFrame, *keys: str) -> DataFrame:
    """Sums of sums per ``keys`` (default GROUP); groups without any row left are dropped."""
    total = parts.groupBy(*(keys or GROUP)).agg(*[F.sum(c).alias(c) for c in SUMS])
    return total.filter(F.col("n_rows") != 0)


def merged_deltas(parts: DataFrame, *keys: str) -> DataFrame:
    """As ``merged_sums`` for sums of both signs: only groups in which nothing changes are dropped."""
    total = parts.groupBy(*(keys or GROUP)).agg(*[F.sum(c).alias(c) for c in SUMS])
    return total.filter(" or ".join(f"{c} <> 0" for c in SUMS))


def seasonal_avg_of(totals: DataFrame, ordered: bool = True) -> DataFrame:
    """As ``metrics.seasonal_avg`` of the rows behind the totals."""
    out = merged_sums(totals, "YEAR", "SEASON").select(
        "YEAR", "SEASON", mean_of_hundredths("temp_sum", "temp_count", READING_SCALE).alias("AVG_SEASONAL_TEMP"))
    return out.orderBy("YEAR", "SEASON") if ordered else out


def station_datapoints_of(totals: DataFrame) -> DataFrame:
    """As ``metrics.station_datapoints``; totals per GROUP are used as they are."""
    return totals.select("YEAR", "SEASON", "STATION",
                         mean_of_hundredths("temp_sum", "temp_count", READING_SCALE).alias("average_temperature"),
                         F.col("temp_count").alias("datapoints"))


def station_year_means_of(totals: DataFrame, scale: int | None = None) -> DataFrame:
    """As ``metrics.station_year_means``."""
    def mean(what: str):
        total, count = F.col(f"{what}_sum"), F.col(f"{what}_count")
        if scale is not None:
            return mean_of_hundredths(total, count, scale)
        return F.try_divide(F.when(count > 0, total).cast("double"), (count * 100).cast("double"))

    return merged_sums(totals, "STATION", "YEAR").select(
        "STATION", "YEAR", mean("temp").alias("avg_temp"), mean("prcp").alias("avg_precip"))
