"""Aggregates over clean readings.

Every aggregate is a hash aggregate with a map-side partial step, so a hot
key (a station or year holding a large share of rows) is reduced inside
each task before the shuffle: the shuffle carries one row per key per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.means import exact_mean, mean_of_doubles, unrounded_mean
from isotherm.schemas import GLOBAL_TEMP_SCALE, READING_SCALE


def seasonal_avg(clean: DataFrame, ordered: bool = True) -> DataFrame:
    """Mean temperature per (YEAR, SEASON), row-weighted, 2 places."""
    out = clean.groupBy("YEAR", "SEASON").agg(
        exact_mean("TAVG", READING_SCALE).alias("AVG_SEASONAL_TEMP")
    )
    return out.orderBy("YEAR", "SEASON") if ordered else out


def station_datapoints(clean: DataFrame) -> DataFrame:
    """Per (YEAR, SEASON, STATION): mean temperature and non-null data points."""
    return clean.groupBy("YEAR", "SEASON", "STATION").agg(
        exact_mean("TAVG", READING_SCALE).alias("average_temperature"),
        F.count("TAVG").alias("datapoints"),
    )


def station_year_means(clean: DataFrame, scale: int | None = None) -> DataFrame:
    """Per (STATION, YEAR): mean temperature and precipitation.

    ``scale=None`` gives the means as doubles; with a scale they are rounded
    to ``scale`` places. The sums are exact either way, so the order of the
    rows does not matter. A NaN or infinite reading counts as missing.
    """
    if scale is None:
        mean_t, mean_p = unrounded_mean("TAVG"), unrounded_mean("PRCP")
    else:
        mean_t, mean_p = exact_mean("TAVG", scale), exact_mean("PRCP", scale)
    return clean.groupBy("STATION", "YEAR").agg(mean_t.alias("avg_temp"), mean_p.alias("avg_precip"))


def global_year_means(station_year: DataFrame, ordered: bool = True) -> DataFrame:
    """Per YEAR: mean of station means (each station weighs the same).

    Temperature rounded to whole degrees (half away from zero); precipitation
    to 12 decimals. Sums are exact, so a tie falls the same way in every run.
    Null station means are skipped.
    """
    out = station_year.groupBy("YEAR").agg(
        F.round(mean_of_doubles("avg_temp"), GLOBAL_TEMP_SCALE).cast("double").alias("rounded_global_avg_temp"),
        mean_of_doubles("avg_precip").cast("double").alias("global_avg_precip"),
    )
    return out.orderBy("YEAR") if ordered else out
