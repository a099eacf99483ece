"""Cleaning of monthly readings.

All steps are narrow (no shuffle): filters and projections that stay inside
one whole-stage-codegen span and follow the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.calendar import month_of, season_of, year_of
from isotherm.functions.temperature import celsius_if_fahrenheit, in_valid_range, outlier_reason
from isotherm.schemas import FAHRENHEIT_ABOVE, READING_SCALE, TAVG_MAX, TAVG_MIN


def filter_missing(df: DataFrame, column: str = "TAVG") -> DataFrame:
    """Keep rows with a temperature; precipitation may be null."""
    return df.filter(F.col(column).isNotNull())


def filter_outliers(df: DataFrame, column: str = "TAVG",
                    low: float = TAVG_MIN, high: float = TAVG_MAX) -> DataFrame:
    """Keep ``low <= TAVG <= high`` (inclusive); null and NaN drop."""
    return df.filter(in_valid_range(column, low, high))


def outlier_report(df: DataFrame, column: str = "TAVG",
                   low: float = TAVG_MIN, high: float = TAVG_MAX) -> DataFrame:
    """The non-null rows that ``filter_outliers`` removes, with reason 'low'/'high'.

    ``filter_outliers(df)`` + ``outlier_report(df)`` + the null rows = ``df``.
    """
    reason = outlier_reason(column, low, high)
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def convert_temperatures(df: DataFrame, column: str = "TAVG",
                         above: float = FAHRENHEIT_ABOVE) -> DataFrame:
    """TAVG above 50 is taken as Fahrenheit and turned into Celsius; 50 stays."""
    return df.withColumn(column, celsius_if_fahrenheit(column, above))


def add_time_and_season(df: DataFrame, date_column: str = "DATE") -> DataFrame:
    """YEAR and MONTH (int) from the ``yyyy-MM`` text, SEASON from the month."""
    return (
        df.withColumn("YEAR", year_of(date_column))
        .withColumn("MONTH", month_of(date_column))
        .withColumn("SEASON", season_of("MONTH"))
    )


def round_readings(df: DataFrame, columns: tuple[str, ...] = ("TAVG", "PRCP"),
                   scale: int = READING_SCALE) -> DataFrame:
    """Round readings half away from zero (Spark's ``round``)."""
    for c in columns:
        df = df.withColumn(c, F.round(F.col(c), scale))
    return df


def clean_readings(df: DataFrame) -> DataFrame:
    """missing -> outliers -> unit conversion -> year/month/season -> rounding.

    The order matters: the range check runs before the conversion, and
    rounding happens before every aggregate.
    """
    return (
        df.transform(filter_missing)
        .transform(filter_outliers)
        .transform(convert_temperatures)
        .transform(add_time_and_season)
        .transform(round_readings)
    )


def cleaning_counts(column: str = "TAVG", low: float = TAVG_MIN, high: float = TAVG_MAX) -> list[F.Column]:
    """Aggregates over raw readings: how many rows there are, and how many each rule of ``clean_readings`` drops or keeps.

    For ``DataFrame.observe``: they are counted while the rows pass by, without a job of their own.
    """
    reason = outlier_reason(column, low, high)
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(column).isNull()).alias("missing"),
            F.count_if(reason == "low").alias("low"), F.count_if(reason == "high").alias("high"),
            F.count_if(in_valid_range(column, low, high)).alias("kept")]


def clean_count(df: DataFrame) -> DataFrame:
    """One row: the number of rows (a single aggregate job)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def consistency_filter(df: DataFrame, tmax: str = "TMAX", tavg: str = "TAVG",
                       tmin: str = "TMIN") -> DataFrame:
    """Keep TMAX > TAVG > TMIN, or all three equal; any null drops the row.

    This is the net effect of the two chained filters ``TMAX >= TAVG >= TMIN``
    and ``strict or all equal``: the second implies the first, so one
    predicate suffices.
    """
    hi, mid, lo = F.col(tmax), F.col(tavg), F.col(tmin)
    strict = (hi > mid) & (mid > lo)
    flat = (hi == mid) & (mid == lo)
    return df.filter(strict | flat)
