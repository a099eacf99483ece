"""Stand-in weather data derived from the driver's TPC-H-like tables.

The test tables hold no weather data, so monthly readings are derived from
``lineitem`` (one reading per line item) and stations from ``supplier``. The
formulas are chosen so that every branch of the cleaning and aggregation
logic is hit (nulls, both outlier sides, Fahrenheit values, a missing year,
stations without precipitation). They are plain projections, so every query
over the stand-in scales with the size of ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.operators.literals import literal_table
from isotherm.schemas import READING_COLUMNS, STATION_COLUMNS

LINEITEM_COLUMNS = ["l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                    "l_returnflag", "l_linestatus", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def station_id(key: str | Column) -> Column:
    """``ST`` and the key, padded to at least six digits (``lpad`` alone would cut longer keys)."""
    digits = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.concat(F.lit("ST"), F.when(F.length(digits) >= 6, digits).otherwise(F.lpad(digits, 6, "0")))


def latitude_of(key: str | Column) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return ((k * 37) % 180 - 90).cast("double")


def longitude_of(key: str | Column) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return ((k * 73) % 360 - 180).cast("double")


def reading_columns(extremes: bool = False) -> list[Column]:
    """Projection from lineitem columns to the reading columns."""
    year = F.year("l_shipdate")
    tavg = F.when(
        (F.col("l_linenumber") < 7) & (year != 1998),
        F.col("l_quantity") * 4 - 40 + (year - 1998) * 3,
    )
    prcp = F.when(
        (F.col("l_returnflag") != "R") & (F.col("l_suppkey") % 10 != 3),
        F.col("l_discount") * 1000,
    )
    cols = [
        station_id("l_suppkey").alias("STATION"),
        F.date_format("l_shipdate", "yyyy-MM").alias("DATE"),
        latitude_of("l_suppkey").alias("LATITUDE"),
        longitude_of("l_suppkey").alias("LONGITUDE"),
        tavg.alias("TAVG"),
        prcp.alias("PRCP"),
    ]
    if extremes:
        cols += [
            (tavg + F.round(F.col("l_tax") * 100)).alias("TMAX"),
            (tavg - F.round(F.col("l_discount") * 100) + 1).alias("TMIN"),
        ]
    return cols


def readings_from_lineitem(lineitem: DataFrame, extremes: bool = False,
                           keep: tuple[str, ...] = ()) -> DataFrame:
    """Readings projected from a lineitem frame; ``keep`` carries source columns."""
    return lineitem.select(*reading_columns(extremes), *[F.col(c) for c in keep])


def readings(spark: SparkSession, sf_dir: str, extremes: bool = False) -> DataFrame:
    return readings_from_lineitem(table(spark, sf_dir, "lineitem"), extremes)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station list: one station per supplier, same coordinate formulas."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        station_id("s_suppkey").alias("station_id"),
        latitude_of("s_suppkey").alias("latitude"),
        longitude_of("s_suppkey").alias("longitude"),
        F.col("s_acctbal").cast("double").alias("elevation"),
        F.col("s_name").alias("station_name"),
        F.lit(None).cast("string").alias("GSN_flag"),
        F.lit(None).cast("string").alias("HCN_CRN_flag"),
    )


def country_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half-open box per nation on a 5 x 5 grid; the northern row stops at 66 degrees, so some stations match none."""
    n = table(spark, sf_dir, "nation")
    lat_min = (F.floor(F.col("n_nationkey") / 5) * 36 - 90).cast("double")
    lon_min = ((F.col("n_nationkey") % 5) * 72 - 180).cast("double")
    return n.select(
        F.col("n_name").alias("country"),
        lat_min.alias("lat_min"),
        F.least(lat_min + 36, F.lit(66.0)).alias("lat_max"),
        lon_min.alias("lon_min"),
        (lon_min + 72).alias("lon_max"),
    )


def country_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation a diamond with a diamond hole, moved east so that those of the last column cross the date line.

    Corners lie off the whole degrees of the stand-in sites, so no site lies on a border.
    """
    n = table(spark, sf_dir, "nation")
    lat = F.floor(F.col("n_nationkey") / 5) * 36 - 72 + 0.313
    lon = (F.col("n_nationkey") % 5) * 72 - 144 + 30.171

    def diamond(height: float, width: float) -> Column:
        corners = [(0.0, -width), (height, 0.0), (0.0, width), (-height, 0.0)]
        wrapped = lambda x: F.when(x >= 180, x - 360).otherwise(x)
        return F.array(*[F.struct((lat + a).alias("lat"), wrapped(lon + b).alias("lon")) for a, b in corners])

    return n.select(F.col("n_name").alias("country"), F.inline(F.array(
        F.struct(F.lit(0).alias("ring"), diamond(17.5, 35.5).alias("points")),
        F.struct(F.lit(1).alias("ring"), diamond(5.25, 9.5).alias("points")))))


# Regional requests of the tests: (region_id, lat1, lon1, lat2, lon2, start, end).
REGION_REQUESTS = [
    (1, -48.0, -102.0, 26.0, 44.0, 1996, 1999),
    (2, 26.0, -102.0, -48.0, 44.0, 1996, 1999),
    (3, -90.0, -180.0, 90.0, 180.0, 1995, 2001),
    (4, 63.0, 117.0, 63.0, 117.0, 1995, 2001),
]


def region_requests(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark,
        REGION_REQUESTS,
        "region_id int, lat1 double, lon1 double, lat2 double, lon2 double, "
        "start_year int, end_year int",
    )


__all__ = [
    "READING_COLUMNS",
    "STATION_COLUMNS",
    "country_polygons",
    "country_regions",
    "readings",
    "readings_from_lineitem",
    "region_requests",
    "stations",
    "table",
]
