"""Schemas and the fixed values shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

STATION_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.StringType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("elevation", T.DoubleType(), True),
        T.StructField("station_name", T.StringType(), True),
        T.StructField("GSN_flag", T.StringType(), True),
        T.StructField("HCN_CRN_flag", T.StringType(), True),
    ]
)
STATION_COLUMNS = [f.name for f in STATION_SCHEMA.fields]

READINGS_SCHEMA = T.StructType(
    [
        T.StructField("STATION", T.StringType(), True),
        T.StructField("DATE", T.StringType(), True),
        T.StructField("LATITUDE", T.DoubleType(), True),
        T.StructField("LONGITUDE", T.DoubleType(), True),
        T.StructField("TAVG", T.DoubleType(), True),
        T.StructField("PRCP", T.DoubleType(), True),
    ]
)
# ---------------------------------------------------------------------------
# Fixed values, on which results depend. Kept together, as plain text, in natural order.
# ---------------------------------------------------------------------------

# Target columns of a monthly reading, in output order.
READING_COLUMNS = ["STATION", "DATE", "LATITUDE", "LONGITUDE", "TAVG", "PRCP"]

# Valid TAVG range, inclusive on both ends, checked before unit conversion.
TAVG_MIN = -20
TAVG_MAX = 122

# A TAVG strictly above this value is taken to be Fahrenheit.
FAHRENHEIT_ABOVE = 50

# Seasons by month number (inclusive); every other month, and a null month, is Winter.
SEASON_MONTHS = [("Spring", 3, 5), ("Summer", 6, 8), ("Autumn", 9, 11)]
DEFAULT_SEASON = "Winter"

# Year ranges of the export, inclusive on both ends.
YEAR_RANGES = [
    (1763, 1800),
    (1801, 1850),
    (1851, 1900),
    (1901, 1927),
    (1928, 1955),
    (1956, 1975),
    (1976, 1985),
    (1986, 1995),
    (1996, 2005),
    (2006, 2023),
]

# Station list tokens: the GSN marker word.
GSN_TOKEN = "GSN"

# First header field of every monthly CSV file.
HEADER_MARKER = "STATION"

# Number of CSV files of one ingest batch.
FILES_PER_BATCH = 500

# Decimal places: readings and seasonal/station means use 2, the global
# yearly temperature mean uses 0.
READING_SCALE = 2
GLOBAL_TEMP_SCALE = 0
