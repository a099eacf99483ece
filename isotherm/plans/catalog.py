"""Named queries over the driver's test tables, and their DuckDB oracles.

Each query reads the stand-in readings/stations (``sources.standin``), which
are projections of ``lineitem`` / ``supplier`` / ``nation``, so every query's
work grows with those tables. Each oracle is an independent SQL statement
over the same tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from isotherm.operators import borders, change, clean, metrics, partials, regions, robust, sampling, trends, union
from isotherm.operators.literals import literal_table
from isotherm.plans import refresh
from isotherm.schemas import FAHRENHEIT_ABOVE, READING_COLUMNS, READINGS_SCHEMA, TAVG_MIN, YEAR_RANGES
from isotherm.session import scratch_path
from isotherm.sources import listing, readings, standin, stations, store

# Every whole degree that a clean reading (and so a mean) can have: -20 to 50.
MATRIX_TEMPERATURES = list(range(TAVG_MIN, FAHRENHEIT_ABOVE + 1))
# Region of the single-request query: stations 6 and 8 sit on its corners.
SINGLE_REGION = (-48.0, -102.0, 26.0, 44.0, 1996, 1999)
# Index ranges of the block sample, half-open.
SAMPLE_RANGES = [(0, 2), (5, 9)]
EXCLUDED_COUNTRY = "NATION_4"


def _round6(df: DataFrame, *cols: str) -> DataFrame:
    """Unrounded means of doubles depend on summation order; compare at 6 places."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def _readings(spark, sf):
    return standin.readings(spark, sf)


def _clean(spark, sf):
    return clean.clean_readings(_readings(spark, sf))


def _year_change(spark, sf):
    yearly = metrics.global_year_means(metrics.station_year_means(_clean(spark, sf)), ordered=False)
    return change.year_change(yearly)


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------

def q_seasonal_avg(spark, sf):
    return metrics.seasonal_avg(_clean(spark, sf))


def q_station_datapoints(spark, sf):
    return metrics.station_datapoints(_clean(spark, sf))


def q_station_year_means(spark, sf):
    return metrics.station_year_means(_clean(spark, sf), scale=6)


def q_station_year_means_default(spark, sf):
    """The path of the batch job: means as doubles, rounded here only."""
    return _round6(metrics.station_year_means(_clean(spark, sf)), "avg_temp", "avg_precip")


def q_global_year_means(spark, sf):
    yearly = metrics.global_year_means(metrics.station_year_means(_clean(spark, sf)))
    return _round6(yearly, "global_avg_precip")


def q_year_change(spark, sf):
    return _round6(_year_change(spark, sf), "global_avg_precip", "prev_global_avg_precip", "precip_change")


def q_temp_change_matrix(spark, sf):
    return change.change_matrix(_year_change(spark, sf), "temp_change", MATRIX_TEMPERATURES)


def q_precip_change_matrix(spark, sf):
    ch = _round6(_year_change(spark, sf), "precip_change")
    return change.change_matrix(ch, "precip_change", MATRIX_TEMPERATURES)


def q_region_summary(spark, sf):
    return regions.region_summary(_clean(spark, sf), *SINGLE_REGION)


def q_region_summary_store(spark, sf):
    """The serving path: write the clean store once (partitioned by year range),
    then answer the request from the stored Parquet, where the box and year
    filters reach the scan and only the touched year ranges are listed."""
    path = scratch_path(spark, "clean-store")
    store.write_clean_store(_clean(spark, sf), path)
    return regions.region_summary(store.read_clean_store(spark, path), *SINGLE_REGION)


def q_region_summary_many(spark, sf):
    return regions.region_summary_many(_clean(spark, sf), standin.region_requests(spark))


def q_filter_missing(spark, sf):
    return clean.filter_missing(_readings(spark, sf))


def q_filter_outliers(spark, sf):
    return clean.filter_outliers(_readings(spark, sf))


def q_outlier_report(spark, sf):
    return clean.outlier_report(_readings(spark, sf))


def q_convert_temperatures(spark, sf):
    return clean.convert_temperatures(_readings(spark, sf))


def q_time_season(spark, sf):
    return clean.add_time_and_season(_readings(spark, sf))


def q_round_readings(spark, sf):
    return clean.round_readings(clean.convert_temperatures(_readings(spark, sf)))


def q_clean_readings(spark, sf):
    return _clean(spark, sf)


def q_clean_count(spark, sf):
    return clean.clean_count(_clean(spark, sf))


def q_consistency_filter(spark, sf):
    return clean.consistency_filter(standin.readings(spark, sf, extremes=True))


def q_year_range_rows(spark, sf):
    return store.with_year_range(_clean(spark, sf))


def q_block_sample(spark, sf):
    ranges = literal_table(spark, SAMPLE_RANGES, "start long, end long")
    return sampling.block_sample(standin.stations(spark, sf), ranges, order_by=["station_id"])


def _lineitem_parts(spark, sf):
    li = standin.table(spark, sf, "lineitem")
    return li.filter(F.col("l_linestatus") == "O"), li.filter(~F.coalesce(F.col("l_linestatus") == "O", F.lit(False)))


def q_align_columns(spark, sf):
    li_o, li_rest = _lineitem_parts(spark, sf)
    no_prcp = standin.readings_from_lineitem(li_o).drop("PRCP")
    reordered = standin.readings_from_lineitem(li_rest).select(*reversed(READING_COLUMNS))
    return union.union_aligned([no_prcp, reordered], READINGS_SCHEMA)


def q_union_all(spark, sf):
    """Four disjoint ranges of supplier keys, a cut that the scans can push down."""
    li = standin.table(spark, sf, "lineitem")
    key = F.col("l_suppkey")
    cuts = [key < 25, (key >= 25) & (key < 50), (key >= 50) & (key < 75), (key >= 75) | key.isNull()]
    return union.union_all([standin.readings_from_lineitem(li.filter(c)) for c in cuts])


# Files of one station each are written as one folder a station; the folder's name holds the id.
FOLDER_PATTERN = r"STATION=([^/]+)/[^/]+$"
# About as many stations go into one folder of folders, which is listed at once (some 4 KB of the driver's memory a station).
STATIONS_LISTED = 20_000


def _write_station_files(df: DataFrame, path: str, header: bool = True) -> str:
    """One CSV file per station, in a folder named by it."""
    df.repartition("STATION").write.partitionBy("STATION").option("header", header).csv(path)
    return path


def _dealt(station: str, n: int) -> Column:
    """The number of the folder, of ``n``, that holds a station's folder."""
    return F.pmod(F.xxhash64(station), F.lit(n)).cast("int")


def _write_dealt_files(df: DataFrame, path: str, header: bool = True) -> int:
    """As ``_write_station_files``, with the stations' folders dealt to folders ``dealt=<number>``; how many these may be."""
    n = max(1, math.ceil(df.agg(F.approx_count_distinct("STATION")).first()[0] / STATIONS_LISTED))
    df.withColumn("dealt", _dealt("STATION", n)).repartition("STATION").write.partitionBy("dealt", "STATION").option(
        "header", header).csv(path)
    return n


def _read_dealt_files(spark, path: str, n: int, only: DataFrame) -> DataFrame:
    """The files of the stations of ``only``, of what ``_write_dealt_files`` wrote."""
    def read(folder: str) -> DataFrame:
        number = folder.rpartition("dealt=")[2]
        here = only.filter(_dealt("station_id", n) == int(number)) if number.isdigit() else only
        rows = readings.read_readings(spark, folder, file_pattern="*.csv", keep_path=True, only=here, folder="STATION")
        return rows.withColumn("STATION", F.regexp_extract("source_file", FOLDER_PATTERN, 1)).drop("source_file")

    return listing.folder_by_folder(spark, listing.folders(spark, path), read, "read-files")


def q_missing_stations(spark, sf):
    """Stations of the list without a file of precipitation readings."""
    rows = _readings(spark, sf).filter(F.col("PRCP").isNotNull())
    path = _write_station_files(rows, scratch_path(spark, "precipitation"))
    present = listing.present_station_ids(spark, path, recursive=True, id_pattern=FOLDER_PATTERN)
    return listing.missing_stations(standin.stations(spark, sf), present)


def _station_list(spark, sf, name: str) -> DataFrame:
    """The list of stations at or above sea level, written as text and read back."""
    path = scratch_path(spark, name)
    station_lines(spark, sf, F.col("s_acctbal") >= 0).write.text(path)
    return stations.read_stations(spark, path)


def q_listed_ingest(spark, sf):
    """Files of all stations; only those of listed stations are read."""
    path = scratch_path(spark, "files")
    n = _write_dealt_files(_readings(spark, sf), path)
    return _read_dealt_files(spark, path, n, _station_list(spark, sf, "list"))


def q_sampled_ingest(spark, sf):
    """Ranges of the ordered station list -> their files -> clean rows."""
    ranges = literal_table(spark, SAMPLE_RANGES, "start long, end long")
    chosen = sampling.block_sample(_station_list(spark, sf, "sampled-list"), ranges, order_by=["station_id"])
    path = scratch_path(spark, "sampled-files")
    n = _write_dealt_files(_readings(spark, sf), path)
    return clean.clean_readings(_read_dealt_files(spark, path, n, chosen))


# Rows of a file that is read whole: some 2 MB, whatever the size of the table.
WHOLE_FILE_ROWS = 20_000


def q_quoted_ingest(spark, sf):
    """A column whose values hold line breaks, quotes and commas, read back in both modes from files fit for each."""
    li = standin.table(spark, sf, "lineitem")
    rows = standin.readings_from_lineitem(li, keep=("l_returnflag", "l_linenumber")).withColumn("NAME", F.concat(
        F.lit("PLACE "), F.col("STATION"), F.lit('\n"'), F.col("l_returnflag"), F.lit('",\n\n2000-01,'), F.col("l_linenumber")))
    base = scratch_path(spark, "quoted")
    schema = StructType([*READINGS_SCHEMA.fields, StructField("NAME", StringType())])

    def read_back(mode: str, most_rows: int, compression: str) -> DataFrame:
        """0 rows: files of any size."""
        rows.select("NAME", *READING_COLUMNS).write.option("header", True).option("escape", '"').option(
            "maxRecordsPerFile", most_rows).option("compression", compression).csv(f"{base}/{mode}")
        found = readings.read_readings(spark, f"{base}/{mode}", schema, file_pattern="*.csv*",
                                       whole_files=mode == "files", quoted_breaks=True)
        return found.withColumn("mode", F.lit(mode))

    # Whole files can be compressed; large ones are read in splits, so they are not.
    return read_back("files", WHOLE_FILE_ROWS, "gzip").unionByName(read_back("lines", 0, "none"))


def _refreshed(spark, sf) -> DataFrame:
    """Sums after two refreshes: files of three folders, then one folder removed, one written anew, one added."""
    base = scratch_path(spark, "refresh")
    rows = standin.readings_from_lineitem(
        standin.table(spark, sf, "lineitem"), keep=("l_linenumber",)).withColumn("part", F.least("l_linenumber", F.lit(4)))

    def write(part: int, to: str, mode: str = "error") -> None:
        rows.filter(F.col("part") == part).select(*READING_COLUMNS).write.mode(mode).option("header", True).csv(f"{base}/raw/{to}")

    for part, to in ((1, "a"), (2, "b"), (3, "c")):
        write(part, to)
    refresh.refresh(spark, f"{base}/raw", f"{base}/store", recursive=True, buckets=8)
    write(4, "b", "overwrite")
    write(2, "d")
    listing.remove_folder(spark, f"{base}/raw/c")
    refresh.refresh(spark, f"{base}/raw", f"{base}/store", recursive=True, buckets=8)
    return refresh.totals(spark, f"{base}/store")


def q_refreshed_datapoints(spark, sf):
    return partials.station_datapoints_of(_refreshed(spark, sf))


def q_refreshed_year_means(spark, sf):
    yearly = metrics.global_year_means(partials.station_year_means_of(_refreshed(spark, sf)))
    return _round6(yearly, "global_avg_precip")


REPLACED_RANGE = "1986_1995"


def q_replaced_range(spark, sf):
    """A committed store in which one year range is then replaced by its warm rows alone."""
    path = scratch_path(spark, "committed")
    cleaned = _clean(spark, sf)
    store.commit_clean_store(cleaned, path)
    store.commit_year_ranges(cleaned.filter("TAVG > 10"), path, [REPLACED_RANGE])
    return store.read_committed_store(spark, path)


OUTLIER_SCORE = 1.3


def q_significant_outliers(spark, sf):
    found = robust.significant_outliers(_readings(spark, sf), OUTLIER_SCORE)
    return _round6(found, "median", "mad", "score")


def q_station_trends(spark, sf):
    return _round6(trends.station_trends(metrics.station_year_means(_clean(spark, sf), scale=6)), "slope", "mk_z")


def q_headerless_files(spark, sf):
    """Stations whose file of rows with line status F was written without a header."""
    li = standin.table(spark, sf, "lineitem")
    open_rows = standin.readings_from_lineitem(li.filter("l_linestatus = 'O'"))
    other_rows = standin.readings_from_lineitem(li.filter("l_linestatus is distinct from 'O'"))
    base = scratch_path(spark, "headers")
    _write_dealt_files(open_rows, f"{base}/with")
    _write_dealt_files(other_rows, f"{base}/without", header=False)
    found = listing.folder_by_folder(
        spark, [f for written in ("with", "without") for f in listing.folders(spark, f"{base}/{written}")],
        lambda f: readings.headerless_files(spark, f, file_pattern="*.csv", recursive=True), "headerless")
    return found.select(F.regexp_extract("source_file", FOLDER_PATTERN, 1).alias("station_id"),
                        F.regexp_extract("source_file", "/(with|without)/", 1).alias("written")).distinct()


def q_station_file_paths(spark, sf):
    return listing.station_file_paths(standin.stations(spark, sf), "s3a://raw/readings/")


def q_year_range_export(spark, sf):
    """The export written by year range and read back."""
    path = scratch_path(spark, "export")
    store.write_year_ranges(_clean(spark, sf), path)
    return store.read_year_ranges(spark, path)


def q_station_country(spark, sf):
    return regions.station_country(standin.stations(spark, sf), standin.country_regions(spark, sf))


def q_polygon_country(spark, sf):
    """Sites by the borders of diamonds with holes, some across the date line; bands of over six edges are cut."""
    return borders.polygon_country(standin.stations(spark, sf), standin.country_polygons(spark, sf), max_edges=6)


def q_country_filter(spark, sf):
    return regions.country_filter(q_station_country(spark, sf), EXCLUDED_COUNTRY)


def station_lines(spark: SparkSession, sf: str, keep: F.Column | None = None) -> DataFrame:
    """Station text lines built from ``supplier``: runs of spaces and tabs,
    two-word names, GSN and numeric flags chosen by ``s_suppkey % 4``."""
    s = standin.table(spark, sf, "supplier")
    s = s if keep is None else s.filter(keep)
    k = F.col("s_suppkey")
    sep = F.when(k % 5 == 0, F.lit("\t")).otherwise(F.repeat(F.lit(" "), (k % 3 + 1).cast("int")))
    gsn = F.when((k % 4 == 1) | (k % 4 == 3), F.lit(" GSN")).otherwise(F.lit(""))
    hcn = F.when((k % 4 == 2) | (k % 4 == 3), F.concat(F.lit("   "), (F.col("s_nationkey") + 100).cast("string"))).otherwise(F.lit(""))
    line = F.concat(
        F.when(k % 7 == 0, F.lit("  ")).otherwise(F.lit("")),
        standin.station_id(k), sep,
        standin.latitude_of(k).cast("string"), sep,
        standin.longitude_of(k).cast("string"), sep,
        F.col("s_acctbal").cast("string"), sep,
        F.lit("SUP N"), k.cast("string"),
        gsn, hcn, F.lit("  "),
    )
    return s.select(line.alias("value"))


def q_station_parse(spark, sf):
    """The list written as text and read back."""
    path = scratch_path(spark, "station-list")
    station_lines(spark, sf).write.text(path)
    return stations.read_stations(spark, path)


def q_readings_ingest(spark, sf):
    """Write the stand-in as CSV files with three header layouts, read them back aligned."""
    li = standin.table(spark, sf, "lineitem")
    part = (
        F.when(F.col("l_linestatus") == "O", F.lit("a"))
        .when(F.col("l_returnflag") == "A", F.lit("b"))
        .otherwise(F.lit("c"))
    )
    rd = standin.readings_from_lineitem(li.withColumn("_part", part), keep=("_part",))
    base = scratch_path(spark, "ingest")
    layouts = {
        # no PRCP; an extra NAME with a comma inside quotes
        "a": ["STATION", "DATE", F.concat(F.lit("PLACE "), F.col("STATION"), F.lit(", XX")).alias("NAME"),
              "LATITUDE", "LONGITUDE", "TAVG"],
        "b": READING_COLUMNS + [F.lit(12.5).alias("ELEVATION")],
        "c": list(reversed(READING_COLUMNS)),
    }

    def write(name: str) -> None:
        part = rd.filter(F.col("_part") == name).select(*layouts[name])
        part.write.mode("overwrite").option("header", True).csv(f"{base}/{name}")

    # The three independent writes run as concurrent Spark jobs.
    with ThreadPoolExecutor(max_workers=len(layouts)) as pool:
        list(pool.map(write, layouts))
    return readings.read_readings(spark, base, file_pattern="*.csv", recursive=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "seasonal_avg": q_seasonal_avg,
    "station_datapoints": q_station_datapoints,
    "station_year_means": q_station_year_means,
    "station_year_means_default": q_station_year_means_default,
    "global_year_means": q_global_year_means,
    "year_change": q_year_change,
    "temp_change_matrix": q_temp_change_matrix,
    "precip_change_matrix": q_precip_change_matrix,
    "region_summary": q_region_summary,
    "region_summary_store": q_region_summary_store,
    "region_summary_many": q_region_summary_many,
    "filter_missing": q_filter_missing,
    "filter_outliers": q_filter_outliers,
    "outlier_report": q_outlier_report,
    "convert_temperatures": q_convert_temperatures,
    "time_season": q_time_season,
    "round_readings": q_round_readings,
    "clean_readings": q_clean_readings,
    "clean_count": q_clean_count,
    "consistency_filter": q_consistency_filter,
    "year_range_rows": q_year_range_rows,
    "block_sample": q_block_sample,
    "align_columns": q_align_columns,
    "union_all": q_union_all,
    "missing_stations": q_missing_stations,
    "listed_ingest": q_listed_ingest,
    "sampled_ingest": q_sampled_ingest,
    "quoted_ingest": q_quoted_ingest,
    "significant_outliers": q_significant_outliers,
    "station_trends": q_station_trends,
    "refreshed_datapoints": q_refreshed_datapoints,
    "refreshed_year_means": q_refreshed_year_means,
    "replaced_range": q_replaced_range,
    "headerless_files": q_headerless_files,
    "station_file_paths": q_station_file_paths,
    "year_range_export": q_year_range_export,
    "station_country": q_station_country,
    "polygon_country": q_polygon_country,
    "country_filter": q_country_filter,
    "station_parse": q_station_parse,
    "readings_ingest": q_readings_ingest,
}


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

def _sql_mean(col: str, scale: int = 2) -> str:
    """Mean of a 2-decimal column rounded half away from zero to ``scale`` places,
    in integer arithmetic on hundredths."""
    s = f"sum(cast(round({col} * 100) AS bigint))"
    n = f"count({col})"
    up = 10 ** (scale - 2)
    return (f"(CASE WHEN {n} = 0 THEN NULL ELSE "
            f"cast(sign({s}) * ((2 * abs({s}) * {up} + {n}) // (2 * {n})) AS double) / {10 ** scale}.0 END)")


def _sql_mean2(col: str) -> str:
    return _sql_mean(col, 2)


def _sql_station(key: str) -> str:
    """The station id of a key; DuckDB's lpad cuts longer texts too."""
    digits = f"cast({key} AS varchar)"
    return f"'ST' || CASE WHEN length({digits}) >= 6 THEN {digits} ELSE lpad({digits}, 6, '0') END"


_READINGS_SELECT = f"""
  {_sql_station('l_suppkey')} AS STATION,
  strftime(l_shipdate, '%Y-%m') AS DATE,
  cast((l_suppkey * 37) % 180 - 90 AS double) AS LATITUDE,
  cast((l_suppkey * 73) % 360 - 180 AS double) AS LONGITUDE,
  CASE WHEN l_linenumber < 7 AND year(l_shipdate) <> 1998
       THEN l_quantity * 4 - 40 + (year(l_shipdate) - 1998) * 3 END AS TAVG,
  CASE WHEN l_returnflag <> 'R' AND l_suppkey % 10 <> 3 THEN l_discount * 1000 END AS PRCP"""

_SEASON = """CASE WHEN MONTH BETWEEN 3 AND 5 THEN 'Spring'
       WHEN MONTH BETWEEN 6 AND 8 THEN 'Summer'
       WHEN MONTH BETWEEN 9 AND 11 THEN 'Autumn' ELSE 'Winter' END"""

_CTE = f"""
readings AS (SELECT {_READINGS_SELECT} FROM lineitem),
converted AS (
  SELECT STATION, DATE, LATITUDE, LONGITUDE,
         CASE WHEN TAVG > 50 THEN (TAVG - 32) * 5 / 9 ELSE TAVG END AS TAVG, PRCP
  FROM readings WHERE TAVG IS NOT NULL AND TAVG >= -20 AND TAVG <= 122),
dated AS (
  SELECT *, try_cast(substr(DATE, 1, 4) AS integer) AS YEAR,
         try_cast(substr(DATE, 6, 2) AS integer) AS MONTH FROM converted),
clean AS (
  SELECT STATION, DATE, LATITUDE, LONGITUDE, round(TAVG, 2) AS TAVG, round(PRCP, 2) AS PRCP,
         YEAR, MONTH, {_SEASON} AS SEASON FROM dated),
station_year AS (
  SELECT STATION, YEAR, avg(TAVG) AS avg_temp, avg(PRCP) AS avg_precip FROM clean GROUP BY STATION, YEAR),
yearly AS (
  SELECT YEAR, round(avg(avg_temp)) AS rounded_global_avg_temp, avg(avg_precip) AS global_avg_precip
  FROM station_year GROUP BY YEAR),
changes AS (
  SELECT *, lag(rounded_global_avg_temp) OVER (ORDER BY YEAR) AS prev_rounded_global_avg_temp,
         lag(global_avg_precip) OVER (ORDER BY YEAR) AS prev_global_avg_precip FROM yearly),
stations AS (
  SELECT {_sql_station('s_suppkey')} AS station_id,
         cast((s_suppkey * 37) % 180 - 90 AS double) AS latitude,
         cast((s_suppkey * 73) % 360 - 180 AS double) AS longitude,
         cast(s_acctbal AS double) AS elevation, s_name AS station_name,
         cast(NULL AS varchar) AS GSN_flag, cast(NULL AS varchar) AS HCN_CRN_flag
  FROM supplier),
regions AS (
  SELECT n_name AS country, cast((n_nationkey // 5) * 36 - 90 AS double) AS lat_min,
         least(cast((n_nationkey // 5) * 36 - 90 + 36 AS double), 66.0) AS lat_max,
         cast((n_nationkey % 5) * 72 - 180 AS double) AS lon_min,
         cast((n_nationkey % 5) * 72 - 180 + 72 AS double) AS lon_max
  FROM nation),
station_country AS (
  SELECT s.*, (SELECT r.country FROM regions r
               WHERE s.latitude >= r.lat_min AND s.latitude < r.lat_max
                 AND s.longitude >= r.lon_min AND s.longitude < r.lon_max
               ORDER BY (r.lat_max - r.lat_min) * (r.lon_max - r.lon_min), r.country LIMIT 1) AS country
  FROM stations s)
"""

_READING_COLS = "STATION, DATE, LATITUDE, LONGITUDE, TAVG, PRCP"
_CLEAN_COLS = _READING_COLS + ", YEAR, MONTH, SEASON"


def _with(body: str) -> str:
    return f"WITH {_CTE}\n{body}"


def _with_line_numbers(body: str) -> str:
    """As ``_with``, where ``clean`` also has ``l_linenumber``."""
    cte = _CTE.replace("FROM lineitem)", ", l_linenumber FROM lineitem)", 1)
    for columns in ("AS TAVG, PRCP\n  FROM readings", "round(PRCP, 2) AS PRCP"):
        cte = cte.replace(columns, columns.replace("PRCP", "PRCP, l_linenumber") if "FROM" in columns else columns + ", l_linenumber", 1)
    return f"WITH {cte}\n{body}"


def _matrix_sql(value: str) -> str:
    cells = ",\n  ".join(
        f"max(CASE WHEN rounded_global_avg_temp = {t} THEN {value} END) AS {change.temp_column_name(t)}"
        for t in MATRIX_TEMPERATURES
    )
    return _with(f"SELECT YEAR,\n  {cells}\nFROM changes GROUP BY YEAR")


def _year_range_case() -> str:
    arms = " ".join(f"WHEN YEAR BETWEEN {s} AND {e} THEN '{s}_{e}'" for s, e in YEAR_RANGES)
    return f"CASE {arms} END"


_REQUESTS_VALUES = ", ".join(
    f"({r[0]}, {r[1]}, {r[2]}, {r[3]}, {r[4]}, {r[5]}, {r[6]})" for r in standin.REGION_REQUESTS
)

ORACLE_SQL: dict[str, str] = {
    "seasonal_avg": _with(
        f"SELECT YEAR, SEASON, {_sql_mean2('TAVG')} AS AVG_SEASONAL_TEMP FROM clean GROUP BY YEAR, SEASON "
        "ORDER BY YEAR, SEASON"),
    "station_datapoints": _with(
        f"SELECT YEAR, SEASON, STATION, {_sql_mean2('TAVG')} AS average_temperature, "
        "count(TAVG) AS datapoints FROM clean GROUP BY YEAR, SEASON, STATION"),
    "station_year_means": _with(
        f"SELECT STATION, YEAR, {_sql_mean('TAVG', 6)} AS avg_temp, {_sql_mean('PRCP', 6)} AS avg_precip "
        "FROM clean GROUP BY STATION, YEAR"),
    "station_year_means_default": _with(
        f"SELECT STATION, YEAR, {_sql_mean('TAVG', 6)} AS avg_temp, {_sql_mean('PRCP', 6)} AS avg_precip "
        "FROM clean GROUP BY STATION, YEAR"),
    "global_year_means": _with(
        "SELECT YEAR, rounded_global_avg_temp, round(global_avg_precip, 6) AS global_avg_precip "
        "FROM yearly ORDER BY YEAR"),
    "year_change": _with(
        "SELECT YEAR, rounded_global_avg_temp, round(global_avg_precip, 6) AS global_avg_precip, "
        "prev_rounded_global_avg_temp, round(prev_global_avg_precip, 6) AS prev_global_avg_precip, "
        "rounded_global_avg_temp - prev_rounded_global_avg_temp AS temp_change, "
        "round(global_avg_precip - prev_global_avg_precip, 6) AS precip_change FROM changes"),
    "temp_change_matrix": _matrix_sql("rounded_global_avg_temp - prev_rounded_global_avg_temp"),
    "precip_change_matrix": _matrix_sql("round(global_avg_precip - prev_global_avg_precip, 6)"),
    "region_summary": _with(
        f"SELECT {_sql_mean2('TAVG')} AS average_temperature, count(*) AS data_points FROM clean "
        f"WHERE LATITUDE BETWEEN {SINGLE_REGION[0]} AND {SINGLE_REGION[2]} "
        f"AND LONGITUDE BETWEEN {SINGLE_REGION[1]} AND {SINGLE_REGION[3]} "
        f"AND YEAR BETWEEN {SINGLE_REGION[4]} AND {SINGLE_REGION[5]}"),
    "region_summary_store": _with(
        f"SELECT {_sql_mean2('TAVG')} AS average_temperature, count(*) AS data_points FROM clean "
        f"WHERE LATITUDE BETWEEN {SINGLE_REGION[0]} AND {SINGLE_REGION[2]} "
        f"AND LONGITUDE BETWEEN {SINGLE_REGION[1]} AND {SINGLE_REGION[3]} "
        f"AND YEAR BETWEEN {SINGLE_REGION[4]} AND {SINGLE_REGION[5]}"),
    "region_summary_many": _with(
        f"SELECT q.region_id, {_sql_mean2('c.TAVG')} AS average_temperature, count(c.TAVG) AS data_points\n"
        f"FROM (VALUES {_REQUESTS_VALUES}) AS q(region_id, lat1, lon1, lat2, lon2, start_year, end_year)\n"
        "LEFT JOIN clean c ON c.LATITUDE >= q.lat1 AND c.LATITUDE <= q.lat2 "
        "AND c.LONGITUDE >= q.lon1 AND c.LONGITUDE <= q.lon2 "
        "AND c.YEAR >= q.start_year AND c.YEAR <= q.end_year GROUP BY q.region_id"),
    "filter_missing": _with(f"SELECT {_READING_COLS} FROM readings WHERE TAVG IS NOT NULL"),
    "filter_outliers": _with(f"SELECT {_READING_COLS} FROM readings WHERE TAVG >= -20 AND TAVG <= 122"),
    "outlier_report": _with(
        f"SELECT {_READING_COLS}, CASE WHEN TAVG < -20 THEN 'low' ELSE 'high' END AS reason "
        "FROM readings WHERE TAVG IS NOT NULL AND NOT (TAVG >= -20 AND TAVG <= 122)"),
    "convert_temperatures": _with(
        "SELECT STATION, DATE, LATITUDE, LONGITUDE, "
        "CASE WHEN TAVG > 50 THEN (TAVG - 32) * 5 / 9 ELSE TAVG END AS TAVG, PRCP FROM readings"),
    "time_season": _with(
        f"SELECT {_READING_COLS}, YEAR, MONTH, {_SEASON} AS SEASON FROM ("
        "SELECT *, try_cast(substr(DATE, 1, 4) AS integer) AS YEAR, "
        "try_cast(substr(DATE, 6, 2) AS integer) AS MONTH FROM readings)"),
    "round_readings": _with(
        "SELECT STATION, DATE, LATITUDE, LONGITUDE, "
        "round(CASE WHEN TAVG > 50 THEN (TAVG - 32) * 5 / 9 ELSE TAVG END, 2) AS TAVG, "
        "round(PRCP, 2) AS PRCP FROM readings"),
    "clean_readings": _with(f"SELECT {_CLEAN_COLS} FROM clean"),
    "clean_count": _with("SELECT count(*) AS n FROM clean"),
    "consistency_filter": _with(
        f"SELECT {_READING_COLS}, TMAX, TMIN FROM (SELECT {_READINGS_SELECT},\n"
        "  CASE WHEN l_linenumber < 7 AND year(l_shipdate) <> 1998\n"
        "       THEN l_quantity * 4 - 40 + (year(l_shipdate) - 1998) * 3 END + round(l_tax * 100) AS TMAX,\n"
        "  CASE WHEN l_linenumber < 7 AND year(l_shipdate) <> 1998\n"
        "       THEN l_quantity * 4 - 40 + (year(l_shipdate) - 1998) * 3 END - round(l_discount * 100) + 1 AS TMIN\n"
        "  FROM lineitem)\n"
        "WHERE TMAX >= TAVG AND TAVG >= TMIN AND ((TMAX > TAVG AND TAVG > TMIN) OR (TMAX = TAVG AND TAVG = TMIN))"),
    "year_range_rows": _with(
        f"SELECT * FROM (SELECT {_CLEAN_COLS}, {_year_range_case()} AS year_range FROM clean) "
        "WHERE year_range IS NOT NULL"),
    "block_sample": _with(
        "SELECT * FROM (SELECT *, row_number() OVER (ORDER BY station_id) - 1 AS row_index FROM stations) "
        "WHERE " + " OR ".join(f"(row_index >= {s} AND row_index < {e})" for s, e in SAMPLE_RANGES)),
    "align_columns": _with(
        f"SELECT STATION, DATE, LATITUDE, LONGITUDE, TAVG, CASE WHEN l_linestatus = 'O' THEN NULL ELSE PRCP END AS PRCP "
        f"FROM (SELECT {_READINGS_SELECT}, l_linestatus FROM lineitem)"),
    "union_all": _with(f"SELECT {_READING_COLS} FROM readings"),
    "missing_stations": _with(
        "SELECT * FROM stations WHERE station_id NOT IN (SELECT STATION FROM readings WHERE PRCP IS NOT NULL)"),
    "listed_ingest": _with(
        f"SELECT {_READING_COLS} FROM readings WHERE STATION IN (SELECT station_id FROM stations WHERE elevation >= 0)"),
    "sampled_ingest": _with(
        f"SELECT {_CLEAN_COLS} FROM clean WHERE STATION IN (SELECT station_id FROM (SELECT station_id, "
        "row_number() OVER (ORDER BY station_id) - 1 AS i FROM stations WHERE elevation >= 0) WHERE "
        + " OR ".join(f"(i >= {s} AND i < {e})" for s, e in SAMPLE_RANGES) + ")"),
    "significant_outliers": _with(
        f"SELECT {_READING_COLS}, MONTH, n_values, round(m, 6) AS median, round(d, 6) AS mad, "
        "round(0.6745 * (TAVG - m) / d, 6) AS score FROM ("
        "SELECT *, try_cast(substr(DATE, 6, 2) AS integer) AS MONTH FROM readings WHERE TAVG IS NOT NULL) JOIN ("
        "SELECT STATION, try_cast(substr(DATE, 6, 2) AS integer) AS MONTH, count(TAVG) AS n_values, median(TAVG) AS m, mad(TAVG) AS d "
        "FROM readings GROUP BY ALL) USING (STATION, MONTH) "
        f"WHERE n_values >= 8 AND d > 0 AND abs(0.6745 * (TAVG - m) / d) > {OUTLIER_SCORE}"),
    "station_trends": _with(
        f"SELECT STATION, n_years, first_year, last_year, round(slope, 6) AS slope, mk_s, round(CASE WHEN mk_s = 0 THEN 0 ELSE "
        "(mk_s - sign(mk_s)) / sqrt((n_years * (n_years - 1) * (2 * n_years + 5) - tied) / 18.0) END, 6) AS mk_z FROM ("
        "SELECT a.STATION, median((b.v - a.v) / (b.YEAR - a.YEAR)) AS slope, sum(sign(b.v - a.v))::BIGINT AS mk_s "
        "FROM sy a JOIN sy b ON a.STATION = b.STATION AND a.YEAR < b.YEAR GROUP BY a.STATION) JOIN ("
        "SELECT STATION, count(*) AS n_years, min(YEAR) AS first_year, max(YEAR) AS last_year FROM sy GROUP BY STATION) USING (STATION) JOIN ("
        "SELECT STATION, sum(t * (t - 1) * (2 * t + 5))::BIGINT AS tied FROM (SELECT STATION, v, count(*) AS t FROM sy GROUP BY ALL) "
        "GROUP BY STATION) USING (STATION) WHERE n_years >= 3").replace(
        "\nSELECT STATION, n_years", f",\nsy AS (SELECT STATION, YEAR, {_sql_mean('TAVG', 6)} AS v FROM clean GROUP BY STATION, YEAR)\n"
        "SELECT STATION, n_years", 1),
    "quoted_ingest": (
        f"SELECT {_READING_COLS}, 'PLACE ' || STATION || chr(10) || '\"' || l_returnflag || '\",' || chr(10) || chr(10) || "
        f"'2000-01,' || l_linenumber AS NAME, mode FROM (SELECT {_READINGS_SELECT}, l_returnflag, l_linenumber FROM lineitem), "
        "(VALUES ('files'), ('lines')) AS m(mode)"),
    "refreshed_datapoints": _with_line_numbers(
        f"SELECT YEAR, SEASON, STATION, {_sql_mean2('TAVG')} AS average_temperature, "
        "count(TAVG) AS datapoints FROM clean WHERE l_linenumber <> 3 GROUP BY YEAR, SEASON, STATION"),
    "refreshed_year_means": _with_line_numbers(
        "SELECT YEAR, round(avg(avg_temp)) AS rounded_global_avg_temp, round(avg(avg_precip), 6) AS global_avg_precip FROM ("
        "SELECT STATION, YEAR, avg(TAVG) AS avg_temp, avg(PRCP) AS avg_precip FROM clean WHERE l_linenumber <> 3 "
        "GROUP BY STATION, YEAR) GROUP BY YEAR"),
    "replaced_range": _with(
        f"SELECT * FROM (SELECT {_CLEAN_COLS}, coalesce({_year_range_case()}, 'outside') AS year_range FROM clean) "
        f"WHERE year_range <> '{REPLACED_RANGE}' OR TAVG > 10"),
    "headerless_files": (
        f"SELECT DISTINCT {_sql_station('l_suppkey')} AS station_id, 'without' AS written FROM lineitem "
        "WHERE l_linestatus IS DISTINCT FROM 'O'"),
    "station_file_paths": _with(
        "SELECT station_id, 's3a://raw/readings/' || station_id || '.csv' AS path FROM stations"),
    "year_range_export": _with(
        f"SELECT * FROM (SELECT {_CLEAN_COLS}, {_year_range_case()} AS year_range FROM clean) "
        "WHERE year_range IS NOT NULL"),
    "station_country": _with("SELECT * FROM station_country"),
    # Ray casting against every edge, on longitudes that run on beyond the date line.
    "polygon_country": _with(
        "SELECT s.*, (SELECT min(country) FROM ("
        "SELECT n_name AS country, count(*) AS met FROM (SELECT n_name, (n_nationkey // 5) * 36 - 72 + 0.313 AS lat, "
        "(n_nationkey % 5) * 72 - 144 + 30.171 AS lon FROM nation) n, "
        "(VALUES (17.5, 35.5), (5.25, 9.5)) AS d(h, w), "
        "(VALUES (0, -1, 1, 0), (1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1)) AS e(a1, b1, a2, b2), (VALUES (0), (360)) AS t(turn) "
        "WHERE least(n.lat + a1 * h, n.lat + a2 * h) <= s.latitude AND s.latitude < greatest(n.lat + a1 * h, n.lat + a2 * h) "
        "AND s.longitude + turn < n.lon + b1 * w + (s.latitude - n.lat - a1 * h) * (b2 - b1) * w / ((a2 - a1) * h) "
        "GROUP BY n_name, turn) WHERE met % 2 = 1) AS country FROM stations s"),
    "country_filter": _with(f"SELECT * FROM station_country WHERE country <> '{EXCLUDED_COUNTRY}'"),
    "station_parse": (
        f"SELECT {_sql_station('s_suppkey')} AS station_id,\n"
        "  cast((s_suppkey * 37) % 180 - 90 AS double) AS latitude,\n"
        "  cast((s_suppkey * 73) % 360 - 180 AS double) AS longitude,\n"
        "  cast(s_acctbal AS double) AS elevation,\n"
        "  'SUP N' || cast(s_suppkey AS varchar) AS station_name,\n"
        "  CASE WHEN s_suppkey % 4 IN (1, 3) THEN 'GSN' END AS GSN_flag,\n"
        "  CASE WHEN s_suppkey % 4 IN (2, 3) THEN cast(s_nationkey + 100 AS varchar) END AS HCN_CRN_flag\n"
        "FROM supplier"),
    "readings_ingest": _with(
        f"SELECT STATION, DATE, LATITUDE, LONGITUDE, TAVG, CASE WHEN l_linestatus = 'O' THEN NULL ELSE PRCP END AS PRCP "
        f"FROM (SELECT {_READINGS_SELECT}, l_linestatus FROM lineitem)"),
}

assert set(ORACLE_SQL) == set(QUERIES), set(ORACLE_SQL) ^ set(QUERIES)
