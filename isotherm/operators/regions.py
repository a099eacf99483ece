"""Rectangle-and-years summaries and country lookup by location."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.functions.geo import (CELL_DEGREES, fine_index, grid_row_and_column, in_rectangle, pyramid_levels,
                                    with_pyramid_cells, within_range)
from isotherm.functions.means import exact_mean, hundredths, mean_of_hundredths
from isotherm.sources.store import year_range_labels

# The smallest cells of requests for many boxes, in degrees; coarser ones are made from them.
REQUEST_CELL_DEGREES = 1.0


def region_filter(clean: DataFrame, lat1: float, lon1: float, lat2: float, lon2: float,
                  start_year: int, end_year: int) -> DataFrame:
    """Rows inside the box (inclusive edges, corners as given) and year span.

    On a typed Parquet store the three ranges are pushed to the scan; on a
    store partitioned by ``year_range`` only the touched ranges are listed.
    """
    cond = in_rectangle("LATITUDE", "LONGITUDE", lat1, lon1, lat2, lon2) & F.col("YEAR").between(
        start_year, end_year
    )
    if "year_range" in clean.columns:
        cond = F.col("year_range").isin(year_range_labels(start_year, end_year)) & cond
    return clean.filter(cond)


def region_summary(clean: DataFrame, lat1: float, lon1: float, lat2: float, lon2: float,
                   start_year: int, end_year: int) -> DataFrame:
    """One row: mean temperature (2 places; null when nothing matches) and data points.

    A single aggregate job over one filtered scan.
    """
    rows = region_filter(clean, lat1, lon1, lat2, lon2, start_year, end_year)
    return rows.agg(
        exact_mean("TAVG").alias("average_temperature"),
        F.count(F.lit(1)).alias("data_points"),
    )


def location_year_totals(clean: DataFrame) -> DataFrame:
    """Pre-aggregate readings to (LATITUDE, LONGITUDE, YEAR) -> exact sum and count.

    Every region predicate depends only on these three columns, so requests
    can be answered from this table. Its size is bounded by stations x years
    instead of by readings, and the partial aggregate runs map-side, so a hot
    station cannot overload one task.
    """
    keyed = clean.filter(
        F.col("LATITUDE").isNotNull() & F.col("LONGITUDE").isNotNull() & F.col("YEAR").isNotNull()
    )
    return keyed.groupBy("LATITUDE", "LONGITUDE", "YEAR").agg(
        F.sum(hundredths("TAVG")).alias("tavg_total"),
        F.count(hundredths("TAVG")).alias("tavg_count"),
        F.count(F.lit(1)).alias("row_count"),
    )


_SUMS = ("tavg_total", "tavg_count", "row_count")
_CELL = ["level", "row", "column"]


def cell_year_sums(yearly: DataFrame) -> DataFrame:
    """One row per cell of the pyramid: ``(level, row, column, first_year, sums)``, running sums of its years without gaps.

    ``sums[k]`` holds the sums up to year ``first_year + k``, so a span of years
    is the difference of two elements. Bounded by cells x years, whatever the
    number of locations; a cell's window and list hold one entry a year.
    """
    run = Window.partitionBy(*_CELL).orderBy("YEAR")
    summed = yearly.select(
        *_CELL, "YEAR", *[F.sum(n).over(run).alias(n) for n in _SUMS],
        F.coalesce(F.lead("YEAR").over(run) - 1, F.col("YEAR")).alias("_until"))
    filled = summed.select(*_CELL, F.explode(F.sequence("YEAR", "_until")).alias("year"), *_SUMS)
    return filled.groupBy(*_CELL).agg(
        F.min("year").alias("first_year"), F.array_sort(F.collect_list(F.struct("year", *_SUMS))).alias("sums"))


def pyramid_year_totals(totals: DataFrame, cells: DataFrame, cell_degrees: float) -> DataFrame:
    """Sums per year of the cells ``(level, row, column)`` that ``cells`` names, from totals with level-0 ``row`` and ``column``.

    Locations are reduced to cells first, so what is copied to the levels above is
    bounded by cells x years; copies that no request asks for go before they are summed.
    """
    inner = totals.filter(within_range(F.col("row"), F.col("column"), cell_degrees))
    small = inner.groupBy("row", "column", "YEAR").agg(*[F.sum(n).alias(n) for n in _SUMS])
    copied = small.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(pyramid_levels(cell_degrees)))))
    raised = copied.withColumns({c: F.expr(f"shiftright({c}, level)") for c in ("row", "column")})
    asked = raised.join(cells.select(*_CELL).distinct(), _CELL, "left_semi")
    return asked.groupBy(*_CELL, "YEAR").agg(*[F.sum(n).alias(n) for n in _SUMS])


def region_summary_many(clean: DataFrame, requests: DataFrame, cell_degrees: float = REQUEST_CELL_DEGREES) -> DataFrame:
    """One row per request ``(region_id, lat1, lon1, lat2, lon2, start_year, end_year)``;
    ``region_id`` must be unique.

    Plan: readings are pre-aggregated per location-year. A request's box becomes
    the cells that make it up, inner ones as coarse as they fit (``cell_degrees``
    times 1, 2, 4, ...), so their number grows with the box's edge. Inner cells
    are answered from running sums per cell and year, two lookups a cell;
    only the locations in the cells on its border are joined one by one and
    tested exactly (inclusive). Requests with no matching rows are kept (mean
    null, count 0).
    """
    row, column = grid_row_and_column("LATITUDE", "LONGITUDE", cell_degrees)
    totals = location_year_totals(clean).withColumns({"row": row, "column": column})
    asked = requests.select("region_id", "lat1", "lon1", "lat2", "lon2", "start_year", "end_year")
    cells = with_pyramid_cells(asked.filter("start_year <= end_year"), cell_degrees)

    inner = cells.filter("inside").select("region_id", "start_year", "end_year", *_CELL)
    found = inner.join(cell_year_sums(pyramid_year_totals(totals, inner, cell_degrees)), _CELL)

    def upto(year, name):
        last = F.least(year - F.col("first_year"), F.size("sums") - 1)
        return F.when(last >= 0, F.get("sums", last)[name]).otherwise(F.lit(0))

    inner_sums = found.select("region_id", *[
        (upto(F.col("end_year"), n) - upto(F.col("start_year") - 1, n)).alias(n) for n in _SUMS])

    edge = cells.filter("not inside")
    cond = (
        (totals["row"] == edge["row"]) & (totals["column"] == edge["column"])
        & in_rectangle(totals["LATITUDE"], totals["LONGITUDE"], edge["lat1"], edge["lon1"], edge["lat2"], edge["lon2"])
        & totals["YEAR"].between(edge["start_year"], edge["end_year"])
    )
    edge_sums = totals.join(edge, cond).select("region_id", *_SUMS)
    matched = inner_sums.unionByName(edge_sums).groupBy("region_id").agg(*[F.sum(n).alias(n) for n in _SUMS])
    return requests.select("region_id").join(matched, "region_id", "left").select(
        "region_id",
        mean_of_hundredths("tavg_total", "tavg_count").alias("average_temperature"),
        F.coalesce(F.col("row_count"), F.lit(0).cast("long")).alias("data_points"),
    )


# A cell with more boxes than this is cut into FINE x FINE smaller ones, LEVELS times at most
# (each grid costs a shuffle of the boxes and a join; crowded tables gain from more).
DENSE_BOXES = 64
FINE = 10
LEVELS = 1


def country_cells(regions: DataFrame, cell_degrees: float = CELL_DEGREES, dense_boxes: int = DENSE_BOXES,
                  levels: int = LEVELS) -> list[DataFrame]:
    """Per grid, coarse to fine: ``(row, column, boxes)``, the boxes that can win in a cell, sorted by (area, name).

    Boxes behind one that covers the whole cell never win and are left out (a
    lower edge on the cell's own border does not count as covering it). A cell that keeps more than ``dense_boxes`` is listed on the next grid instead.
    """
    parts = FINE ** levels
    box = F.struct(
        ((F.col("lat_max") - F.col("lat_min")) * (F.col("lon_max") - F.col("lon_min"))).alias("area"),
        F.col("country"), "lat_min", "lat_max", "lon_min", "lon_max")
    edges = [("_r1", "lat_min", 90), ("_r2", "lat_max", 90), ("_c1", "lon_min", 180), ("_c2", "lon_max", 180)]

    def cells(rows: DataFrame, size: int, within: int | None = None) -> DataFrame:
        """A row per cell of ``size`` strips that a box touches, in its present cell of ``within`` such cells."""
        def span(name: str, k: str):
            first, last = F.floor(F.col(f"_{k}1") / size), F.floor(F.col(f"_{k}2") / size)
            if within:
                first = F.greatest(first, F.col(name) * within)
                last = F.least(last, F.col(name) * within + (within - 1))
            return F.sequence(first, last)

        spans = rows.select("box", *[e[0] for e in edges], span("row", "r").alias("_rows"), span("column", "c").alias("_columns"))
        return spans.withColumn("row", F.explode("_rows")).withColumn("column", F.explode("_columns")).drop("_rows", "_columns")

    # Other boxes hold no point.
    sound = regions.filter("lat_min < lat_max AND lon_min < lon_max")
    rows = cells(sound.select(box.alias("box"), *[
        fine_index(v, limit, cell_degrees, parts).alias(n) for n, v, limit in edges]), parts)
    lists, in_cell = [], Window.partitionBy("row", "column")
    for level in range(levels + 1):
        size = FINE ** (levels - level)
        # Strips ascend with the coordinate, so an edge in a strip beyond the cell's lies beyond all its points.
        covers = ((F.col("_r1") < F.col("row") * size) & (F.col("_r2") >= (F.col("row") + 1) * size)
                  & (F.col("_c1") < F.col("column") * size) & (F.col("_c2") >= (F.col("column") + 1) * size))
        # One shuffle a grid; a window spills what it does not hold.
        able = rows.withColumn("_cover", F.min(F.when(covers, F.col("box"))).over(in_cell)).filter(
            F.col("_cover").isNull() | (F.col("box") <= F.col("_cover")))
        if level < levels:
            counted = able.withColumn("_n", F.count(F.lit(1)).over(in_cell))
            able, rows = counted.filter(F.col("_n") <= dense_boxes), cells(counted.filter(F.col("_n") > dense_boxes), size // FINE, FINE)
        lists.append(able.groupBy("row", "column").agg(F.array_sort(F.collect_list("box")).alias("boxes")))
    return lists


def station_country(stations: DataFrame, regions: DataFrame, cell_degrees: float = CELL_DEGREES,
                    dense_boxes: int = DENSE_BOXES, levels: int = LEVELS) -> DataFrame:
    """Add ``country`` from a regions table ``(country, lat_min, lat_max, lon_min, lon_max)``.

    Boxes are half-open (``min <= x < max``). Several hits: the smallest box
    wins, then the smaller name. No hit: null, the station is kept;
    duplicate station rows are kept.

    Plan: each station looks up its cell (``country_cells``) on each grid and
    takes the first box of the one list found that contains it. Spark chooses
    the joins from run-time sizes; stations are never grouped.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    parts = FINE ** levels

    def contains(b):
        return (lat >= b["lat_min"]) & (lat < b["lat_max"]) & (lon >= b["lon_min"]) & (lon < b["lon_max"])

    found = stations.withColumns({"_r": fine_index(lat, 90, cell_degrees, parts), "_c": fine_index(lon, 180, cell_degrees, parts)})
    for level, cells in enumerate(country_cells(regions, cell_degrees, dense_boxes, levels)):
        size = FINE ** (levels - level)
        found = found.join(cells.toDF(f"_row{level}", f"_column{level}", f"_boxes{level}"), (
            F.floor(F.col("_r") / size) == F.col(f"_row{level}")) & (F.floor(F.col("_c") / size) == F.col(f"_column{level}")), "left")
    hit = F.get(F.filter(F.coalesce(*[f"_boxes{level}" for level in range(levels + 1)]), contains), 0)
    return found.select(*[F.col(c) for c in stations.columns], hit["country"].alias("country"))


def country_filter(with_country: DataFrame, exclude: str) -> DataFrame:
    """Drop one country; like SQL ``<>``, a null country drops too."""
    return with_country.filter(F.col("country") != exclude)
