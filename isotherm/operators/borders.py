"""Country of a site by real borders: polygons of any number of rings, with holes, also across the date line.

Polygons are a table ``(country, ring, points)``, ``points`` an array of
``(lat, lon)`` without a repeated last point; a country's rings may be parts or
holes, in any direction. A site lies in a country when a ray from it to the east and
then along the date line to the north pole meets the rings an odd number of times, so
the pole itself must lie outside (the south pole may lie inside). An edge goes the
shorter way round the globe. Edges count half-open in latitude, and
a site on a border belongs to the side to the east of it.

Plan: each country's edges are dealt to bands of latitude, which hold all that the rays
of their sites can meet. A band's cells (``cell_degrees`` wide) are either crossed by a
border, or lie inside as a whole, which the crossings of the band's middle
tell; others are not listed. A site looks up its cell: inside, the country is known; only on
a border the ray is cast, against the edges of that band that reach as far east. A band
of more than ``max_edges`` edges of one country is cut into four, and these again, up to ``depth``
times, so lists stay short where borders are detailed. The tables of cells
depend on the borders alone; sites are joined to them and never grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.functions.arrays import bound

CELL_DEGREES = 1.0
MAX_EDGES = 256
DEPTH = 3
# Cells next to a border count as crossed by it; there the ray decides.
_MARGIN = 1e-9
_EDGE = ["lat1", "lon1", "lat2", "lon2"]


def _west_of_date_line(lon: Column) -> Column:
    return F.when(lon >= 180, lon - 360).otherwise(lon)


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """``(country, lat1, lon1, lat2, lon2)`` of all rings, longitudes within -180 to 180.

    An edge over the date line becomes two, and a third along it from the south
    pole to the crossing, which stands for the ray's way north.
    """
    n = F.size("points")
    pairs = F.transform(F.when(n > 1, F.sequence(F.lit(0), n - 1)), lambda i: F.struct(
        F.get("points", i).alias("a"), F.get("points", (i + 1) % n).alias("b")))
    ends = polygons.select("country", F.explode(pairs).alias("e")).select(
        "country", F.col("e.a.lat").alias("lat1"), _west_of_date_line(F.col("e.a.lon")).alias("lon1"),
        F.col("e.b.lat").alias("lat2"), _west_of_date_line(F.col("e.b.lon")).alias("to"))
    # The end of the shorter way, perhaps beyond the date line.
    way = ends.withColumn("lon2", F.col("lon1") + F.pmod(F.col("to") - F.col("lon1") + 540, F.lit(360.0)) - 180)
    line = F.when(F.col("lon2") >= 180, F.lit(180.0)).when(F.col("lon2") < -180, F.lit(-180.0))
    met = F.col("lat1") + (F.col("lat2") - F.col("lat1")) * (F.col("line") - F.col("lon1")) / (F.col("lon2") - F.col("lon1"))
    crossed = way.withColumn("line", line).withColumn("met", met)
    edge = lambda *v: F.struct(*[F.lit(x).cast("double").alias(c) if not isinstance(x, Column) else x.alias(c)
                                 for x, c in zip(v, _EDGE)])
    lat1, lon1, lat2, at, met = F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("line"), F.col("met")
    pieces = F.when(at.isNull(), F.array(edge(lat1, lon1, lat2, F.col("lon2")))).otherwise(F.array(
        edge(lat1, lon1, met, at), edge(met, -at, lat2, F.col("to")), edge(-90.0, 180.0, met, 180.0)))
    return crossed.select("country", F.inline(pieces))


def _low(e) -> Column:
    return F.least(e["lat1"], e["lat2"])


def _high(e) -> Column:
    return F.greatest(e["lat1"], e["lat2"])


def _lon_at(e, lat: Column) -> Column:
    """The longitude at which an edge that does not run along a latitude meets one."""
    return e["lon1"] + (lat - e["lat1"]) * F.try_divide(e["lon2"] - e["lon1"], e["lat2"] - e["lat1"])


def _meets(e, lat: Column) -> Column:
    return (_low(e) <= lat) & (lat < _high(e))


def _bands(edges: DataFrame, size: float) -> DataFrame:
    """``(country, band, edges)``: the edges that a band of ``size`` degrees of latitude holds parts of.

    ``edges`` may be cut to a band of a coarser level, ``south`` to ``north``: it has columns of these names.
    """
    low, high = F.greatest(F.least("lat1", "lat2"), F.col("south")), F.least(F.greatest("lat1", "lat2"), F.col("north"))
    first = F.floor(low / size)
    last = F.least(F.floor(high / size), F.ceil(F.col("north") / size) - 1)
    dealt = edges.select(
        "country", F.struct(*_EDGE).alias("edge"), F.explode(F.when(first <= last, F.sequence(first, last))).alias("band"))
    return dealt.groupBy("country", "band").agg(F.collect_list("edge").alias("edges"))


def _cells(bands: DataFrame, size: float, cell_degrees: float) -> DataFrame:
    """``(band, column, country, inside, edges)`` of the cells of bands; ``edges`` are null inside."""
    south, middle = F.col("band") * size, (F.col("band") + 0.5) * size
    column = lambda lon: F.floor(lon / cell_degrees)

    def crossed(e):
        along = e["lat1"] == e["lat2"]  # such an edge is never met by a ray, but it bounds cells
        ends = [F.when(along, e["lon1"]).otherwise(_lon_at(e, F.greatest(_low(e), south))),
                F.when(along, e["lon2"]).otherwise(_lon_at(e, F.least(_high(e), south + size)))]
        return F.sequence(column(F.least(*ends) - _MARGIN), column(F.greatest(*ends) + _MARGIN))

    at = F.array_sort(F.transform(F.filter("edges", lambda e: _meets(e, middle)), lambda e: _lon_at(e, middle)))
    # An odd number: the ray from the date line itself starts inside.
    even = bound(at, lambda x: F.when(F.size(x) % 2 == 1, F.concat(F.array(F.lit(-180.0)), x)).otherwise(x))
    # Inside from the first crossing of the middle to the second, from the third to the fourth, and so on.
    spans = bound(even, lambda x: F.transform(F.when(F.size(x) > 1, F.sequence(F.lit(0), F.floor(F.size(x) / 2) - 1)), lambda k: F.sequence(
        column(F.get(x, (2 * k).cast("int"))), column(F.get(x, (2 * k + 1).cast("int"))))))
    listed = bands.withColumn("_border", F.array_distinct(F.flatten(F.transform("edges", crossed))))
    within = F.array_except(F.coalesce(F.flatten(spans), F.array().cast("array<bigint>")), F.col("_border"))
    cells = F.concat(F.transform("_border", lambda c: F.struct(c.alias("column"), F.lit(False).alias("inside"))),
                     F.transform(within, lambda c: F.struct(c.alias("column"), F.lit(True).alias("inside"))))
    placed = listed.select("country", "band", "edges", F.explode(cells).alias("c")).select(
        "country", "band", "c.column", "c.inside", "edges")
    east = F.filter("edges", lambda e: F.greatest(e["lon1"], e["lon2"]) >= F.col("column") * cell_degrees - _MARGIN)
    return placed.select("band", "column", "country", "inside", F.when(~F.col("inside"), east).alias("edges"))


def border_cells(polygons: DataFrame, cell_degrees: float = CELL_DEGREES, max_edges: int = MAX_EDGES,
                 depth: int = DEPTH) -> list[tuple[float, DataFrame]]:
    """The cells of all countries: (height of the bands, ``(band, column, countries)``) per level.

    ``countries`` lists ``(country, inside, edges)`` of the countries that a cell may belong to.
    """
    whole = polygon_edges(polygons).withColumns({"south": F.lit(-1000.0), "north": F.lit(1000.0)})
    levels, edges, size = [], whole, cell_degrees
    for level in range(depth + 1):
        bands = _bands(edges, size)
        done = bands if level == depth else bands.filter(F.size("edges") <= max_edges)
        levels.append((size, _cells(done, size, cell_degrees).groupBy("band", "column").agg(
            F.collect_list(F.struct("country", "inside", "edges")).alias("countries"))))
        edges = bands.filter(F.size("edges") > max_edges).select(
            "country", (F.col("band") * size).alias("south"), ((F.col("band") + 1) * size).alias("north"),
            F.inline("edges"))
        size /= 4
    return levels


def polygon_country(sites: DataFrame, polygons: DataFrame, cell_degrees: float = CELL_DEGREES, max_edges: int = MAX_EDGES,
                    depth: int = DEPTH) -> DataFrame:
    """Add ``country`` to sites (``latitude``, ``longitude``); null where no polygon holds a site.

    Where several do, the smallest name. Sites without coordinates are kept with a null country, repeated sites each.
    """
    columns = [F.col(f"`{c}`") for c in sites.columns]
    lat, lon = F.col("latitude"), _west_of_date_line(F.col("longitude"))

    def holds(c):
        met = F.aggregate(c["edges"], F.lit(0), lambda n, e: n + F.when(_meets(e, lat) & (lon < _lon_at(e, lat)), 1).otherwise(0))
        return c["inside"] | (met % 2 == 1)

    found = sites.withColumn("_column", F.floor(lon / cell_degrees))
    hits = []
    for k, (size, cells) in enumerate(border_cells(polygons, cell_degrees, max_edges, depth)):
        renamed = cells.select(F.col("band").alias(f"_band{k}"), F.col("column").alias(f"_column{k}"), F.col("countries").alias(f"_countries{k}"))
        found = found.join(renamed, (F.floor(lat / size) == F.col(f"_band{k}")) & (F.col("_column") == F.col(f"_column{k}")), "left")
        hits.append(F.array_min(F.transform(F.filter(f"_countries{k}", holds), lambda c: c["country"])))
    name = hits[0] if len(hits) == 1 else F.least(*hits)  # least passes over nulls
    return found.select(*columns, name.alias("country"))
