"""Rectangle predicates and a coarse grid used to turn range joins into equi-joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default grid cell size in degrees: 10 degrees gives at most 21 x 39 cells.
# Smaller cells suit many small boxes (fewer candidate pairs per cell),
# larger cells suit few large boxes (fewer cells per box).
CELL_DEGREES = 10.0
# The smallest size: a box then touches at most 183 x 363 cells.
MIN_CELL_DEGREES = 1.0
# Cell id = latitude cell * _LON_SPAN + longitude cell.
_LON_SPAN = 100_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_rectangle(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """Inclusive box test; corners are not reordered, so swapped corners match nothing."""
    la, lo = _col(lat), _col(lon)
    return (la >= lat1) & (la <= lat2) & (lo >= lon1) & (lo <= lon2)


def _bounds(limit: float, size: float) -> tuple[int, int]:
    """Cells on either side of the valid range, which hold everything beyond it."""
    return math.floor(-limit / size) - 1, math.floor(limit / size) + 1


def _cell(v: Column, size: float, bounds: tuple[int, int]) -> Column:
    # Out-of-range values share a cell beyond the valid range with the boxes
    # that reach there; the exact predicate decides afterwards.
    return F.least(F.greatest(F.floor(v / F.lit(size)), F.lit(bounds[0])), F.lit(bounds[1])).cast("long")


def grid_cell(lat, lon, cell_degrees: float = CELL_DEGREES) -> Column:
    """Cell id of a point; null when a coordinate is null."""
    la, lo = _col(lat), _col(lon)
    return (_cell(la, cell_degrees, _bounds(90, cell_degrees)) * _LON_SPAN
            + _cell(lo, cell_degrees, _bounds(180, cell_degrees)))


def grid_cells_of_box(lat1, lon1, lat2, lon2, cell_degrees: float = CELL_DEGREES) -> Column:
    """Array of (cell, inside) for every cell a box touches (empty for swapped corners).

    ``inside``: every point of the cell lies in the box. It never holds for
    the cells beyond the valid range.
    """
    if cell_degrees < MIN_CELL_DEGREES:
        raise ValueError(f"cell_degrees must be at least {MIN_CELL_DEGREES}")
    a1, b1, a2, b2 = _col(lat1), _col(lon1), _col(lat2), _col(lon2)
    lat_b, lon_b = _bounds(90, cell_degrees), _bounds(180, cell_degrees)

    def span(low, high, bounds):
        within = lambda k: (k * cell_degrees >= low) & ((k + 1) * cell_degrees <= high) & k.between(bounds[0] + 1, bounds[1] - 1)
        cells = F.sequence(_cell(low, cell_degrees, bounds), _cell(high, cell_degrees, bounds))
        return F.transform(cells, lambda k: F.struct(k.alias("k"), within(k).alias("inside")))

    cells = F.flatten(F.transform(span(a1, a2, lat_b), lambda a: F.transform(span(b1, b2, lon_b), lambda b: F.struct(
        (a["k"] * _LON_SPAN + b["k"]).alias("cell"), (a["inside"] & b["inside"]).alias("inside")))))
    valid = (a1 <= a2) & (b1 <= b2)
    return F.when(valid, cells).otherwise(F.array().cast("array<struct<cell: bigint, inside: boolean>>"))


def grid_row_and_column(lat, lon, cell_degrees: float = CELL_DEGREES) -> tuple[Column, Column]:
    """Row and column of the cell of a point, as in ``grid_cell``."""
    return (_cell(_col(lat), cell_degrees, _bounds(90, cell_degrees)), _cell(_col(lon), cell_degrees, _bounds(180, cell_degrees)))


def pyramid_levels(cell_degrees: float) -> int:
    """The number of levels above the cells: level k has cells of 2^k times the size, up to about a third of the globe's width."""
    return max(0, math.floor(math.log2(128 / cell_degrees)))


def within_range(row: Column, column: Column, cell_degrees: float) -> Column:
    """Whether a cell lies within the valid range of coordinates."""
    lat_b, lon_b = _bounds(90, cell_degrees), _bounds(180, cell_degrees)
    return row.between(lat_b[0] + 1, lat_b[1] - 1) & column.between(lon_b[0] + 1, lon_b[1] - 1)


def with_pyramid_cells(boxes: DataFrame, cell_degrees: float) -> DataFrame:
    """``boxes`` (lat1, lon1, lat2, lon2 and others) with a row for each of the cells that make up a box.

    Adds ``level``, ``row``, ``column``, ``inside``. The cells inside a box are
    taken as coarse as they fit, so their number, and that of the cells on its
    border (level 0, not inside), grows with the box's edge and not with its area:
    at each level what is left around the cells of the next one is a ring of
    one cell's width. Nothing is listed that is not part of the answer.
    """
    if cell_degrees < MIN_CELL_DEGREES:
        raise ValueError(f"cell_degrees must be at least {MIN_CELL_DEGREES}")
    size, levels = F.lit(cell_degrees), pyramid_levels(cell_degrees)
    named = lambda columns: F.inline(F.array(F.struct(*[e.alias(n) for n, e in columns.items()])))
    # Rows and columns: touched cells (_t), and cells inside (_0). Each step is a generator, so that the next one
    # refers to its columns and not to their expressions.
    bounds: dict[str, Column] = {}
    for k, low, high, limits in (("r", _col("lat1"), _col("lat2"), _bounds(90, cell_degrees)),
                                 ("c", _col("lon1"), _col("lon2"), _bounds(180, cell_degrees))):
        first, last = _cell(low, cell_degrees, limits), _cell(high, cell_degrees, limits)
        bounds[f"_{k}1_t"], bounds[f"_{k}2_t"] = first, last
        bounds[f"_{k}1_0"] = F.greatest(F.when(first * size >= low, first).otherwise(first + 1), F.lit(limits[0] + 1))
        # The cell of ``high`` itself ends beyond it; out of range everything is cut to the last valid cell.
        bounds[f"_{k}2_0"] = F.when(last >= limits[1], F.lit(limits[1] - 1).cast("long")).otherwise(
            F.when(last * size <= high, last - 1).otherwise(last - 2))
    valid = (_col("lat1") <= _col("lat2")) & (_col("lon1") <= _col("lon2"))
    numbered = boxes.filter(valid).select("*", named(bounds))
    # Level -1 stands for the border: touched cells without those inside.
    raised = numbered.select("*", F.explode(F.sequence(F.lit(-1), F.lit(levels))).alias("_level"))
    level = F.col("_level")
    rectangles: dict[str, Column] = {}
    for k in "rc":
        first, last = f"_{k}1_0", f"_{k}2_0"
        at = lambda up: (F.expr(f"shiftright({first} + shiftleft(1L, _level + {up}) - 1, _level + {up})"),  # noqa: E731,B023
                         F.expr(f"shiftright({last} + 1, _level + {up}) - 1"))  # noqa: B023
        rectangles[f"_{k}1"] = F.when(level < 0, F.col(f"_{k}1_t")).otherwise(at(0)[0])
        rectangles[f"_{k}2"] = F.when(level < 0, F.col(f"_{k}2_t")).otherwise(at(0)[1])
        # What the next level covers of it.
        rectangles[f"_{k}1_x"] = F.when(level < 0, F.col(first)).when(level == levels, F.lit(1).cast("long")).otherwise(at(1)[0] * 2)
        rectangles[f"_{k}2_x"] = F.when(level < 0, F.col(last)).when(level == levels, F.lit(0).cast("long")).otherwise(at(1)[1] * 2 + 1)
    placed = raised.select("*", named(rectangles))

    def span(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    def of_row(row: Column) -> Column:
        cut = row.between(F.col("_r1_x"), F.col("_r2_x")) & (F.col("_c1_x") <= F.col("_c2_x"))
        sides = F.concat(span(F.col("_c1"), F.col("_c1_x") - 1), span(F.col("_c2_x") + 1, F.col("_c2")))
        return F.transform(F.when(cut, sides).otherwise(span(F.col("_c1"), F.col("_c2"))), lambda column: F.struct(
            row.alias("row"), column.alias("column")))

    cells = F.flatten(F.transform(span(F.col("_r1"), F.col("_r2")), of_row))
    kept = [F.col(f"`{c}`") for c in boxes.columns]
    return placed.select(*kept, F.greatest(level, F.lit(0)).alias("level"), (level >= 0).alias("inside"), F.inline(cells)).select(
        *kept, "level", "row", "column", "inside")


def _spread(v: Column, bits: int) -> Column:
    """The bits of an integer moved apart: bit k to bit 2k. For up to 32 bits."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        if shift < bits:
            v = F.shiftleft(v, shift).bitwiseOR(v).bitwiseAND(F.lit(mask))
    return v


def morton_key(lat, lon, bits: int = 20) -> Column:
    """Place of a point on a Z-order curve over the globe: near points mostly have near keys.

    Each coordinate is cut to ``bits`` bits of its valid range (20: about 40 m), the
    bits of both alternate. Values beyond the range count as its end; a null
    coordinate gives null.
    """
    def part(v: Column, limit: float) -> Column:
        steps = F.floor((v + limit) / (2 * limit) * (1 << bits))
        within = F.least(F.greatest(steps, F.lit(0)), F.lit((1 << bits) - 1)).cast("long")
        return F.when(v.isNotNull(), within)  # greatest() and least() pass over nulls

    return F.shiftleft(_spread(part(_col(lat), 90.0), bits), 1).bitwiseOR(_spread(part(_col(lon), 180.0), bits))


def fine_index(v, limit: float, cell_degrees: float, parts: int) -> Column:
    """Number of a coordinate's strip on a grid ``parts`` times as fine; ascending with the coordinate.

    The strip of a coarser cell is this number divided by strips a cell, so
    grids of all sizes nest exactly. Values beyond the valid range count as in ``grid_cell``.
    """
    low, high = _bounds(limit, cell_degrees)
    return _cell(_col(v), cell_degrees / parts, (low * parts, high * parts + parts - 1))
