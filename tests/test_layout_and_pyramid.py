"""The Z-order layout of the store and the pyramid of cells for requests."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from isotherm.functions import geo
from isotherm.operators import regions
from isotherm.operators.literals import literal_table
from isotherm.sources import store

REQUEST = "region_id int, lat1 double, lon1 double, lat2 double, lon2 double, start_year int, end_year int"


def plain_morton(lat, lon, bits=20):
    part = lambda v, limit: min(max(int((v + limit) / (2 * limit) * (1 << bits) // 1), 0), (1 << bits) - 1)
    a, b = part(lat, 90), part(lon, 180)
    return sum(((a >> k & 1) << (2 * k + 1)) | ((b >> k & 1) << (2 * k)) for k in range(bits))


@pytest.mark.parametrize("bits", [1, 7, 20, 30])
def test_morton_key(spark, bits):
    points = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (12.34, -56.78), (-89.999, 179.999), (500.0, -900.0), (1e-9, -1e-9)]
    points += [((k * 37.77) % 180 - 90, (k * 73.31) % 360 - 180) for k in range(200)]
    df = spark.createDataFrame(points + [(None, 1.0), (1.0, None)], "lat double, lon double")
    got = df.select("lat", "lon", geo.morton_key("lat", "lon", bits).alias("k")).collect()
    for r in got:
        assert r.k == (None if r.lat is None or r.lon is None else plain_morton(r.lat, r.lon, bits))


def touched(path, lat, lon):
    """(files, row groups) whose statistics allow rows in the box, and all of them."""
    files = groups = all_files = all_groups = 0
    for p in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(p).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        hits = 0
        for g in range(meta.num_row_groups):
            a, b = (meta.row_group(g).column(names.index(c)).statistics for c in ("LATITUDE", "LONGITUDE"))
            hits += a.max >= lat[0] and a.min <= lat[1] and b.max >= lon[0] and b.min <= lon[1]
        files, groups = files + (hits > 0), groups + hits
        all_files, all_groups = all_files + 1, all_groups + meta.num_row_groups
    return files, groups, all_files, all_groups


def test_square_box_reads_fewer_files_and_row_groups(spark, tmp_path):
    """Against the same rows sorted by latitude and then longitude, in as many files."""
    n = 120_000
    rows = spark.range(n).select(
        (F.lit(1996) + F.col("id") % 10).cast("int").alias("YEAR"), (F.col("id") % 12).cast("int").alias("MONTH"),
        (F.pmod(F.xxhash64(F.lit(1), F.col("id") % 6000), F.lit(18000)) / 100 - 90).alias("LATITUDE"),
        (F.pmod(F.xxhash64(F.lit(2), F.col("id") % 6000), F.lit(36000)) / 100 - 180).alias("LONGITUDE"),
        F.col("id").cast("double").alias("TAVG"))
    z, flat = str(tmp_path / "z"), str(tmp_path / "flat")
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "256"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        store.write_clean_store(rows, z)
        by = ["year_range", "LATITUDE", "LONGITUDE"]
        store.with_any_year_range(rows).repartitionByRange(*by).sortWithinPartitions(*by).write.partitionBy(
            "year_range").option("parquet.block.row.count.limit", 1000).parquet(flat)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for back in (z, flat):
        assert store.read_clean_store(spark, back).select("TAVG").distinct().count() == n
    total_z = total_flat = 0
    for lat in range(-80, 80, 32):
        for lon in range(-170, 170, 64):
            box = ((lat, lat + 15), (lon, lon + 30))
            got_z, got_flat = touched(z, *box), touched(flat, *box)
            assert got_z[2] == got_flat[2] == 256
            total_z, total_flat = total_z + got_z[0], total_flat + got_flat[0]
    print("files read for a box, mean of 30:", total_z / 30, "against", total_flat / 30)
    assert total_z < 0.6 * total_flat
    request = ((10.0, 30.0, 25.0, 60.0, 1996, 2005),)
    one = [regions.region_summary(store.read_clean_store(spark, p), *request[0]).collect() for p in (z, flat)]
    assert one[0] == one[1] and one[0][0].data_points > 0


def cells_of(spark, boxes, cell_degrees):
    req = spark.createDataFrame([(k, *map(float, b)) for k, b in enumerate(boxes)],
                                "region_id int, lat1 double, lon1 double, lat2 double, lon2 double")
    return geo.with_pyramid_cells(req, cell_degrees)


def test_cells_grow_with_the_edge(spark):
    edges = [8, 16, 32, 64, 128]
    boxes = [(-61.5, -71.5, -61.5 + e, -71.5 + e) for e in edges]
    counts = {r.region_id: r.n for r in cells_of(spark, boxes, 1.0).groupBy("region_id").agg(F.count("*").alias("n")).collect()}
    for k, e in enumerate(edges):
        assert counts[k] <= 14 * e  # about 4 e on the border and, of all levels together, twice that inside
    assert counts[4] < 2.5 * counts[3] < 6.25 * counts[2]


@given(st.lists(st.tuples(*[st.integers(-400, 400).map(lambda v: v / 2)] * 4), min_size=1, max_size=5),
       st.sampled_from([1.0, 2.0, 7.5, 10.0, 90.0]))
@settings(max_examples=30, deadline=None)
def test_cells_make_up_the_box(spark, boxes, size):
    """No two cells of a box overlap; those inside lie within it; all that touch it are there."""
    found = {}
    for r in cells_of(spark, boxes, size).collect():
        found.setdefault(r.region_id, []).append((r.level, r["row"], r["column"], r.inside))
    lat_b, lon_b = geo._bounds(90, size), geo._bounds(180, size)
    clamp = lambda v, b: min(max(int(v // size), b[0]), b[1])
    for k, (a1, b1, a2, b2) in enumerate(boxes):
        covered = {}
        for level, row, column, inside in found.get(k, []):
            for i in range(row << level, (row + 1) << level):
                for j in range(column << level, (column + 1) << level):
                    assert (i, j) not in covered
                    covered[i, j] = inside
        want = {}
        if a1 <= a2 and b1 <= b2:
            for i in range(clamp(a1, lat_b), clamp(a2, lat_b) + 1):
                for j in range(clamp(b1, lon_b), clamp(b2, lon_b) + 1):
                    want[i, j] = (a1 <= i * size and (i + 1) * size <= a2 and b1 <= j * size and (j + 1) * size <= b2
                                  and lat_b[0] < i < lat_b[1] and lon_b[0] < j < lon_b[1])
        assert covered == want


def test_unasked_cells_are_not_summed(spark):
    """Only cells of requests reach the windows."""
    rows = [(float(a), float(b), 2000, 1.0) for a in range(-80, 81, 4) for b in range(-170, 171, 4)]
    clean = spark.createDataFrame(rows, "LATITUDE double, LONGITUDE double, YEAR int, TAVG double")
    req = literal_table(spark, [(1, -10.0, -10.0, 22.5, 22.5, 1999, 2001)], REQUEST)
    row, column = geo.grid_row_and_column("LATITUDE", "LONGITUDE", 1.0)
    totals = regions.location_year_totals(clean).withColumns({"row": row, "column": column})
    inner = geo.with_pyramid_cells(req, 1.0).filter("inside")
    sums = regions.pyramid_year_totals(totals, inner, 1.0)
    assert 0 < sums.count() <= inner.count() < 200
    got = regions.region_summary_many(clean, req).collect()[0]
    assert got.data_points == sum(-10 <= a <= 22.5 and -10 <= b <= 22.5 for a, b, *_ in rows)
