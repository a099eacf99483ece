"""Year-range export, unions, block sampling and the random ranges."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isotherm.operators import sampling, union
from isotherm.operators.literals import literal_table
from isotherm.schemas import YEAR_RANGES
from isotherm.sources import store


def test_year_ranges_disjoint_and_covering():
    ordered = sorted(YEAR_RANGES)
    assert ordered[0][0] == 1763 and ordered[-1][1] == 2023
    for (s1, e1), (s2, e2) in zip(ordered, ordered[1:]):
        assert s1 <= e1 and e1 + 1 == s2


def test_year_range_labels_and_rows(spark):
    df = spark.createDataFrame([(1762,), (1763,), (1800,), (1801,), (2023,), (2024,), (None,)], "YEAR int")
    got = {r.YEAR: r.year_range for r in store.with_year_range(df).collect()}
    assert got == {1763: "1763_1800", 1800: "1763_1800", 1801: "1801_1850", 2023: "2006_2023"}
    assert store.year_range_labels(1990, 2000) == ["1986_1995", "1996_2005"]


def test_write_and_read_year_ranges(spark, tmp_path):
    df = spark.createDataFrame([(1790, 1.0), (1999, 2.0), (2010, 3.0), (1700, 4.0)], "YEAR int, TAVG double")
    df = df.withColumns({"LATITUDE": df.TAVG, "LONGITUDE": df.TAVG})
    path = str(tmp_path / "ranges")
    store.write_year_ranges(df, path)
    back = store.read_year_ranges(spark, path, 1996, 2005)
    assert [r.YEAR for r in back.collect()] == [1999]
    assert sorted(r.YEAR for r in store.read_parquet(spark, path).collect()) == [1790, 1999, 2010]


def test_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.5)], "STATION string, TAVG double")
    path = str(tmp_path / "p")
    store.write_parquet(df, path)
    store.write_parquet(df, path)  # overwrite replaces
    assert store.read_parquet(spark, path).count() == 1


def test_union_all_checks_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, x int")
    with pytest.raises(ValueError):
        union.union_all([a, b])
    assert union.union_all([a, a]).count() == 2


def test_union_aligned_adds_missing(spark):
    a = spark.createDataFrame([("S", "2000-01", 1.0)], "STATION string, DATE string, TAVG double")
    b = spark.createDataFrame([(2.0, "T", 9.9)], "PRCP double, STATION string, EXTRA double")
    out = union.union_aligned([a, b])
    assert out.columns == ["STATION", "DATE", "LATITUDE", "LONGITUDE", "TAVG", "PRCP"]
    assert sorted((r.STATION, r.TAVG, r.PRCP) for r in out.collect()) == [("S", 1.0, None), ("T", None, 2.0)]


def test_row_index_contiguous_over_partitions(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("id * 3 AS v")
    out = sampling.with_row_index(df, order_by=["v"]).collect()
    assert sorted(r.row_index for r in out) == list(range(1000))
    assert all(r.v == 3 * r.row_index for r in out)


def test_block_sample_half_open_and_overlaps(spark, shuffle_joins):
    df = spark.range(0, 50, 1, 4).withColumnRenamed("id", "k")
    ranges = literal_table(spark, [(0, 2), (5, 9), (7, 8), (49, 60)], "start long, end long")
    got = sorted(r.k for r in sampling.block_sample(df, ranges, order_by=["k"]).collect())
    assert got == [0, 1, 5, 6, 7, 7, 8, 49]
    shuffle_joins()
    big = sorted(r.k for r in sampling.block_sample(df, ranges, order_by=["k"]).collect())
    assert big == got


def test_block_sample_cuts_ranges_to_the_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    ranges = literal_table(spark, [(-5, 10**13), (20, 10**15)], "start long, end long")
    assert sorted(r.k for r in sampling.block_sample(df, ranges, order_by=["k"]).collect()) == list(range(10))
    assert sampling.block_sample(df.limit(0), ranges, order_by=["k"]).count() == 0


@settings(max_examples=15, deadline=None)
@given(n=st.integers(1, 40), lower=st.integers(1, 500), width=st.integers(60, 5000), max_len=st.integers(5, 50))
def test_random_ranges_bounds(spark, n, lower, width, max_len):
    upper = lower + width
    rows = sampling.random_ranges(spark, n, lower, upper, max_len, seed=42).collect()
    assert len(rows) == n
    for r in rows:
        assert lower <= r.start <= upper - max_len
        assert r.start < r.end <= min(r.start + max_len, upper)


def test_year_range_labels_include_outside_when_span_leaves_coverage():
    assert store.year_range_labels(1996, 2005) == ["1996_2005"]
    assert store.year_range_labels(2020, 2030) == ["2006_2023", store.OUTSIDE_LABEL]
    assert store.year_range_labels(1700, 1770) == ["1763_1800", store.OUTSIDE_LABEL]
    assert store.year_range_labels(1990, 2000, with_outside=False) == ["1986_1995", "1996_2005"]


def test_clean_store_keeps_rows_outside_the_ranges(spark, tmp_path):
    df = spark.createDataFrame([(1700, 1.0), (1999, 2.0), (2030, 3.0), (None, 4.0)], "YEAR int, TAVG double")
    df = df.withColumns({"LATITUDE": df.TAVG, "LONGITUDE": df.TAVG})
    path = str(tmp_path / "store")
    store.write_clean_store(df, path)
    back = store.read_clean_store(spark, path)
    assert back.count() == 4  # the whole clean table
    assert sorted(r.YEAR for r in store.read_year_ranges(spark, path).collect()) == [1999]  # the export
