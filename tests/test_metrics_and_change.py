"""Aggregates, the year-over-year window and the change matrices."""

from isotherm.operators import change, metrics

CLEAN = ("STATION string, DATE string, LATITUDE double, LONGITUDE double, TAVG double, "
         "PRCP double, YEAR int, MONTH int, SEASON string")


def sample(spark):
    rows = [
        # station A: two readings in 2000, one in 2002 (2001 missing everywhere)
        ("A", "2000-01", 0.0, 0.0, 10.0, 1.0, 2000, 1, "Winter"),
        ("A", "2000-07", 0.0, 0.0, 20.0, None, 2000, 7, "Summer"),
        ("A", "2002-07", 0.0, 0.0, 22.0, 2.0, 2002, 7, "Summer"),
        # station B: weighs the same as A in the global mean
        ("B", "2000-01", 0.0, 0.0, 30.0, None, 2000, 1, "Winter"),
        ("B", "2002-01", 0.0, 0.0, 26.0, None, 2002, 1, "Winter"),
        ("B", "2002-04", 0.0, 0.0, 0.01, None, 2002, 4, "Spring"),
    ]
    return spark.createDataFrame(rows, CLEAN)


def test_seasonal_avg_sorted_row_weighted(spark):
    out = [tuple(r) for r in metrics.seasonal_avg(sample(spark)).collect()]
    assert out == [(2000, "Summer", 20.0), (2000, "Winter", 20.0), (2002, "Spring", 0.01),
                   (2002, "Summer", 22.0), (2002, "Winter", 26.0)]


def test_station_datapoints_counts_non_null(spark):
    out = {(r.YEAR, r.SEASON, r.STATION): (r.average_temperature, r.datapoints)
           for r in metrics.station_datapoints(sample(spark)).collect()}
    assert out[(2000, "Winter", "A")] == (10.0, 1)
    assert out[(2000, "Winter", "B")] == (30.0, 1)
    assert len(out) == 6


def test_global_means_station_weighted(spark):
    sy = metrics.station_year_means(sample(spark))
    rows = {(r.STATION, r.YEAR): (r.avg_temp, r.avg_precip) for r in sy.collect()}
    assert rows[("A", 2000)] == (15.0, 1.0)
    assert rows[("B", 2000)] == (30.0, None)  # no precipitation -> null mean
    g = [tuple(r) for r in metrics.global_year_means(sy).collect()]
    # 2000: (15 + 30) / 2 = 22.5 -> 23 (half away from zero); precip mean skips B's null
    assert g[0] == (2000, 23.0, 1.0)
    # 2002: A = 22, B = (26 + 0.01) / 2 = 13.005; (22 + 13.005) / 2 = 17.5025 -> 18
    assert g[1][0] == 2002 and g[1][1] == 18.0


def test_year_change_uses_previous_present_year(spark):
    g = metrics.global_year_means(metrics.station_year_means(sample(spark)), ordered=False)
    ch = {r.YEAR: r for r in change.year_change(g).collect()}
    assert ch[2000].prev_rounded_global_avg_temp is None and ch[2000].temp_change is None
    assert ch[2002].prev_rounded_global_avg_temp == 23.0  # 2001 is absent: previous present year
    assert ch[2002].temp_change == ch[2002].rounded_global_avg_temp - 23.0
    assert ch[2002].precip_change == 2.0 - 1.0


def test_change_matrix_one_cell_per_year(spark):
    g = metrics.global_year_means(metrics.station_year_means(sample(spark)), ordered=False)
    ch = change.year_change(g)
    m = change.change_matrix(ch, "temp_change")
    temps = sorted({r.rounded_global_avg_temp for r in g.collect()})
    assert m.columns == ["YEAR"] + [change.temp_column_name(t) for t in temps]
    fixed = change.change_matrix(ch, "temp_change", [-1, 17, 23])
    assert fixed.columns == ["YEAR", "t_minus1", "t17", "t23"]
    long = change.change_long(ch, "precip_change")
    assert long.count() == 2


def test_exact_mean_matches_rounded_true_mean(spark):
    from pyspark.sql import functions as F

    from isotherm.functions.means import exact_mean

    vals = [0.01, 0.02, 0.01, 0.01]  # mean 0.0125 -> 0.01; and ties below
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert df.agg(exact_mean("x").alias("m")).collect()[0].m == 0.01
    tie = spark.createDataFrame([(1.0,), (1.01,)], "x double")  # 1.005 -> 1.01
    assert tie.agg(exact_mean("x").alias("m")).collect()[0].m == 1.01
    neg = spark.createDataFrame([(-1.0,), (-1.01,)], "x double")  # -1.005 -> -1.01
    assert neg.agg(exact_mean("x").alias("m")).collect()[0].m == -1.01
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.agg(exact_mean("x").alias("m"), F.count("x").alias("n")).collect()[0].m is None
