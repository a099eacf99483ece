"""One station holding a third of all rows: results stay whole and exact on every join path."""

from pyspark.sql import functions as F

from isotherm.operators import metrics, regions
from isotherm.operators.literals import literal_table


def skewed_clean(spark, n=30000):
    # station HOT has a third of the rows; the rest spread over 1,000 stations
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") % 1000).cast("string"))).alias("STATION"),
        F.when(F.col("id") % 3 == 0, F.lit(10.0)).otherwise(((F.col("id") % 1000) % 180 - 90).cast("double")).alias("LATITUDE"),
        F.when(F.col("id") % 3 == 0, F.lit(20.0)).otherwise(((F.col("id") % 1000) % 360 - 180).cast("double")).alias("LONGITUDE"),
        (F.lit(1990) + F.col("id") % 20).cast("int").alias("YEAR"),
        ((F.col("id") % 5000) / 100 - 10).alias("TAVG"),
    )
    return base.withColumn("SEASON", F.lit("Winter"))


def test_hot_station_aggregates(spark):
    df = skewed_clean(spark)
    dp = metrics.station_datapoints(df).filter(F.col("STATION") == "HOT")
    assert dp.agg(F.sum("datapoints")).first()[0] == 10000
    assert df.filter(F.col("STATION") == "HOT").count() == 10000


def test_hot_station_region_join_paths_agree(spark, shuffle_joins):
    df = skewed_clean(spark)
    req = literal_table(spark, [(1, 0.0, 0.0, 20.0, 30.0, 1990, 2009), (2, -90.0, -180.0, 90.0, 180.0, 1990, 2009)],
                        "region_id int, lat1 double, lon1 double, lat2 double, lon2 double, start_year int, end_year int")
    small = sorted(map(tuple, regions.region_summary_many(df, req).collect()))
    shuffle_joins()
    big = sorted(map(tuple, regions.region_summary_many(df, req).collect()))
    assert small == big
    assert dict((r[0], r[2]) for r in small)[2] == 30000  # every row counted, none dropped
    single = regions.region_summary(df, 0.0, 0.0, 20.0, 30.0, 1990, 2009).first()
    assert (single.average_temperature, single.data_points) == small[0][1:]
