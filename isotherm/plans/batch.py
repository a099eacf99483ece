"""The whole batch job: site list + CSV files of the listed sites -> stores -> results.

Stage layout (each arrow is one Spark job, nothing is collected):

    read_stations -> stations ──────┬────────────────────> missing_stations, station_country
    read_readings (listed files) -> raw store ─┬─> outlier_report
                                               └─> clean store (by year range) ─┬─> seasonal_avg
                                                                                ├─> station_datapoints
                                                                                └─> yearly_means -> year_change -> matrices
    headerless_files (files that hold no recognised header)

The raw and the clean store are written once and every result reads them back,
so no result rescans the CSV text, and the written tables cut the lineage: a
lost executor only reruns tasks of the current job. All tables of a run are
staged in new folders and become visible together, in one commit at its end
(``sources.snapshots``): a run that fails leaves the results of the last one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from isotherm.operators import change, clean, metrics, regions, sampling
from isotherm.schemas import FAHRENHEIT_ABOVE, TAVG_MIN
from isotherm.sources import listing, readings, snapshots, stations, store

# Every whole degree that a mean of clean readings can have.
TEMPERATURES = list(range(TAVG_MIN, FAHRENHEIT_ABOVE + 1))


@dataclass
class BatchOutputs:
    """The folder of each table that a run wrote; ``snapshots.read_table(spark, base, name)`` reads the newest run's."""

    base: str
    written: dict[str, str] = field(default_factory=dict)
    #: Of the raw readings: rows, ragged ones, and rows that each cleaning rule drops (missing, low, high) or keeps.
    counts: dict[str, int] = field(default_factory=dict)
    version: int | None = None

    def path(self, name: str) -> str:
        return self.written[name]


def run_batch(spark: SparkSession, station_list: str, readings_dir: str, output: str,
              country_regions: DataFrame | None = None, matrix_temperatures: list[float] | None = None,
              sample_ranges: DataFrame | None = None) -> BatchOutputs:
    """Run the job and write every result as a Parquet table of the snapshot folder ``output``.

    Only files of listed sites are read. ``sample_ranges`` (``start, end`` over
    the list ordered by id) restricts the run to the sites in these ranges.
    """
    out = BatchOutputs(output)
    work = snapshots.begin(spark, output)
    work.tables.clear()  # a run replaces all tables

    def emit(name: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        staged = work.replace(name, df, partition)
        if work.tables[name]["folders"]:
            out.written[name] = work.path(name)
        return staged

    listed = stations.read_stations(spark, station_list)
    if sample_ranges is not None:
        listed = sampling.block_sample(listed, sample_ranges, order_by=["station_id"]).drop("row_index")
    listed = emit("stations", listed)

    # Counted as the raw store is written: no further job.
    passed = Observation("readings")
    read = readings.read_readings(spark, readings_dir, file_pattern="*.csv", only=listed, flag_ragged=True)
    raw = emit("raw", read.observe(
        passed, F.count_if("ragged").alias("ragged"), *clean.cleaning_counts()).drop("ragged"))
    out.counts = dict(passed.get)
    emit("headerless_files", readings.headerless_files(spark, readings_dir, file_pattern="*.csv"))
    emit("outlier_report", clean.outlier_report(raw))
    cleaned = emit("clean", store.arranged(store.with_any_year_range(clean.clean_readings(raw))), "year_range").drop("year_range")

    emit("seasonal_avg", metrics.seasonal_avg(cleaned))
    emit("station_datapoints", metrics.station_datapoints(cleaned))

    # One row per year from here on.
    yearly = emit("yearly_means", metrics.global_year_means(metrics.station_year_means(cleaned), ordered=False))
    changes = emit("year_change", change.year_change(yearly))
    emit("temp_change_matrix", change.change_matrix(changes, "temp_change", matrix_temperatures or TEMPERATURES))
    emit("precip_change_matrix", change.change_matrix(changes, "precip_change", matrix_temperatures or TEMPERATURES))

    present = listing.present_station_ids(spark, readings_dir)
    emit("missing_stations", listing.missing_stations(listed, present))
    if country_regions is not None:
        emit("station_country", regions.station_country(listed, country_regions))
    out.version = work.commit()
    return out


def main(argv: list[str] | None = None) -> None:
    """Command line for ``spark-submit``: the whole job with paths as arguments."""
    import argparse

    from isotherm.session import cluster_session

    p = argparse.ArgumentParser(description="Monthly readings batch on Spark")
    p.add_argument("--stations", required=True, help="site list (text, one site per line)")
    p.add_argument("--readings", required=True, help="directory of CSV files, one per site")
    p.add_argument("--output", required=True, help="output directory for the stores and results")
    p.add_argument("--regions", help="optional Parquet table (country, lat_min, lat_max, lon_min, lon_max)")
    p.add_argument("--sample", help="optional Parquet table (start, end): ranges of the site list to run on")
    args = p.parse_args(argv)

    spark = cluster_session("isotherm-batch")
    out = run_batch(spark, args.stations, args.readings, args.output,
                    country_regions=spark.read.parquet(args.regions) if args.regions else None,
                    sample_ranges=spark.read.parquet(args.sample) if args.sample else None)
    for name, count in out.counts.items():
        print(f"{name}\t{count}")
    for name, path in out.written.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
