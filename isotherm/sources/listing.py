"""Stations of the list that have no readings file."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.session import scratch_path


# The id of a file is its name without the suffix.
STEM_PATTERN = r"([^/]+)\.csv$"


def file_listing(spark: SparkSession, paths: str | list[str], file_pattern: str | None = None,
                 recursive: bool = False) -> DataFrame:
    """``path`` of every file. Uses the binary-file source with only the path
    selected, so no content is read; the file index lists the directories (in
    a Spark job when there are many), and the paths stay a DataFrame."""
    return _listed(spark, paths, file_pattern, recursive).select(F.col("_metadata.file_path").alias("path"))


def _listed(spark: SparkSession, paths: str | list[str], file_pattern: str | None, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(paths)


def file_details(spark: SparkSession, paths: str | list[str], file_pattern: str | None = None,
                 recursive: bool = False) -> DataFrame:
    """``path``, ``size`` and ``modified`` of every file, from the listing alone."""
    return _listed(spark, paths, file_pattern, recursive).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"))


def present_station_ids(spark: SparkSession, directory: str, file_pattern: str = "*.csv",
                        recursive: bool = False, id_pattern: str = STEM_PATTERN) -> DataFrame:
    """Station ids of the files present in ``directory``: the pattern's group on the path."""
    listing = file_listing(spark, directory, file_pattern, recursive)
    return listing.select(F.regexp_extract(F.col("path"), id_pattern, 1).alias("station_id"))


def missing_stations(stations: DataFrame, present_ids: DataFrame, id_column: str = "station_id") -> DataFrame:
    """Stations whose id has no file (left anti join on the id).

    The present ids are de-duplicated first (partial, map-side distinct), so
    the join side is bounded by the number of stations even when the ids
    come from readings rather than from a file listing.
    """
    present = present_ids.select(F.col(id_column).alias(id_column)).distinct()
    return stations.join(present, id_column, "left_anti")


def station_file_paths(stations: DataFrame, base: str, suffix: str = ".csv") -> DataFrame:
    """``<base>/<station_id>.csv`` per station, as a column (ids are not collected)."""
    return stations.select(
        "station_id", F.concat(F.lit(base.rstrip("/") + "/"), F.col("station_id"), F.lit(suffix)).alias("path")
    )


@contextmanager
def many_small_files(spark: SparkSession) -> Iterator[None]:
    """Within it, folders are listed by a few tasks a core instead of up to 10,000, a task reads many small
    files, and the driver keeps no listing (Spark keeps up to 250 MB of them).

    The session's own settings come back at the end.
    """
    now = spark._jsparkSession.sessionState().conf()
    tasks = min(now.parallelPartitionDiscoveryParallelism(), max(32, 4 * spark.sparkContext.defaultParallelism))
    settings = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": tasks,
                "spark.sql.files.openCostInBytes": min(now.filesOpenCostInBytes(), 128 << 10),
                "spark.sql.hive.manageFilesourcePartitions": "false"}
    own = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in own.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly in ``path`` that Spark's readers would enter; ``path`` itself if there are none or it holds files too."""
    here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    entries = [e for e in here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(here)
               if not e.getPath().getName().startswith(".") and (not e.getPath().getName().startswith("_") or "=" in e.getPath().getName())]
    if not entries or not all(e.isDirectory() for e in entries):
        return [path]
    return sorted(e.getPath().toString() for e in entries)


def folder_by_folder(spark: SparkSession, paths: list[str], read: Callable[[str], DataFrame], name: str) -> DataFrame:
    """The rows that ``read`` gives for each of ``paths``.

    One path is read as it is. Of several, the rows of each are written to a
    scratch table before the next is listed, so the driver holds the files of
    one at a time, however many there are in all.
    """
    with many_small_files(spark):
        if len(paths) == 1:
            return read(paths[0])
        table = scratch_path(spark, name)
        for path in paths:
            rows = read(path)
            rows.write.mode("append").parquet(table)
            gc.collect()  # frames are in reference cycles, by which the JVM would keep their file listings
        return spark.read.schema(rows.schema).parquet(table)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what it holds, on whatever file system it lies."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
