"""Incremental refresh: results follow the files of a folder, and only new or changed files are read.

The snapshot folder holds three tables that are replaced together:

* ``files``: path, size and modification time of every file that is part of the results;
* ``parts``: each file's sums and counts per station, year and season, by a hash bucket of the path;
* ``totals``: the sums over all files, by a hash bucket of the station.

A refresh lists the folder (no content is read) and compares it with ``files``. New
and changed files are read and reduced to their parts. What changed and removed files
gave before is known from ``parts`` and subtracted; so totals change by a small delta,
and only the buckets that the delta touches are written again. All sums are
integers, so the totals equal those of a full run exactly. A file that is
changed between the listing and the reading has another time than the one noted, and
is read again by the next refresh.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.operators import clean, partials
from isotherm.sources import listing, readings, snapshots

# Hash buckets of the parts and the totals: the grain in which they are rewritten.
BUCKETS = 64

FILES, PARTS, TOTALS = "files", "parts", "totals"
_PART_SCHEMA = ("bucket int, path string, STATION string, YEAR int, SEASON string, n_rows long, temp_sum long, "
                "temp_count long, prcp_sum long, prcp_count long")
_TOTAL_SCHEMA = _PART_SCHEMA.replace(" path string,", "")


@dataclass
class Refreshed:
    """What a refresh did. ``version`` is None when nothing had changed and nothing was written."""

    base: str
    version: int | None
    added: int
    changed: int
    removed: int


def _bucket(key: str, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _touched(df: DataFrame) -> list[int]:
    """The buckets of some rows: BUCKETS at most."""
    return sorted(r.bucket for r in df.select("bucket").distinct().collect())


def file_changes(now: DataFrame, known: DataFrame) -> DataFrame:
    """(path, size, modified, change): ``added``, ``changed`` or ``removed``; files that are the same are left out."""
    old = known.select("path", F.col("size").alias("_size"), F.col("modified").alias("_modified"))
    both = now.join(old, "path", "full_outer")
    change = (F.when(F.col("_size").isNull(), "added").when(F.col("size").isNull(), "removed")
              .when((F.col("size") != F.col("_size")) | (F.col("modified") != F.col("_modified")), "changed"))
    return both.select("path", "size", "modified", change.alias("change")).filter("change is not null")


def refresh(spark: SparkSession, readings_dir: str, base: str, file_pattern: str = "*.csv", recursive: bool = False,
            buckets: int = BUCKETS) -> Refreshed:
    """Bring the snapshot at ``base`` up to date with the CSV files of ``readings_dir``.

    ``buckets`` must be the same for every refresh of a snapshot.
    """
    work = snapshots.begin(spark, base)
    if not work.tables:
        work.replace(FILES, spark.createDataFrame([], "path string, size long, modified timestamp"))
        work.replace(PARTS, spark.createDataFrame([], _PART_SCHEMA), "bucket")
        work.replace(TOTALS, spark.createDataFrame([], _TOTAL_SCHEMA), "bucket")
    known, parts, totals = work.read(FILES), work.read(PARTS), work.read(TOTALS)
    now = work.replace(FILES, listing.file_details(spark, readings_dir, file_pattern, recursive))
    changes = work.replace("changes", file_changes(now, known))
    counts = {r.change: r["count"] for r in changes.groupBy("change").count().collect()}
    done = Refreshed(base, None, *[counts.get(c, 0) for c in ("added", "changed", "removed")])
    if not counts:
        return done

    fresh_files = changes.filter("change <> 'removed'").select("path")
    rows = readings.read_readings(spark, readings_dir, keep_path=True, file_pattern=file_pattern, recursive=recursive,
                                  only_paths=fresh_files)
    cleaned = clean.clean_readings(rows.withColumnRenamed("source_file", "path"))
    fresh = work.replace("fresh", partials.partial_sums(cleaned, "path", *partials.GROUP))
    gone = changes.filter("change <> 'added'").select("path")
    stale = parts.filter(F.col("bucket").isin(_touched(gone.select(_bucket("path", buckets))))).join(gone, "path", "left_semi")

    columns = [*partials.GROUP, *partials.SUMS]
    delta = partials.merged_deltas(fresh.select(*columns).unionByName(partials.negated(stale).select(*columns)))
    delta = work.replace("delta", delta.select(_bucket("STATION", buckets), *columns))
    touched = _touched(delta)
    new_totals = partials.merged_sums(
        totals.filter(F.col("bucket").isin(touched)).unionByName(delta), "bucket", *partials.GROUP)
    work.replace_partitions(TOTALS, new_totals.select(*totals.columns).repartition("bucket"), "bucket", touched)

    touched = _touched(changes.select(_bucket("path", buckets)))
    kept = parts.filter(F.col("bucket").isin(touched)).join(gone, "path", "left_anti")
    new_parts = kept.select(*parts.columns).unionByName(fresh.select(_bucket("path", buckets), "path", *columns))
    work.replace_partitions(PARTS, new_parts.repartition("bucket"), "bucket", touched)
    for scratch in ("changes", "fresh", "delta"):
        del work.tables[scratch]
    done.version = work.commit()
    return done


def totals(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The stored sums per station, year and season: the input of ``operators.partials.*_of``."""
    return snapshots.read_table(spark, base, TOTALS, version).drop("bucket")
