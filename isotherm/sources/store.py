"""Parquet store of clean readings, year-range labels and the partitioned export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.functions.geo import morton_key
from isotherm.schemas import YEAR_RANGES
from isotherm.sources import snapshots


_PLACE = "_place"
# Partition label of clean rows whose year is in no export range (or null).
OUTSIDE_LABEL = "outside"


def range_label(start: int, end: int) -> str:
    return f"{start}_{end}"


def year_range_of(year: str | Column, ranges=YEAR_RANGES) -> Column:
    """Label ``start_end`` of the inclusive range holding the year; null outside all ranges.

    A ``when`` chain over the ten fixed ranges: no join, stays in codegen.
    """
    y = F.col(year) if isinstance(year, str) else year
    expr = None
    for start, end in ranges:
        cond = y.between(start, end)
        label = F.lit(range_label(start, end))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def year_range_labels(start_year: int, end_year: int, ranges=YEAR_RANGES,
                      with_outside: bool = True) -> list[str]:
    """Labels of the partitions that can hold years in ``[start_year, end_year]``.

    Used for partition pruning; the outside label is included when the span
    reaches beyond the covered years (or the covered years have gaps).
    """
    labels = [range_label(s, e) for s, e in ranges if s <= end_year and e >= start_year]
    covered = sum(max(0, min(e, end_year) - max(s, start_year) + 1) for s, e in ranges)
    if with_outside and covered < end_year - start_year + 1:
        labels.append(OUTSIDE_LABEL)
    return labels


def _contiguous(ranges) -> bool:
    ordered = sorted(ranges)
    return all(a[1] + 1 == b[0] for a, b in zip(ordered, ordered[1:]))


def with_year_range(clean: DataFrame, ranges=YEAR_RANGES) -> DataFrame:
    """Add ``year_range``; rows whose year is in no range are not kept (as in the export).

    For contiguous ranges the row filter is the overall span (two
    comparisons that the optimizer can push to the scan) instead of the
    label test, which would repeat the whole ``when`` chain in the filter.
    """
    if _contiguous(ranges):
        lo, hi = min(s for s, _ in ranges), max(e for _, e in ranges)
        kept = clean.filter(F.col("YEAR").between(lo, hi))
        return kept.withColumn("year_range", year_range_of("YEAR", ranges))
    return clean.withColumn("year_range", year_range_of("YEAR", ranges)).filter(
        F.col("year_range").isNotNull()
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def arranged(labelled: DataFrame) -> DataFrame:
    """Rows with ``year_range`` in the layout of the store.

    Rows are range-partitioned by year range, place and time: a range that
    holds a third of all rows becomes many partitions, and so does a place
    within it, while AQE joins small ones up to the advisory size. Places are
    ordered along a Z-order curve (``morton_key``), so each file and each row group holds a
    compact area, short in latitude and in longitude, and a request for a box
    skips the others by their statistics. Within each task rows are sorted alike.
    """
    time = [c for c in ("YEAR", "MONTH") if c in labelled.columns]
    placed = labelled.withColumn(_PLACE, morton_key("LATITUDE", "LONGITUDE"))
    ordered = placed.repartitionByRange("year_range", _PLACE, *time).sortWithinPartitions("year_range", _PLACE, *time)
    return ordered.drop(_PLACE)


def _write_partitioned(labelled: DataFrame, path: str, mode: str, arrange: bool = True) -> None:
    """Write partitioned by ``year_range``; ``arrange`` (default): in the layout of ``arranged``."""
    df = arranged(labelled) if arrange else labelled.sortWithinPartitions("year_range", morton_key("LATITUDE", "LONGITUDE"))
    df.write.mode(mode).partitionBy("year_range").parquet(path)


def with_any_year_range(clean: DataFrame, ranges=YEAR_RANGES) -> DataFrame:
    """Add ``year_range``, OUTSIDE_LABEL for rows whose year is in no range."""
    return clean.withColumn("year_range", F.coalesce(year_range_of("YEAR", ranges), F.lit(OUTSIDE_LABEL)))


def write_clean_store(clean: DataFrame, path: str, ranges=YEAR_RANGES, mode: str = "overwrite",
                      arrange: bool = True) -> None:
    """Write the whole clean table once, partitioned by ``year_range``.

    Rows outside every range are kept under ``year_range=outside``, so the
    store is the complete clean table and, without that partition, the
    year-range export. Reading it back cuts the lineage of every result.
    """
    _write_partitioned(with_any_year_range(clean, ranges), path, mode, arrange)


def read_clean_store(spark: SparkSession, path: str) -> DataFrame:
    """The clean table; the folder column of an incrementally written store is left out."""
    return spark.read.parquet(path).drop("batch")


CLEAN = "clean"


def commit_clean_store(clean: DataFrame, base: str, ranges=YEAR_RANGES) -> int:
    """As ``write_clean_store``, into a snapshot folder: readers see the old store until the new one is complete."""
    work = snapshots.begin(clean.sparkSession, base)
    work.replace(CLEAN, arranged(with_any_year_range(clean, ranges)), "year_range")
    return work.commit()


def commit_year_ranges(clean: DataFrame, base: str, labels: list[str], ranges=YEAR_RANGES) -> int:
    """Replace the rows of the year ranges ``labels`` in a snapshot folder; files of other ranges are not touched.

    ``clean`` may hold other years, which are left out.
    """
    work = snapshots.begin(clean.sparkSession, base)
    rows = with_any_year_range(clean, ranges).filter(F.col("year_range").isin(labels))
    work.replace_partitions(CLEAN, arranged(rows), "year_range", labels)
    return work.commit()


def read_committed_store(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The clean table of a snapshot folder, with ``year_range``."""
    return snapshots.read_table(spark, base, CLEAN, version)


def write_year_ranges(clean: DataFrame, path: str, ranges=YEAR_RANGES, mode: str = "overwrite",
                      arrange: bool = True) -> None:
    """The year-range export: one write of the clean rows inside the ten
    ranges, partitioned by ``year_range`` (one scan instead of ten filtered
    scans). File sizing and skew handling as in ``_write_partitioned``.
    """
    _write_partitioned(with_year_range(clean, ranges), path, mode, arrange)


def read_year_ranges(spark: SparkSession, path: str, start_year: int | None = None,
                     end_year: int | None = None) -> DataFrame:
    """Read the export; with a year span only the touched partitions are listed."""
    df = spark.read.parquet(path).filter(F.col("year_range") != OUTSIDE_LABEL)
    if start_year is not None and end_year is not None:
        df = df.filter(F.col("year_range").isin(year_range_labels(start_year, end_year, with_outside=False)))
    return df
