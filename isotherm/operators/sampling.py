"""Contiguous row index and block sampling by index ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isotherm.session import cut_lineage

# monotonically_increasing_id() puts the partition id in the upper 31 bits
# and the record number within the partition in the lower 33 bits.
_ROW_BITS = 33


def with_row_index(df: DataFrame, name: str = "row_index", order_by: list[str] | None = None) -> DataFrame:
    """Add a 0-based contiguous index in the frame's order (or ``order_by``).

    Distributed: rows are tagged with their partition and position, the
    frame is checkpointed to the shared folder (so both uses below see the
    same partitioning, and a lost executor does not renumber rows), the
    per-partition counts (one row per partition) are turned into offsets,
    and each row gets offset + position. No task ever holds all rows.
    """
    src = df.orderBy(*order_by) if order_by else df
    tagged = cut_lineage(
        src.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a window over it is tiny.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS)
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + pos).cast("long"))
        .drop("_pid", "_mid", "_off")
    )


# Index block size of the range join in ``block_sample``.
INDEX_BLOCK = 4096


def block_sample(df: DataFrame, ranges: DataFrame, order_by: list[str] | None = None,
                 index_name: str = "row_index") -> DataFrame:
    """Rows whose 0-based index lies in any half-open ``[start, end)`` of ``ranges``.

    Overlapping ranges repeat rows, like extending a list with slices; ranges
    that reach beyond the rows are cut to them. The range join is an equi-join
    on index blocks of ``INDEX_BLOCK`` rows: each range is expanded to the
    blocks of existing rows it touches, joined on the block and then tested
    exactly. Spark chooses the join from run-time sizes.
    """
    indexed = with_row_index(df, index_name, order_by).withColumn(
        "_block", F.floor(F.col(index_name) / INDEX_BLOCK).cast("long")
    )
    # A scalar subquery: the last block that exists.
    last = indexed.agg(F.max("_block")).scalar()
    r = ranges.select(F.greatest(F.col("start").cast("long"), F.lit(0).cast("long")).alias("_start"),
                      F.col("end").cast("long").alias("_end"))
    first_block = F.floor(F.col("_start") / INDEX_BLOCK).cast("long")
    last_block = F.least(F.floor((F.col("_end") - 1) / INDEX_BLOCK).cast("long"), last)
    spans = r.filter(F.col("_end") > F.col("_start")).withColumn("_first", first_block).withColumn("_last", last_block)
    blocks = spans.filter("_first <= _last").select(
        "_start", "_end", F.explode(F.sequence("_first", "_last")).alias("_block"))
    cond = (
        (indexed["_block"] == blocks["_block"])
        & (indexed[index_name] >= blocks["_start"]) & (indexed[index_name] < blocks["_end"])
    )
    return indexed.join(blocks, cond, "inner").drop("_start", "_end", "_block")


def random_ranges(spark: SparkSession, num_ranges: int, lower: int, upper: int,
                  max_length: int, seed: int = 42) -> DataFrame:
    """``num_ranges`` ranges: start uniform in [lower, upper - max_length], length
    uniform in [1, max_length], end clamped to ``upper``. Seeded, distributed."""
    span = upper - max_length - lower + 1
    if span <= 0:
        raise ValueError("upper - max_length must be >= lower")
    base = spark.range(num_ranges).select(
        (F.lit(lower) + F.floor(F.rand(seed) * span)).cast("long").alias("start"),
        (F.lit(1) + F.floor(F.rand(seed + 1) * max_length)).cast("long").alias("_len"),
    )
    return base.select("start", F.least(F.col("start") + F.col("_len"), F.lit(upper)).cast("long").alias("end"))
