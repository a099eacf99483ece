"""Helpers shared by the operators: tables, scratch tables, words, bounded broadcasts."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.session import scratch_path

# ``[^\x20\x09-\x0D]+``: what bytes.split() without arguments cuts at.
WORD = r"[^\x20\x09-\x0D]+"

# A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# As LOWER, and every ASCII byte that is neither a letter nor a digit becomes a
# space, so that split() yields the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

# Largest table (bytes) that an operator hints as broadcast after measuring it.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    Column names must be unique. The files go when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def columns_of(df: DataFrame) -> list[F.Column]:
    """All columns, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small_side(df: DataFrame, row_bytes: F.Column) -> DataFrame:
    """``broadcast(df)`` when ``sum(row_bytes)`` is measured within BROADCAST_BYTES, else ``df``.

    ``df`` should be a scratch table: the measure reads it once.
    """
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column of a batch as UTF-8 bytes; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def text_slices(column: pa.Array, rows: int = 512) -> Iterable[tuple[int, list[bytes]]]:
    """(first row, texts) of consecutive slices of a string column, so that few texts are copied at a time."""
    for first in range(0, len(column), rows):
        yield first, byte_texts(column.slice(first, rows))


def bucket_of_id(id_col: str, modulus: int) -> F.Column:
    """``crc32(id as text) mod modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


def chunk_pairs(rows: DataFrame, keys: list[str], home: str, id_col: str, size: int) -> DataFrame:
    """Deals the rows of each key to comparisons of two chunks of about ``size`` rows.

    Every pair of a home row with another home row or with a guest row meets in
    exactly one comparison (``keys``, ``i``, ``j``): home chunks are numbered
    first, guest chunks after them. ``side`` is 0 for chunk i and 1 for chunk j;
    ``same`` marks a chunk's comparison with itself, where each row comes once.
    Guests are not compared with guests; keys without home rows yield nothing.
    """
    is_home = F.col(home)
    chunks = rows.groupBy(*keys).agg(
        F.ceil(F.sum(is_home.cast("int")) / size).alias("_homes"),
        F.ceil(F.sum((~is_home).cast("int")) / size).alias("_guests"),
        F.count("*").alias("_all")).filter("_homes > 0 and _all > 1").drop("_all")
    salted = rows.join(chunks, keys).withColumn(
        "_own", F.when(is_home, F.pmod(F.xxhash64(id_col), F.col("_homes")))
        .otherwise(F.col("_homes") + F.pmod(F.xxhash64(id_col), F.greatest("_guests", F.lit(1)))).cast("int"))
    last = F.when(is_home, F.col("_homes") + F.col("_guests") - 1).otherwise(F.col("_homes") - 1)
    dealt = salted.withColumn("_other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    first = is_home & (F.col("_own") <= F.col("_other"))
    return dealt.withColumn("i", F.least("_own", "_other")).withColumn("j", F.greatest("_own", "_other")).withColumn(
        "side", F.when(first, 0).otherwise(1)).withColumn("same", F.col("_own") == F.col("_other")).drop(
        "_homes", "_guests", "_own", "_other")
