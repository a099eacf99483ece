"""Reproducible shuffle: Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0..n-1 in the order of (id, size, checksum); a keyed Feistel
network permutes that range, and ``permuted % shards`` / ``permuted // shards``
give the shard and the slot. Any row's place, and the row at any place, can be
computed from (row number, n, seed) alone. Only DataFrame and SQL functions.

Defined results: a null text has size 8 and checksum 0; null ids are numbered
first; repeated rows take one place each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.common import scratch_table

ROUNDS = 6
PRIME = 2**31 - 1  # modulus of the round function; keeps products within 62 bits
_ROW_BITS = 33  # monotonically_increasing_id(): record number in the partition


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """A multiplier and an increment below PRIME for each round."""
    keys = []
    for i in range(rounds):
        d = hashlib.sha256(f"{seed}:{i}".encode()).digest()
        keys.append((1 + int.from_bytes(d[:8], "big") % (PRIME - 1), int.from_bytes(d[8:16], "big") % PRIME))
    return keys


def domain(n: int) -> tuple[int, int]:
    """Sides (a, b) of the Feistel domain: a*b >= n and a*b - n < a."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def round_value(r: int, key: tuple[int, int]) -> int:
    x = (r % PRIME * key[0] + key[1]) % PRIME
    return x * x % PRIME * x % PRIME


def permute(i: int, n: int, seed: int) -> int:
    """The permuted place of row number ``i``; the same rule as the column expression."""
    a, b = domain(n)
    while True:
        left, right = i % a, i // a
        for k, key in enumerate(round_keys(seed)):
            left, right = right, (left + round_value(right, key)) % (a if k % 2 == 0 else b)
        i = left + a * right
        if i < n:
            return i


def unpermute(p: int, n: int, seed: int) -> int:
    """The row number whose permuted place is ``p``."""
    a, b = domain(n)
    while True:
        left, right = p % a, p // a
        for k, key in reversed(list(enumerate(round_keys(seed)))):
            left, right = (right - round_value(left, key)) % (a if k % 2 == 0 else b), left
        p = left + a * right
        if p < n:
            return p


def permuted(row_number: str, n: int, seed: int) -> F.Column:
    """``permute`` as a column over a row-number column.

    The walk through values >= n visits each of the a*b - n (below sqrt n + 1)
    surplus points at most once, so that many steps always suffice; only the
    share of about 1/sqrt(n) of the rows that leave the range walks at all.
    """
    a, b = domain(n)
    keys = round_keys(seed)
    mult = "array(" + ", ".join(f"{m}L" for m, _ in keys) + ")"
    incr = "array(" + ", ".join(f"{c}L" for _, c in keys) + ")"

    def network(v: str) -> str:
        x = f"((s.r % {PRIME}L * element_at({mult}, i) + element_at({incr}, i)) % {PRIME}L)"
        mixed = f"({x} * {x} % {PRIME}L * {x} % {PRIME}L)"
        return (
            f"aggregate(sequence(1, {len(keys)}), named_struct('l', {v} % {a}L, 'r', {v} div {a}L),"
            f" (s, i) -> named_struct('l', s.r, 'r', (s.l + {mixed}) % if(i % 2 = 1, {a}L, {b}L)),"
            f" s -> s.l + {a}L * s.r)"
        )

    first = F.expr(network(f"`{row_number}`")).alias("_p")
    if a * b == n:
        return first
    walk = (
        f"aggregate(sequence(1L, {a * b - n}L), {{p}},"
        f" (v, k) -> if(v < {n}L, v, {network('v')}))"
    )
    p = network(f"`{row_number}`")
    return F.expr(f"if({p} < {n}L, {p}, {walk.format(p=p)})")


def number_rows(df: DataFrame, order_by: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """Global row numbers from 0 in the given order, and the number of rows.

    A range partitioning, a sort within each partition and one offset per
    partition; no task sees all rows. The tagged rows are written once, so a
    lost executor cannot number them anew.
    """
    tagged = scratch_table(
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)),
        "numbered",
    )
    # One row per partition, so the window and the broadcast are bounded by the
    # number of partitions.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tagged.groupBy("_pid").agg(F.count("*").alias("_n")).select(
        "_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    numbered = tagged.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_offset") + F.col("_pos"))
    return numbered.drop("_pid", "_pos", "_offset"), tagged.count()


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 20240229, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Shard and slot of every row under the law ``rows`` (shard sizes differ by one at most).

    Columns: doc_id, size (UTF-8 bytes + 8), text_crc32, law, shard, slot,
    grown_shard (null), row_number, permuted.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered, n = number_rows(rows, ["doc_id", "size", "text_crc32"])
    return numbered.withColumn("permuted", permuted("row_number", max(n, 1), seed)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("permuted") % shards).cast("int").alias("shard"),
        F.expr(f"permuted div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number", "permuted",
    )
