"""Mixing sources to target weights by hash-threshold histograms.

Each source has a budget of words. Every row has a fixed 60-bit hash; a source
takes, besides whole passes, the rows whose hash lies below a threshold. The
threshold is found without sorting: words are summed per (source, hash bucket),
the bucket in which the running sum passes the budget is opened into finer
buckets, and so on, until the boundary is a single hash value. Rows are then
filtered by comparing their hash with the threshold.

Defined results: a null text has size 0; null is a source of its own, last in
order; rows equal in id and text share a hash and are taken or left
together; an empty table gives no rows; a source without words has target 0; other columns
are ignored, or kept by ``mix_rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.common import WORD, columns_of, scratch_table, small_side, unused_name

HASH_BITS, LEVEL_BITS = 60, 10


def word_count(text_col: str) -> F.Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(id_col: str, text_col: str) -> F.Column:
    """A 60-bit hash of the id and the text: the same in every run, independent between copies."""
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("#"), text)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   max_passes: int = 2) -> DataFrame:
    """Target words per source: (source, source_size, weight, target).

    Sources in code-point order, null last, weigh ``weights`` in turn. ``share``
    times all words are split by weight; no target exceeds ``max_passes`` times
    its source, and the excess is split among the others by weight until none
    is above. The sources are ordered by (cap / weight): those up to some place
    are capped, the rest share what is left. One row per source throughout.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                   (place % len(weights) + 1).cast("int")).cast("long"))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = (F.lit(float(share)) * F.sum("source_size").over(everything)
            - max_passes * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    walked = listed.select(
        "source", "source_size", "weight", left.alias("_left"), F.sum("weight").over(after).alias("_weights"))
    # The first source in cap order that its part does not fill sets the level for all after it.
    fits = F.col("weight") * F.col("_left") / F.col("_weights") <= max_passes * F.col("source_size")
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    marked = walked.withColumn("_open", F.max(fits.cast("int")).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    first = Window.partitionBy("_open").orderBy(F.col("source_size") / F.col("weight"),
                                                F.col("source").asc_nulls_last())
    level = lambda c: F.first(c).over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("_open") == 1, F.col("weight") * level("_left") / level("_weights")).otherwise(
        (max_passes * F.col("source_size")).cast("double"))
    return marked.select("source", "source_size", "weight", target.alias("target"))


def budget_thresholds(measured: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole passes, and the hash up to which (inclusive) rows are taken once more.

    ``measured``: (source, size, hash). The row at the boundary is taken if that
    brings the sum nearer to the budget. Returns (source, source_size, target,
    passes, threshold); threshold -1: none.
    """
    targets = scratch_table(targets, "targets")
    state = targets.filter("source_size > 0").select(
        "source", "source_size", "target", F.floor(F.col("target") / F.col("source_size")).alias("passes"),
        F.lit(0).cast("double").alias("below"), F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("words"))
    for low in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        state = _open_boundary(measured, state, low)
    budget = F.col("target") - F.col("passes") * F.col("source_size")
    nearer = F.col("below") + F.col("words") - budget < budget - F.col("below")
    found = state.select("source", "source_size", "target", "passes",
                         F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("threshold"))
    none = targets.filter("source_size = 0").select(
        "source", "source_size", "target", F.lit(0).cast("long").alias("passes"), F.lit(-1).cast("long").alias("threshold"))
    return scratch_table(found.unionByName(none), "thresholds")


def _open_boundary(measured: DataFrame, state: DataFrame, low: int) -> DataFrame:
    """The boundary bucket of every source at the next finer level, from the rows of the last one."""
    known = ["source_size", "target", "passes", "below", "prefix"]
    small = small_side(state.select(F.col("source").alias("_source"), *known), source_bytes("_source"))
    inside = measured.join(small, F.col("source").eqNullSafe(F.col("_source"))
                           & (F.shiftright("hash", low + LEVEL_BITS) == F.col("prefix")))
    histogram = inside.groupBy("source", *known[:-1], F.shiftright("hash", low).alias("bucket")).agg(
        F.sum("size").alias("words"))
    # At most 2^LEVEL_BITS rows per source.
    run = Window.partitionBy("source").orderBy("bucket")
    upto = F.col("below") + F.sum("words").over(run)
    passed = upto > F.col("target") - F.col("passes") * F.col("source_size")
    # The first bucket whose running sum passes the budget, or the last of all.
    summed = histogram.select("*", upto.alias("upto"), passed.alias("passed"), F.lead("bucket").over(run).alias("later"))
    return scratch_table(
        summed.filter("passed or later is null").withColumn("_k", F.row_number().over(run)).filter("_k = 1").select(
            "source", "source_size", "target", "passes", (F.col("upto") - F.col("words")).alias("below"),
            F.col("bucket").alias("prefix"), F.col("words").cast("long").alias("words")),
        f"boundary{low}")


def source_bytes(col: str) -> F.Column:
    """A bound on the bytes of one row of a table of sources."""
    return F.octet_length(F.coalesce(F.col(col), F.lit(""))) + 96


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What the mix needs of every row: (id, source, size, hash), written once."""
    return scratch_table(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        word_count(text_col).alias("size"), row_hash(id_col, text_col).alias("hash")), "measured")


def mix_report(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_passes: int = 2,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row with what the mix takes of it: doc_id, size, source_size, target, taken, copies."""
    measured = measure(docs, id_col, text_col, source_col)
    limits = budget_thresholds(measured, source_targets(measured, weights, share, max_passes))
    small = small_side(limits.withColumnRenamed("source", "_source"), source_bytes("_source"))
    copies = F.col("passes") + (F.col("hash") <= F.col("threshold")).cast("long")
    return measured.join(small, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def mix_rows(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_passes: int = 2,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as it is taken (0 times: left out)."""
    measured = measure(docs, id_col, text_col, source_col)
    limits = budget_thresholds(measured, source_targets(measured, weights, share, max_passes))
    source, passes, threshold, copies, copy = (
        unused_name(docs, f"_mix_{n}") for n in ("source", "passes", "threshold", "copies", "copy"))
    small = small_side(limits.select(F.col("source").alias(source), F.col("passes").alias(passes),
                                     F.col("threshold").alias(threshold)), source_bytes(source))
    taken = F.col(passes) + (row_hash(id_col, text_col) <= F.col(threshold)).cast("long")
    return (
        docs.join(small, F.col(source_col).cast("string").eqNullSafe(F.col(source)))
        .withColumn(copies, taken).filter(F.col(copies) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
        .select(*columns_of(docs))
    )
