"""Centroid clustering over a VA-file.

Vectors become integers, floor(scale * x). Each dimension is cut into at most 256
cells of about equal population; the VA-file holds a cell number of one byte per
dimension and the vector's squared norm. In squared distance to a centroid c,
|x|^2 + sum(c_d^2 - 2 x_d c_d), the norm is known, and a lookup table per
dimension gives the least and the greatest of the other term for each cell, for all
centroids at once. So a scan of the VA-file alone gives an interval of the distance
to each centroid. Where one interval lies below all others, the cluster is certain.

Rounds update sums instead of adding everything again: a vector changes them only
when its cluster changes. A round scans the VA-file with the centroids before and
after; rows whose cluster is certain under both and the same are done. Only the
others (intervals overlap, or the cluster changes) are fetched from the table of
full vectors, assigned exactly under both, and moved from one sum to the other.
All arithmetic is on 64-bit integers, so results do not depend on partitioning.
The first sums and the final distances, which every row needs, read all vectors.

What reaches the driver: cell borders, k centroids with their sums, one count.

Defined results: vectors that are null, of another number of components, or that
hold null or non-finite components are left out; a component of 2^17 or more in
size stops the job with an error that says so, because its distance would not fit 64 bits;
repeated rows count as vectors of their own; a null id stands for the empty text
where the start is drawn, and is kept; of equal hashes the smaller vector comes
first; fewer vectors than centroids give that many clusters; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import scratch_table, small_side

CELLS = 256  # cells of a dimension, at most
LARGEST = 1 << 17  # components must be smaller in size
BATCH_ROWS = 2048  # rows of a slice whose table lookups are held at once


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    """A column of integer lists, none null, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every centroid."""
    return (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)[None]


class Cells:
    """Borders of the cells: cell j of dimension d holds the integers from low[d][j] to high[d][j]."""

    def __init__(self, least: list[int], greatest: list[int], borders: list[list[int]]):
        self.edges = [np.unique([b for b in of if a < b <= z]).astype(np.int64)
                      for a, z, of in zip(least, greatest, borders)]
        self.low = [np.concatenate([[a], e]).astype(np.int64) for a, e in zip(least, self.edges)]
        self.high = [np.concatenate([e - 1, [z]]).astype(np.int64) for z, e in zip(greatest, self.edges)]

    def numbers(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, d], side="right") for d, e in enumerate(self.edges)], 1).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> list[np.ndarray]:
        """Per dimension: (cell, least terms of all centroids, then greatest terms)."""
        out = []
        for d, (low, high) in enumerate(zip(self.low, self.high)):
            c = centroids[:, d]
            at_low, at_high = c * c - 2 * low[:, None] * c, c * c - 2 * high[:, None] * c
            out.append(np.concatenate([np.minimum(at_low, at_high), np.maximum(at_low, at_high)], 1))
        return out


def intervals(numbers: np.ndarray, norms: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) squared distance of each row to each centroid, from its cells."""
    total = np.repeat(norms[:, None], tables[0].shape[1], 1)
    for d, table in enumerate(tables):
        total += table[numbers[:, d]]
    k = total.shape[1] // 2
    return total[:, :k], total[:, k:]


def certain_clusters(least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    """The cluster of each row whose interval lies below all others, else -1."""
    best = greatest.argmin(1)
    rows = np.arange(len(best))
    others = least.copy()
    others[rows, best] = np.iinfo(np.int64).max
    return np.where(others.min(1) > greatest[rows, best], best, -1)


def _approximate(cells: Cells, dims: int):
    """mapInArrow: (row, x) to (row, norm, cells)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column("x"), dims)
            blob = cells.numbers(x).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array((x * x).sum(1)),
                 pa.array([blob[k:k + dims] for k in range(0, len(blob), dims)], pa.binary())], names=["row", "norm", "cells"])

    return run


def _unsettled(cells: Cells, dims: int, before: np.ndarray, after: np.ndarray):
    """mapInArrow over the VA-file: rows that do not certainly keep their cluster from one round to the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old_tables, new_tables = cells.tables(before), cells.tables(after)
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(first, BATCH_ROWS)
                numbers = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, dims)
                norms = part.column("norm").to_numpy()
                old = certain_clusters(*intervals(numbers, norms, old_tables))
                new = certain_clusters(*intervals(numbers, norms, new_tables))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row").filter(pa.array((old < 0) | (new != old)))], names=["row"])

    return run


def _sum_rows(change: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """(cluster, dim, total): the sums by dimension, and the count as dimension -1."""
    table = np.concatenate([counts[:, None], change], 1)
    k, width = table.shape
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(np.arange(k), width), pa.int32()), pa.array(np.tile(np.arange(-1, width - 1), k), pa.int32()),
         pa.array(table.reshape(-1), pa.int64())], names=["cluster", "dim", "total"])


def _change(dims: int, before: np.ndarray | None, after: np.ndarray):
    """mapInArrow over full vectors: what the sums of the clusters gain and lose. Without ``before``, their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change, counts = np.zeros_like(after), np.zeros(len(after), np.int64)
        for batch in batches:
            x = _vectors(batch.column("x"), dims)
            for sign, centroids in ((1, after), (-1, before)):
                if centroids is not None and len(x):
                    of = distances(x, centroids).argmin(1)
                    np.add.at(change, of, sign * x)
                    counts += sign * np.bincount(of, minlength=len(after))
        yield _sum_rows(change, counts)

    return run


def _assign(dims: int, centroids: np.ndarray):
    """mapInArrow: (vec_id, x) to (vec_id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_of = distances(_vectors(batch.column("x"), dims), centroids)
            of = all_of.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(of.astype(np.int32)), pa.array(all_of[np.arange(len(of)), of])],
                names=["vec_id", "cluster", "distance"])

    return run


def _kept(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, x) of the vectors that take part, as a written table; ``row`` numbers are unique."""
    wide = F.col("v")
    sound = (F.size(wide) == dims) & F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(wide, lambda c: F.when(F.abs(c) < LARGEST / scale, F.floor(c * F.lit(float(scale))).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component is not below {LARGEST} / {scale} in size")).cast("int")))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return scratch_table(
        rows.filter(F.coalesce(sound, F.lit(False))).select(
            F.monotonically_increasing_id().alias("row"), "vec_id", whole.alias("x")), "vectors")


def _cells_of(kept: DataFrame) -> Cells:
    """Borders at the quantiles of every dimension, over all rows."""
    shares = [j / CELLS for j in range(1, CELLS)]
    by_dim = kept.select(F.posexplode("x").alias("d", "c")).groupBy("d").agg(
        F.min("c").alias("least"), F.max("c").alias("greatest"), F.percentile_approx("c", shares, 4 * CELLS).alias("borders"))
    rows = sorted(by_dim.collect())  # one row per dimension
    return Cells([r.least for r in rows], [r.greatest for r in rows], [r.borders for r in rows])


def _totals(found: DataFrame, k: int, dims: int) -> np.ndarray:
    """(cluster, 1 + dims) sums of ``_sum_rows``: k * (dims + 1) rows at most."""
    out = np.zeros((k, dims + 1), np.int64)
    for r in found.groupBy("cluster", "dim").agg(F.sum("total").alias("total")).collect():
        out[r.cluster, r.dim + 1] = r.total
    return out


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, start: str = "3:",
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector that takes part: vec_id (as given), cluster, distance, cluster_inertia, inertia, centroid_sha256.

    The start is the ``k`` vectors with the smallest sha256 of ``start`` and their id.
    """
    kept = _kept(vectors, dims, scale, id_col, vector_col)
    draw = F.sha2(F.concat(F.lit(start), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = np.array([r.x for r in kept.orderBy(draw, "x").limit(k).collect()], dtype=np.int64).reshape(-1, dims)
    k = len(centroids)
    id_type = kept.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, cluster int, distance long"
    if k == 0:
        return kept.sparkSession.createDataFrame(
            [], schema + ", cluster_inertia long, inertia long, centroid_sha256 string")
    cells = _cells_of(kept)
    approximate = scratch_table(
        kept.select("row", "x").mapInArrow(_approximate(cells, dims), "row long, norm long, cells binary"), "cells")

    before, sums = None, np.zeros((k, dims + 1), np.int64)
    for _ in range(rounds):
        rows = kept.select("row", "x")
        if before is not None:
            if (before == centroids).all():
                break  # no vector can change its cluster any more
            unsettled = scratch_table(
                approximate.mapInArrow(_unsettled(cells, dims, before, centroids), "row long"), "unsettled")
            rows = rows.join(small_side(unsettled, F.lit(8)), "row", "left_semi")
        sums = sums + _totals(
            rows.select("x").mapInArrow(_change(dims, before, centroids), "cluster int, dim int, total long"), k, dims)
        filled = sums[:, 0] > 0
        before, centroids = centroids, centroids.copy()
        centroids[filled] = sums[filled, 1:] // sums[filled, :1]
    return _report(kept, centroids, dims, schema)


def _report(kept: DataFrame, centroids: np.ndarray, dims: int, schema: str) -> DataFrame:
    assigned = scratch_table(kept.select("vec_id", "x").mapInArrow(_assign(dims, centroids), schema), "assigned")
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # One row per cluster.
    clusters = assigned.sparkSession.createDataFrame(
        [(c, inertia[c], sum(inertia.values()), digests[c]) for c in sorted(inertia)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
