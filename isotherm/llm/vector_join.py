"""Embedding near-duplicates: a subspace pigeonhole join.

Unit vectors u, v with cosine >= t have squared distance at most 2 - 2t. After
a fixed random rotation, the coordinates are split into blocks; in at least one
block the squared distance is within that block's share of the budget. Each
block is range-joined: a grid over its first coordinates deals vectors to cells,
a vector being copied to the lower neighbouring cells within reach, so that every pair
within the block's radius meets in exactly one cell. There the block's distance
is tested, a pair is counted only in the first block that admits it (so nothing
is counted twice and no pairs are shipped), and the cosine of the given vectors,
in double precision, decides.

A cell never goes to one task whole when it is large: its vectors are salted into
chunks of about ``CHUNK`` rows and pairs of chunks are compared. A task returns
link counts and, for each vector, one link to the smallest of its group in that
task, never the pairs; components are formed from these. Exact copies are
folded into one vector with a count first.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those with a null label, link with nothing; vectors of different
length do not link; repeated ids are folded into the row with their smallest
label and vector; a null id is left out; an empty table gives no rows; other
columns are ignored. Labels may be of any type and are compared as text; ids are
cast to long; vectors of other numbers than floats are compared as doubles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from isotherm.llm.common import chunk_pairs, scratch_table
from isotherm.llm.components import connected_components

BLOCK_DIMS = 8  # coordinates of a block
GRID_DIMS = 2  # coordinates of a block that the grid cuts
CHUNK = 1024  # vectors of one side of a comparison, about
SLACK = 1e-5  # on squared distances, for coordinates rounded to single precision


def rotation(dims: int, seed: int = 11) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed + dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int, budget: float) -> list[tuple[int, int, float]]:
    """(first, last + 1, share of the budget) of each block."""
    edges = list(range(0, dims, BLOCK_DIMS)) + [dims]
    return [(a, b, budget * (b - a) / dims) for a, b in zip(edges[:-1], edges[1:])]


def rotated(x: np.ndarray) -> np.ndarray:
    """Unit vectors in rotated coordinates, row by row in a fixed order of operations, to single precision.

    The same vector gives the same bits in every task, whatever rows surround it.
    """
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    return np.einsum("ij,jk->ik", unit, rotation(x.shape[1]), optimize=False).astype(np.float32).astype(np.float64)


def _matrix(blobs: list[bytes], kind: str) -> np.ndarray:
    """Packed vectors, row by row; doubles are scaled by a power of two, which leaves cosines as they are, so that no square overflows."""
    x = np.frombuffer(b"".join(blobs), dtype=kind).reshape(len(blobs), -1).astype(np.float64)
    return x if kind == "<f4" else np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def _cells(threshold: float, kind: str):
    """mapInArrow: (rep, label, vector) to rows (label, block, cell, home, rep, vector) for each cell a vector is in."""
    budget = 2.0 - 2.0 * threshold
    width = np.dtype(kind).itemsize

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = np.array(batch.column("vector").to_pylist(), dtype=object)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            reps = batch.column("rep").to_numpy()
            sizes = np.array([len(b) for b in blobs])
            for size in np.unique(sizes):
                of = np.flatnonzero(sizes == size)
                y = rotated(_matrix(blobs[of].tolist(), kind))
                for b, (first, last, share) in enumerate(blocks_of(size // width, budget)):
                    reach = np.sqrt(share + SLACK)
                    grid = y[:, first:min(last, first + GRID_DIMS)] / (2 * reach)
                    home = np.floor(grid).astype(np.int64)
                    low = np.floor(grid - 0.5).astype(np.int64)
                    high = np.floor(grid + 0.5).astype(np.int64)
                    steps = np.stack(np.meshgrid(*[[-1, 0, 1]] * grid.shape[1], indexing="ij"), -1).reshape(-1, grid.shape[1])
                    for step in steps:
                        if tuple(step) > (0,) * len(step):
                            continue  # pairs meet in the lower of their home cells
                        cell = home + step
                        at = np.flatnonzero(((cell >= low) & (cell <= high)).all(1))
                        if not len(at):
                            continue
                        yield pa.RecordBatch.from_arrays([
                            pa.array(labels[of[at]], pa.string()), pa.array(np.full(len(at), size // width), pa.int32()),
                            pa.array(np.full(len(at), b), pa.int32()),
                            pa.array([c.tobytes() for c in cell[at].astype("<i4")], pa.binary()),
                            pa.array(np.full(len(at), not step.any())), pa.array(reps[of[at]], pa.int64()),
                            pa.array(blobs[of[at]].tolist(), pa.binary()),
                        ], names=["label", "dims", "block", "cell", "home", "rep", "vector"])

    return deal


_CELL = ["label", "dims", "block", "cell"]
_CELL_SCHEMA = "label string, dims int, block int, cell binary, home boolean, rep long, vector binary"


def _compare(threshold: float, kind: str):
    """applyInArrow on one pair of chunks: (rep, root, links) of the vectors that link there."""
    budget = 2.0 - 2.0 * threshold

    def compare(group: pa.Table) -> pa.Table:
        left = group.filter(group.column("side").combine_chunks().to_numpy(zero_copy_only=False) == 0)
        right = group.filter(group.column("side").combine_chunks().to_numpy(zero_copy_only=False) == 1)
        same = bool(group.column("same")[0].as_py())
        empty = pa.table({"rep": pa.array([], pa.int64()), "root": pa.array([], pa.int64()),
                          "links": pa.array([], pa.int64())})
        if len(left) == 0 or (len(right) == 0 and not same):
            return empty
        block = group.column("block")[0].as_py()
        ids_a = left.column("rep").to_numpy()
        x_a = _matrix(left.column("vector").to_pylist(), kind)
        ids_b, x_b = (ids_a, x_a) if same else (
            right.column("rep").to_numpy(), _matrix(right.column("vector").to_pylist(), kind))
        y_a, y_b = rotated(x_a), rotated(x_b) if not same else None
        y_b = y_a if same else y_b
        weight_a = left.column("n").to_numpy()
        weight_b = weight_a if same else right.column("n").to_numpy()
        parts = blocks_of(x_a.shape[1], budget)
        first, last, share = parts[block]
        p, q = y_a[:, first:last], y_b[:, first:last]
        near = (p * p).sum(1)[:, None] + (q * q).sum(1)[None] - 2.0 * (p @ q.T) <= share + 2 * SLACK
        if same:
            near &= np.triu(np.ones(near.shape, dtype=bool), 1)
        ia, ib = np.nonzero(near)
        linked = np.zeros(len(ia), dtype=bool)
        norm_a, norm_b = np.sqrt((x_a * x_a).sum(1)), np.sqrt((x_b * x_b).sum(1))
        for s in range(0, len(ia), 65536):
            i, j = ia[s:s + 65536], ib[s:s + 65536]
            squares = (y_a[i] - y_b[j]) ** 2
            within = [squares[:, f:t].sum(1) <= w + SLACK for f, t, w in parts[:block + 1]]
            mine = within[block]
            for w in within[:block]:
                mine = mine & ~w
            cosine = (x_a[i] * x_b[j]).sum(1) / (norm_a[i] * norm_b[j])
            linked[s:s + 65536] = mine & (cosine >= threshold)
        ia, ib = ia[linked], ib[linked]
        ids = np.concatenate([ids_a, ids_b])
        total = np.zeros(len(ids), dtype=np.int64)
        np.add.at(total, ia, weight_b[ib])
        np.add.at(total, len(ids_a) + ib, weight_a[ia])
        if same:
            total[:len(ids_a)] += total[len(ids_a):]
            total[len(ids_a):] = 0
        # The smallest id of each vector's group in this comparison.
        root = ids.copy()
        ja, jb = ia, ib if same else len(ids_a) + ib
        while len(ja):
            low = np.minimum(root[ja], root[jb])
            old = root.copy()
            np.minimum.at(root, ja, low)
            np.minimum.at(root, jb, low)
            if (old == root).all():
                break
        keep = total > 0
        return pa.table({"rep": pa.array(ids[keep]), "root": pa.array(root[keep]), "links": pa.array(total[keep])})

    return compare


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links (vectors with cosine >= threshold and the same label), component_id."""
    element = vectors.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, FloatType) else "<f8"
    raw = vectors.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))
    sound = F.exists("v", lambda c: c != 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = scratch_table(
        raw.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("_r")).select("vec_id", "_r.label", "_r.v")
        .withColumn("fit", F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & sound, F.lit(False))), "vectors")
    # Exact copies: the smallest id stands for all.
    folded = scratch_table(
        rows.filter("fit").groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "folded")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.array(v, dtype=kind).tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("label"), pa.array(blobs, pa.binary())], names=["rep", "label", "vector"])

    packed = folded.select("rep", "label", "v").mapInArrow(pack, "rep long, label string, vector binary")
    dealt = scratch_table(packed.mapInArrow(_cells(threshold, kind), _CELL_SCHEMA).join(
        folded.select("rep", "n"), "rep"), "cells")
    found = scratch_table(
        chunk_pairs(dealt, _CELL, "home", "rep", CHUNK).groupBy(*_CELL, "i", "j").applyInArrow(
            _compare(threshold, kind), "rep long, root long, links long"), "links")
    return _report(rows, folded, found)


def _report(rows: DataFrame, folded: DataFrame, found: DataFrame) -> DataFrame:
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    reps = folded.join(links, "rep", "left").join(
        component.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        F.col("label").alias("_label"), F.col("v").alias("_v"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    joined = rows.join(reps, F.col("fit") & (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v")), "left")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         F.coalesce("component_id", "vec_id").alias("component_id"))
