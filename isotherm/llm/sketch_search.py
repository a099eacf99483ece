"""Ranked lexical search by hashed max-sketches.

The index is one row per document: its distinct terms with their counts, and a
sketch. A sketch has about four to eight cells per distinct term (a power of two);
every term is hashed to two cells, and a cell keeps the maximum over its terms. A
term's impact grows with its count tf and depends otherwise on the document alone,

    impact = 10^9 tf div (1000 tf + 8 m),  m = 100 - 90 + (90 n N div L),

so the coordinatewise maximum of impacts is the impact of the coordinatewise
maximum of counts: cells hold counts (one byte, 255 for 255 or more), which stay
valid when documents are added, and become impacts when N and L are known.

A batch of queries looks up the cells of all its terms in all sketches of a slice at
once. The smaller of a term's two cells bounds its impact, and the weighted sum
bounds the document's score. Documents are rescored exactly, from their terms, in
descending order of the bound, and only while the bound reaches the query's
threshold: its k-th best exact score so far in this task, and at least the k-th best
score within a share of the index that is searched first. No document is left out
that could be among the k best. Each task returns its best k per query, and one
window per query merges them.

Queries are read in blocks of about ``BLOCK_BYTES`` of terms (the stated query set);
each block is one pass over the index and its results are written before the next.

Defined results: a null text has no terms; documents without terms are not counted
in N and never returned; a query without terms, or whose terms no document holds, has
no rows; each query row is ranked by itself, also where item ids repeat or are null;
repeated documents are ranked each; among equal scores a null doc_id comes last; ids
are read as long; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isotherm.llm.common import ALNUM, scratch_table, text_slices
from isotherm.session import scratch_path

FULL = 255  # the count of a cell that stands for this many or more
SCALE = 10**9
TOP = 10**6  # no impact reaches it
SLOPE = 90  # of 100: how far the length of a document counts
# Terms of the queries searched in one pass over the index, in bytes, about.
BLOCK_BYTES = 4 << 20
# Table lookups (documents x terms of queries) held at a time.
LOOKUPS = 2_000_000
# Documents whose sketches a task holds at a time.
SLICE_ROWS = 2048
# One in so many documents is searched first, for a threshold to start from.
FIRST_SHARE = 32

INDEX_SCHEMA = "doc_id long, n long, terms binary, counts array<int>, sketch binary"
_INDEX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.list_(pa.int32())),
                    ("sketch", pa.binary())])


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text in turn."""
    return text.translate(ALNUM).split()


def hashes(terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each term; a sketch of 2^b cells uses their last b bits."""
    first = np.fromiter(map(crc32, terms), np.uint64, len(terms))
    second = first * np.uint64(0x9E3779B97F4A7C15)  # 64-bit product; its upper half depends on all bits
    return first.astype(np.int64), (second >> np.uint64(32)).astype(np.int64)


def sketch_of(terms: list[bytes], counts: np.ndarray) -> bytes:
    """Coordinatewise maxima of the terms' counts."""
    cells = np.zeros(4 << max(len(terms) - 1, 0).bit_length(), np.uint8)
    held = np.minimum(counts, FULL).astype(np.uint8)
    for at in hashes(terms):
        np.maximum.at(cells, at & (len(cells) - 1), held)
    return cells.tobytes()


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for first, texts in text_slices(batch.column("text")):
            n, blobs, counts, sketches = [], [], [], []
            for text in texts:
                of = Counter(terms_of(text))
                terms, held = list(of), np.fromiter(of.values(), np.int32, len(of))
                n.append(int(held.sum()))
                blobs.append(b" ".join(terms))
                counts.append(held)
                sketches.append(sketch_of(terms, held))
            bounds = np.concatenate([[0], np.cumsum([len(c) for c in counts])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                ids.slice(first, len(texts)), pa.array(n, pa.int64()), pa.array(blobs, pa.binary()),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(counts), pa.int32())),
                pa.array(sketches, pa.binary())], schema=_INDEX)


def index_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents, written to the shared folder."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return scratch_table(rows.mapInArrow(_index_rows, INDEX_SCHEMA), "lexical-index")


class Queries:
    """A block of queries: distinct terms, and for each query where its terms are among them."""

    def __init__(self, queries: list[tuple[int | None, list[bytes]]]):
        self.ids = [i for i, _ in queries]
        number: dict[bytes, int] = {}
        for _, terms in queries:
            for t in terms:
                number.setdefault(t, len(number))
        self.number = number
        self.of = [np.array([number[t] for t in terms]) for _, terms in queries]
        self.flat = np.concatenate(self.of)
        self.starts = np.concatenate([[0], np.cumsum([len(o) for o in self.of])])[:-1]
        self.places = hashes(list(number))
        self.weights = np.zeros(len(number), np.int64)

    def weigh(self, documents: int, frequency: dict[int, int]) -> None:
        for t in range(len(self.weights)):
            self.weights[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(t, 0) + 1)))


def query_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    """The queries with terms, in blocks."""
    block, held = [], 0
    for row in items.select(F.col(id_col).cast("long"), F.encode(text_col, "UTF-8")).toLocalIterator():
        terms = list(dict.fromkeys(terms_of(bytes(row[1] or b""))))
        if terms:
            block.append((row[0], terms))
            held += sum(map(len, terms)) + 40 * len(terms)
        if held > BLOCK_BYTES:
            yield Queries(block)
            block, held = [], 0
    if block:
        yield Queries(block)


def _frequencies(queries: Queries):
    """mapInArrow: how many documents of the task hold each of the queries' terms."""
    number = queries.number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(number), np.int64)
        for batch in batches:
            for blob in batch.column("terms"):
                held = [number[t] for t in blob.as_py().split() if t in number]
                found[held] += 1
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(found[seen])], names=["term", "df"])

    return run


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Impacts of counts in documents of length norm m, rounded down."""
    return SCALE * tf // (1000 * tf + 8 * m)


class _Best:
    """The best k (score, doc_id) of each query, and the score a document must reach."""

    def __init__(self, thresholds: np.ndarray, k: int):
        self.thresholds, self.k = thresholds.copy(), k
        self.held: list[list[tuple[int, bool, int]]] = [[] for _ in thresholds]

    def add(self, q: int, score: int, doc_id: int | None) -> None:
        if score < self.thresholds[q]:
            return
        held = self.held[q]
        held.append((-score, doc_id is None, doc_id or 0))
        if len(held) >= self.k:
            held.sort()
            del held[self.k:]
            self.thresholds[q] = max(self.thresholds[q], -held[-1][0])

    def rows(self) -> pa.RecordBatch:
        flat = [(q, -s, None if null else i) for q, held in enumerate(self.held) for s, null, i in held]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in flat], pa.int32()), pa.array([r[2] for r in flat], pa.int64()),
             pa.array([r[1] for r in flat], pa.int64())], names=["query", "doc_id", "score"])


def upper_bounds(queries: Queries, sketches: list[bytes], m: np.ndarray) -> np.ndarray:
    """(documents, queries): bounds of the scores, from sketches of one size."""
    cells = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    last = cells.shape[1] - 1
    first, second = queries.places
    tf = np.minimum(cells[:, first & last], cells[:, second & last])
    by_count = impacts(np.arange(FULL + 1)[None], m[:, None])
    by_count[:, FULL] = TOP
    weighted = np.take_along_axis(by_count, tf.astype(np.int64), 1) * queries.weights
    return np.add.reduceat(weighted[:, queries.flat], queries.starts, 1)


def _search(queries: Queries, thresholds: np.ndarray, k: int, documents: int, words: int):
    """mapInArrow over the index: (query, doc_id, score) of the task's best."""
    number, weights = queries.number, queries.weights
    rows = max(1, LOOKUPS // len(queries.flat))
    of_query = [set(o.tolist()) for o in queries.of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(thresholds, k)
        for batch in (b.slice(first, SLICE_ROWS) for b in batches for first in range(0, b.num_rows, SLICE_ROWS)):
            sketches = batch.column("sketch").to_pylist()
            sizes = np.fromiter(map(len, sketches), np.int64, len(sketches))
            m_all = 100 - SLOPE + SLOPE * batch.column("n").to_numpy() * documents // words
            ids, terms, counts = batch.column("doc_id"), batch.column("terms"), batch.column("counts")
            for size in np.unique(sizes):
                of_size = np.flatnonzero(sizes == size)
                for first in range(0, len(of_size), rows):
                    at = of_size[first:first + rows]
                    bounds = upper_bounds(queries, [sketches[i] for i in at], m_all[at])
                    held: dict[int, dict[int, int]] = {}
                    for q in np.flatnonzero((bounds >= np.maximum(best.thresholds, 1)).any(0)):
                        column = bounds[:, q]
                        near = np.flatnonzero(column >= max(best.thresholds[q], 1))
                        for d in near[np.argsort(-column[near], kind="stable")]:
                            if column[d] < best.thresholds[q]:
                                break
                            if d not in held:
                                held[d] = _impacts_of(terms[at[d]].as_py(), counts[at[d]].values, int(m_all[at[d]]), number)
                            here = held[d]
                            score = sum(int(weights[t]) * here[t] for t in here.keys() & of_query[q])
                            if score > 0:
                                best.add(q, score, ids[at[d]].as_py())
        yield best.rows()

    return run


def _impacts_of(terms: bytes, counts: pa.Array, m: int, number: dict[bytes, int]) -> dict[int, int]:
    """The exact impact of each of the queries' terms that a document holds."""
    found = {number[t]: counts[j].as_py() for j, t in enumerate(terms.split()) if t in number}
    return {t: SCALE * tf // (1000 * tf + 8 * m) for t, tf in found.items()}


def _thresholds(found: DataFrame, queries: int, k: int) -> np.ndarray:
    """The k-th best score of each query in ``found``, 0 where there are fewer: one row per query."""
    out = np.zeros(queries, np.int64)
    kth = _ranked(found, k).filter(F.col("rank") == k).select("query", "score")
    for r in kth.collect():
        out[r.query] = r.score
    return out


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each query row."""
    spark = index.sparkSession
    size = index.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("words")).first()
    schema = "item_id long, rank int, doc_id long, score long"
    path = scratch_path(spark, "ranked")
    spark.createDataFrame([], schema).write.parquet(path)
    if not size.documents:
        return spark.read.schema(schema).parquet(path)
    for queries in query_blocks(items, id_col, text_col):
        _search_block(spark, index, queries, k, size.documents, size.words).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _search_block(spark: SparkSession, index: DataFrame, queries: Queries, k: int, documents: int, words: int) -> DataFrame:
    counted = index.select("terms").mapInArrow(_frequencies(queries), "term int, df long")
    queries.weigh(documents, {r.term: r.df for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()})
    rows = index.select("doc_id", "n", "terms", "counts", "sketch")
    found = "query int, doc_id long, score long"
    none = np.zeros(len(queries.of), np.int64)
    share = rows.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(FIRST_SHARE)) == 0)
    start = _thresholds(share.mapInArrow(_search(queries, none, k, documents, words), found), len(none), k)
    best = _ranked(rows.mapInArrow(_search(queries, start, k, documents, words), found), k)
    # The block's queries: their number is bounded by BLOCK_BYTES.
    ids = spark.createDataFrame(list(enumerate(queries.ids)), "query int, item_id long")
    return best.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score")
