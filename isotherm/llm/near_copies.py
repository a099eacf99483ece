"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of five-word shingles. A shingle's weight is
(1 + ln tf) times its idf, the mean of its words' ln(1 + N/df); the document
frequencies are counted over all documents, in hash buckets of words, so that
their table has a fixed size. Improved consistent weighted sampling draws
``BANDS * ROWS`` samples per document, equal between two documents with the
chance of their weighted Jaccard similarity. Samples are banded; documents that
share a band are candidates, and the weighted Jaccard similarity of the whole
texts decides.

Exact copies are folded first. Candidates are then verified in two rounds, which
emit neither all pairs of a bucket nor gather one in a task: each member with a
few leading members; then, in buckets that still hold several components, the
members outside the largest one with all others, in chunks, for pairs of
different components whose samples agree well enough. Classes are the connected components.

Defined results: null and empty texts are equal texts without shingles; texts of
fewer than five words are one shingle; a null id has a null class and takes no
part; rows that repeat an id are one node, that of the text with the smallest
digest; an empty table gives no rows; other columns are ignored, or kept by ``one_of_each_class``.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import ALNUM, byte_texts, chunk_pairs, scratch_table, small_side, unused_name
from isotherm.llm.components import connected_components

SHINGLE = 5
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
THRESHOLD = 0.8
# At similarity 0.8, 38.4 of the 48 samples agree on average, with a deviation of 2.8; fewer than
# AGREE agree with a chance of 4.8e-5 (binomial).
AGREE = 27
LEADERS = 5  # members of a bucket beyond CHUNK that all others are verified with first; of smaller ones one
WORD_BUCKETS = 1 << 17  # document frequencies are kept in that many hash buckets of words
CHUNK = 512  # documents of one side of a comparison, about

_FINE = 12  # bits of a hash that pick r and beta; 16 bits pick c


def _gamma_2_1(uniform: np.ndarray) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, by Newton steps on 1 - (1 + x) exp(-x)."""
    x = np.sqrt(2.0 * uniform) + uniform
    for _ in range(60):
        x = np.maximum(1e-9, x - (1.0 - (1.0 + x) * np.exp(-x) - uniform) / np.maximum(x * np.exp(-x), 1e-300) * 0.9)
    return x


_MID = (np.arange(1 << _FINE) + 0.5) / (1 << _FINE)
_R = _gamma_2_1(_MID).astype(np.float32)
_BETA = _MID.astype(np.float32)
_LN_C = np.log(_gamma_2_1((np.arange(1 << 16) + 0.5) / (1 << 16))).astype(np.float32)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(32))) * _MIX
    z = (z ^ (z >> np.uint64(32))) * _MIX
    return z ^ (z >> np.uint64(32))


_KEYS = _mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _MUL)


def word_hashes(text: bytes) -> np.ndarray:
    words = text.translate(ALNUM).split()
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))


@dataclass
class ShingleWeights:
    """The idf of every word bucket."""

    idf: np.ndarray

    def shingles(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes in ascending order, and their weights."""
        words = word_hashes(text)
        n = len(words)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(0, np.float32)
        k = min(SHINGLE, n)
        total = np.concatenate([[0.0], np.cumsum(self.idf[(words & np.uint64(WORD_BUCKETS - 1)).astype(np.intp)])])
        hashed = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            hashed = hashed * _MUL + words[j:n - k + 1 + j] + np.uint64(1)
        distinct, at, tf = np.unique(_mixed(hashed), return_index=True, return_counts=True)
        return distinct, ((1.0 + np.log(tf)) * (total[at + k] - total[at]) / k).astype(np.float32)

    def similarity(self, a: bytes, b: bytes) -> float:
        """Weighted Jaccard similarity of two texts; of two without shingles 0."""
        return similarity(*self.shingles(a), *self.shingles(b))


def similarity(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two weighted sets with ascending hashes; with an empty one 0."""
    if not len(ha) or not len(hb):
        return 0.0
    at = np.searchsorted(ha, hb)
    both = ha[np.minimum(at, len(ha) - 1)] == hb
    common = float(np.minimum(wa[at[both]], wb[both]).sum(dtype=float))
    return common / (float(wa.sum(dtype=float)) + float(wb.sum(dtype=float)) - common)


def weighted_samples(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """SAMPLES consistent weighted samples of a weighted set, as 64-bit values."""
    ln_w = np.log(weights)
    best = np.full(SAMPLES, np.inf, dtype=np.float32)
    out = np.zeros(SAMPLES, dtype=np.uint64)
    columns = np.arange(SAMPLES)
    for s in range(0, len(hashes), 4096):
        h = hashes[s:s + 4096]
        z = h[:, None] ^ _KEYS
        z *= _MIX
        z ^= z >> np.uint64(29)
        z *= _MUL
        r = _R[(z >> np.uint64(52)).view(np.int64)]
        beta = _BETA[((z >> np.uint64(40)) & np.uint64(0xFFF)).view(np.int64)]
        ln_c = _LN_C[((z >> np.uint64(24)) & np.uint64(0xFFFF)).view(np.int64)]
        t = np.floor(ln_w[s:s + 4096, None] / r + beta)
        ln_a = ln_c - r * (t - beta + 1)
        at = ln_a.argmin(0)
        low = ln_a[at, columns]
        better = low < best
        best[better] = low[better]
        drawn = _mixed(h[at] + t[at, columns].astype(np.int64).view(np.uint64) * _MUL)
        out[better] = drawn[better]
    return out


def learn_weights(docs: DataFrame, text_col: str = "text") -> ShingleWeights:
    """idf by word bucket over all documents; the table has WORD_BUCKETS entries at any size of the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(WORD_BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for text in byte_texts(batch.column(0)):
                df[np.unique(word_hashes(text) & np.uint64(WORD_BUCKETS - 1)).astype(np.intp)] += 1
                df[-1] += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], names=["bucket", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()
    df = np.zeros(WORD_BUCKETS + 1, dtype=np.float64)
    df[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    return ShingleWeights(np.log1p(max(1.0, df[-1]) / np.maximum(df[:-1], 1.0)).astype(np.float32))


def sign(docs: DataFrame, shared, id_col: str, text_col: str) -> DataFrame:
    """(node, copy, bands, samples) per row: the text's digest, band hashes and 16 bits of each sample."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: ShingleWeights = pickle.loads(shared.value)
        powers = _MUL ** np.arange(ROWS, dtype=np.uint64)
        for batch in batches:
            bands, samples = [], []
            for text in byte_texts(batch.column("text")):
                hashes, w = weights.shingles(text)
                if not len(hashes):
                    bands.append([])
                    samples.append(b"")
                    continue
                drawn = weighted_samples(hashes, w)
                bands.append(_mixed((drawn.reshape(BANDS, ROWS) * powers).sum(1, dtype=np.uint64)).view(np.int64).tolist())
                samples.append(drawn.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copy"), pa.array(bands, pa.list_(pa.int64())), pa.array(samples)],
                names=["node", "copy", "bands", "samples"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("node"), F.unhex(F.md5(text.cast("binary"))).alias("copy"), text.alias("text"))
    return rows.mapInArrow(draw, "node long, copy binary, bands array<long>, samples binary")


def verified(pairs: DataFrame, texts: DataFrame, shared, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts have a weighted Jaccard similarity of ``threshold`` or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: ShingleWeights = pickle.loads(shared.value)
        for batch in batches:
            a, b = byte_texts(batch.column("text_a")), byte_texts(batch.column("text_b"))
            kept = [weights.similarity(x, y) >= threshold for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    named = lambda n: texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}"))
    return pairs.join(named("a"), "a").join(named("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(
        check, "a long, b long")


def _linked(shared, threshold: float):
    """applyInArrow on one comparison of chunks: a spanning set of the links (a, b) found there.

    Pairs of different components whose samples agree are verified on their
    whole texts, in the first band that the two share; a pair that is already
    joined within the comparison is not needed.
    """

    def link(group: pa.Table) -> pa.Table:
        weights: ShingleWeights = pickle.loads(shared.value)
        side = group.column("side").combine_chunks().to_numpy(zero_copy_only=False)
        node, component = group.column("node").to_numpy(), group.column("component").to_numpy()
        samples = np.frombuffer(b"".join(group.column("samples").to_pylist()), dtype="<u2").reshape(-1, SAMPLES)
        bands = np.array(group.column("bands").to_pylist(), dtype=np.int64)
        band, same = group.column("band")[0].as_py(), bool(group.column("same")[0].as_py())
        texts = group.column("text")
        sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def shingles(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in sets:
                sets[i] = weights.shingles(texts[i].as_py().encode())
            return sets[i]

        root = {c: c for c in np.unique(component).tolist()}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        out: list[tuple[int, int]] = []
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        for i in left:
            near = (samples[right] == samples[i]).sum(1) >= AGREE
            near &= component[right] != component[i]
            if same:
                near &= node[right] > node[i]
            near[near] = ~(bands[right[near], :band] == bands[i, :band]).any(1)
            for j in right[near]:
                x, y = top(int(component[i])), top(int(component[j]))
                if x != y and similarity(*shingles(int(i)), *shingles(int(j))) >= threshold:
                    root[x] = y
                    out.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return link


def near_copies(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row with an id: doc_id, class_id (the smallest id of its class), copy (digest of the id's text)."""
    weights = learn_weights(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(weights))
    signed = scratch_table(sign(docs, shared, id_col, text_col), "signed")
    # One node per id, and of exact copies one: the smallest id.
    members = signed.groupBy("node").agg(F.min("copy").alias("copy"))
    folded = scratch_table(
        signed.join(members, ["node", "copy"], "left_semi").groupBy("copy").agg(
            F.min(F.struct("node", "bands", "samples")).alias("_r")).select("copy", "_r.*"), "folded")
    bands = scratch_table(
        folded.select("node", F.posexplode("bands").alias("band", "key")), "bands")
    more = F.array(*[F.min_by("node", F.xxhash64("node", F.lit(k))) for k in range(1, LEADERS)])
    leaders = bands.groupBy("band", "key").agg(F.min("node").alias("first"), more.alias("more"), F.count("*").alias("n")).filter(
        "n > 1").select("band", "key", F.when(F.col("n") > CHUNK, F.concat(F.array("first"), "more")).otherwise(
            F.array("first")).alias("leaders"))
    shared_bands = scratch_table(bands.join(leaders, ["band", "key"]), "buckets")

    led = shared_bands.select("node", F.explode(F.array_distinct("leaders")).alias("leader")).filter("node <> leader")
    pairs = scratch_table(led.select(
        F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b")).distinct(), "pairs")
    texts = scratch_table(_texts_of(shared_bands.select("node").distinct(), docs, folded, id_col, text_col), "texts")
    first = scratch_table(verified(pairs, texts, shared, threshold), "first")
    component = connected_components(first)

    known = shared_bands.select("band", "key", "node").join(component, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    # The component with most members of each bucket; the others are compared with all.
    main = known.groupBy("band", "key", "component").count().groupBy("band", "key").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("n")).filter("n > 1")
    placed = scratch_table(
        known.join(main.drop("n"), ["band", "key"]).withColumn("home", F.col("component") != F.col("main"))
        .select("band", "key", "node", "component", "home"), "placed")
    # Texts, samples and bands travel only with members of buckets that are not one component yet.
    described = placed.join(folded.select("node", "samples", "bands"), "node").join(texts, "node")
    second = chunk_pairs(described, ["band", "key"], "home", "node", CHUNK).groupBy("band", "key", "i", "j").applyInArrow(
        _linked(shared, threshold), "a long, b long")
    links = first.union(scratch_table(second, "second"))
    classes = connected_components(links)

    by_copy = folded.join(classes, "node", "left").select(
        "copy", F.coalesce("component", "node").alias("class_id"))
    return signed.select("node").join(members, "node").join(by_copy, "copy").select(
        F.col("node").alias("doc_id"), "class_id", "copy")


def _texts_of(nodes: DataFrame, docs: DataFrame, folded: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of the given nodes, once each."""
    wanted = scratch_table(nodes.join(folded.select("node", "copy"), "node"), "wanted")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("node"), text.alias("text"))
    found = rows.join(small_side(wanted, F.lit(40)), "node").filter(
        F.unhex(F.md5(F.col("text").cast("binary"))) == F.col("copy"))
    return found.groupBy("node").agg(F.min("text").alias("text")) if _repeats(wanted, found) else found.select("node", "text")


def _repeats(wanted: DataFrame, found: DataFrame) -> bool:
    """Whether some node was found more than once (rows repeat an id and its text)."""
    return found.select("node").count() > wanted.count()


def one_of_each_class(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class, and those without an id; their columns as they are.

    Of rows that repeat an id, one with the id's smallest text digest stays.
    """
    classes = scratch_table(near_copies(docs, threshold, id_col, text_col), "classes")
    name = unused_name(docs, "dropped")
    dropped = scratch_table(classes.filter("doc_id <> class_id").select(F.col("doc_id").alias(name)).distinct(), "dropped")
    kept = docs.join(small_side(dropped, F.lit(16)), F.col(id_col).cast("long") == F.col(name), "left_anti")
    if classes.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return kept
    copy = unused_name(docs, "copy")
    chosen = classes.select(F.col("doc_id").alias(name), F.col("copy").alias(copy)).distinct()
    digest = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    once = kept.join(chosen, (F.col(id_col).cast("long") == F.col(name)) & (digest == F.col(copy)), "left_semi")
    return once.dropDuplicates([id_col]).unionByName(kept.filter(F.col(id_col).isNull()))
