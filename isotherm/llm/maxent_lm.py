"""Language-model scores from a hashed maximum-entropy model.

A token's chance is the chance of its class given the words before it times
its chance within the class (a class-factored softmax). Both factors are
log-linear in hashed features: the last word, the last two, and the skipped
second- and third-last words. Frequent words fill the head classes; the others
fall into tail classes by their shape, in which a word's chance is its smoothed
share of the class, so every word of any text has one.

The texts are encoded once into chunks of documents (token numbers, and 64-bit
hashes of the chunk's distinct words), which are written to the shared folder.
Word counts are gathered by shards of the hashes, whose answers go back to the
chunks. The model is trained by distributed gradient updates: in each round every
task runs over its share of the training chunks from the same weights, and the
changed weights are averaged by tokens. Scores are computed chunk by chunk in
sparse numpy batches.

Tokens: words cut at ASCII white space, A-Z lower-cased, then one end token.

Defined results: null and empty texts are the end token alone; repeated rows
are scored, and counted, each by itself; with nothing to learn from, all
words are unknown and the base score is 0; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.llm.common import LOWER, scratch_table, text_slices

CHUNK_TOKENS = 600_000  # tokens of a chunk; a longer document is a chunk of its own
HEAD_CLASSES, CLASS_WORDS, TAIL_CLASSES = 24, 32, 8
CLASSES = HEAD_CLASSES + TAIL_CLASSES
HEAD_SHARE = 1 / 20_000  # words with this share of the tokens may become head words: 20,000 at most
BUCKETS_1, BUCKETS_2 = 1 << 14, 1 << 14  # hashed features of the class and of the word factor; at most 2^16
FEATURES = 4
ROUNDS = 3
RATE = 0.12
BATCH = 4096  # tokens of a gradient step
CACHE_WORDS = 400_000  # words whose hash a worker remembers; it starts afresh beyond that
SPAN = 16 * BATCH  # tokens whose features are held at a time
SLICE = 1 << 15  # weights that travel in one row
END = np.uint64(8)  # the end token's hash; its low bits are tail class 0

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_START = np.uint64(0x51ED270B7A1D2F4B)  # stands for the words before a text

# Letters (in UTF-8) that mark the tail classes 4, 5 and 6.
_LETTERS = ((4, "äöüßÄÖÜ"), (5, "ñóíáúÑÓÍÁÚ"), (6, "éèêçàùâîôÉÈÊÇÀ"))
_SHAPE_OF = {c.encode(): k for k, letters in _LETTERS for c in letters}


def tail_class(word: bytes) -> int:
    """The shape of a word, 0 to 7."""
    if word.isascii():
        if word.isalnum():
            return 0 if len(word) < 6 else 1
        return 2 if word[-1] in b".," and word[:-1].isalnum() else 3
    for c in word.decode():
        if not c.isascii():
            return _SHAPE_OF.get(c.encode(), 7)
    return 7


def word_id(word: bytes) -> int:
    """A 64-bit hash whose low three bits are the tail class; above END."""
    return (xxhash.xxh3_64_intdigest(word) | 16) & ~7 | tail_class(word)


class _WordIds(dict):
    """Hashes by word, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        found = self[word] = word_id(word)
        return found


_WORD_IDS = _WordIds()


def packed(a: np.ndarray, kind: str) -> bytes:
    return zstandard.compress(a.astype(kind).tobytes(), 3)


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def encode_chunks(docs: DataFrame, held_out: F.Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Chunks of documents: ids, flags, lengths, distinct words' hashes, their training counts, tokens."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), itertools.count()

        def chunk() -> pa.RecordBatch:
            hashes = np.fromiter(map(_WORD_IDS.__getitem__, words), dtype=np.uint64, count=len(words))
            hashes = np.concatenate([[END], hashes])
            flat = np.concatenate(tokens)
            train = np.repeat([not h for h in held], [len(t) for t in tokens])
            counts = np.bincount(flat[train], minlength=len(hashes))
            return pa.RecordBatch.from_pylist([{
                "chunk": (task << 32) | next(number), "ids": ids, "held": held, "lengths": [len(t) for t in tokens],
                "trained": int(counts.sum()), "hashes": hashes.astype("<u8").tobytes(),
                "counts": packed(counts, "<u4"), "tokens": packed(flat, "<u4")}], _CHUNK_ARROW)

        ids, held, tokens, size = [], [], [], 0
        words: dict[bytes, int] = defaultdict(itertools.count(1).__next__)
        end = np.zeros(1, dtype=np.int64)
        for batch in batches:
            all_ids, all_held = batch.column("doc_id").to_pylist(), batch.column("held").to_pylist()
            for first, texts in text_slices(batch.column("text")):
                for k, text in enumerate(texts, first):
                    parts = text.translate(LOWER).split()
                    tokens.append(np.concatenate([
                        np.fromiter(map(words.__getitem__, parts), dtype=np.int64, count=len(parts)), end]))
                    ids.append(all_ids[k])
                    held.append(all_held[k])
                    size += len(parts) + 1
                    if size >= CHUNK_TOKENS:
                        yield chunk()
                        ids, held, tokens, size = [], [], [], 0
                        words = defaultdict(itertools.count(1).__next__)
        if ids:
            yield chunk()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held"), F.col(text_col).alias("text"))
    return scratch_table(rows.mapInArrow(encode, _CHUNK_SCHEMA), "chunks")


_CHUNK_SCHEMA = ("chunk long, ids array<long>, held array<boolean>, lengths array<int>, trained long, hashes binary, "
                 "counts binary, tokens binary")
_CHUNK_ARROW = pa.schema([
    ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())),
    ("trained", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())])


@dataclass
class Vocabulary:
    """Totals of the training tokens, and the head words by class."""

    tokens: int
    words: int
    head: np.ndarray  # hashes in ascending order
    head_class: np.ndarray
    head_place: np.ndarray
    head_count: np.ndarray
    tail_tokens: np.ndarray
    tail_words: np.ndarray

    def classes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and place in the class (-1 in tail classes) of words given by their hashes."""
        kind = HEAD_CLASSES + (hashes & np.uint64(7)).astype(np.int64)
        place = np.full(len(hashes), -1, dtype=np.int64)
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
            found = self.head[at] == hashes
            kind[found] = self.head_class[at[found]]
            place[found] = self.head_place[at[found]]
        return kind, place


def count_words(chunks: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and (chunk, shard, counts): the corpus counts of a chunk's distinct words by shard.

    There are twice as many shards as shuffle partitions, so a shard's part of
    the words stays as small as the session asks partitions to be.
    """
    spark = chunks.sparkSession
    shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = chunks.agg(F.sum("trained")).first()[0] or 0
    least = max(1.0, total * HEAD_SHARE)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, h, c in zip(*(batch.column(n).to_pylist() for n in ("chunk", "hashes", "counts"))):
                hashes, counts = np.frombuffer(h, "<u8"), unpacked(c, "<u4")
                order, bounds = _by_shard(hashes, shards)
                used = [s for s in range(shards) if bounds[s] < bounds[s + 1]]
                hashes, counts = hashes[order], counts[order]
                cut = lambda a: pa.array([a[bounds[s]:bounds[s + 1]].tobytes() for s in used], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([chunk] * len(used), pa.int64()), cut(hashes), cut(counts)],
                    names=["shard", "chunk", "hashes", "counts"])

    def gather(group: pa.Table) -> pa.Table:
        blobs = group.column("hashes").to_pylist()
        hashes = np.frombuffer(b"".join(blobs), "<u8")
        counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), "<u4")
        distinct, at = np.unique(hashes, return_inverse=True)
        # Sums of int64 stay exact: floats of bincount would round beyond 2^53.
        summed = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(summed, at, counts)
        shard = group.column("shard")[0].as_py()
        answers = summed[at]
        bounds = np.concatenate([[0], np.cumsum([len(b) // 8 for b in blobs])])
        known = summed > 0
        shape = (distinct & np.uint64(7)).astype(np.int64)
        words = np.bincount(shape[known], minlength=TAIL_CLASSES)
        tokens = np.zeros(TAIL_CLASSES, dtype=np.int64)
        np.add.at(tokens, shape, summed)
        top = np.flatnonzero(summed >= least)
        return pa.Table.from_pylist(
            [{"shard": shard, "chunk": c, "counts": answers[a:b].astype("<i8").tobytes()}
             for c, a, b in zip(group.column("chunk").to_pylist(), bounds[:-1], bounds[1:])]
            + [{"shard": shard, "words": words.tolist(), "tokens": tokens.tolist(),
                "head": [{"hash": int(h), "n": int(n)} for h, n in zip(distinct[top].view(np.int64), summed[top])]}],
            _ANSWER_ARROW)

    answers = scratch_table(
        chunks.select("chunk", "hashes", "counts").mapInArrow(split, "shard int, chunk long, hashes binary, counts binary")
        .groupBy("shard").applyInArrow(gather, _ANSWER_SCHEMA), "answers")
    sums = answers.filter("chunk is null").agg(*[
        F.sum(F.col(c)[k]).alias(f"{c}{k}") for c in ("words", "tokens") for k in range(TAIL_CLASSES)]).first()
    # At most 1 / HEAD_SHARE rows.
    head = answers.filter("chunk is null").select(F.inline("head")).orderBy(F.desc("n"), "hash").limit(
        HEAD_CLASSES * CLASS_WORDS).collect()
    hashes = np.array([r["hash"] for r in head], dtype=np.int64).view(np.uint64)
    counts = np.array([r["n"] for r in head], dtype=np.int64)
    tail_words = np.array([sums[f"words{k}"] or 0 for k in range(TAIL_CLASSES)], dtype=np.int64)
    tail_tokens = np.array([sums[f"tokens{k}"] or 0 for k in range(TAIL_CLASSES)], dtype=np.int64)
    words = int(tail_words.sum())
    np.subtract.at(tail_words, (hashes & np.uint64(7)).astype(np.int64), 1)
    np.subtract.at(tail_tokens, (hashes & np.uint64(7)).astype(np.int64), counts)
    # Classes of like frequency, so that the first factor says how frequent the word is.
    rank, order = np.arange(len(hashes)), np.argsort(hashes)
    vocabulary = Vocabulary(int(total), words, hashes[order], (rank // CLASS_WORDS)[order], (rank % CLASS_WORDS)[order],
                            counts[order], tail_tokens, tail_words)
    return vocabulary, answers.filter("chunk is not null").select("chunk", "shard", "counts")


def _by_shard(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by shard, and where each shard begins."""
    shard = ((hashes >> np.uint64(3)) % np.uint64(shards)).astype(np.int64)
    return np.argsort(shard, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


_ANSWER_SCHEMA = ("shard int, chunk long, counts binary, words array<long>, tokens array<long>, "
                  "head array<struct<hash: bigint, n: bigint>>")
_ANSWER_ARROW = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int64()), ("counts", pa.binary()), ("words", pa.list_(pa.int64())),
    ("tokens", pa.list_(pa.int64())), ("head", pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64())])))])


def context_hashes(hashes: np.ndarray, lengths: np.ndarray, before: int = 0) -> np.ndarray:
    """The hashed features of every token of concatenated texts: (tokens, FEATURES).

    ``before``: tokens of the first text that came before the given ones.
    """
    n = len(hashes)
    place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place[:lengths[0]] += before
    back = []
    for d in (1, 2, 3):
        h = np.empty(n, dtype=np.uint64)
        h[:d], h[d:] = _START, hashes[:-d] if n > d else hashes[:0]
        h[place < d] = _START
        back.append(h)
    one, two, three = back
    raw = np.stack([one * _MUL, one * _MUL + two * _MIX + np.uint64(1), two * _MIX + np.uint64(2),
                    three * _MIX * _MUL + np.uint64(3)], 1)
    raw ^= raw >> np.uint64(31)
    raw *= _MIX
    return raw ^ (raw >> np.uint64(29))


@dataclass
class Model:
    """Weights of both factors."""

    bias_1: np.ndarray
    bias_2: np.ndarray
    weights_1: np.ndarray
    weights_2: np.ndarray

    @classmethod
    def start(cls, v: Vocabulary) -> Model:
        """The model without features: shares of the classes, and of the words in them."""
        per_class = np.full(CLASSES, 0.5)
        np.add.at(per_class, v.head_class, v.head_count)
        per_class[HEAD_CLASSES:] += v.tail_tokens
        in_class = np.full((HEAD_CLASSES, CLASS_WORDS), -30.0)
        in_class[v.head_class, v.head_place] = np.log(np.maximum(v.head_count, 1))
        empty = np.bincount(v.head_class, minlength=HEAD_CLASSES)[:HEAD_CLASSES] == 0
        per_class[:HEAD_CLASSES][empty] = 1e-12
        return cls(np.log(per_class / per_class.sum()).astype(np.float32), in_class.astype(np.float32),
                   np.zeros((BUCKETS_1, CLASSES), np.float32), np.zeros((BUCKETS_2, CLASS_WORDS), np.float32))

    def class_weights(self, features: np.ndarray) -> np.ndarray:
        """Exponentials of the scores of all classes, one row a token; ``features``: buckets."""
        return _exponentials(self.bias_1 + self.weights_1[features[:, 0]], self.weights_1, features)

    def word_weights(self, kinds: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Exponentials of the scores of all words of each token's head class."""
        return _exponentials(self.bias_2[kinds] + self.weights_2[features[:, 0]], self.weights_2, features)


def _exponentials(z: np.ndarray, weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    for k in range(1, FEATURES):
        z += weights[features[:, k]]
    # Far beyond any trained score; keeps sums within single precision without a pass for the largest.
    np.clip(z, -60.0, 60.0, out=z)
    return np.exp(z, out=z)


def _shares(e: np.ndarray) -> np.ndarray:
    """Rows divided by their sums."""
    e /= (e @ np.ones(e.shape[1], np.float32))[:, None]
    return e


def _log_share(e: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The log share of one column of each row."""
    return np.log(e[np.arange(len(e)), column]) - np.log(e @ np.ones(e.shape[1], np.float32))


def _buckets_1(raw: np.ndarray) -> np.ndarray:
    return (raw & np.uint64(BUCKETS_1 - 1)).astype(np.intp)


def _buckets_2(raw: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    z = (raw + kinds.astype(np.uint64)[:, None] * _MUL) * _MIX
    return (z >> np.uint64(64 - BUCKETS_2.bit_length() + 1)).astype(np.intp)


def _step(weights: np.ndarray, squares: np.ndarray, features: np.ndarray, error: np.ndarray) -> None:
    """One AdaGrad step on the rows of ``weights`` that a batch's features name."""
    flat = features.ravel().astype(np.uint16)  # sorted by radix
    order = np.argsort(flat, kind="stable")
    rows = flat[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    gradient = np.add.reduceat(error[order // FEATURES], first, axis=0)
    used = rows[first]
    squares[used] += (gradient * gradient).mean(1)
    weights[used] += (RATE / np.sqrt(squares[used] + 1e-3))[:, None] * gradient


def train_on(model: Model, v: Vocabulary, hashes: np.ndarray, tokens: np.ndarray, lengths: np.ndarray,
             squares: tuple[np.ndarray, np.ndarray]) -> None:
    """Gradient updates over the texts of one chunk, in batches of tokens."""
    kinds, places = v.classes(hashes)
    for s in range(0, len(tokens), SPAN):
        first = max(0, s - 3)
        part = tokens[first:s + SPAN]
        raw_all = context_hashes(hashes[part], *_texts_within(lengths, first, first + len(part)))
        for b in range(s - first, len(part), BATCH):
            at, raw = part[b:b + BATCH], raw_all[b:b + BATCH]
            kind, place = kinds[at], places[at]
            f1 = _buckets_1(raw)
            error = -_shares(model.class_weights(f1))
            error[np.arange(len(at)), kind] += 1.0
            _step(model.weights_1, squares[0], f1, error)
            head = np.flatnonzero(place >= 0)
            if len(head):
                f2 = _buckets_2(raw[head], kind[head])
                error = -_shares(model.word_weights(kind[head], f2))
                error[np.arange(len(head)), place[head]] += 1.0
                _step(model.weights_2, squares[1], f2, error)


def _texts_within(lengths: np.ndarray, start: int, end: int) -> tuple[np.ndarray, int]:
    """The lengths of the texts' parts that lie in tokens [start, end), and how much of the first lies before."""
    ends = np.cumsum(lengths)
    at = int(np.searchsorted(ends, start, side="right"))
    edges = np.unique(np.clip(np.concatenate([[start], ends, [end]]), start, end))
    return np.diff(edges), start - int(ends[at] - lengths[at])


def train(chunks: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Distributed gradient updates: every training chunk is used once, in one of ``rounds`` rounds.

    The changes of the weights are averaged in two levels of rows of SLICE
    weights, read one by one, so that no task holds those of many others.
    """
    spark = chunks.sparkSession
    model = Model.start(v)
    shapes = (model.weights_1.shape, model.weights_2.shape)
    size = sum(a * b for a, b in shapes)
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(pickle.dumps((model, v)))

        def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            local, seen = None, 0
            for batch in batches:
                for row in zip(*(batch.column(n) for n in ("hashes", "tokens", "lengths", "held"))):
                    hashes, tokens = np.frombuffer(row[0].as_py(), "<u8"), unpacked(row[1].as_py(), "<u4")
                    lengths, use = np.array(row[2].as_py()), ~np.array(row[3].as_py())
                    tokens = tokens[np.repeat(use, lengths)]
                    if not len(tokens):
                        continue
                    if local is None:
                        local, words = pickle.loads(shared.value)
                        squares = tuple(np.zeros(len(w), np.float32) for w in (local.weights_1, local.weights_2))
                    train_on(local, words, hashes, tokens, lengths[use], squares)
                    seen += len(tokens)
            if local is None:
                return
            start, _ = pickle.loads(shared.value)
            change = np.concatenate([(local.weights_1 - start.weights_1).ravel(), (local.weights_2 - start.weights_2).ravel()])
            part = TaskContext.get().partitionId() % 8
            for k in range(0, size, SLICE):
                yield pa.RecordBatch.from_pylist([
                    {"slice": k // SLICE, "part": part, "tokens": seen, "mean": change[k:k + SLICE].astype("<f2").tobytes()}],
                    _UPDATE_ARROW)

        def add(group: pa.Table) -> pa.Table:
            tokens = group.column("tokens").to_pylist()
            total = np.zeros(len(group.column("mean")[0].as_py()) // 2, dtype=np.float64)
            for n, blob in zip(tokens, group.column("mean")):
                total += n * np.frombuffer(blob.as_py(), "<f2").astype(np.float64)
            return pa.Table.from_pylist([
                {"slice": group.column("slice")[0].as_py(), "part": 0, "tokens": sum(tokens),
                 "mean": (total / sum(tokens)).astype("<f2").tobytes()}], _UPDATE_ARROW)

        updates = chunks.filter((F.col("trained") > 0) & (F.pmod(F.xxhash64("chunk"), F.lit(rounds)) == r)).select(
            "hashes", "tokens", "lengths", "held").mapInArrow(update, _UPDATE_SCHEMA)
        # One row per slice: the model itself, whose size is fixed.
        slices = updates.groupBy("slice", "part").applyInArrow(add, _UPDATE_SCHEMA).groupBy("slice").applyInArrow(
            add, _UPDATE_SCHEMA).orderBy("slice").collect()
        if slices:
            change = np.concatenate([np.frombuffer(s["mean"], "<f2") for s in slices]).astype(np.float32)
            cut = shapes[0][0] * shapes[0][1]
            model = Model(model.bias_1, model.bias_2, model.weights_1 + change[:cut].reshape(shapes[0]),
                          model.weights_2 + change[cut:].reshape(shapes[1]))
        shared.unpersist()
    return model


_UPDATE_SCHEMA = "slice int, part int, tokens long, mean binary"
_UPDATE_ARROW = pa.schema([("slice", pa.int32()), ("part", pa.int32()), ("tokens", pa.int64()), ("mean", pa.binary())])


def log_chances(model: Model, v: Vocabulary, hashes: np.ndarray, counts: np.ndarray, tokens: np.ndarray,
                lengths: np.ndarray) -> np.ndarray:
    """Natural-log chance of every token of concatenated texts."""
    kinds, places = v.classes(hashes)
    shape = (hashes & np.uint64(7)).astype(np.int64)
    in_tail = np.log((counts + 0.5) / (v.tail_tokens[shape] + 0.5 * (v.tail_words[shape] + 1)))
    out = np.empty(len(tokens))
    raw_part = None
    for s in range(0, len(tokens), BATCH):
        if s % SPAN == 0:
            # The span's context starts three tokens before it.
            first = max(0, s - 3)
            raw_part = context_hashes(hashes[tokens[first:s + SPAN]], *_texts_within(lengths, first, min(s + SPAN, len(tokens))))
            raw_part = raw_part[s - first:]
        at, raw = tokens[s:s + BATCH], raw_part[s % SPAN:s % SPAN + BATCH]
        kind, place = kinds[at], places[at]
        logs = _log_share(model.class_weights(_buckets_1(raw)), kind).astype(np.float64)
        head = place >= 0
        logs[~head] += in_tail[at[~head]]
        if head.any():
            logs[head] += _log_share(model.word_weights(kind[head], _buckets_2(raw[head], kind[head])), place[head])
        out[s:s + BATCH] = logs
    return out


def score_chunks(chunks: DataFrame, answers: DataFrame, model: Model, v: Vocabulary) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = chunks.sparkSession
    shared = spark.sparkContext.broadcast(pickle.dumps((model, v)))
    shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = v.tokens + 0.5 * (v.words + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words = pickle.loads(shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in ("ids", "held", "lengths", "hashes", "tokens", "parts")}
                hashes, tokens = np.frombuffer(row["hashes"], "<u8"), unpacked(row["tokens"], "<u4")
                order, _ = _by_shard(hashes, shards)
                counts = np.empty(len(hashes), dtype=np.int64)
                counts[order] = np.frombuffer(
                    b"".join(p["counts"] for p in sorted(row["parts"], key=lambda p: p["shard"])), "<i8")
                lengths = np.array(row["lengths"])
                first = np.cumsum(lengths) - lengths
                base = np.log10((counts + 0.5) / total)
                n = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["ids"], pa.int64()), pa.array(row["held"]), pa.array(lengths, pa.int64()),
                    pa.array(np.add.reduceat((counts > 0).astype(np.int64)[tokens], first)),
                    pa.array(np.full(n, words.tokens, dtype=np.int64)), pa.array(np.add.reduceat(base[tokens], first)),
                    pa.array(np.add.reduceat(log_chances(known, words, hashes, counts, tokens, lengths), first)
                             / math.log(10)),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    # At most one part per shard: together they are as large as the chunk's words.
    parts = answers.groupBy("chunk").agg(F.collect_list(F.struct("shard", "counts")).alias("parts"))
    return chunks.select("chunk", "ids", "held", "lengths", "hashes", "tokens").join(parts, "chunk").drop("chunk").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame, held_out: F.Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learns from the rows that are not held out, and scores all."""
    chunks = encode_chunks(docs, held_out, id_col, text_col)
    vocabulary, answers = count_words(chunks)
    return score_chunks(chunks, answers, train(chunks, vocabulary), vocabulary)
