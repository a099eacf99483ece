"""Benchmark decontamination with an FM-index per training shard.

A task takes its documents in runs of bounded size (a shard) and builds a
full-text index of each: the words become symbols of the phrases' vocabulary (a
word that no phrase holds becomes a separator, and a run of separators one), a
suffix array is sorted by prefix doubling, and its Burrows-Wheeler transform
goes into a wavelet matrix with rank directories. All phrases are then searched
backwards at once, their occurrences located by walking to the nearest sampled
suffix position, and the words they cover merged into spans per document.

A phrase is ``window`` consecutive words of a benchmark item; an item with
fewer words, but not none, is one phrase. Words: A-Z lower-cased, runs of
characters that are neither ASCII punctuation, space nor control.

Defined results: a null or empty text has no words and no spans; a null item
text has no phrases; an item without an id marks words but is not listed;
repeated items count once by their id; repeated documents are rows of their
own; an empty benchmark marks nothing; other columns are kept.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import ALNUM, BROADCAST_BYTES, byte_texts, columns_of, unused_name

WINDOW = 10
SHARD_WORDS = 400_000  # words of a shard; a longer document is a shard of its own
SAMPLE = 8  # every SAMPLE-th position of the sequence is kept
LEAK_TYPE = "struct<n_words: bigint, spans: array<struct<start: int, end: int>>, items: array<string>>"
_LEAK_ARROW = pa.struct([("n_words", pa.int64()),
                         ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                         ("items", pa.list_(pa.string()))])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()


def suffix_array(seq: np.ndarray, width: int) -> np.ndarray:
    """Sorted suffixes of ``seq``, whose symbols take ``width`` bits and which ends with 0.

    Each 0 is a separator that differs from every other: suffixes equal up to a
    separator are ordered by position.
    """
    n = len(seq)
    reach = max(1, 62 // width)
    key = np.zeros(n, dtype=np.int64)
    alive = np.ones(n, dtype=bool)
    padded = np.concatenate([seq, np.zeros(reach, dtype=seq.dtype)])
    for j in range(reach):
        symbol = padded[j:j + n] * alive
        key = (key << width) | symbol
        alive &= symbol != 0
    sa = np.argsort(key, kind="stable").astype(np.int64)
    ordered = key[sa]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    whole = ~alive[sa]  # a separator is within reach: the order is final
    place = np.arange(n, dtype=np.int64)
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = np.where(whole, place, np.maximum.accumulate(np.where(head, place, 0)))
    tied = ~whole & ~(head & np.concatenate([head[1:], [True]]))
    open_at = np.flatnonzero(tied)
    while len(open_at):
        sub = sa[open_at]
        pair = rank[sub] * n + rank[sub + reach]
        order = np.argsort(pair, kind="stable")
        sub, pair = sub[order], pair[order]
        sa[open_at] = sub
        first = np.concatenate([[True], pair[1:] != pair[:-1]])
        rank[sub] = np.maximum.accumulate(np.where(first, open_at, 0))
        open_at = open_at[~(first & np.concatenate([first[1:], [True]]))]
        reach *= 2
    return sa


class WaveletMatrix:
    """Rank over a sequence of symbols: one bit row a level, with counts per 64 bits."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.n, self.width = len(symbols), width
        self.bits: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = symbols
        for level in range(width - 1, -1, -1):
            bit = ((current >> level) & 1).astype(bool)
            packed = np.packbits(np.concatenate([bit, np.zeros(-len(bit) % 64 + 64, dtype=bool)]), bitorder="little")
            row = packed.view("<u8")
            self.bits.append(row)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(row), dtype=np.int64)]))
            current = np.concatenate([current[~bit], current[bit]])
            self.zeros.append(int(self.n - bit.sum()))

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][block] + np.bitwise_count(self.bits[level][block] & mask).astype(np.int64)

    def rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """How often ``symbol`` stands before each place."""
        at = [np.zeros_like(symbol), *places]
        for level in range(self.width):
            one = ((symbol >> (self.width - 1 - level)) & 1).astype(bool)
            for k, i in enumerate(at):
                ones = self._ones(level, i)
                at[k] = np.where(one, self.zeros[level] + ones, i - ones)
        return [i - at[0] for i in at[1:]]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places ``i``, and how often each stands before its place."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for level in range(self.width):
            block = i >> 6
            one = ((self.bits[level][block] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            ones, ones_start = self._ones(level, i), self._ones(level, start)
            symbol = (symbol << 1) | one
            i = np.where(one, self.zeros[level] + ones, i - ones)
            start = np.where(one, self.zeros[level] + ones_start, start - ones_start)
        return symbol, i - start


class FMIndex:
    """Count and locate phrases in a sequence of symbols > 0 with separators 0."""

    def __init__(self, seq: np.ndarray, symbols: int):
        width = max(1, int(symbols).bit_length())
        n = len(seq)
        sa = suffix_array(seq, width)
        before = np.where(sa > 0, seq[sa - 1], 0)
        self.bwt = WaveletMatrix(before, width)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols + 1))])
        # Kept: every SAMPLE-th position, and those that follow a separator, where a walk must end.
        kept = (sa % SAMPLE == 0) | (before == 0)
        self.kept = WaveletMatrix(kept.astype(np.int64), 1)
        self.positions = sa[kept]
        self.n = n

    def ranges(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of phrases, rows of symbols filled from the right with -1 in front."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        live = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            live = live[(lengths[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = phrases[live, phrases.shape[1] - 1 - step]
            down, up = self.bwt.rank(symbol, low[live], high[live])
            low[live], high[live] = self.first[symbol] + down, self.first[symbol] + up
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of suffix rows."""
        rows = rows.copy()
        out = np.zeros(len(rows), dtype=np.int64)
        walked = np.zeros(len(rows), dtype=np.int64)
        live = np.arange(len(rows))
        while len(live):
            marked, place = self.kept.access(rows[live])
            done = marked == 1
            out[live[done]] = self.positions[place[done]] + walked[live[done]]
            live = live[~done]
            symbol, before = self.bwt.access(rows[live])
            rows[live] = self.first[symbol] + before
            walked[live] += 1
        return out


@dataclass
class Phrases:
    """A block of phrases: their symbols, lengths and the items that hold them."""

    vocabulary: dict[bytes, int]
    symbols: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    @classmethod
    def of(cls, rows: list[tuple[str | None, bytes]], window: int) -> Phrases:
        """From (item id, text) rows."""
        found: dict[tuple[bytes, ...], dict[str, None]] = {}
        for item, text in rows:
            words = words_of(text)
            for i in range(max(1 if words else 0, len(words) - window + 1)):
                holders = found.setdefault(tuple(words[i:i + window]), {})
                if item is not None:
                    holders[item] = None
        vocabulary: dict[bytes, int] = {}
        symbols = np.full((len(found), window), -1, dtype=np.int64)
        for k, phrase in enumerate(found):
            symbols[k, window - len(phrase):] = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in phrase]
        return cls(vocabulary, symbols, (symbols >= 0).sum(1), [list(x) for x in found.values()])

    def search(self, encoded: list[np.ndarray]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """Merged spans and items of each document of a shard, given as arrays of symbols (0: no phrase's word)."""
        results: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in encoded]
        if not len(self.symbols):
            return results
        starts = np.cumsum([0] + [len(e) + 1 for e in encoded])
        text = np.zeros(starts[-1], dtype=np.int64)
        for e, s in zip(encoded, starts):
            text[s:s + len(e)] = e
        kept = text != 0
        kept[1:] |= kept[:-1]  # of a run of separators, the first; one follows every word
        origin = np.flatnonzero(kept)
        if not len(origin):
            return results
        index = FMIndex(text[origin], len(self.vocabulary))
        low, high = index.ranges(self.symbols, self.lengths)
        hit = np.flatnonzero(high > low)
        if not len(hit):
            return results
        count = (high - low)[hit]
        phrase = np.repeat(hit, count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[hit], count)
        at = origin[index.locate(rows)]
        order = np.argsort(at, kind="stable")
        at, phrase = at[order], phrase[order]
        doc = np.searchsorted(starts, at, side="right") - 1
        for d, p, a in zip(doc.tolist(), phrase.tolist(), (at - starts[doc]).tolist()):
            spans, items = results[d]
            end = a + int(self.lengths[p])
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], end))
            else:
                spans.append((a, end))
            items.update(self.items[p])
        return results


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def phrase_blocks(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> Iterator[Phrases]:
    """The phrases of all items, in blocks whose texts are together within BROADCAST_BYTES / 8.

    The benchmark is the stated query set; a block is what every task gets.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    held: list[tuple[str | None, bytes]] = []
    size = 0
    for row in items.toLocalIterator():
        text = row["text"].encode()
        if held and size + len(text) > BROADCAST_BYTES // 8:
            yield Phrases.of(held, window)
            held, size = [], 0
        held.append((row["item"], text))
        size += len(text)
    yield Phrases.of(held, window)


def _leak_column(spark, phrases: Phrases, text_col: str, earlier: F.Column | None) -> F.Column:
    shared = spark.sparkContext.broadcast(pickle.dumps(phrases))

    @F.arrow_udf(LEAK_TYPE)
    def leaks(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        known: Phrases = pickle.loads(shared.value)
        get = known.vocabulary.get
        for columns in batches:
            columns = columns if isinstance(columns, tuple) else (columns,)
            texts = byte_texts(columns[0])
            before = columns[1].to_pylist() if len(columns) > 1 else None
            out: list[dict] = []
            encoded: list[np.ndarray] = []
            held = 0
            for k, text in enumerate(texts):
                words = words_of(text)
                encoded.append(np.fromiter((get(w, 0) for w in words), dtype=np.int32, count=len(words)))
                held += len(words)
                if held >= SHARD_WORDS or k == len(texts) - 1:
                    for e, (spans, items) in zip(encoded, known.search(encoded)):
                        old = before[len(out)] if before else None
                        if old:
                            spans = _merged(spans + [(s["start"], s["end"]) for s in old["spans"]])
                            items |= set(old["items"])
                        out.append({"n_words": len(e), "items": sorted(items),
                                    "spans": [{"start": a, "end": b} for a, b in spans]})
                    encoded, held = [], 0
            yield pa.array(out, _LEAK_ARROW)

    return leaks(F.col(text_col), *([earlier] if earlier is not None else []))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", name: str = "leaks") -> DataFrame:
    """``docs`` with a column ``name`` of (n_words, merged word spans [start, end), item ids in order of code point).

    A column of that name in ``docs`` is replaced.
    """
    result = docs
    for k, phrases in enumerate(phrase_blocks(benchmark, window, item_col, item_text_col)):
        result = result.withColumn(
            name, _leak_column(docs.sparkSession, phrases, text_col, F.col(name) if k else None))
    return result


def leaked_words(leaks: str) -> F.Column:
    """The number of words inside the spans."""
    return F.aggregate(f"{leaks}.spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no phrase occurs, with their columns."""
    name = unused_name(docs, "leaks")
    return find_leaks(docs, benchmark, window, text_col, name=name).filter(
        F.size(f"{name}.spans") == 0).select(*columns_of(docs))
