"""Token counts: how many ids a byte-level vocabulary gives a text, without the ids.

Texts are counted in Arrow functions that return lengths only. A text is cut at
safe boundaries, before a space, tab or line break that follows a visible
character: the vocabulary's rules never join characters across such a place, and
special strings hold no white space, so the counts of the pieces add up to the
count of the text. The pieces of a slice that are not yet known are encoded by
the ``tokenizers`` library in batches of about ``BATCH_BYTES``, longest first, so
that a batch holds pieces of like size; short pieces are remembered by the worker.

Tasks are balanced by bytes too. Spark cuts files by bytes; what that leaves is a
text far longer than others, so texts above ``LONG_BYTES`` are cut into parts of
about that size, which are dealt to all tasks and counted apart; equal long texts
are cut once. A text without a safe boundary stays one part, and a run of visible
characters one piece, whatever its length.

Defined results: a null text is counted as the empty text, 0 bytes and 0 tokens;
repeated ids and rows are kept, each with its own row; a null id is kept; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts above this many bytes are cut into parts of about this size for other tasks.
LONG_BYTES = 1 << 20
# Bytes of the pieces encoded in one call of the library.
BATCH_BYTES = 256 << 10
# Characters of a piece that a worker remembers, and how many pieces; it starts afresh beyond that.
PIECE_CHARS = 64
PIECES = 600_000

# White space before which no text is cut, as libraries differ about some of it.
_ODD = "".join(map(chr, (0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                         0x202F, 0x205F, 0x3000)))
# A run of white space and the visible run after it; odd white space also joins the next ones.
_PIECE = re.compile(rf"\s*\S+(?:[{_ODD}]\s*\S*)*|\s+")
_CUT = re.compile(r"\S(?=[ \t\n\r])")


def safe_parts(text: str, chars: int) -> Iterator[str]:
    """``text`` in parts of ``chars`` characters or a little more, each but the last ending at a safe boundary."""
    first = 0
    while len(text) - first > chars:
        cut = _CUT.search(text, first + chars - 1)
        if cut is None:
            break
        yield text[first:cut.end()]
        first = cut.end()
    yield text[first:]


class LengthEncoder:
    """Counts the ids of texts, in batches of pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}

    def _lengths(self, pieces: list[str]) -> Iterator[tuple[str, int]]:
        pieces.sort(key=len, reverse=True)
        batch, held = [], 0
        for k, piece in enumerate(pieces):
            batch.append(piece)
            held += len(piece) + 1
            if held >= BATCH_BYTES or k + 1 == len(pieces):
                yield from zip(batch, map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)))
                batch, held = [], 0

    def counts(self, texts: list[str]) -> list[int]:
        """Number of ids of each text."""
        if len(self.known) > PIECES:
            self.known = {}
        known, totals = self.known, [0] * len(texts)
        # Whole texts together, but no more than about this many characters of pieces at a time.
        group: list[tuple[int, list[str]]] = []
        held = 0
        for k, text in enumerate(texts):
            for part in safe_parts(text, LONG_BYTES):
                group.append((k, _PIECE.findall(part)))
                held += len(part)
                if held > LONG_BYTES:
                    self._add(group, known, totals)
                    group, held = [], 0
        self._add(group, known, totals)
        return totals

    def _add(self, group: list[tuple[int, list[str]]], known: dict[str, int], totals: list[int]) -> None:
        new = {p for _, pieces in group for p in pieces if p not in known}
        long: dict[str, int] = {}
        for piece, n in self._lengths(list(new)):
            (known if len(piece) <= PIECE_CHARS else long)[piece] = n
        for k, pieces in group:
            try:
                totals[k] += sum(map(known.__getitem__, pieces))
            except KeyError:
                totals[k] += sum(known[p] if p in known else long[p] for p in pieces)


_ENCODERS: dict[str, LengthEncoder] = {}  # one per vocabulary and Python worker


def _texts(column: pa.Array, rows: int = 512) -> Iterator[list[str]]:
    for first in range(0, len(column), rows):
        yield [t or "" for t in column.slice(first, rows).to_pylist()]


def _count(vocabulary: str):
    """mapInArrow: replaces the column ``text`` by its number of tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _ENCODERS:
            _ENCODERS[vocabulary] = LengthEncoder(vocabulary)
        encoder = _ENCODERS[vocabulary]
        for batch in batches:
            totals = [n for texts in _texts(batch.column("text")) for n in encoder.counts(texts)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "n_tokens", pa.array(totals, pa.int64()))

    return count


def _parts(long_bytes: int):
    """mapInArrow: (key, text) to (key, no, text) per part."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                parts = list(safe_parts(text.as_py(), long_bytes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()] * len(parts), pa.string()), pa.array(range(len(parts)), pa.int32()),
                     pa.array(parts, pa.string())], names=["key", "no", "text"])

    return cut


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 long_bytes: int = LONG_BYTES) -> DataFrame:
    """doc_id (as given), n_bytes long, n_tokens long of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "n_bytes", F.octet_length("text").cast("long"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.filter(F.col("n_bytes") <= long_bytes).mapInArrow(
        _count(vocabulary), f"doc_id {id_type}, n_tokens long, n_bytes long")
    long = rows.filter(F.col("n_bytes") > long_bytes).withColumn("key", F.sha2("text", 256))
    parts = long.groupBy("key").agg(F.first("text").alias("text")).select("key", "text").mapInArrow(
        _parts(long_bytes), "key string, no int, text string")
    totals = parts.repartition("key", "no").mapInArrow(
        _count(vocabulary), "key string, no int, n_tokens long").groupBy("key").agg(F.sum("n_tokens").alias("n_tokens"))
    return counted.select("doc_id", "n_bytes", "n_tokens").unionByName(
        long.select("doc_id", "n_bytes", "key").join(totals, "key").select("doc_id", "n_bytes", "n_tokens"))
