"""Token ids in Parquet files: list columns, controlled row groups, page indexes.

Texts are range-partitioned by id and a hash of the text, encoded batch by batch and written as one
row per document: ``doc_id``, ``part`` (the range), ``offset`` (ids before it in
its range), ``n_tokens`` and ``ids`` (array<int>). ``ids`` and ``part`` are
dictionary-encoded, the ascending ``doc_id`` and ``offset`` are delta-encoded,
and the small row groups and pages carry column and offset indexes, so that a
reader of a few documents, or of the metadata columns alone, skips the rest.
A document's global start is its part's start plus ``offset``.

Defined results: null and empty texts hold the end id alone; null ids come
first; repeated ids and rows are kept, in the order of a hash of their text; an
empty table gives no rows; other columns are ignored. ``doc_id`` is cast to long.
"""

from __future__ import annotations

import itertools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isotherm.llm.common import LOWER, text_slices

END_ID = 1
# Encoded pieces a worker remembers; it starts afresh beyond that.
PIECES = 700_000
# ids per output batch of a task
BATCH_IDS = 1_000_000

FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",  # delta encodings
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#offset": "false",
}

TOKEN_SCHEMA = "doc_id long, part int, offset long, n_tokens int, ids array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int32()),
                    ("ids", pa.list_(pa.int32()))])


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write bytes as letters: printable Latin-1 as itself, the others from U+0100 on in turn."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = itertools.count(256)
    return {b: chr(b if b in printable else next(others)) for b in range(256)}


_BYTE_LETTERS = _byte_letters()
# Latin-1 letters, for which lower-casing and normal forms leave no choice.
_LATIN = re.compile("[a-zß-öø-ÿÀ-ÖØ-Þ]+")


class _Known(dict):
    """Ids by piece; a missing piece is encoded and kept."""

    def __missing__(self, piece: bytes) -> bytes:
        ids = self[piece] = self.encode(piece)
        return ids


class PieceEncoder:
    """Encodes whole texts with a ``tokenizers`` vocabulary file, word by word.

    The vocabulary's rules lower-case a text and never join a letter with a
    character of another kind, nor anything across white space, which they drop.
    So the ids of a text are those of its white-space-separated pieces in turn;
    A-Z may be lower-cased first, and a stop or comma after a letter or digit is
    encoded apart. Pieces repeat, so their ids are remembered. Lower-case Latin
    words go to the library's model directly; all others through its whole pipeline.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = self._none_known()

    def _none_known(self) -> _Known:
        known = _Known()
        known.encode = self._ids
        return known

    def _ids(self, piece: bytes) -> bytes:
        if piece.isalpha() and piece.islower():  # a-z only
            ids = [t.id for t in self.model.tokenize(piece.decode())]
        else:
            text = piece.decode()
            if _LATIN.fullmatch(text):
                letters = text.lower().encode().decode("latin-1").translate(_BYTE_LETTERS)
                return array("i", [t.id for t in self.model.tokenize(letters)]).tobytes()
            if len(text) > 1 and text[-1] in ".," and text[:-1].lower()[-1].isalnum():
                return self.known[piece[:-1]] + self.known[piece[-1:]]
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("i", ids).tobytes()

    def encode(self, text: bytes) -> np.ndarray:
        # Special tokens are recognised before lower-casing.
        pieces = (text if b"<|" in text else text.translate(LOWER)).split()
        if len(self.known) > PIECES:
            self.known = self._none_known()
        return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), dtype=np.int32)


_ENCODERS: dict[str, PieceEncoder] = {}  # one per vocabulary and Python worker


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     end_id: int = END_ID) -> DataFrame:
    """Rows of the token table, in ascending id order across and within partitions."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.setdefault(vocabulary, PieceEncoder(vocabulary))
        offset = 0
        end = np.array([end_id], dtype="<i4")
        for batch in batches:
            ids, parts = batch.column("doc_id"), batch.column("part")
            for first, texts in text_slices(batch.column("text")):
                done = 0
                while done < len(texts):
                    arrays, held, start = [], 0, done
                    while done < len(texts) and held < BATCH_IDS:
                        arrays += [encoder.encode(texts[done]), end]
                        held += len(arrays[-2]) + 1
                        done += 1
                    lengths = np.array([len(a) + 1 for a in arrays[::2]], dtype=np.int64)
                    bounds = np.concatenate([[0], np.cumsum(lengths)])
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(first + start, done - start), parts.slice(first + start, done - start),
                        pa.array(offset + bounds[:-1]), pa.array(lengths.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(np.concatenate(arrays))),
                    ], schema=_ARROW)
                    offset += int(bounds[-1])

    # Rows of one id are dealt by a hash of their text, so a null or repeated id is not one task.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("_hash"))
    ordered = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash", "text")
    return ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(encode, TOKEN_SCHEMA)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` into token files at ``path``."""
    encode_documents(docs, vocabulary, id_col, text_col).write.options(**FILE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The token table with the global ``start`` of each document; only the columns used are read."""
    rows = spark.read.schema(TOKEN_SCHEMA).parquet(path)
    # One row per part, so the window and the broadcast are bounded by the number of parts.
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select(
        F.col("part"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    return rows.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("_start") + F.col("offset")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"),
        "ids")


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (crc32 of the ids as little-endian unsigned 32-bit integers)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False).view(np.uint8)
            bounds = ids.offsets.to_numpy().astype(np.int64) * 4
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
