"""Token ids in a binary file format: patched frame-of-reference blocks.

Ids are cut into blocks of BLOCK. A block stores its minimum, the differences to it packed at
the width that FITS of them need, and a list of exceptions (place and whole difference) for the
rest. An index holds each block's start, so one block can be read without those before it.

A file is a Parquet folder in the shared store with one row per shard: `part` and `shard` give
the order, `content` holds the blocks of the documents' token counts and then of their ids.
Spark's writer commits it, so a lost executor or a repeated task leaves no half-written shard.

Scale: one shuffle sorts the documents by id over all tasks, and the ids never leave the task
that encodes them except as packed shards. The start of a document is its place in the shard
plus the totals of earlier shards, summed per part first.

Defined cases: documents are in ascending id order, NULL first; documents of one id follow each
other by a hash of their text, repeated rows in any order (they are alike), and may lie in
different parts, so one id's rows needn't fit one task. NULL and empty texts hold the end id
only. A document longer than a shard has a shard of its own.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.bpe import SLICE, Codec, load
from tillroll.llm.common import ship

ship(__name__)

BLOCK = 128
FITS = 0.9
SHARD = 1 << 19
END = 0
_HEADER = "<QI"


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width, each row as 2 * width words of 64 bits."""
    words = np.zeros((2 * width, len(values)), dtype="<u8")
    columns = np.ascontiguousarray(values.T.astype(np.uint64))
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        words[word] |= columns[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= columns[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.zeros((BLOCK, len(words)), dtype=np.uint32)
    if width:
        source, mask = np.ascontiguousarray(words.T), np.uint64((1 << width) - 1)
        for i in range(BLOCK):
            word, shift = divmod(i * width, 64)
            value = source[word] >> np.uint64(shift)
            if shift + width > 64:
                value |= source[word + 1] << np.uint64(64 - shift)
            columns[i] = value & mask
    return np.ascontiguousarray(columns.T)


def pack_blocks(values: np.ndarray) -> bytes:
    """Values of 32 bits as header, block index, packed blocks and exceptions."""
    n = len(values)
    blocks = -(-n // BLOCK)
    padded = np.empty(blocks * BLOCK, dtype=np.uint32)
    padded[:n] = values
    padded[n:] = values[-1] if n else 0
    rows = padded.reshape(blocks, BLOCK)
    least = rows.min(axis=1) if n else np.empty(0, np.uint32)
    over = rows - least[:, None]
    lengths = _bit_lengths(over)
    widths = np.sort(lengths, axis=1)[:, int(np.ceil(FITS * BLOCK)) - 1]
    odd_block, odd_place = np.nonzero(lengths > widths[:, None])
    starts = np.concatenate([[0], np.cumsum(widths.astype(np.uint64) * (BLOCK // 8))]).astype("<u8")
    body = np.zeros(int(starts[-1]) // 8, dtype="<u8")
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        if width:
            low = over[at] & np.uint32((1 << int(width)) - 1)
            body[(starts[at] // np.uint64(8))[:, None].astype(np.int64) + np.arange(2 * int(width))] = _pack(low, int(width))
    odd_ends = np.concatenate([[0], np.cumsum(np.bincount(odd_block, minlength=blocks))]).astype("<u4")
    return b"".join(
        part if isinstance(part, bytes) else part.tobytes()
        for part in (
            struct.pack(_HEADER, n, blocks),
            least.astype("<u4"),
            widths.astype("u1"),
            starts,
            odd_ends,
            odd_place.astype("u1"),
            over[odd_block, odd_place].astype("<u4"),
            body,
        )
    )


class Blocks:
    """Packed blocks, to be read whole or one by one."""

    def __init__(self, content: bytes, start: int = 0):
        self.n, blocks = struct.unpack_from(_HEADER, content, start)
        self._content, self._next = content, start + struct.calcsize(_HEADER)
        self.least = self._take("<u4", blocks)
        self.widths = self._take("u1", blocks)
        self.starts = self._take("<u8", blocks + 1)
        self.odd_ends = self._take("<u4", blocks + 1)
        self.odd_places = self._take("u1", int(self.odd_ends[-1]))
        self.odd_values = self._take("<u4", int(self.odd_ends[-1]))
        self.body = self._take("<u8", int(self.starts[-1]) // 8)
        self.end = self._next

    def _take(self, kind: str, count: int) -> np.ndarray:
        found = np.frombuffer(self._content, kind, count, self._next)
        self._next += found.nbytes
        return found

    def read(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The values of blocks `first` up to, but not including, `last`."""
        last = len(self.widths) if last is None else last
        rows = np.zeros((last - first, BLOCK), dtype=np.uint32)
        for width in np.unique(self.widths[first:last]):
            at = first + np.flatnonzero(self.widths[first:last] == width)
            places = (self.starts[at] // np.uint64(8)).astype(np.int64)[:, None] + np.arange(2 * int(width))
            rows[at - first] = _unpack(self.body[places], int(width))
        odd = slice(int(self.odd_ends[first]), int(self.odd_ends[last]))
        block = np.repeat(np.arange(last - first), np.diff(self.odd_ends[first : last + 1].astype(np.int64)))
        rows[block, self.odd_places[odd]] = self.odd_values[odd]
        rows += self.least[first:last, None]
        return rows.reshape(-1)[: self.n - first * BLOCK]


def _shards(batches: Iterator[pa.RecordBatch], tokenizer: str, end: int) -> Iterator[pa.RecordBatch]:
    codec, part, shard = Codec(tokenizer), TaskContext.get().partitionId(), 0
    ids, found, held = [], [], 0
    last = np.array([end], dtype=np.uint32)

    def closed() -> pa.RecordBatch:
        lengths = np.array([len(one) for one in found], dtype=np.uint32)
        content = pack_blocks(lengths) + pack_blocks(np.concatenate(found))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([shard], pa.int32()),
                pa.array([held], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.concat_arrays(ids)),
                pa.array([content], pa.binary()),
            ],
            names=["part", "shard", "n_tokens", "doc_ids", "content"],
        )

    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            keys, texts = batch.slice(start, SLICE).columns
            for i, text in enumerate(texts.to_pylist()):
                one = np.concatenate([codec.encode(text or ""), last])
                if found and held + len(one) > SHARD:
                    yield closed()
                    ids, found, held, shard = [], [], 0, shard + 1
                ids.append(keys.slice(i, 1))
                found.append(one)
                held += len(one)
    if found:
        yield closed()


def write(
    docs: DataFrame, path: str, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", end: int = END
) -> None:
    """Encode `text`, append the `end` id to each document, and write the file at `path`."""
    tokenizer = load(tokenizer_path)
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.col(text).alias("whole_text"),
        F.xxhash64(text).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    fields = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(rows.schema["id"].dataType)),
            T.StructField("content", T.BinaryType()),
        ]
    )
    order = ["id", "tie", "row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "whole_text")
    packed = ordered.mapInArrow(lambda batches: _shards(batches, tokenizer, end), fields)
    packed.write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, shard, keys, content in zip(*batch.columns, strict=True):
            data = content.as_py()
            counts = Blocks(data)
            lengths = counts.read().astype(np.int64)
            ids = Blocks(data, counts.end).read().astype("<u4")
            ends = np.cumsum(lengths)
            sums = [
                zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)
            ]
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part.as_py(), np.int32)),
                    pa.array(np.full(n, shard.as_py(), np.int32)),
                    keys.values,
                    pa.array(ends - lengths),
                    pa.array(lengths),
                    pa.array(sums, pa.int64()),
                ],
                names=["part", "shard", "doc_id", "place", "n_tokens", "ids_crc32"],
            )


def documents_in(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, unpacked from the file at `path`."""
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType
    fields = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("doc_id", kind),
            T.StructField("place", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    earlier = lambda window: F.coalesce(
        F.sum("n_tokens").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    parts = parts.select("part", earlier(Window.orderBy("part")).alias("before_part"))
    within = earlier(Window.partitionBy("part").orderBy("shard")).alias("before")
    starts = shards.select("part", "shard", within).join(parts, "part")
    found = shards.select("part", "shard", "doc_ids", "content").mapInArrow(_documents, fields)
    return found.join(starts, ["part", "shard"]).select(
        "doc_id",
        (F.col("before_part") + F.col("before") + F.col("place")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
