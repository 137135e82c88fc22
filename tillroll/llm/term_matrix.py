"""A sparse document-term matrix in CSR shards, over one dictionary of all words.

A shard is a stretch of documents of one task: `docs` (one struct per matrix row), `starts` (where each
row begins, and where the last one ends), `terms` (column numbers) and `counts`, all three as packed
numbers that `unpacked` reads. Words are encoded in two steps. Each task numbers
its distinct words in order of appearance; then only those, not the text's words, are ranked in
hash buckets. A word's number in the global dictionary is its rank times the number of buckets plus
its bucket: unique, and without gaps but for those between the least and the fullest bucket. A bucket's
numbers go back to each task as one row of packed slots and numbers, not as a row per word.

Scale: a word that every document holds is shuffled once per task, so common words weigh no more
than others. The dictionary is a table like any other: nothing of it is broadcast or collected. A bucket's
words are ranked together, and buckets are BUCKETS_PER_PARTITION times the shuffle partitions. A
shard closes at SHARD_BYTES of text or SHARD_DOCS documents; a task holds one shard and its own
distinct words, which follow the size of an input split or the longest text. Shards are stored in
the shared folder before and after their words get their numbers.

Defined cases: words are the maximal runs without the six ASCII separators, compared byte by byte.
NULL and empty texts are rows without entries. Equal rows are rows of their own. Kept columns are
carried by place, so their names can't clash. An empty table has no shards and no words.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import ship
from tillroll.session import scratch_path

ship(__name__)

SHARD_BYTES = 4 << 20
SHARD_DOCS = 4096
SLICE = 256
BUCKETS_PER_PARTITION = 8
PARTS = ["starts", "slots", "counts"]

Measure = Callable[[bytes], int]


def _new_slots() -> defaultdict[bytes, int]:
    """Numbers for words, in order of appearance."""
    return defaultdict(count().__next__)


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers as zstd over their differences, first the lowest bytes of all, then the next."""
    steps = np.diff(numbers.astype(np.int64), prepend=np.int64(0))
    planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.cumsum(np.frombuffer(planes, np.uint8).reshape(8, n).T.copy().view(np.int64).ravel())


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *parts])


class _Shard:
    """The rows of one open shard. `slots`, the numbers of the task's words, goes on from shard to shard."""

    def __init__(self, slots: defaultdict[bytes, int]) -> None:
        self.slots, self.known = slots, len(slots)
        self.docs: list[pa.StructArray] = []
        self.starts, self.terms, self.counts = [0], [], []
        self.size = 0

    def add(self, text: bytes) -> None:
        # bytes.split() parts at exactly the six ASCII separators.
        found = Counter(text.split())
        slots = np.fromiter(map(self.slots.__getitem__, found), np.int64, len(found))
        order = np.argsort(slots)
        self.terms.append(slots[order])
        self.counts.append(np.fromiter(found.values(), np.int64, len(found))[order])
        self.starts.append(self.starts[-1] + len(found))
        self.size += len(text)

    def full(self) -> bool:
        return self.size >= SHARD_BYTES or len(self.starts) > SHARD_DOCS

    def row(self, task: int, fields: T.StructType) -> pa.RecordBatch:
        docs = pa.concat_arrays(self.docs)
        fresh = list(islice(self.slots, self.known, None))
        made = [pa.array([task], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)]
        parts = (np.array(self.starts), _joined(self.terms), _joined(self.counts))
        made += [pa.array([packed(part)], pa.binary()) for part in parts]
        made += [pa.array([self.known], pa.int32()), pa.array([fresh], pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays(made, names=fields.names)


def _sharder(fields: T.StructType, measures: list[Measure]):
    names = fields["docs"].dataType.elementType.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        shard = _Shard(_new_slots())
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                *kept, given = batch.slice(start, SLICE).columns
                texts = [text or b"" for text in given.to_pylist()]
                kept += [pa.array([measure(text) for text in texts], pa.int64()) for measure in measures]
                docs = pa.StructArray.from_arrays(kept, names=names)
                taken = 0
                for i, text in enumerate(texts):
                    shard.add(text)
                    if shard.full():
                        shard.docs.append(docs.slice(taken, i + 1 - taken))
                        yield shard.row(task, fields)
                        taken, shard = i + 1, _Shard(shard.slots)
                if taken < len(docs):
                    shard.docs.append(docs.slice(taken))
        if shard.docs:
            yield shard.row(task, fields)

    return run


def _ranked(bucket: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """A bucket's distinct words, the rank of each, and which of them each row holds."""
    rows = bucket["word"].combine_chunks().dictionary_encode()
    ranks = np.empty(len(rows.dictionary), np.int64)
    ranks[pc.sort_indices(rows.dictionary).to_numpy()] = np.arange(len(ranks))
    return rows.dictionary, ranks, rows.indices.to_numpy()


def _slices(numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The stretches of numbers between the ends, as bytes."""
    offsets = pa.py_buffer((ends * numbers.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(numbers)])


def _numberer(buckets: int):
    def run(bucket: pa.Table) -> pa.Table:
        """Per task that holds words of the bucket, their slots and their column numbers."""
        _, ranks, place = _ranked(bucket)
        terms = ranks[place] * buckets + bucket["bucket"][0].as_py()
        tasks = bucket["task"].to_numpy()
        order = np.argsort(tasks, kind="stable")
        own, starts = np.unique(tasks[order], return_index=True)
        ends = np.append(starts, len(tasks))
        slots = bucket["slot"].to_numpy()[order]
        return pa.table({"task": pa.array(own, pa.int32()), "slots": _slices(slots, ends), "terms": _slices(terms[order], ends)})

    return run


def _speller(buckets: int):
    def run(bucket: pa.Table) -> pa.Table:
        """The bucket's part of the dictionary."""
        words, ranks, _ = _ranked(bucket)
        return pa.table({"term": ranks * buckets + bucket["bucket"][0].as_py(), "word": words})

    return run


def _scattered(numbers: pa.Table) -> pa.Table:
    """One task's numbers of its words, packed in the order of their slots."""
    slots = np.frombuffer(b"".join(numbers["slots"].to_pylist()), np.int32)
    terms = np.empty(len(slots), np.int64)
    terms[slots] = np.frombuffer(b"".join(numbers["terms"].to_pylist()), np.int64)
    return pa.table({"task": numbers["task"].slice(0, 1), "numbers": pa.array([terms.tobytes()], pa.binary())})


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots become column numbers."""
    for batch in batches:
        docs, starts, slots, counts, numbers = batch.columns
        terms = []
        for own, known in zip(slots, numbers):
            # A task without a word has no numbers, and its shards no slots.
            table = np.frombuffer(known.as_py() or b"", np.int64)
            terms.append(packed(table[unpacked(own.as_py())]))
        made = [docs, starts, pa.array(terms, pa.binary()), counts]
        yield pa.RecordBatch.from_arrays(made, names=["docs", "starts", "terms", "counts"])


def _stored(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """As `staged`, but packed tighter: long lists of small numbers."""
    path = scratch_path(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def build(
    spark: SparkSession,
    docs: DataFrame,
    text: str = "text",
    keep: dict[str, Column] | None = None,
    measures: dict[str, Measure] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The shards (docs, starts, terms, counts), and the dictionary (term, word as bytes).

    Each matrix row carries in its struct the expressions in `keep`, by default all columns, and
    whole numbers that `measures` take of the text's bytes.
    """
    keep = {name: F.col(f"`{name}`") for name in docs.columns} if keep is None else keep
    measures = measures or {}
    columns = [column.alias(f"kept_{i}") for i, column in enumerate(keep.values())]
    row = T.StructType([T.StructField(f.name, f.dataType) for f in docs.select(*columns).schema])
    for i in range(len(measures)):
        row = row.add(f"measure_{i}", "long")
    fields = T.StructType().add("task", "integer").add("docs", T.ArrayType(row))
    for name in PARTS:
        fields = fields.add(name, "binary")
    fields = fields.add("known", "integer").add("words", T.ArrayType(T.BinaryType()))
    given = docs.select(*columns, F.col(f"`{text}`").cast("binary").alias("given"))
    local = _stored(spark, given.mapInArrow(_sharder(fields, list(measures.values())), fields), "local-shards")

    words = local.select("task", "known", F.posexplode("words").alias("at", "word"))
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int").alias("bucket")
    dealt = words.select("task", (F.col("known") + F.col("at")).alias("slot"), "word", bucket).groupBy("bucket")
    encoding = dealt.applyInArrow(_numberer(buckets), "task int, slots binary, terms binary")
    numbers = encoding.groupBy("task").applyInArrow(_scattered, "task int, numbers binary")
    names = dict(zip(row.names, [*keep, *measures]))
    renamed = F.transform("docs", lambda doc: F.struct(*(doc[place].alias(name) for place, name in names.items())))
    joined = local.join(numbers, "task", "left").select(renamed.alias("docs"), *PARTS, "numbers")
    shape = T.StructType([joined.schema["docs"]])
    for name in ("starts", "terms", "counts"):
        shape = shape.add(name, "binary")
    shards = _stored(spark, joined.mapInArrow(_encode, shape), "shards")
    return shards, words.select("word", bucket).groupBy("bucket").applyInArrow(_speller(buckets), "term long, word binary")


def row_totals(shards: DataFrame) -> DataFrame:
    """Per matrix row its struct `doc`, `n_words` (the row's sum) and `n_terms` (its nonzero entries)."""
    row = shards.schema["docs"].dataType.elementType
    shape = T.StructType().add("doc", row).add("n_words", "long").add("n_terms", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, *parts in zip(*batch.columns):
                starts, terms, counts = (unpacked(part.as_py()) for part in parts)
                # The sums and the numbers of nonzero entries up to each place.
                totals = (np.cumsum(np.concatenate([[0], each])) for each in (counts, terms >= 0))
                made = [docs.values, *(pa.array(np.diff(total[starts]), pa.int64()) for total in totals)]
                yield pa.RecordBatch.from_arrays(made, names=shape.names)

    return shards.select("docs", "starts", "terms", "counts").mapInArrow(run, shape)
