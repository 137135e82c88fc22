"""SimHash near-dedup by covering locality-sensitive hashing.

Every word shingle is hashed with XXH64; a fingerprint bit is set if more than half of the
hashes set it. Candidates come from structured bit masks (a covering code): bit i gets a
non-zero vector of `max_bits + 1` bits, and there is one mask per non-zero vector v, holding
the bits whose vector has an odd product with v. The vectors of at most `max_bits` differing
bits can't span the whole space, so some v is orthogonal to all of them and its mask leaves
all differing bits out: every pair within the radius agrees under some mask, without
exception. The bit distance is then checked.

Scale: copies shrink to one row per fingerprint by a partial aggregate before the masks apply.
Within a masked bucket, links are found by searching outward from one fingerprint at a time,
so a task emits at most one row per fingerprint and never a list of pairs. A bucket of more
than BLOCK fingerprints is cut into blocks and dealt out as pairs of blocks, so no task holds
more than two, whatever the bucket's size.

Defined cases: A-Z only is lower-cased; words are runs of bytes other than 0x20 and 0x09-0x0D;
fewer words than a shingle make one shingle, and no word (also NULL) gives fingerprint zero.
Repeated shingles count each time. NULL ids take part and never name a component that has
another id. Repeated rows are near-duplicates of each other like any others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import ship, staged, text_key, unused_name
from tillroll.llm.components import components

ship(__name__)

SEED = 42
BLOCK = 4096
CHUNK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_chunks(text: bytes, size: int = CHUNK) -> Iterator[list[bytes]]:
    """The words in lists of bounded size, so that a huge text is never all objects at once."""
    start = 0
    while start < len(text):
        space = _SPACE.search(text, start + size)
        end = space.start() if space else len(text)
        yield text[start:end].lower().split()
        start = end


def _fingerprint(text: bytes | None, shingle: int) -> int:
    ones, total, tail = np.zeros(64, dtype=np.int64), 0, []
    for fresh in _word_chunks(text or b""):
        words = tail + fresh
        runs = zip(*(words[k:] for k in range(shingle)), strict=False)
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs), dtype="<u8")
        ones += _bit_counts(hashes)
        total += len(hashes)
        tail = words[max(0, len(words) - shingle + 1) :]
    if not total and tail:
        ones += _bit_counts(np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], dtype="<u8"))
        total = 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, keys: list[Column], text: str = "text", shingle: int = 3) -> DataFrame:
    """`keys` of each row, then its `fingerprint` as a long."""
    rows = docs.select(*keys, F.col(text).cast("binary").alias("whole_text"))
    fields = rows.drop("whole_text").schema.add("fingerprint", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            prints = pa.array([_fingerprint(text.as_py(), shingle) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*kept, prints], names=[*batch.schema.names[:-1], "fingerprint"])

    return rows.mapInArrow(run, fields)


def masks(max_bits: int) -> list[int]:
    """The covering masks for 64-bit fingerprints, as signed longs."""
    vectors = [1 + i % (2 ** (max_bits + 1) - 1) for i in range(64)]
    found = []
    for v in range(1, 2 ** (max_bits + 1)):
        mask = sum(1 << i for i, vector in enumerate(vectors) if (vector & v).bit_count() % 2)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def _search(prints: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, int]]:
    """Fingerprints reached from a first one by steps within the radius, and that first one."""
    left = prints
    while len(left) > 1:
        root, left = left[0], left[1:]
        edge = [root]
        while edge and len(left):
            near = np.bitwise_count(left ^ edge.pop()) <= max_bits
            if near.any():
                reached, left = left[near], left[~near]
                edge.extend(reached)
                yield reached, root


SMALL = 8


def _group_links(starts: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of consecutive groups; `starts` holds each group's first place and the end."""
    sizes = np.diff(starts)
    own = np.repeat(np.arange(len(sizes)), sizes)
    left, right = [], []
    small = sizes[own] <= SMALL
    for lag in range(1, SMALL):
        if lag >= len(prints):
            break
        near = (own[lag:] == own[:-lag]) & small[lag:]
        near &= np.bitwise_count(prints[lag:] ^ prints[:-lag]) <= max_bits
        left.append(prints[lag:][near])
        right.append(prints[:-lag][near])
    for group in np.flatnonzero(sizes > SMALL):
        for reached, root in _search(np.unique(prints[starts[group] : starts[group + 1]]), max_bits):
            left.append(reached)
            right.append(np.full(len(reached), root, dtype=np.uint64))
    join = lambda parts: np.concatenate([np.empty(0, np.uint64), *parts]).view(np.int64)
    return join(left), join(right)


def _links_in(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by group, the fingerprint last; a group may go on in the next batch."""
    rest = None

    def found(rows: np.ndarray) -> pa.RecordBatch:
        changes = np.flatnonzero((rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)) + 1
        starts = np.concatenate([[0], changes, [len(rows)]])
        a, b = _group_links(starts, np.ascontiguousarray(rows[:, -1]).view(np.uint64), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        rows = np.column_stack([column.to_numpy(zero_copy_only=False) for column in batch.columns])
        rows = rows if rest is None else np.concatenate([rest, rows])
        if not len(rows):
            continue
        last = np.flatnonzero((rows[:, :-1] != rows[-1, :-1]).any(axis=1))
        cut = last[-1] + 1 if len(last) else 0
        rest = rows[cut:]
        if cut:
            yield found(rows[:cut])
    if rest is not None and len(rest):
        yield found(rest)


def links(prints: DataFrame, max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """(a, b) fingerprints that lie in one component; enough of them to connect each.

    `prints` holds distinct fingerprints in its only column.
    """
    keys = prints.toDF("print").select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(i).cast("long").alias("mask"), F.col("print").bitwiseAND(F.lit(mask)).alias("key"))
                    for i, mask in enumerate(masks(max_bits))
                )
            )
        ),
        "print",
    )
    sizes = keys.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block)
    own = F.pmod(F.xxhash64("print"), blocks)
    shared = keys.join(sizes, ["mask", "key"]).select("mask", "key", own.alias("own"), blocks.alias("n"), "print")
    paired = shared.select(
        "mask", "key", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other"), "print"
    ).select("mask", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "print")
    group = ["mask", "key", "i", "j"]
    return (
        paired.repartition(*group)
        .sortWithinPartitions(*group, "print")
        .mapInArrow(lambda batches: _links_in(batches, max_bits), "a long, b long")
    )


def _components_of(spark: SparkSession, prints: DataFrame, least: Column, max_bits: int) -> DataFrame:
    """(fingerprint, least): each fingerprint's component named by the least of all its rows."""
    distinct = staged(spark, prints.groupBy("fingerprint").agg(least.alias("least")), "prints")
    found = components(spark, links(distinct.select("fingerprint"), max_bits))
    rooted = distinct.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("least"))
    return rooted.select("fingerprint", "root").join(names, "root").select("fingerprint", "least")


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """(doc_id, fingerprint as a long, component_id: the smallest id that links lead to)."""
    prints = staged(spark, fingerprints(docs, [F.col(doc_id).alias("doc_id")], text, shingle), "fingerprints")
    found = _components_of(spark, prints, F.min("doc_id"), max_bits)
    return prints.join(found, "fingerprint").select("doc_id", "fingerprint", F.col("least").alias("component_id"))


def keep_one(
    spark: SparkSession,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """One row of each group of near-duplicates, with its columns as they were.

    It is the one with the smallest id (NULL last); rows with one id are ordered by hashes of
    their text and of their other columns. Of rows alike in all columns one stays.
    """
    name = unused_name(docs.columns, "document")
    others = [F.col(f"`{column}`") for column in docs.columns if column not in (doc_id, text)]
    key = text_key(F.col(text))
    document = F.struct(
        F.col(doc_id).isNull().alias("missing"),
        F.col(doc_id).alias("id"),
        key["low"].alias("low"),
        key["high"].alias("high"),
        F.xxhash64(F.to_json(F.struct(F.lit(0).alias("_"), *others))).alias("others"),
    )
    prints = staged(spark, fingerprints(docs, [document.alias("document")], text, shingle), "fingerprints")
    winners = _components_of(spark, prints, F.min("document"), max_bits).select(F.col("least").alias(name)).distinct()
    rows = docs.withColumn(name, document).dropDuplicates([name])
    return rows.join(winners, name, "left_semi").select(*(F.col(f"`{column}`") for column in docs.columns))
