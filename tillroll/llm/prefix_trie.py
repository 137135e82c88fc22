"""A trie of conversation prefixes, with totals over subtrees by depth-band rollup.

A node is a distinct sequence of first turns. It is known by the exclusive or of 128-bit hashes of its
turns, each hashed with its place, so that a running aggregate gives the keys of all prefixes.
Totals over subtrees come by bands of BAND depths: a node is exploded only to its ancestors in its own
band. The roots of the bands form a trie of their own, BAND times flatter, which is rolled up in the
same way; a band root's finished total is then exploded to its ancestors in the band above. So a
node meets at most BAND ancestors per level, and levels grow with the logarithm of the greatest
depth to the base BAND.

Scale: turns get their places by a range sort, so a conversation that holds a third of all turns is
spread over tasks; running aggregates go by bands of a conversation, then over its bands, and so on.
Texts are dropped after that sort: all else moves hashes. A prefix that very many conversations share is
aggregated per task before it is shuffled, and the ids that end at a node are joined in
pieces of bounded size, which one task digests in order as a stream.

Defined cases: turns come by number (NULL first), then role and text; equal rows are turns of
their own. NULL roles and texts are empty. Rows without a conversation id belong to no conversation
and are left out. Other columns are ignored. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import ship, staged
from tillroll.llm.places import numbered
from tillroll.sinks.staging import stage

ship(__name__)

BAND = 32
# Conversations whose first turns lie in one stretch of so many turns share a piece of joined ids.
STRETCH = 8192
KEY = ["low", "high"]
SUMS = ["n_leaves", "saved_tokens"]


def turns(
    spark: SparkSession, rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(conv, position, low, high, bytes) per turn, positions from 0, and (conv, first, n) per conversation."""
    said = rows.filter(F.col(f"`{conversation}`").isNotNull()).select(
        F.col(f"`{conversation}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{speaker}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    hashed = said.withColumns(
        {
            "low": F.xxhash64("role", "text"),
            "high": F.xxhash64(F.lit("second"), "role", "text"),
            "bytes": F.octet_length("text").cast("long"),
        }
    )
    placed = numbered(spark, hashed, ["conv", "turn", "role", "text"], keep=["conv", "low", "high", "bytes"])
    sizes = placed.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    sizes = staged(spark, sizes, "conversations")
    position = (F.col("place") - F.col("first")).alias("position")
    return placed.join(sizes, "conv").select("conv", position, "low", "high", "bytes"), sizes


def with_borrowed_heads(
    said: DataFrame, sizes: DataFrame, head: Column, lender: Column, longest: int
) -> DataFrame:
    """Each conversation with its first `head` turns replaced by the first `head` of the conversation `lender`.

    (conv, first, n_turns, depth, low, high, bytes), depth 0 being a row without a turn. `head`, at most
    `longest`, and `lender` are expressions of `conv`.
    """
    plan = sizes.withColumns({"head": head, "lender": lender})
    lenders = sizes.select(F.col("conv").alias("lender"), F.col("n").alias("lent"))
    taken = F.least("head", F.coalesce("lent", F.lit(0)))
    n_turns = (taken + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("n_turns")
    plan = plan.join(lenders, "lender", "left").select("conv", "first", "lender", "head", taken.alias("taken"), n_turns)
    same = ["conv", "first", "n_turns"]
    own = said.join(plan, "conv").filter(F.col("position") >= F.col("head"))
    own = own.select(*same, (F.col("position") - F.col("head") + F.col("taken") + 1).alias("depth"), *KEY, "bytes")
    heads = said.filter(F.col("position") < longest).withColumnRenamed("conv", "lender")
    lent = heads.join(plan, "lender").filter(F.col("position") < F.col("head"))
    lent = lent.select(*same, (F.col("position") + 1).alias("depth"), *KEY, "bytes")
    nothing = F.lit(0).cast("long")
    roots = plan.select(*same, nothing.alias("depth"), *(nothing.alias(name) for name in [*KEY, "bytes"]))
    return own.unionByName(lent).unionByName(roots)


def _running(rows: DataFrame, highest: int) -> DataFrame:
    """`rows` of (conv, depth, low, high, ...) with low and high as running exclusive ors over depth."""
    band = F.floor(F.col("depth") / BAND).cast("long")
    so_far = Window.partitionBy("conv", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("band", band)
    summed = inside.withColumns({name: F.bit_xor(name).over(so_far) for name in KEY})
    if highest < BAND:
        return summed.drop("band")
    bands = inside.groupBy("conv", F.col("band").alias("depth")).agg(*(F.bit_xor(name).alias(name) for name in KEY))
    before = _running(bands, highest // BAND).select(
        "conv", (F.col("depth") + 1).alias("band"), *(F.col(name).alias(f"{name}_before") for name in KEY)
    )
    joined = summed.join(before, ["conv", "band"], "left")
    whole = {name: F.col(name).bitwiseXOR(F.coalesce(f"{name}_before", F.lit(0))) for name in KEY}
    return joined.withColumns(whole).select(*rows.columns)


def prefixes(spark: SparkSession, sequences: DataFrame) -> tuple[DataFrame, int]:
    """The sequences' rows with low and high as keys of their prefixes, up_low and up_high as the parents'.

    The rows are stored; the second value is the greatest depth.
    """
    turn = F.col("depth") > 0
    own = sequences.withColumns(
        {
            "low": F.when(turn, F.xxhash64("depth", "low", "high")).otherwise(0),
            "high": F.when(turn, F.xxhash64(F.lit("second"), "depth", "low", "high")).otherwise(0),
        }
    ).withColumns({"up_low": F.col("low"), "up_high": F.col("high")})
    rows, seen = stage(spark, own, "sequences", deepest=F.max("depth"))
    deepest = seen["deepest"] or 0
    parents = {f"up_{name}": F.col(name).bitwiseXOR(F.col(f"up_{name}")) for name in KEY}
    return staged(spark, _running(rows, deepest).withColumns(parents), "prefixes"), deepest


def _banded(rows: DataFrame, deepest: int) -> DataFrame:
    """`rows` with `above`, the keys of the prefixes above in the band, from the band's root down.

    A band's root, other than the trie's, also comes as the `lower` edge of the band above it.
    """
    own = rows.withColumns({"band": F.floor(F.col("depth") / BAND).cast("long"), "lower": F.lit(False)})
    if deepest >= BAND:
        edges = own.filter((F.col("depth") > 0) & (F.col("depth") % BAND == 0))
        own = own.unionByName(edges.withColumns({"band": F.col("band") - 1, "lower": F.lit(True)}))
    # At most BAND + 1 rows of one conversation meet.
    higher = Window.partitionBy("conv", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return own.withColumn("above", F.collect_list(F.struct(*KEY)).over(higher)).drop("band")


def _to_ancestors(nodes: DataFrame, targets: Column, *values: Column) -> DataFrame:
    return nodes.select(F.explode(targets).alias("to"), *values).select("to.low", "to.high", *SUMS)


def _rolled_up(spark: SparkSession, nodes: DataFrame, rows: DataFrame, deepest: int) -> DataFrame:
    """(low, high, SUMS) over whole subtrees.

    `nodes` has low, high, lower, above and, where not `lower`, the SUMS of the node itself; `rows`
    has a row per conversation and depth.
    """
    inner = nodes.filter("not lower")
    itself = F.array(F.struct(*KEY))
    parts = _to_ancestors(inner, F.concat("above", itself), *map(F.col, SUMS))
    if deepest >= BAND:
        root = F.get(F.concat("above", itself), F.lit(0)).alias("root")
        bands = inner.select(root, *SUMS).groupBy("root").agg(*(F.sum(name).alias(name) for name in SUMS))
        flat = rows.filter(F.col("depth") % BAND == 0).select("conv", (F.col("depth") / BAND).cast("long").alias("depth"), *KEY)
        flat_nodes = _banded(flat, deepest // BAND).groupBy(*KEY, "lower").agg(F.min(F.struct("conv", "above")).alias("one"))
        flat_nodes = flat_nodes.withColumn("root", F.struct(*KEY)).join(bands, "root").select(*KEY, "lower", "one.above", *SUMS)
        done = _rolled_up(spark, staged(spark, flat_nodes, "band-roots"), flat, deepest // BAND)
        edges = nodes.filter("lower").select(*KEY, "above").join(done, KEY)
        parts = parts.unionByName(_to_ancestors(edges, F.col("above"), *map(F.col, SUMS)))
    return parts.groupBy(*KEY).agg(*(F.sum(name).alias(name) for name in SUMS))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key, of its pieces joined by commas; pieces come in order, and only one is held."""

    def pieces() -> Iterator[tuple[tuple[int, int], str]]:
        for batch in batches:
            low, high, piece = (column.to_pylist() for column in batch.columns)
            yield from zip(zip(low, high), piece)

    def packed(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*found)], names=[*KEY, "ends_sha256"])

    found = []
    for key, group in groupby(pieces(), key=lambda pair: pair[0]):
        digest = hashlib.sha256()
        for number, (_, piece) in enumerate(group):
            digest.update((f",{piece}" if number else piece).encode())
        found.append((*key, digest.hexdigest()))
        if len(found) == 4096:
            yield packed(found)
            found = []
    if found:
        yield packed(found)


def _ends(rows: DataFrame) -> DataFrame:
    """(low, high, ends_sha256) of the nodes where conversations end."""
    ending = rows.filter(F.col("depth") == F.col("n_turns"))
    # `first` rises with the id, so pieces by stretches of it are in the order of ids.
    piece = F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",")
    pieces = ending.groupBy(*KEY, F.floor(F.col("first") / STRETCH).alias("stretch")).agg(piece.alias("piece"))
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "stretch")
    return ordered.select(*KEY, "piece").mapInArrow(_digests, "low long, high long, ends_sha256 string")


def trie(spark: SparkSession, sequences: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, SUMS, ends_sha256.

    `sequences` has (conv, first, n_turns, depth, low, high, bytes): a row per turn and one of depth
    0 per conversation; `first` is any number that rises with `conv`, at most STRETCH of them
    between two multiples of it.
    """
    rows, deepest = prefixes(spark, sequences)
    ends = F.col("depth") == F.col("n_turns")
    grouped = _banded(rows, deepest).groupBy(*KEY, "lower").agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if(ends).alias("n_ends"),
        F.min(F.struct("conv", "depth", "bytes", "up_low", "up_high", "above")).alias("one"),
    )
    saved = ((F.col("n_convs") - 1) * F.col("one.bytes")).alias("saved_tokens")
    leaf = F.when(F.col("n_ends") == F.col("n_convs"), 1).otherwise(0).cast("long").alias("n_leaves")
    nodes = staged(
        spark, grouped.select(*KEY, "lower", "one.*", "n_convs", leaf, saved), "nodes"
    )
    inner = nodes.filter("not lower")
    children = inner.filter("depth > 0").groupBy("up_low", "up_high").agg(F.count(F.lit(1)).alias("n_children"))
    children = children.select(F.col("up_low").alias("low"), F.col("up_high").alias("high"), "n_children")
    totals = _rolled_up(spark, nodes, rows, deepest)
    parents = inner.select(
        F.col("low").alias("up_low"), F.col("high").alias("up_high"), F.col("conv").alias("parent_conv_id")
    )
    own = inner.select(*KEY, "conv", "depth", "up_low", "up_high", "n_convs")
    # Nodes stay on the left: many of them may share a parent, and only a left side is split by AQE.
    found = own.join(totals, KEY).join(children, KEY, "left").join(_ends(rows), KEY, "left").join(
        parents, ["up_low", "up_high"], "left"
    )
    no_ends = hashlib.sha256(b"").hexdigest()
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(no_ends)).alias("ends_sha256"),
    )
