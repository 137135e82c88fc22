"""Embedding near-dedup by lattice hashing.

Each table projects unit vectors at random onto PARTS blocks of eight dimensions and decodes
each block to the nearest point of the E8 lattice; the points of a table together are its cell.
A vector is filed under its own cell and under the neighbouring cells that come next (per block
the PROBES nearest lattice points found in the two cosets of E8), so vectors on either side of a
cell wall meet. Vectors that share a cell of one table are compared by cosine in double
precision; only pairs at or above the threshold link.

Scale: equal vectors shrink to one class by a partial aggregate. First only (cell, class) pairs
are shuffled; vectors follow to the few cells that two classes share. Cells of over BLOCK classes
are dealt out as pairs of blocks, so no task holds more than two, whatever the cell's size. A
task answers with a link count and a component root per vector and never lists pairs: a pair
that shares several cells is counted in the least of them only, which both sides' cell lists tell:
by a product of 0/1 matrices (who holds which lesser cell) where many pairs are near, pair by pair
where few are. Both give the same.

Defined cases: vectors that are NULL, empty or zero, or hold a NULL or a non-finite component,
and rows with a NULL label, link with nothing. Vectors of different lengths don't compare. Rows
of one class (equal vector and label) link with each other. Ids may be NULL or repeat; the
component is the smallest id reachable, NULL only if no row there has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import ship, staged
from tillroll.llm.components import components

ship(__name__)

TABLES = 6
PARTS = 2
PROBES = 3
SCALE = 0.6
SEED = 8
BLOCK = 512
# Near pairs per vector that are compared one by one, how many multiplications count as one
# comparison of cells, and how many cells a matrix has at most. None changes a result.
PAIRS_PER_ROW = 1
PRODUCT_GAIN = 16
WIDTH = 4096


def _nearest_d8(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and a next point of D8 (whole coordinates of even sum) for each row."""
    rows = np.arange(len(points))
    whole = np.rint(points)
    gap = points - whole
    step = np.where(gap >= 0, 1.0, -1.0)
    order = np.argsort(-np.abs(gap), axis=1, kind="stable")
    odd = (whole.sum(axis=1) % 2 != 0).astype(float)
    nearest, following = whole.copy(), whole.copy()
    # An odd sum moves the least certain coordinate. The next point moves the second instead,
    # or, for an even sum, the two least certain.
    nearest[rows, order[:, 0]] += odd * step[rows, order[:, 0]]
    following[rows, order[:, 1]] += step[rows, order[:, 1]]
    following[rows, order[:, 0]] += (1 - odd) * step[rows, order[:, 0]]
    return nearest, following


def lattice_points(points: np.ndarray, probes: int) -> np.ndarray:
    """(rows, probes, 8): E8 points near each row, nearest first, doubled to be whole."""
    found = []
    for shift in (0.0, 0.5):
        found += [near + shift for near in _nearest_d8(points - shift)]
    near = np.stack(found, axis=1)
    distance = ((near - points[:, None, :]) ** 2).sum(axis=2)
    order = np.argsort(distance, axis=1, kind="stable")[:, :probes]
    return np.rint(2 * np.take_along_axis(near, order[:, :, None], axis=1)).astype(np.int64)


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of the last axis."""
    state = np.full(values.shape[:-1], seed, dtype=np.uint64)
    for i in range(values.shape[-1]):
        state = (state ^ values[..., i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        state ^= state >> np.uint64(29)
    return state


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """(rows, tables, cells): the hashed cells that each unit vector is filed under, its own first."""
    random = np.random.default_rng(SEED)
    found = []
    for table in range(tables):
        parts = []
        for part in range(PARTS):
            projection = random.standard_normal((unit.shape[1], 8)) * SCALE
            parts.append(_mixed(lattice_points(unit @ projection, probes), 1 + part))
        joint = [np.stack([parts[i][:, choice[i]] for i in range(PARTS)], axis=1) for choice in product(range(probes), repeat=PARTS)]
        found.append(np.stack([_mixed(one, 1000 + table) for one in joint], axis=1))
    return np.stack(found, axis=1).view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _file(batches: Iterator[pa.RecordBatch], tables: int, probes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, length, vector = batch.columns
        sizes = length.to_numpy()
        for size in np.unique(sizes):
            at = pa.array(np.flatnonzero(sizes == size))
            unit = _unit(_matrix(vector.take(at)))
            for start in range(0, len(unit), 1024):
                found = cells(unit[start : start + 1024], tables, probes)
                found = np.sort(found.reshape(len(found), -1), axis=1)
                ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [node.take(at.slice(start, 1024)), pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))],
                    names=["node", "cells"],
                )


class _Group:
    """The classes that meet in one cell, or in a pair of its blocks."""

    def __init__(self, batch: pa.RecordBatch, threshold: float):
        self.node, self.copies, self.own = (batch.column(name).to_numpy() for name in ("node", "n", "own"))
        self.unit = _unit(_matrix(batch.column("vector")))
        self.cells = batch.column("cells").flatten().to_numpy().reshape(len(self.node), -1)
        self.cell = batch.column("cell")[0].as_py()
        self.within = batch.column("i")[0].as_py() == batch.column("j")[0].as_py()
        self.near = self.unit @ self.unit.T >= threshold
        np.fill_diagonal(self.near, False)
        if not self.within:
            self.near &= self.own[:, None] != self.own[None, :]

    def counts(self) -> np.ndarray:
        """Copies linked with each class by pairs whose least shared cell this is."""
        rows, pairs = np.flatnonzero(self.near.any(axis=1)), int(self.near.sum()) // 2
        # Comparing so few costs less than numbering the cells.
        if pairs <= PAIRS_PER_ROW * len(rows):
            return self._counts_by_pair()
        at, place = np.nonzero(self.cells[rows] < self.cell)
        _, number, held = np.unique(self.cells[rows][at, place], return_inverse=True, return_counts=True)
        common = np.cumsum(held > 1) - 1
        at, number = at[held[number] > 1], common[number[held[number] > 1]]
        n_common = int((held > 1).sum())
        # A multiplication in a product takes far less time than a comparison of two cells.
        if PRODUCT_GAIN * pairs * self.cells.shape[1] ** 2 <= len(rows) ** 2 * n_common:
            return self._counts_by_pair()
        before = np.zeros((len(rows), len(rows)), dtype=bool)
        for start in range(0, n_common, WIDTH):
            inside = (number >= start) & (number < start + WIDTH)
            holds = np.zeros((len(rows), min(WIDTH, n_common - start)), dtype=np.float32)
            holds[at[inside], number[inside] - start] = 1
            before |= holds @ holds.T > 0
        ours = np.triu(self.near[np.ix_(rows, rows)]) & ~before
        total = np.zeros(len(self.node), dtype=np.int64)
        total[rows] = ours @ self.copies[rows] + ours.T @ self.copies[rows]
        return total

    def _counts_by_pair(self) -> np.ndarray:
        total = np.zeros(len(self.node), dtype=np.int64)
        left, right = np.nonzero(np.triu(self.near))
        for start in range(0, len(left), 4096):
            a, b = left[start : start + 4096], right[start : start + 4096]
            # Both lists are sorted and hold this cell: the pair belongs here if no lesser one is shared.
            shared = (self.cells[a][:, :, None] == self.cells[b][:, None, :]).any(axis=2)
            ours = np.take_along_axis(self.cells[a], shared.argmax(axis=1)[:, None], axis=1)[:, 0] == self.cell
            np.add.at(total, a[ours], self.copies[b[ours]])
            np.add.at(total, b[ours], self.copies[a[ours]])
        return total

    def roots(self) -> np.ndarray:
        """A class of each class's component within the group."""
        root = np.full(len(self.node), -1)
        for start in range(len(root)):
            if root[start] >= 0:
                continue
            reached = np.zeros(len(root), dtype=bool)
            edge = np.zeros(len(root), dtype=bool)
            reached[start] = edge[start] = True
            while edge.any():
                edge = self.near[edge].any(axis=0) & ~reached
                reached |= edge
            root[reached] = start
        return self.node[root]


def _compare(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Link counts and roots from rows sorted by group; a group may go on in the next batch.

    Most cells hold no near pair: nothing comes of them.
    """
    rest: list[pa.RecordBatch] = []

    def found(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = _Group(group, threshold)
        if not own.near.any():
            return
        yield pa.RecordBatch.from_arrays(
            [group.column("node"), pa.array(own.counts()), pa.array(own.roots())], names=["node", "links", "root"]
        )

    def ended() -> Iterator[pa.RecordBatch]:
        whole = rest[0] if len(rest) == 1 else pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
        rest.clear()
        return found(whole)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(name).to_numpy() for name in ("length", "cell", "i", "j")])
        label = np.array(batch.column("label").to_pylist(), dtype=object)
        changes = (keys[1:] != keys[:-1]).any(axis=1) | (label[1:] != label[:-1])
        starts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False):
            part = batch.slice(start, end - start)
            if rest and any(
                rest[0].column(name)[0] != part.column(name)[0] for name in ("label", "length", "cell", "i", "j")
            ):
                yield from ended()
            rest.append(part)
    if rest:
        yield from ended()


def _usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def near_duplicates(
    spark: SparkSession,
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    tables: int = TABLES,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row; see the module's text for the cases."""
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("vector")
    ).withColumn("usable", F.coalesce(_usable(F.col("vector"), F.col("label")), F.lit(False)))
    classes = rows.filter("usable").groupBy("label", "vector").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n")
    )
    classes = staged(
        spark, classes.withColumn("node", F.monotonically_increasing_id()).withColumn("length", F.size("vector")), "classes"
    )
    filed = staged(
        spark,
        classes.select("node", "length", "vector").mapInArrow(
            lambda batches: _file(batches, tables, probes), "node long, cells array<long>"
        ),
        "cells",
    )
    kind = classes.select("node", "label", "length")
    group = ["label", "length", "cell"]
    members = filed.join(kind, "node").select("node", "label", "length", F.explode(F.array_distinct("cells")).alias("cell"))
    shared = members.groupBy(*group).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / block)
    own = F.pmod(F.xxhash64("node"), blocks)
    met = members.join(shared, group).select(*group, "node", own.alias("own"), blocks.alias("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    paired = met.select(*group, "node", "own", other).select(
        *group, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node"
    )
    loaded = paired.join(filed, "node").join(classes.select("node", "vector", "n"), "node")
    order = [*group, "i", "j"]
    found = staged(
        spark,
        loaded.repartition(*order)
        .sortWithinPartitions(*order, "node")
        .mapInArrow(lambda batches: _compare(batches, threshold), "node long, links long, root long")
        .filter("links > 0 OR node != root"),
        "compared",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(spark, found.select("node", "root"))
    named = (
        classes.join(reached, "node", "left")
        .join(links, "node", "left")
        .select(
            "label",
            "vector",
            "least",
            F.coalesce("component", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    result = named.join(names, "root").select("label", "vector", "n_links", "component_id")
    key = F.when(F.col("usable"), F.struct("label", "vector")).alias("key")
    joined = rows.select("vec_id", key).join(
        result.select(F.struct("label", "vector").alias("key"), "n_links", "component_id"), "key", "left"
    )
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
