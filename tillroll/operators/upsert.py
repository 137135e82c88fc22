"""Keyed upsert of one DataFrame into another.

A matched target row takes every value of its source row, NULLs included; an unmatched
source row is added; no target row is ever removed. The key matches by plain equality, so a
NULL key matches nothing: such target rows stay and such source rows are always added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows without a key match nothing, so they may go anywhere; this many join partitions
# share them instead of one.
KEYLESS_SPREAD = 4096

SPREAD = "_spread"
MATCHED = "_matched"
KIND = "_kind"
HELD, GONE, NEW = 0, 1, 2


def _spread(frame: DataFrame, key: str) -> DataFrame:
    bucket = F.pmod(F.xxhash64(*frame.columns), F.lit(KEYLESS_SPREAD)).cast("int")
    return frame.withColumn(SPREAD, F.when(F.col(key).isNull(), bucket).otherwise(F.lit(0)))


def matched_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Distinct source keys that the target holds; reads only the key column of each."""
    return target.select(key).join(source.select(key), key, "left_semi").distinct()


def repeated_keys(source: DataFrame, key: str) -> DataFrame:
    """Keys of several source rows; counted per task first, so a hot key moves as one row."""
    counted = source.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col(key).isNotNull() & (F.col("n") > 1))


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    matched: DataFrame | None = None,
    places: tuple[str, ...] = (),
    tasks: int = 1,
) -> DataFrame:
    """The target after the upsert, with the target's columns.

    `matched` may bring the source keys that the target holds, if they are known. Fails while
    running if several source rows match one target row. The sides of each join are shuffled
    for that join alone, and the one that may hold a hot key is on the left: only so can AQE
    split the key, or broadcast a right side that proved small.

    With `places`, columns that say where a row lies, `matched` brings the key and place of every target
    row that is replaced. The result is then dealt to so many `tasks` by place and sorted by (places, key),
    and the target needs no shuffle by key before. A place is in one task, so it should be bounded.
    """
    if places:
        return _upsert_in_place(target, source, key, matched, places, tasks)
    columns = target.columns
    keys = [key, SPREAD]
    incoming = _spread(source.select(*columns), key)
    renamed = incoming.select(
        *(F.col(name).alias(f"_new_{name}") for name in columns), *keys, F.lit(True).alias(MATCHED)
    )
    joined = _spread(target, key).join(renamed, keys, "left")
    updated = joined.select(
        *(
            F.when(F.col(MATCHED), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
            for name in columns
        )
    )

    if matched is None:
        matched = matched_keys(target, source, key)
    held = matched.select(key, F.lit(0).alias(SPREAD))
    added = incoming.join(held, keys, "left_anti").select(*columns)
    return updated.unionByName(added).unionByName(_no_ambiguity(source, matched, columns, key))


def _upsert_in_place(
    target: DataFrame, source: DataFrame, key: str, matched: DataFrame, places: tuple[str, ...], tasks: int
) -> DataFrame:
    """The target rows, the replaced ones' keys and the source rows meet in the task of their place."""
    columns = target.columns
    incoming = source.select(*columns)
    # A target row that is there several times becomes as many copies of its source row.
    repeats = repeated_keys(matched, key).select(key, (F.col("n") - 1).alias("_more"))
    copies = incoming.join(repeats, key).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_more"))))
    gone = matched.select(
        *(F.col(n) if n in (key, *places) else F.lit(None).cast(target.schema[n].dataType).alias(n) for n in columns)
    )
    new = incoming.unionByName(copies.select(*columns)).unionByName(_no_ambiguity(source, matched, columns, key))
    kinds = {HELD: target, GONE: gone, NEW: new}
    held, gone, new = (rows.withColumn(KIND, F.lit(kind)) for kind, rows in kinds.items())
    dealt = held.unionByName(gone).unionByName(new).repartition(tasks, *places)
    is_gone = F.max(F.col(KIND) == GONE).over(Window.partitionBy(*places, key))
    left = dealt.withColumn(MATCHED, is_gone).filter((F.col(KIND) == NEW) | ((F.col(KIND) == HELD) & ~F.col(MATCHED)))
    return left.select(*columns).sortWithinPartitions(*places, key)


def _no_ambiguity(
    source: DataFrame, matched: DataFrame, columns: list[str], key: str
) -> DataFrame:
    """No rows; an error if a matched key has several source rows.

    The error depends on counts from both sides of the join, so that no optimizer rule can
    move it to where unmatched or single keys still are.
    """
    hits = matched.groupBy(key).agg(F.count(F.lit(1)).alias("hits"))
    both = repeated_keys(source, key).join(hits, key)
    text = F.concat(F.lit(f"several source rows match {key} "), F.col(key).cast("string"))
    ambiguous = (F.col("n") > 1) & (F.col("hits") > 0)
    nothing = both.filter(F.when(ambiguous, F.raise_error(text)).isNotNull())
    return nothing.select(
        *(F.lit(None).cast(source.schema[name].dataType).alias(name) for name in columns)
    )
