"""Writes that count their rows on the way, and frames staged for several readers."""

from __future__ import annotations

from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.session import scratch_path

# Short stretches share a task up to so many rows; more tasks would cost more than they spread.
ROWS_PER_TASK = 1_000_000


def writers(spark: SparkSession) -> int:
    """The tasks that write a partitioned table: the session's shuffle partitions, or cores if there are more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def clustered(
    frame: DataFrame,
    partition_by: tuple[str, ...],
    sort_by: str | None,
    numbered: str | None = None,
    rows: int = 0,
    longest: int = 1,
) -> DataFrame:
    """Each task writes a stretch of the order (partition values, key), so a day has few files.

    The stretches hold equally many rows: small days share a task, and a hot one is split by key
    over several, each with bounds of its own for later upserts to skip by. The stretches are as
    many as the session's shuffle partitions, or cores if there are more: by size alone, one task
    would create thousands of tiny day folders, whose cost is their creation.

    The column `numbered`, if asked for, gets the number of a row's stretch. The `rows` are then cut into
    stretches of about `longest` each. A task holds several of them if they are short, so that tasks follow
    the rows and not the stretches: each task that writes reads a block of each task before it.
    """
    order = [*partition_by, *([sort_by] if sort_by else [])]
    if not order:
        return frame
    tasks = max(writers(frame.sparkSession), ceil(rows / max(longest, ROWS_PER_TASK)))
    dealt = frame.repartitionByRange(tasks, *order)
    if numbered:
        stretch = F.spark_partition_id()
        if rows > tasks * longest:
            dealt = dealt.sortWithinPartitions(*order)
            # The lower bits of this id count a task's rows.
            place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
            stretch = (stretch + tasks * F.floor(place / longest)).cast("int")
        dealt = dealt.withColumn(numbered, stretch)
        order.insert(len(partition_by), numbered)
    return dealt.sortWithinPartitions(*order)


def write_counted(
    frame: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    sort_by: str | None = None,
    numbered: str | None = None,
    rows: int = 0,
    longest: int = 1,
    dealt: bool = False,
    **measures: Column,
) -> dict[str, Any]:
    """Write Parquet; return `rows` and the measures, taken in the very pass that writes.

    With `numbered`, each stretch of a partition goes to a folder of its own, named by that column. A
    frame that is `dealt` and sorted already is written as it lies.
    """
    named = [column.alias(name) for name, column in measures.items()]
    seen = Observation()
    laid = frame if dealt else clustered(frame, partition_by, sort_by, numbered, rows, longest)
    counted = laid.observe(seen, F.count(F.lit(1)).alias("rows"), *named)
    counted.write.mode("overwrite").parquet(path, partitionBy=[*partition_by, *([numbered] if numbered else [])])
    return seen.get


def stage(
    spark: SparkSession, frame: DataFrame, label: str, **measures: Column
) -> tuple[DataFrame, dict[str, Any]]:
    """Write the frame to the shared folder; return it as read back, and what was measured.

    The staged frame's lineage is its files: a lost executor costs a re-read, not a re-run.
    """
    path = scratch_path(spark, label)
    measured = write_counted(frame, path, **measures)
    return spark.read.schema(frame.schema).parquet(path), measured
