"""Dense numbers for rows in one total order, without a task that sees them all.

Rows are sorted by ranges; a row's number is its place in its range plus the rows of the ranges
before. Only the number of rows per range comes to the driver, a long per shuffle partition.

Defined cases: rows that are equal in the order are told apart by a tie-breaker, so that even one
row repeated without end is spread over ranges. An empty table stays empty.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import staged, unused_name

# monotonically_increasing_id() holds the partition above this many bits.
ID_BITS = 33


def numbered(
    spark: SparkSession, rows: DataFrame, order: list[str], name: str = "place", keep: list[str] | None = None
) -> DataFrame:
    """`rows` (or their columns in `keep`) with the column `name`: 0 for the first row by `order`, NULL
    first, 1 for the next, and so on."""
    columns = rows.columns if keep is None else keep
    spot, tie, stretch = (unused_name([*rows.columns, name], wish) for wish in ("spot", "tie", "stretch"))
    ranged = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, tie)
    sorted_rows = ranged.sortWithinPartitions(*order, tie).select(*columns)
    # Stored, since ranges may differ between two runs and the places are read twice.
    placed = staged(spark, sorted_rows.withColumn(spot, F.monotonically_increasing_id()), "places")
    cut = placed.withColumn(stretch, F.shiftright(spot, ID_BITS))
    sizes = sorted(cut.groupBy(stretch).agg(F.count(F.lit(1)).alias("n"), F.min(spot).alias("least")).collect())
    before = accumulate((size for _, size, _ in sizes), initial=0)
    shifts = [(number, shift - least) for (number, _, least), shift in zip(sizes, before)]
    # One row per range of the sort: as many as shuffle partitions, whatever the table's size.
    shift = F.broadcast(spark.createDataFrame(shifts, f"{stretch} long, shift long").withColumnRenamed("shift", name))
    return cut.join(shift, stretch).select(*columns, (F.col(spot) + F.col(name)).alias(name))
