"""New landing files as a stream: each file is handed on once, by name, in batches.

The stream carries paths only. Reading the rows per file keeps every header its own, so files
whose columns differ or change order stay right.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.layers import LANDING_PREFIX
from tillroll.plans.run import LandingFile

# Fixed value: the CSV suffix in any case.
CSV_GLOB = "*.[cC][sS][vV]"

# Fixed value: the columns of a file listing.
LISTING = "path string, modificationTime timestamp, length bigint, content binary"


# The driver plans one scan per file of a batch; more files than this come in further batches.
FILES_PER_BATCH = 200

# A file counts however old its time stamp is. The price: the source keeps the names of all files it
# has seen in the driver's memory, where by default it forgets those older than a week.
ANY_AGE = "36500d"


def new_files(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(uri, key, landed) of each CSV below the folder; file contents are not read."""
    listed = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("pathGlobFilter", CSV_GLOB)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
        .load(folder)
    )
    relative = F.substring_index("path", folder.rstrip("/") + "/", -1)
    return listed.select(
        F.col("path").alias("uri"),
        F.concat(F.lit(LANDING_PREFIX), relative).alias("key"),
        F.col("modificationTime").alias("landed"),
    )


def start(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    bucket: str,
    on_files: Callable[[list[LandingFile]], object],
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Hand each batch of files not seen before to `on_files`, by landing time and key; then stop.

    A batch that dies is repeated, so `on_files` must bear a replay; `run_files` does.
    """

    def run_batch(files: DataFrame, _batch: int) -> None:
        # At most `files_per_batch` names come to the driver; the files' rows never do.
        landed = sorted(files.collect(), key=lambda row: (row.landed, row.key))
        on_files([LandingFile(row.uri, bucket, row.key) for row in landed])

    return (
        new_files(spark, folder, files_per_batch)
        .writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
