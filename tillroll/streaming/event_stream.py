"""Notifications that start runs: each object-created notification hands its file on, once.

A file that is overwritten is notified again, with another sequencer, and so comes again; time stamps
of files play no part. Notifications may be delivered more than once: copies are dropped by
(bucket, key, sequencer) for as long as `remember` says after the first one arrived. A copy that
comes later only costs a replay, which changes nothing. Because arrival is the watermark's clock, no
notification is ever too late.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.layers import LANDING_PREFIX
from tillroll.plans.run import LandingFile
from tillroll.sources.events import landing_events
from tillroll.sources.landing import LISTINGS_AT_ONCE, listed_files
from tillroll.streaming.landing_stream import ANY_AGE, FILES_PER_BATCH

REMEMBER = "7 days"
NOTIFICATIONS_PER_BATCH = 1000


@dataclass(frozen=True)
class EventBatch:
    """Files to run, in the order of their notifications; what was dropped as malformed; files no longer there."""

    files: list[LandingFile]
    malformed: int = 0
    missing: tuple[LandingFile, ...] = ()

    def portions(self, size: int = FILES_PER_BATCH) -> Iterator[list[LandingFile]]:
        """The files in runs of at most `size`."""
        for start in range(0, len(self.files), size):
            yield self.files[start : start + size]


def store_uri(bucket: str, key: str) -> str:
    return f"s3://{bucket}/{key}"


def new_notifications(
    spark: SparkSession, folder: str, prefix: str = LANDING_PREFIX, remember: str = REMEMBER, files_per_batch: int = NOTIFICATIONS_PER_BATCH
) -> DataFrame:
    """`landing_events` of the notification files below the folder, one JSON text per line, without copies."""
    bodies = (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
        .option("recursiveFileLookup", True)
        .text(folder)
    )
    # What has neither sequencer nor time can't be told from a copy, so it counts as new.
    token = F.when(~F.col("malformed"), F.coalesce("sequencer", "event_time"))
    events = landing_events(bodies, prefix=prefix).withColumns(
        {"token": F.coalesce(token, F.expr("uuid()")), "arrived": F.current_timestamp()}
    )
    return events.withWatermark("arrived", remember).dropDuplicatesWithinWatermark(["bucket", "key", "token"])


def _still_there(spark: SparkSession, uri: str) -> bool:
    try:
        return bool(listed_files(spark, [uri])[uri])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def start(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    on_batch: Callable[[EventBatch], object],
    uri_of: Callable[[str, str], str] = store_uri,
    prefix: str = LANDING_PREFIX,
    remember: str = REMEMBER,
    files_per_batch: int = NOTIFICATIONS_PER_BATCH,
) -> StreamingQuery:
    """Hand the files of each batch of new notifications to `on_batch`; then stop.

    A file that is notified several times in a batch comes once, where its last notification is. A
    batch that dies is repeated, so `on_batch` must bear a replay; `run_files` does.
    """

    def run_batch(events: DataFrame, _batch: int) -> None:
        # One action, since each would run the state again; as many names as the batch has notifications.
        last = F.max(F.struct(F.col("event_time"), F.length("sequencer").alias("digits"), F.col("sequencer")))
        found = events.groupBy("bucket", "key").agg(
            last.alias("last"), F.count_if(~F.col("malformed")).alias("n"), F.count_if("malformed").alias("malformed")
        ).collect()
        if not found:
            # The stream ends with a batch of its own to forget old notifications.
            return
        named = sorted((row for row in found if row.n), key=_order)
        files = [LandingFile(uri_of(row.bucket, row.key), row.bucket, row.key) for row in named]
        with ThreadPoolExecutor(LISTINGS_AT_ONCE) as calls:
            there = list(calls.map(lambda file: _still_there(spark, file.uri), files))
        on_batch(
            EventBatch(
                [file for file, held in zip(files, there) if held],
                sum(row.malformed for row in found),
                tuple(file for file, held in zip(files, there) if not held),
            )
        )

    return (
        new_notifications(spark, folder, prefix, remember, files_per_batch)
        .writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _order(row) -> tuple:
    """By time, then sequencer (a hexadecimal number), then name; what is missing comes first."""
    return (row.last.event_time or "", row.last.digits or 0, row.last.sequencer or "", row.bucket, row.key)
