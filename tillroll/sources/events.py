"""Object-created notifications, one JSON text per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.cleaning import form_decoded
from tillroll.layers import DAMAGED, LANDING_PREFIX, LANDING_SUFFIX, OBJECT_EVENT


def _parsed(events: DataFrame, body: str) -> DataFrame:
    """Notifications as structs; a body that is missing or damaged has its `damaged` flag set."""
    event = F.from_json(body, OBJECT_EVENT, {"columnNameOfCorruptRecord": DAMAGED})
    parsed = events.select(event.alias("event"))
    return parsed.select(
        "event.Records", (F.col("event").isNull() | F.col(f"event.{DAMAGED}").isNotNull()).alias("damaged")
    )


def _records(parsed: DataFrame) -> DataFrame:
    """(bucket, key) of every record; what a damaged body still shows is not trusted."""
    record = F.explode(F.when(~F.col("damaged"), F.col("Records"))).alias("record")
    return parsed.select(record).select(
        F.col("record.s3.bucket.name").alias("bucket"),
        form_decoded(F.col("record.s3.object.key")).alias("key"),
    )


def event_records(events: DataFrame, body: str = "value") -> DataFrame:
    """(bucket, key) of every record; text without records yields no rows."""
    return _records(_parsed(events, body))


def landing_events(events: DataFrame, body: str = "value", prefix: str = LANDING_PREFIX) -> DataFrame:
    """(bucket, key, event_time, sequencer, malformed): a row per file to ingest, and one per thing dropped as malformed."""
    record = F.explode_outer(F.when(~F.col("damaged"), F.col("Records"))).alias("record")
    rows = _parsed(events, body).select("damaged", record)
    lacking = F.col("record.s3.bucket.name").isNull() | F.col("record.s3.object.key").isNull()
    named = rows.select(
        F.col("record.s3.bucket.name").alias("bucket"),
        form_decoded(F.col("record.s3.object.key")).alias("key"),
        F.col("record.eventTime").alias("event_time"),
        F.col("record.s3.object.sequencer").alias("sequencer"),
        (F.col("damaged") | (F.col("record").isNotNull() & lacking)).alias("malformed"),
    )
    return named.filter(F.col("malformed") | (F.col("bucket").isNotNull() & is_landing_key(F.col("key"), prefix)))


def is_landing_key(key: Column, prefix: str = LANDING_PREFIX) -> Column:
    """The prefix is case-sensitive, the suffix is not."""
    return key.startswith(prefix) & F.lower(key).endswith(LANDING_SUFFIX)


def runnable_keys(events: DataFrame, body: str = "value", prefix: str = LANDING_PREFIX) -> DataFrame:
    """The files to ingest. A record that lacks its bucket or key drops out alone."""
    return event_records(events, body).filter(
        F.col("bucket").isNotNull() & is_landing_key(F.col("key"), prefix)
    )


def started_count(keys: DataFrame) -> DataFrame:
    return keys.agg(F.count(F.lit(1)).alias("started"))


def malformed_count(events: DataFrame, body: str = "value") -> DataFrame:
    """What was dropped: bodies that can't be read, and records without bucket or key."""
    lacking = F.filter(
        "Records", lambda record: record["s3"]["bucket"]["name"].isNull() | record["s3"]["object"]["key"].isNull()
    )
    dropped = F.when(F.col("damaged"), 1).otherwise(F.coalesce(F.size(lacking), F.lit(0)))
    total = F.coalesce(F.sum(dropped), F.lit(0)).cast("long")
    return _parsed(events, body).agg(total.alias("malformed"))
